"""Hard negatives beside all products."""

import math

import numpy as np
import pytest
from pyspark.sql import functions as F

from contestry.llm import hard_negatives
from contestry.llm.queries import ORACLE, QUERIES
from tests.oracle import agree

VECTORS = "vec_id long, embedding array<float>, label int"


def brute_force(rows):
    taken = []
    for i, v, label in rows:
        if None not in (i, v, label) and all(x is not None and math.isfinite(x) for x in v):
            taken.append((i, [math.floor(256 * float(np.float32(x))) for x in v], (label + 1) % 10 if i % 7 == 0 else label))
    dot = lambda a, b: sum(x * y for x, y in zip(a, b))
    out = []
    for a, (i, v, label) in enumerate(taken):
        if i % 100:
            continue
        others = sorted((-dot(v, w), j, other) for b, (j, w, other) in enumerate(taken) if b != a)
        for p, j, _ in [x for x in others if x[2] == label][:5]:
            band = [x for x in others if x[2] != label and 80 * -p <= 100 * -x[0] <= 100 * -p][:5]
            out += [(i, j, rank, k, -p, -n) for rank, (n, k, _) in enumerate(band, 1)]
    return sorted(out)


def rows_of(kind):
    r = np.random.default_rng(8)
    if kind == "clusters":  # long and short vectors near few directions, so that ranges prune
        centres = r.normal(size=(6, 8))
        v = centres[r.integers(6, size=700)] * r.choice([0.01, 0.3, 1, 40], size=(700, 1)) + r.normal(size=(700, 8)) * 0.02
    elif kind == "copies":  # a third of all rows alike: ties go by id
        v = r.normal(size=(700, 8))
        v[::3] = v[0]
    else:
        v = r.normal(size=(700, 8)) * (r.random((700, 1)) < 0.9)
    return [(int(i), [float(np.float32(x)) for x in w], int(r.integers(4))) for i, w in enumerate(v)]


@pytest.mark.parametrize("kind", ["clusters", "copies", "spread"])
def test_all_hard_negatives(spark, kind, monkeypatch):
    monkeypatch.setattr(hard_negatives, "BLOCK", 60)
    monkeypatch.setattr(hard_negatives, "TILE", 3)
    rows = rows_of(kind)
    found = hard_negatives.hard_negatives(spark.createDataFrame(rows, VECTORS).repartition(3))
    assert sorted(map(tuple, found.collect())) == brute_force(rows) != []


def test_odd_rows(spark):
    rows = rows_of("spread")[:250]
    rows += [(300, None, 1), (400, [1.0, None], 1), (500, [float("nan")] * 8, 1), (600, [float("inf")] * 8, 1), (None, [1.0] * 8, 1), (800, [1.0] * 8, None), (900, [0.5, 0.25], 1), (1000, [], 2), (1100, [0.0] * 8, 1)]
    rows += [rows[100], rows[100], rows[5], rows[101]]
    docs = spark.createDataFrame(rows, VECTORS).withColumns({"vector": F.lit("x"), "rid": F.lit(1), "length": F.lit(2), "block": F.lit(3)})
    assert sorted(map(tuple, hard_negatives.hard_negatives(docs).collect())) == brute_force(rows)
    assert hard_negatives.hard_negatives(docs.where("false")).count() == 0


def test_products_beyond_doubles_are_an_error(spark):
    rows = spark.createDataFrame([(100, [3e8] * 4, 1), (1, [3e8] * 4, 1)], VECTORS)
    with pytest.raises(Exception, match="beyond"):
        hard_negatives.hard_negatives(rows).collect()


def test_ranges_leave_every_row_that_reaches_the_threshold():
    import pandas as pd

    r = np.random.default_rng(2)
    v = np.round(r.normal(size=(500, 6)) * 100 * r.random((500, 1))).astype(int)
    frame = pd.DataFrame({"vec_id": range(500), "label": 0, "rid": range(500), "vector": list(v), "length": np.sqrt((v**2).sum(1))})
    block, pruned = hard_negatives.Block(frame, 6), 0
    for q in v[:100].astype(float):
        scores, length = v @ q, np.sqrt((q**2).sum())
        for least in np.quantile(scores, [0.1, 0.5, 0.9, 0.99, 1]):
            kept = block.candidates(q, length, least)
            if kept is not None:
                assert set(np.flatnonzero(scores >= least)) <= set(kept)
                pruned += 500 - len(kept)
    assert pruned > 50_000


def test_the_query_on_more_rows(spark):
    agree(spark, QUERIES["op11_hard_negatives"], ORACLE["op11_hard_negatives"], "/root/testdata/sf0.1")
