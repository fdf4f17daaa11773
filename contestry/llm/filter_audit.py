"""Filter interaction audit by contraction of contingency tensors.

Every document falls into one cell of a tensor with an axis of two (pass, fail) for each filter. Spark
counts the cells of each part; whatever order the filters run in, what a step keeps, removes or finds
removed already is a contraction of that tensor: each axis is cut to pass or fail, or summed over, and
one einsum does so for all steps of all orders.

The last filter (exact repeats) needs the smallest doc_id of a text. Rows are counted by text digest
before anything is shuffled by it, so a text that a third of all rows share arrives as a few counted
rows, and the smallest id is compared inside those: texts are never joined back.
"""

from __future__ import annotations

from functools import reduce
from itertools import permutations

import numpy as np
import pandas as pd
from pyspark.sql import Column, DataFrame
from pyspark.sql import Window as W
from pyspark.sql import functions as F

from .common import let, text_of, words_of

#: What a text fails, one letter each; repeats of a text come last, as one more letter.
LEAST_WORDS = 200
SIGNS = r"[#$%&*|]"
REPEATS = "E"
#: Counted in each cell: all documents, those of quality 1, those marked toxic.
MEASURES = ("n", "good", "toxic")
FIGURES = ("kept", "removed", "redundant", "unique_fails", "good_lost", "toxic_lost", "shapley")


def text_failures(text: Column) -> dict[str, Column]:
    """The failure conditions that a text alone decides, by letter."""
    capitals = F.char_length(F.regexp_replace(text, "[^A-Z]+", ""))
    words = words_of(text)
    few = let(words, lambda w: F.struct(F.size(w).alias("all"), F.size(F.array_distinct(w)).alias("different")))
    return {
        "A": few["all"] < LEAST_WORDS,
        "B": few["different"] * 100 < few["all"] * 50,
        "C": capitals.cast("long") * 100 > F.char_length(text).cast("long") * 2,
        "D": text.rlike(SIGNS),
    }


def bits(failures: list[Column]) -> Column:
    """Failures as one number, the first in the highest bit."""
    return reduce(lambda number, failed: number * 2 + failed.cast("int"), failures, F.lit(0))


def cells(docs: DataFrame, labels: DataFrame) -> DataFrame:
    """part, cell (the failures A to E as bits), n, good and toxic: a row for each cell that has documents.

    Of a text's documents, that with the smallest doc_id passes E; documents without doc_id are neither
    smaller nor larger than others and pass. Repeated rows count each. A document is good or toxic where
    any of its labels says so.
    """
    text = text_of(F.col("text"))
    rows = docs.select("doc_id", F.coalesce(F.col("source").cast("string"), F.lit("")).alias("part"), F.unhex(F.md5(text)).alias("digest"), text.alias("text"))
    rows = rows.select("doc_id", "part", "digest", bits(list(text_failures(F.col("text")).values())).alias("fails"))
    # rows without an id never meet a label: a second key spreads them over the join's tasks
    spread = F.when(F.col("doc_id").isNull(), F.xxhash64("digest")).otherwise(F.lit(0).cast("long"))
    counted = rows.groupBy("doc_id", spread.alias("spread"), "digest", "part", "fails").agg(F.count("*").alias("n"))
    marks = labels.groupBy("doc_id").agg(F.max(F.col("quality") == 1).alias("good"), F.max(F.col("toxic") == 1).alias("toxic")).withColumn("spread", F.lit(0).cast("long"))
    marked = counted.join(marks, ["doc_id", "spread"], "left").withColumns({c: F.coalesce(c, F.lit(False)) for c in ("good", "toxic")})
    smallest = F.min(F.when(F.col("doc_id").isNotNull(), F.struct("doc_id", "n")))
    texts = marked.groupBy("digest", "part", "fails", "good", "toxic").agg(F.sum("n").alias("n"), smallest.alias("first"), F.coalesce(F.sum(F.when(F.col("doc_id").isNull(), F.col("n"))), F.lit(0)).alias("unnamed"))
    texts = texts.withColumn("least", F.min("first.doc_id").over(W.partitionBy("digest")))
    passing = F.col("unnamed") + F.when(F.col("first.doc_id") == F.col("least"), F.col("first.n")).otherwise(0)
    both = F.array(F.struct(F.lit(0).alias("e"), passing.alias("n")), F.struct(F.lit(1).alias("e"), (F.col("n") - passing).alias("n")))
    split = texts.select("part", "fails", "good", "toxic", F.explode(both).alias("of")).select("part", (F.col("fails") * 2 + F.col("of.e")).alias("cell"), "good", "toxic", F.col("of.n").alias("n")).where("n > 0")
    return split.groupBy("part", "cell").agg(F.sum("n").alias("n"), *[F.coalesce(F.sum(F.when(F.col(c), F.col("n"))), F.lit(0)).alias(c) for c in ("good", "toxic")])


def selections(filters: str) -> tuple[list[tuple[str, int]], dict[str, np.ndarray]]:
    """All (order, step), and for each question an array [step, filter, 2] of what counts on each axis.

    kept: pass up to this step; removed: pass before, fail here; failing: fail here; alone: fail here,
    pass elsewhere. Axes that a question doesn't name are summed over.
    """
    passed, failed = np.array([1, 0]), np.array([0, 1])
    orders = ["".join(p) for p in permutations(filters)]
    asked = {q: np.ones((len(orders) * len(filters), len(filters), 2), np.int64) for q in ("kept", "removed", "failing", "alone")}
    steps = [(order, at) for order in orders for at in range(len(filters))]
    for i, (order, at) in enumerate(steps):
        here, before = filters.index(order[at]), [filters.index(f) for f in order[:at]]
        asked["kept"][i, [*before, here]] = passed
        asked["removed"][i, before] = passed
        asked["alone"][i] = passed
        for q in ("removed", "failing", "alone"):
            asked[q][i, here] = failed
    return [(order, at + 1) for order, at in steps], asked


def contract(tensor: np.ndarray, chosen: np.ndarray) -> np.ndarray:
    """tensor [measure, 2, 2, ...] cut by chosen [step, filter, 2]: an array [step, measure]."""
    axes = "abcdefghij"[: tensor.ndim - 1]
    return np.einsum(f"m{axes},{','.join('s' + a for a in axes)}->sm", tensor, *np.moveaxis(chosen, 1, 0), optimize=True)


def audit(counts: DataFrame, filters: str) -> DataFrame:
    """From cells, every order of the filters and every step: what it kept, removed, found removed, failed alone and lost, and Shapley sums.

    A group is a part's cells, two to the power of the filters at most.
    """
    shape = (len(MEASURES), *[2] * len(filters))
    steps, asked = selections(filters)
    letters = np.array([order[step - 1] for order, step in steps])

    def of_part(key: tuple, found: pd.DataFrame) -> pd.DataFrame:
        tensor = np.zeros((len(MEASURES), 2 ** len(filters)), np.int64)
        tensor[:, found["cell"]] = found[list(MEASURES)].T
        kept, removed, failing, alone = (contract(tensor.reshape(shape), asked[q]) for q in ("kept", "removed", "failing", "alone"))
        shares = {f: removed[letters == f, 0].sum() for f in filters}
        out = {"kept": kept[:, 0], "removed": removed[:, 0], "redundant": failing[:, 0] - removed[:, 0], "unique_fails": alone[:, 0], "good_lost": removed[:, 1], "toxic_lost": removed[:, 2], "shapley": [shares[f] for f in letters]}
        return pd.DataFrame({"part": key[0], "filter_order": [o for o, _ in steps], "step": [s for _, s in steps], **out})

    return counts.groupBy("part").applyInPandas(of_part, "part string, filter_order string, step int, " + ", ".join(f"{c} long" for c in FIGURES))


def filter_audit(docs: DataFrame, labels: DataFrame) -> DataFrame:
    """The audit of the five filters over all documents, a row for each part, order and step.

    part is the source, null as the empty string. Null texts are empty: they fail A, and E where an
    earlier text is empty or null too. Other columns aren't read; no documents give no rows.
    """
    return audit(cells(docs, labels), "ABCD" + REPEATS)


SQL = r"""
WITH d AS (SELECT doc_id, coalesce(source, '') AS part, coalesce(text, '') AS text, regexp_extract_all(coalesce(text, ''), '[^\x20\x09-\x0D]+') AS w FROM documents),
firsts AS (SELECT text, min(doc_id) AS least FROM d GROUP BY text),
marks AS (SELECT doc_id, bool_or(quality = 1) AS good, bool_or(toxic = 1) AS toxic FROM labels GROUP BY doc_id),
f AS (SELECT part, len(w) < 200 AS "A", 100 * len(list_distinct(w)) < 50 * len(w) AS "B", 100 * len(regexp_extract_all(text, '[A-Z]')) > 2 * length(text) AS "C",
    regexp_matches(text, '[#$%&*|]') AS "D", coalesce(d.doc_id > least, false) AS "E", coalesce(good, false) AS good, coalesce(toxic, false) AS toxic
  FROM d JOIN firsts USING (text) LEFT JOIN marks ON marks.doc_id = d.doc_id),
cell AS (SELECT part, (CASE WHEN "A" THEN 'A' ELSE '' END) || (CASE WHEN "B" THEN 'B' ELSE '' END) || (CASE WHEN "C" THEN 'C' ELSE '' END) || (CASE WHEN "D" THEN 'D' ELSE '' END) || (CASE WHEN "E" THEN 'E' ELSE '' END) AS fails,
    count(*) AS n, count(*) FILTER (WHERE good) AS good, count(*) FILTER (WHERE toxic) AS toxic FROM f GROUP BY ALL),
l AS (SELECT unnest(['A', 'B', 'C', 'D', 'E']) AS x),
o AS (SELECT a.x || b.x || c.x || d.x || e.x AS filter_order FROM l a JOIN l b ON b.x <> a.x JOIN l c ON c.x NOT IN (a.x, b.x) JOIN l d ON d.x NOT IN (a.x, b.x, c.x) JOIN l e ON e.x NOT IN (a.x, b.x, c.x, d.x)),
s AS (SELECT filter_order, step::INT AS step, filter_order[step] AS here, filter_order[:step - 1] AS before FROM o, range(1, 6) r(step)),
t AS (SELECT part, filter_order, step, here, n, good, toxic, contains(fails, here) AS failing, fails = here AS alone, length(translate(fails, before, '')) < length(fails) AS gone FROM cell, s),
r AS (SELECT part, filter_order, step, here, coalesce(sum(n) FILTER (WHERE NOT gone AND NOT failing), 0)::BIGINT AS kept, coalesce(sum(n) FILTER (WHERE NOT gone AND failing), 0)::BIGINT AS removed,
    coalesce(sum(n) FILTER (WHERE gone AND failing), 0)::BIGINT AS redundant, coalesce(sum(n) FILTER (WHERE alone), 0)::BIGINT AS unique_fails,
    coalesce(sum(good) FILTER (WHERE NOT gone AND failing), 0)::BIGINT AS good_lost, coalesce(sum(toxic) FILTER (WHERE NOT gone AND failing), 0)::BIGINT AS toxic_lost FROM t GROUP BY ALL)
SELECT part, filter_order, step, kept, removed, redundant, unique_fails, good_lost, toxic_lost, (sum(removed) OVER (PARTITION BY part, here))::BIGINT AS shapley FROM r
"""
