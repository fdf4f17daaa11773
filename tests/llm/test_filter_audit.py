"""The filter audit beside a document by document run of every order."""

import itertools
import re
from collections import defaultdict

import numpy as np
from pyspark.sql import functions as F

from contestry.llm import filter_audit
from tests.llm.test_operators import ODD, make, prose


def brute_force(docs, labels):
    good, toxic = {i for i, q, _ in labels if q == 1 and i is not None}, {i for i, _, t in labels if t == 1 and i is not None}
    least, out = {}, defaultdict(lambda: [0] * 6)
    for i, text, _ in docs:
        if i is not None:
            least[text or ""] = min(i, least.get(text or "", i))
    shares, parts = defaultdict(int), defaultdict(list)
    for i, text, source in docs:
        text = text or ""
        w = re.findall(r"[^\x20\x09-\x0D]+", text)
        fails = {"A": len(w) < 200, "B": 100 * len(set(w)) < 50 * len(w), "C": 100 * len(re.findall("[A-Z]", text)) > 2 * len(text), "D": re.search(r"[#$%&*|]", text), "E": i is not None and i > least[text]}
        parts[source or ""].append((i, {f for f, x in fails.items() if x}))
    for part, rows in parts.items():
        for order in itertools.permutations("ABCDE"):
            for i, fails in rows:
                gone = False
                for step, f in enumerate(order, 1):
                    row = out[part, "".join(order), step]
                    row[3] += fails == {f}
                    if f in fails and not gone:
                        row[1] += 1
                        row[4] += i in good
                        row[5] += i in toxic
                        shares[part, f] += 1
                    row[2] += f in fails and gone
                    gone = gone or f in fails
                    row[0] += not gone
            for step in range(1, 6):
                out[part, "".join(order), step][0] += 0
    return {(*k, *v, shares[k[0], k[1][k[2] - 1]]) for k, v in out.items()}


def test_every_order_and_step(spark):
    texts = [prose(i % 23, 30 + 17 * (i % 23), 90 if i % 2 else 400) + (" #" if i % 5 == 0 else "") + (" ABC DEF GHI" * (i % 7 == 0) * 9) for i in range(120)] + ODD
    docs = [(None if i % 31 == 30 else i % 110, t, [None, "", "b", "hot", "hot"][i % 5]) for i, t in enumerate(texts)]
    docs += docs[40:44] + [(7, "same", "x"), (7, "same", "y"), (9, "same", "x")]
    labels = [(i, i % 2, int(i % 3 == 0)) for i in range(0, 110, 2)] + [(4, 0, 0), (6, None, 1), (None, 1, 1)]
    frame = spark.createDataFrame(docs, "doc_id long, text string, source string").withColumns({"part": F.lit(1), "n": F.lit("n"), "cell": F.lit(3), "fails": F.lit(4)}).repartition(5)
    found = filter_audit.filter_audit(frame, spark.createDataFrame(labels, "doc_id long, quality int, toxic int").withColumn("good", F.lit("x")))
    assert {tuple(r) for r in found.collect()} == brute_force(docs, labels)


def test_no_documents_give_no_rows(spark):
    labels = spark.createDataFrame([], "doc_id long, quality int, toxic int")
    assert filter_audit.filter_audit(make(spark, ["x"]).where("false"), labels).count() == 0
    assert filter_audit.filter_audit(make(spark, ["x"]), labels).count() == 600


def test_contraction_of_two_filters():
    tensor = np.array([[[5, 3], [2, 1]]])
    steps, asked = filter_audit.selections("AB")
    assert steps == [("AB", 1), ("AB", 2), ("BA", 1), ("BA", 2)]
    assert filter_audit.contract(tensor, asked["kept"])[:, 0].tolist() == [8, 5, 7, 5]
    assert filter_audit.contract(tensor, asked["removed"])[:, 0].tolist() == [3, 3, 4, 2]
    assert filter_audit.contract(tensor, asked["alone"])[:, 0].tolist() == [2, 3, 3, 2]
