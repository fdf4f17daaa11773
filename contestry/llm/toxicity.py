"""Toxicity by cumulative-link ordinal regression.

Severity has GRADES ordered grades. P(grade > j) = 1 / (1 + exp(cut_j - w x)): one weight vector serves
all thresholds. The features x are log(1 + count) of words and of word beginnings. Labels tell clean
from toxic only; a toxic training document's grade is 1, 2 or 3 by terciles of the share of its
sentences that hold a marking word, where the marking words of one half of the sample are those found
on the other half: the grade tells how much of a document is toxic, and isn't read off the counts that
the model sees.

The model is fitted on at most SAMPLE labelled documents (chosen by a hash of doc_id): features are
counted and selected by Spark, at most FEATURES of them by their log-likelihood ratio, and the fit on
the driver sees only those. Scoring reads all documents, whole, without a shuffle.
"""

from __future__ import annotations

import math
import re
from collections import Counter
from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pandas as pd
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql.functions import pandas_udf

from .common import small, text_of, unused, written

SAMPLE = 20_000
FEATURES = 4_096
GRADES = 4
STEMS = (4, 5, 6, 7)
#: Least ratio and rows of a feature; in small samples a share of the largest ratio there can be, and of the toxic rows.
LEAST_RATIO, RATIO_SHARE = 40.0, 0.25
LEAST_ROWS, ROWS_SHARE = 5, 0.25
PENALTY = 0.002
STEPS = 1_500
WORD = re.compile(r"[^\W\d_]+")
SENTENCE = re.compile(r"[^.!?\n\u3002\uff01\uff1f]+")


def words(text: str | None) -> list[str]:
    return WORD.findall(text.lower()) if text else []


def features_of(word: str) -> list[str]:
    """The word itself, and its beginnings (marked by a star)."""
    return [word, *(f"{word[:n]}*" for n in STEMS if len(word) > n)]


def labelled_sample(docs: DataFrame, labels: DataFrame, most: int = SAMPLE) -> DataFrame:
    """text, toxic, half of at most about `most` labelled documents.

    Documents alike in their whole text, but for case and white space, are one row, toxic where any of
    them is; texts without words are left out.
    """
    known = labels.where("doc_id is not null and toxic is not null").groupBy("doc_id").agg(F.max("toxic").alias("toxic"))
    n = known.count()
    if n > most:
        share = int(most / n * (1 << 30))
        known = known.where(F.pmod(F.xxhash64("doc_id"), F.lit(1 << 30)) < share)
    known = small(known.withColumnRenamed("doc_id", "labelled"))
    found = docs.select("doc_id", text_of(F.col("text")).alias("text")).join(known, F.col("doc_id") == F.col("labelled"))
    plain = F.trim(F.regexp_replace(F.lower("text"), r"\s+", " "))
    digest = F.sha2(plain, 256)
    found = found.where(plain != "").groupBy(digest.alias("digest")).agg(F.min("text").alias("text"), F.max(F.col("toxic") > 0).alias("toxic"))
    return found.select("text", "toxic", (F.pmod(F.xxhash64("digest"), F.lit(2))).cast("int").alias("half"))


def select_features(sample: DataFrame, most: int = FEATURES) -> dict[str, int]:
    """The features that mark toxic documents with the largest log-likelihood ratios, numbered."""

    def count(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for batch in batches:
            toxic, clean = Counter(), Counter()
            for text, is_toxic in zip(batch["text"], batch["toxic"]):
                (toxic if is_toxic else clean).update({f for w in set(words(text)) for f in features_of(w)})
            names = list(toxic.keys() | clean.keys())
            yield pd.DataFrame({"f": names, "t": [toxic[x] for x in names], "c": [clean[x] for x in names]})

    n_toxic, n_clean = sample.agg(F.count_if("toxic"), F.count_if(~F.col("toxic"))).first()
    if not n_toxic or not n_clean:
        return {}
    df = sample.mapInPandas(count, "f string, t long, c long").groupBy("f").agg(F.sum("t").alias("t"), F.sum("c").alias("c")).where(F.col("t") + F.col("c") >= min(LEAST_ROWS, math.ceil(n_toxic * ROWS_SHARE)))
    rest_t, rest_c, n = n_toxic - F.col("t"), n_clean - F.col("c"), float(n_toxic + n_clean)
    largest = 2 * (n * math.log(n) - n_toxic * math.log(n_toxic) - n_clean * math.log(n_clean))
    least = min(LEAST_RATIO, RATIO_SHARE * largest)

    def cell(seen, row, column):
        return F.when(seen > 0, seen * F.log(seen * n / (row * column))).otherwise(0.0)
    have, lack = F.col("t") + F.col("c"), rest_t + rest_c
    ratio = 2 * (cell(F.col("t"), have, F.lit(n_toxic)) + cell(F.col("c"), have, F.lit(n_clean)) + cell(rest_t, lack, F.lit(n_toxic)) + cell(rest_c, lack, F.lit(n_clean)))
    marks = F.col("t") * n_clean > F.col("c") * n_toxic
    top = df.withColumn("ratio", ratio).where(marks & (F.col("ratio") >= least)).orderBy(F.col("ratio").desc(), "f").limit(most).collect()
    return {r.f: i for i, r in enumerate(top)}


def encode(text: str | None, index: dict[str, int], cache: dict[str, list[int]]) -> Counter:
    """Counts of the selected features."""
    out: Counter = Counter()
    for word, n in Counter(words(text)).items():
        at = cache.get(word)
        if at is None:
            if len(cache) > 500_000:
                cache.clear()
            cache[word] = at = [index[f] for f in features_of(word) if f in index]
        for i in at:
            out[i] += n
    return out


@dataclass
class Model:
    index: dict[str, int]
    weights: np.ndarray
    cuts: np.ndarray

    def above(self, texts: Iterator[str]) -> np.ndarray:
        """P(grade > j) of each text, j from 0."""
        cache: dict = {}
        lines = np.array([sum(self.weights[i] * np.log1p(n) for i, n in encode(t, self.index, cache).items()) for t in texts], float)
        return sigmoid(lines[:, None] - self.cuts[None, :])


def sigmoid(x: np.ndarray) -> np.ndarray:
    return 1 / (1 + np.exp(-np.clip(x, -35, 35)))


def objective(p: np.ndarray, rows: np.ndarray, cols: np.ndarray, values: np.ndarray, grades: np.ndarray, n_features: int, penalty: float) -> tuple[float, np.ndarray]:
    """Mean penalised negative log-likelihood and its gradient; p: weights, the first cut, logs of the gaps between cuts."""
    n, k = len(grades), GRADES - 1
    w, raw = p[:n_features], p[n_features:]
    gaps = np.exp(raw[1:])
    cuts = raw[0] + np.concatenate([[0.0], np.cumsum(gaps)])
    line = np.bincount(rows, w[cols] * values, n)
    upper = np.concatenate([np.ones((n, 1)), sigmoid(line[:, None] - cuts), np.zeros((n, 1))], 1)
    every = np.arange(n)
    hi, lo = upper[every, grades], upper[every, grades + 1]
    prob = np.maximum(hi - lo, 1e-12)
    d_hi, d_lo = hi * (1 - hi) / prob, lo * (1 - lo) / prob
    d_cuts = np.zeros(k)
    np.add.at(d_cuts, grades[grades > 0] - 1, d_hi[grades > 0])
    np.add.at(d_cuts, grades[grades < k], -d_lo[grades < k])
    d_raw = np.concatenate([[d_cuts.sum()], gaps * np.cumsum(d_cuts[::-1])[::-1][1:]])
    g = np.concatenate([np.bincount(cols, (d_lo - d_hi)[rows] * values, n_features) + penalty * w, d_raw]) / n
    return float(-np.log(prob).sum() + penalty * (w * w).sum() / 2) / n, g


def fit_ordinal(rows: np.ndarray, cols: np.ndarray, values: np.ndarray, grades: np.ndarray, n_features: int, penalty: float = PENALTY, steps: int = STEPS) -> tuple[np.ndarray, np.ndarray]:
    """Weights and rising cuts by Adam on the penalised likelihood; the matrix is given by its entries.

    Weights stay at 0 or above, as every feature marks toxic documents.
    """
    p = np.concatenate([np.zeros(n_features), [1.0], np.zeros(GRADES - 2)])
    m, v = np.zeros_like(p), np.zeros_like(p)
    for step in range(1, steps + 1):
        _, g = objective(p, rows, cols, values, grades, n_features, penalty)
        m, v = 0.9 * m + 0.1 * g, 0.999 * v + 0.001 * g * g
        p = p - 0.1 * (m / (1 - 0.9**step)) / (np.sqrt(v / (1 - 0.999**step)) + 1e-8)
        p[:n_features] = np.maximum(p[:n_features], 0)
    raw = p[n_features:]
    return p[:n_features], raw[0] + np.concatenate([[0.0], np.cumsum(np.exp(raw[1:]))])


def marked_share(text: str, marks: set[str]) -> float:
    """The share of the sentences (with words) that hold a word with a marking feature."""
    sentences = [w for s in SENTENCE.findall(text) if (w := words(s))]
    return sum(any(f in marks for x in s for f in features_of(x)) for s in sentences) / max(len(sentences), 1)


def grades_of(toxic: np.ndarray, shares: np.ndarray) -> np.ndarray:
    """0 for clean; toxic documents 1, 2 or 3 by terciles of the shares above 0, and 1 where the share is 0."""
    grades, marked = toxic.astype(int), shares[toxic & (shares > 0)]
    if len(marked):
        grades[toxic] = 1 + np.searchsorted(np.quantile(marked, [1 / 3, 2 / 3]), shares[toxic])
    return grades


def train(docs: DataFrame, labels: DataFrame, most: int = SAMPLE) -> Model | None:
    """None where the labels hold no toxic or no clean document."""
    sample = written(labelled_sample(docs, labels, most), "labelled")
    index = select_features(sample)
    if not index:
        return None
    halves = [set(select_features(sample.where(F.col("half") != h))) or set(index) for h in (0, 1)]
    shared = docs.sparkSession.sparkContext.broadcast((index, halves))

    def run(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        (at, marks), cache = shared.value, {}
        for batch in batches:
            out = []
            for text, toxic, half in zip(batch["text"], batch["toxic"], batch["half"]):
                counts = encode(text, at, cache)
                out.append((bool(toxic), marked_share(text, marks[half]) if toxic else 0.0, list(counts), [float(np.log1p(k)) for k in counts.values()]))
            yield pd.DataFrame(out, columns=["toxic", "share", "cols", "vals"])

    rows = sample.mapInPandas(run, "toxic boolean, share double, cols array<int>, vals array<double>").toPandas()
    rows = rows.sort_values(["toxic", "share"], kind="stable", ignore_index=True)
    grades = grades_of(rows["toxic"].to_numpy(bool), rows["share"].to_numpy())
    lengths = rows["cols"].map(len).to_numpy()
    entries = [np.concatenate([np.zeros(0), *rows[c]]) for c in ("cols", "vals")]
    weights, cuts = fit_ordinal(np.repeat(np.arange(len(rows)), lengths), entries[0].astype(int), entries[1], grades, len(index))
    return Model(index, weights, cuts)


def severity(docs: DataFrame, model: Model | None, names: tuple[str, str, str] = ("severity", "grade", "toxic")) -> DataFrame:
    """docs with the expected severity (0 to GRADES - 1), the grade most likely, and toxic: P(grade > 0) >= 1/2.

    Null and empty texts have no features; without a model severity is 0. Columns called like the new
    ones are replaced; repeated rows score alike; very long texts are read whole; an empty table stays
    empty.
    """
    docs = docs.drop(*[c for c in docs.columns if c.lower() in {n.lower() for n in names}])
    if model is None:
        return docs.withColumns({names[0]: F.lit(0.0), names[1]: F.lit(0), names[2]: F.lit(False)})
    shared = docs.sparkSession.sparkContext.broadcast(model)

    @pandas_udf("severity double, grade int, toxic boolean")
    def run(batches: Iterator[pd.Series]) -> Iterator[pd.DataFrame]:
        for texts in batches:
            above = shared.value.above(texts)
            each = np.concatenate([np.ones((len(above), 1)), above], 1) - np.concatenate([above, np.zeros((len(above), 1))], 1)
            yield pd.DataFrame({"severity": above.sum(1), "grade": each.argmax(1).astype("int32"), "toxic": above[:, 0] >= 0.5})

    (found,) = unused(docs, "found")
    scored = docs.withColumn(found, run(F.col("text")))
    return scored.withColumns({n: F.col(f"{found}.{k}") for n, k in zip(names, ("severity", "grade", "toxic"))}).drop(found)


def toxicity(docs: DataFrame, labels: DataFrame) -> DataFrame:
    """doc_id, severity, grade, toxic of every document; nulls, repeats and long texts as in severity."""
    return severity(docs.select("doc_id", "text"), train(docs, labels)).select("doc_id", "severity", "grade", "toxic")
