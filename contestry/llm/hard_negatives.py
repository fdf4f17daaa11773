"""Hard-negative mining by coordinate pruning, after LEMP.

Vectors are put into buckets by length, and large buckets are split into blocks of a bounded size by a
hash. For a query and a threshold, a block's longest vector turns the threshold on products into one on
cosines; for each of the query's largest (focus) coordinates that gives a range in which a candidate's
normalised coordinate must lie. The block holds its vectors' coordinates as sorted lists: the shortest
feasible range gives candidates, the others intersect them, and what is left is verified by exact
integer products.

Three passes, each of (block x tile of queries) groups, so that no task holds more than a block and a
tile, however many rows or queries there are:

1. a query's own block gives a first threshold: the score of its fifth row of the same label there;
2. rows of the same label at or above it, in every bucket that can reach it, give the positives;
3. rows of other labels in the band of each positive give the negatives.

Bounds are widened by more than the rounding of doubles, so no row is lost; if a block can't be pruned,
all its rows are verified.
"""

from __future__ import annotations

from collections.abc import Callable, Iterator
from functools import cached_property

import numpy as np
import pandas as pd
from pyspark.sql import Column, DataFrame
from pyspark.sql import Window as W
from pyspark.sql import functions as F

from .common import written

#: Lengths of a bucket lie within this factor of each other; so there are some hundreds of buckets at most.
RATIO = 1.1
#: Most rows of a block and queries of a tile, on average.
BLOCK, TILE = 4096, 4096
#: Coordinates whose ranges are intersected.
FOCUS = 4
#: Positives of an anchor and negatives of a positive.
KEPT = 5
#: A negative's score in hundredths of its positive's.
LOW, HIGH = 80, 100
SLACK = 1e-9
FACTOR = 256


class Block:
    """A block's vectors with sorted coordinate lists, which are made when they are first asked for."""

    def __init__(self, rows: pd.DataFrame, width: int):
        self.ids, self.labels, self.numbers = rows["vec_id"].to_numpy(), rows["label"].to_numpy(), rows["rid"].to_numpy()
        self.vectors = matrix(rows["vector"], width)
        self.lengths = rows["length"].to_numpy()
        self.lists: dict[int, tuple[np.ndarray, np.ndarray]] = {}

    @cached_property
    def unit(self) -> np.ndarray:
        return self.vectors / np.where(self.lengths > 0, self.lengths, 1)[:, None]

    def sorted_list(self, coordinate: int) -> tuple[np.ndarray, np.ndarray]:
        """The rows in the order of their coordinate, and its values in that order."""
        if coordinate not in self.lists:
            order = np.argsort(self.unit[:, coordinate], kind="stable")
            self.lists[coordinate] = order, self.unit[order, coordinate]
        return self.lists[coordinate]

    def candidates(self, query: np.ndarray, length: float, least: float) -> np.ndarray | None:
        """Rows whose product with the query may reach least; None where that may be all of them."""
        reach = length * (self.lengths.max() if least > 0 else self.lengths.min())
        if reach == 0:
            return np.empty(0, int) if least > 0 else None
        cosine = least / reach - SLACK
        if cosine > 1:
            return np.empty(0, int)
        if cosine <= -1:
            return None
        unit, angle = query / length, np.arccos(cosine)
        ranges = []
        for f in np.argsort(-np.abs(unit))[:FOCUS]:
            own = np.arccos(np.clip(unit[f], -1, 1))
            low, high = np.cos(min(np.pi, own + angle)) - SLACK, np.cos(max(0.0, own - angle)) + SLACK
            order, values = self.sorted_list(f)
            first, last = np.searchsorted(values, low, "left"), np.searchsorted(values, high, "right")
            ranges.append((last - first, f, low, high, order[first:last]))
        ranges.sort(key=lambda r: r[0])
        found = ranges[0][-1]
        for _, f, low, high, _ in ranges[1:]:
            at = self.unit[found, f]
            found = found[(at >= low) & (at <= high)]
        return found

    def scores(self, query: np.ndarray, rows: np.ndarray | None) -> np.ndarray:
        return ((self.vectors if rows is None else self.vectors[rows]) @ query).astype(np.int64)


def matrix(vectors: pd.Series, width: int) -> np.ndarray:
    """Rows of a common width, shorter vectors filled with zeros; doubles where all products are exact in them."""
    out = np.zeros((len(vectors), width), np.int64)
    for i, v in enumerate(vectors):
        out[i, : len(v)] = v
    return out.astype(np.float64) if np.abs(out).max(initial=0) <= 2**53 // 256 else out


def best(scores: np.ndarray, ids: np.ndarray, most: int = KEPT) -> np.ndarray:
    """Places of the first rows: highest scores first, then the smallest ids."""
    at = np.arange(len(scores))
    if len(scores) > most:
        at = np.flatnonzero(scores >= np.partition(scores, -most)[-most])
    return at[np.lexsort((ids[at], -scores[at]))[:most]]


def exact(rows: pd.DataFrame, queries: pd.DataFrame) -> int:
    """The common width of a group; products must be exact in doubles, or in 64 bits."""
    if rows["length"].max() * queries["length"].max() >= 2.0**53:
        raise ValueError("products of these vectors are beyond 2**53")
    return max(rows["vector"].str.len().max(), queries["vector"].str.len().max())


def positives_of(block: Block, query, vector: np.ndarray, least: float) -> tuple[np.ndarray, np.ndarray]:
    """Ids and scores of the block's first rows of the query's label, other than itself, that reach least."""
    rows = block.candidates(vector, query.length, least)
    rows = np.arange(len(block.ids)) if rows is None else rows
    rows = rows[(block.labels[rows] == query.label) & (block.numbers[rows] != query.rid)]
    scores = block.scores(vector, rows)
    reach = scores >= least
    rows, scores = rows[reach], scores[reach]
    first = best(scores, block.ids[rows])
    return block.ids[rows[first]], scores[first]


def searched(key: tuple, rows: pd.DataFrame, queries: pd.DataFrame, found: Callable, columns: list[str]) -> pd.DataFrame:
    """found(block, query, vector) -> iterator of result rows, for each query of a group."""
    if rows.empty or queries.empty:
        return pd.DataFrame(columns=columns)
    width = exact(rows, queries)
    block, vectors = Block(rows, width), matrix(queries["vector"], width)
    return pd.DataFrame([r for query, vector in zip(queries.itertuples(), vectors) for r in found(block, query, vector)], columns=columns)


def first_threshold(block: Block, query, vector: np.ndarray) -> Iterator[tuple]:
    _, scores = positives_of(block, query, vector, -np.inf)
    if len(scores) == KEPT:
        yield query.rid, scores[-1]


def all_positives(block: Block, query, vector: np.ndarray) -> Iterator[tuple]:
    ids, scores = positives_of(block, query, vector, -np.inf if pd.isna(query.least) else query.least)
    for i, score in zip(ids, scores):
        yield query.rid, i, score


def all_negatives(block: Block, query, vector: np.ndarray) -> Iterator[tuple]:
    rows = block.candidates(vector, query.length, query.least)
    rows = np.arange(len(block.ids)) if rows is None else rows
    rows = rows[block.labels[rows] != query.label]
    scores = block.scores(vector, rows)
    ids = block.ids[rows]
    for number, (positive, of) in enumerate(zip(query.positive_ids, query.positive_scores)):
        band = np.flatnonzero((scores * 100 >= of * LOW) & (scores * 100 <= of * HIGH))
        for at in band[best(scores[band], ids[band])]:
            yield query.rid, query.vec_id, number, positive, of, ids[at], scores[at]


def quantised(vectors: DataFrame) -> DataFrame:
    """vec_id, label, vector (floor of 256 times each component), length, bucket and rid (a number for the row), of the rows that take part."""
    whole = F.col("vec_id").isNotNull() & F.col("label").isNotNull() & F.col("embedding").isNotNull()
    finite = F.forall("embedding", lambda x: F.coalesce(F.abs(x.cast("double")) < float("inf"), F.lit(False)))
    rows = vectors.where(whole & finite).select("vec_id", "label", F.transform("embedding", lambda x: F.floor(x.cast("double") * FACTOR)).alias("vector"))
    square = F.aggregate("vector", F.lit(0.0), lambda s, x: s + x.cast("double") * x.cast("double"))
    rows = rows.withColumn("length", F.sqrt(square))
    bucket = F.when(F.col("length") > 0, F.floor(F.log("length") / np.log(RATIO)).cast("int")).otherwise(-1)
    return written(rows.withColumns({"bucket": bucket, "rid": F.monotonically_increasing_id()}), "vectors")


def mine(vectors: DataFrame, anchors: Column) -> DataFrame:
    """anchor_id, positive_id, rank, negative_id, positive_score, negative_score for vectors (vec_id, embedding, label) and the rows that anchors names.

    Rows with a null label, vector or component, or a component that isn't finite, take no part, nor do
    rows without vec_id, which no result could name. A shorter vector counts as filled with zeros. Repeated rows
    take part each: one is the other's positive, and a repeated anchor gives its rows again. Positives
    with a score below 0 have no band and so no negatives. Products of 2**53 and more are an error.
    Other columns aren't read; an empty table gives no rows.
    """
    rows = quantised(vectors)
    # lengths span some hundreds of buckets at most, whatever the number of rows
    buckets = written(rows.groupBy("bucket").agg(F.ceil(F.count("*") / F.lit(BLOCK)).cast("int").alias("blocks"), F.max("length").alias("longest")), "buckets")
    rows = rows.join(F.broadcast(buckets.select("bucket", "blocks")), "bucket").withColumn("block", F.expr("pmod(xxhash64(rid), blocks)").cast("int")).drop("blocks")
    chosen = written(rows.where(anchors), "anchors")
    tiles = max(1, -(-chosen.count() // TILE))
    chosen = chosen.withColumn("tile", F.expr(f"pmod(xxhash64(rid, 1), {tiles})").cast("int"))
    copies = rows.withColumn("tile", F.explode(F.sequence(F.lit(0), F.lit(tiles - 1))))
    group = ["bucket", "block", "tile"]

    def over(queries: DataFrame, found: Callable, schema: str) -> DataFrame:
        columns = [c.split()[0] for c in schema.split(", ")]
        return copies.groupBy(*group).cogroup(queries.groupBy(*group)).applyInPandas(lambda key, left, right: searched(key, left, right, found, columns), schema)

    def reaching(queries: DataFrame) -> DataFrame:
        """A row for each query and block of a bucket whose longest vector can reach what the query asks for at least."""
        near = F.col("least").isNull() | (F.col("length") * F.col("longest") * (1 + SLACK) >= F.col("least"))
        spread = queries.drop("bucket", "block").join(F.broadcast(buckets), near)
        return spread.withColumn("block", F.explode(F.sequence(F.lit(0), F.col("blocks") - 1))).drop("blocks", "longest")

    def own_block(key: tuple, block: pd.DataFrame) -> pd.DataFrame:
        return searched(key, block, block[block["asks"]], first_threshold, ["rid", "least"])

    least = rows.withColumn("asks", anchors).groupBy("bucket", "block").applyInPandas(own_block, "rid long, least double")
    asking = chosen.join(written(least, "least"), "rid", "left")
    found = over(reaching(asking), all_positives, "rid long, positive_id long, positive_score long")
    order = W.partitionBy("rid").orderBy(F.desc("positive_score"), "positive_id")
    first = written(found.withColumn("place", F.row_number().over(order)).where(F.col("place") <= KEPT), "positives")
    listed = F.sort_array(F.collect_list(F.struct("place", "positive_id", "positive_score")))  # KEPT at most
    bands = first.where("positive_score >= 0").groupBy("rid").agg(listed.alias("of"))
    bands = bands.select("rid", F.col("of.positive_id").alias("positive_ids"), F.col("of.positive_score").alias("positive_scores"), F.ceil(F.array_min("of.positive_score") * LOW / 100).cast("double").alias("least"))
    negatives = over(reaching(chosen.join(bands, "rid")), all_negatives, "rid long, anchor_id long, number int, positive_id long, positive_score long, negative_id long, negative_score long")
    order = W.partitionBy("rid", "number").orderBy(F.desc("negative_score"), "negative_id")
    ranked = negatives.withColumn("rank", F.row_number().over(order)).where(F.col("rank") <= KEPT)
    return ranked.select("anchor_id", "positive_id", "rank", "negative_id", "positive_score", "negative_score")


def hard_negatives(vectors: DataFrame) -> DataFrame:
    """The rows of mine for every vector whose vec_id is divisible by 100, with the label of every seventh id moved on by one."""
    moved = F.when(F.col("vec_id") % 7 == 0, (F.col("label") + 1) % 10).otherwise(F.col("label"))
    return mine(vectors.select("vec_id", "embedding", moved.alias("label")), F.col("vec_id") % 100 == 0)


SQL = """
WITH v AS (SELECT row_number() OVER () AS rid, vec_id, CASE WHEN vec_id % 7 = 0 THEN (label + 1) % 10 ELSE label END AS label, list_transform(embedding, lambda x: floor(256 * x::DOUBLE)) AS q
  FROM embeddings WHERE vec_id IS NOT NULL AND label IS NOT NULL AND embedding IS NOT NULL AND len(list_filter(embedding, lambda x: x IS NULL OR NOT isfinite(x))) = 0),
s AS (SELECT a.rid, a.vec_id AS anchor_id, b.rid AS other, b.vec_id, a.label = b.label AS same, list_dot_product(a.q, b.q)::BIGINT AS score FROM v a, v b WHERE a.vec_id % 100 = 0 AND a.rid <> b.rid),
p AS (SELECT rid, anchor_id, vec_id AS positive_id, score AS positive_score, row_number() OVER (PARTITION BY rid ORDER BY score DESC, vec_id) AS place FROM s WHERE same QUALIFY place <= 5),
n AS (SELECT p.anchor_id, positive_id, positive_score, s.vec_id AS negative_id, s.score AS negative_score, (row_number() OVER (PARTITION BY rid, place ORDER BY s.score DESC, s.vec_id))::INT AS rank
  FROM p JOIN s USING (rid) WHERE NOT same AND 80 * positive_score <= 100 * s.score AND s.score <= positive_score)
SELECT anchor_id, positive_id, rank, negative_id, positive_score, negative_score FROM n WHERE rank <= 5
"""
