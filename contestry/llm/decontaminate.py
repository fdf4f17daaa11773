"""Benchmark decontamination by Wu-Manber multi-pattern search over words.

The patterns are the items' windows of 13 words (an item of fewer words is one pattern). Patterns of
one length form a searcher: a table over blocks of two words tells how far the search may jump; where
it can't, the patterns that end in this block, kept by their other words, are compared with the text's.

The patterns are broadcast in blocks of at most BLOCK_WORDS item words. With one block the search is one
pass over the documents' rows, without a shuffle. With more, each block's pass writes what it finds, and
the block is given up before the next is made: neither a task nor the driver holds two of them, however
large the benchmark is.
"""

from __future__ import annotations

import itertools
import re
import uuid
from collections.abc import Iterator
from functools import reduce

import pandas as pd
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T
from pyspark.sql.functions import pandas_udf

from .common import text_of, unused, written

WINDOW = 13
#: Item words that one pass looks for at most (about 100 MB of tables in a Python worker).
BLOCK_WORDS = 400_000
#: A document is contaminated where hit words are at least one in SHARE words.
SHARE = 20
#: Over UTF-8 bytes: ASCII letters and digits, and all that is not ASCII.
ITEM_WORD = re.compile(rb"[0-9a-z\x80-\xff]+")


def tokens(text: str | None) -> list[bytes]:
    """Lower-cased (A-Z only) words."""
    return ITEM_WORD.findall(text.encode("utf-8", "surrogatepass").lower()) if text else []


class Searcher:
    """Wu-Manber search for word sequences of one length."""

    def __init__(self, length: int, patterns: dict[tuple[bytes, ...], set]):
        self.length, self.block = length, min(2, length)
        self.jump = length - self.block + 1
        self.shift: dict = {}
        self.ends: dict[tuple, dict[tuple, set]] = {}
        for words, items in patterns.items():
            for end in range(self.block, length + 1):
                block = words[end - self.block : end]
                self.shift[block] = min(self.shift.get(block, self.jump), length - end)
            self.ends.setdefault(words[-self.block :], {})[words[: length - self.block]] = items

    def find(self, words: list[bytes]) -> Iterator[tuple[int, set]]:
        """(start, items) of every occurrence."""
        shift, block, jump, at, n = self.shift.get, self.block, self.jump, self.length, len(words)
        while at <= n:
            tail = (words[at - 2], words[at - 1]) if block == 2 else (words[at - 1],)
            step = shift(tail, jump)
            if step:
                at += step
                continue
            start = at - self.length
            items = self.ends[tail].get(tuple(words[start : at - block]))
            if items:
                yield start, items
            at += 1


class Patterns:
    """The searchers of some items, one for each pattern length."""

    def __init__(self, items: list[tuple[str, list[bytes]]], window: int = WINDOW):
        by_length: dict[int, dict] = {}
        for item, words in items:
            length = min(window, len(words))
            for i in range(len(words) - length + 1 if length else 0):
                by_length.setdefault(length, {}).setdefault(tuple(words[i : i + length]), set()).add(item)
        self.searchers = [Searcher(length, found) for length, found in sorted(by_length.items())]

    def search(self, words: list[bytes]) -> tuple[list[list[int]], set]:
        """The hit stretches as sorted, disjoint [start, end), and the items found."""
        spans, items = [], set()
        for searcher in self.searchers:
            for start, found in searcher.find(words):
                spans.append([start, start + searcher.length])
                items |= found
        return merged(spans), items


def merged(spans: list) -> list[list[int]]:
    out: list[list[int]] = []
    for start, end in sorted(map(list, spans)):
        if out and start <= out[-1][1]:
            out[-1][1] = max(out[-1][1], end)
        else:
            out.append([start, end])
    return out


FOUND = "n_words long, spans array<array<int>>, items array<string>"


#: The table of the block that this Python worker searched last, by the block's number.
_tables: dict[str, Patterns] = {}


def _pass(patterns) -> F.Column:
    """A pandas UDF text -> FOUND; patterns is a broadcast (number of the block, its items)."""

    @pandas_udf(FOUND)
    def search(batches: Iterator[pd.Series]) -> Iterator[pd.DataFrame]:
        number, block = patterns.value
        if number not in _tables:
            _tables.clear()
            _tables[number] = Patterns(block)
        table = _tables[number]
        for texts in batches:
            rows = []
            for text in texts:
                words = tokens(text)
                spans, items = table.search(words)
                rows.append((len(words), spans, sorted(items)))
            yield pd.DataFrame(rows, columns=["n_words", "spans", "items"])

    return search


@pandas_udf(T.ArrayType(T.ArrayType(T.IntegerType())))
def _merged(spans: pd.Series) -> pd.Series:
    return spans.map(lambda s: merged([list(x) for x in s]))


def blocks_of(items: DataFrame, block_words: int) -> Iterator[list[tuple[str, list[bytes]]]]:
    """The items' words in blocks of about block_words words; only one block is on the driver at a time."""
    counted = items.select(F.col("item_id").cast("string").alias("item_id"), text_of(F.col("text")).alias("text"))
    total = counted.agg(F.coalesce(F.sum(F.regexp_count("text", F.lit(r"[^\x00-\x2F\x3A-\x60\x7B-\x7F]+"))), F.lit(0))).first()[0]
    n = max(1, -(-total // block_words))
    for k in range(n):
        rows = counted if n == 1 else counted.where(F.pmod(F.xxhash64("item_id", "text"), F.lit(n)) == k)
        yield [(r.item_id, tokens(r.text)) for r in rows.toLocalIterator() if r.item_id is not None]


def search_items(docs: DataFrame, items: DataFrame, name: str = "found", block_words: int = BLOCK_WORDS) -> DataFrame:
    """docs with a struct column name: n_words, the hit spans in words, and the ids of the items found.

    docs needs text, items item_id and text; all other columns stay as they are. Null and empty texts
    have no words; items without words or without an id are never found; repeated rows are judged one
    by one; very long texts are searched whole; an empty benchmark finds nothing. A column called name is
    replaced.
    """
    spark, blocks, made = docs.sparkSession, blocks_of(items, block_words), []
    docs = docs.drop(*[c for c in docs.columns if c.lower() == name.lower()])
    first = next(blocks)
    second = next(blocks, None)
    if second is None:
        return docs.withColumn(name, _pass(spark.sparkContext.broadcast((uuid.uuid4().hex, first)))("text"))
    (row,) = unused(docs, "row_")
    kept = written(docs.withColumn(row, F.monotonically_increasing_id()), "searched")
    for block in itertools.chain([first, second], blocks):
        shared = spark.sparkContext.broadcast((uuid.uuid4().hex, block))
        passed = kept.select(row, _pass(shared)("text").alias("f")).select(row, "f.*")
        made.append(written(passed if not made else passed.where(F.size("items") > 0), "found"))
        shared.destroy()
    every = reduce(DataFrame.unionByName, made).groupBy(row).agg(F.max("n_words").alias("n"), F.flatten(F.collect_list("spans")).alias("s"), F.array_sort(F.array_distinct(F.flatten(F.collect_list("items")))).alias("i"))
    found = every.select(F.col(row).alias(f"{row}_"), F.struct(F.col("n").alias("n_words"), _merged("s").alias("spans"), F.col("i").alias("items")).alias(name))
    return kept.join(found, F.col(row) == F.col(f"{row}_")).drop(row, f"{row}_")


def hit_words(found: F.Column) -> F.Column:
    return F.aggregate(found["spans"], F.lit(0).cast("long"), lambda n, s: n + (s[1] - s[0]).cast("long"))


def is_contaminated(found: F.Column, share: int = SHARE) -> F.Column:
    n = hit_words(found)
    return (n > 0) & (n * share >= found["n_words"])


def contamination(docs: DataFrame, items: DataFrame) -> DataFrame:
    """doc_id, n_words, n_hit, n_items, items_sha256, contaminated of every document.

    Null and empty texts have no words; repeated rows and ids get a row each; further columns don't
    matter; an empty table stays empty.
    """
    found = search_items(docs.select("doc_id", "text"), items, "hits")
    at = F.col("hits")
    return found.select(
        "doc_id",
        at["n_words"].alias("n_words"),
        hit_words(at).alias("n_hit"),
        F.size(at["items"]).cast("long").alias("n_items"),
        F.sha2(F.concat_ws(",", F.array_sort(at["items"])), 256).alias("items_sha256"),
        is_contaminated(at).alias("contaminated"),
    )


def decontaminate(docs: DataFrame, items: DataFrame) -> DataFrame:
    """The documents that are not contaminated, with their own columns only."""
    (name,) = unused(docs, "hits")
    return search_items(docs, items, name).where(~is_contaminated(F.col(name))).drop(name)


SQL = """
WITH dw AS (SELECT row_number() OVER () AS rid, doc_id,
    regexp_extract_all(translate(coalesce(text,''),'ABCDEFGHIJKLMNOPQRSTUVWXYZ','abcdefghijklmnopqrstuvwxyz'), '[^\\x00-\\x2F\\x3A-\\x60\\x7B-\\x7F]+') AS w FROM documents),
iw AS (SELECT CAST(item_id AS VARCHAR) AS item_id,
    regexp_extract_all(translate(coalesce(text,''),'ABCDEFGHIJKLMNOPQRSTUVWXYZ','abcdefghijklmnopqrstuvwxyz'), '[^\\x00-\\x2F\\x3A-\\x60\\x7B-\\x7F]+') AS w FROM benchmark WHERE item_id IS NOT NULL),
ip AS (SELECT item_id, w, unnest(range(1, greatest(len(w) - 13, 0) + 2)) AS i FROM iw WHERE len(w) > 0),
pat AS (SELECT DISTINCT item_id, least(len(w), 13) AS n, array_to_string(w[i:i + least(len(w), 13) - 1], ' ') AS g FROM ip),
lens AS (SELECT DISTINCT n FROM pat),
dp AS (SELECT rid, n, w, unnest(range(1, len(w) - n + 2)) AS i FROM dw, lens WHERE len(w) >= n),
hit AS (SELECT rid, i, dp.n, item_id FROM dp JOIN pat ON dp.n = pat.n AND array_to_string(w[i:i + dp.n - 1], ' ') = pat.g),
cov AS (SELECT rid, count(DISTINCT p) AS n_hit FROM (SELECT rid, unnest(range(i, i + n)) AS p FROM hit) GROUP BY rid),
its AS (SELECT rid, count(DISTINCT item_id) AS n_items, array_to_string(list_sort(list(DISTINCT item_id)), ',') AS ids FROM hit GROUP BY rid)
SELECT doc_id, len(w)::BIGINT AS n_words, coalesce(n_hit, 0)::BIGINT AS n_hit, coalesce(n_items, 0)::BIGINT AS n_items,
  sha256(coalesce(ids, '')) AS items_sha256, coalesce(n_hit, 0) > 0 AND 20 * coalesce(n_hit, 0) >= len(w) AS contaminated
FROM dw LEFT JOIN cov USING (rid) LEFT JOIN its USING (rid)
"""
