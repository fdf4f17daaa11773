"""The corpus pipeline: quality rules, near duplicates, benchmark decontamination, mixing, sharding.

Each stage takes (spark, docs, sf_dir) and works on all that the one before kept. All but the last
return the columns of documents; the last adds shard and slot.
"""

from __future__ import annotations

from functools import reduce

from pyspark.sql import DataFrame, SparkSession

from contestry.llm import decontaminate, mixing, ngram_join, quality, sharding
from contestry.llm.common import table, written


def quality_rules(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that fail a base rule, or whose host fails, go."""
    return quality.good_documents(docs)


def near_duplicates(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Of each component of the n-gram Jaccard join one document stays."""
    return ngram_join.one_of_each(docs)


def decontamination(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that the benchmark's passages contaminate go."""
    return decontaminate.decontaminate(docs, table(spark, sf_dir, "benchmark"))


def mix(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Sources meet their targets: documents are left out or repeated."""
    return mixing.mixed(docs)


def shard(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Every row gets its shard and its slot in the shard's shuffled order."""
    return sharding.assign_shards(docs)


STAGES = [
    ("quality rules", quality_rules),
    ("n-gram Jaccard join", near_duplicates),
    ("benchmark decontamination", decontamination),
    ("mixing", mix),
    ("sharding", shard),
]


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All stages over documents, each written to the shared folder and read again."""
    docs = table(spark, sf_dir, "documents")
    kept = reduce(lambda found, stage: written(stage[1](spark, found, sf_dir), "stage"), STAGES[:-1], docs)
    return STAGES[-1][1](spark, kept, sf_dir)


#: The order inside the shards comes from 64-bit hashes that SQL elsewhere does not have.
ORACLE_SQL = None
