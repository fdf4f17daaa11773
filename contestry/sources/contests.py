"""The contests view: two-sided contests derived from order lines.

The first two lines of an order are the home and the away side; the order is a contest where their
suppliers differ and belong to nations of one region, which is the competition.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import Window as W
from pyspark.sql import functions as F

from contestry.sources.store import cleaned, large, stored

#: The fixed day up to which contests count as played.
TODAY = "2001-02-01"


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def contests(spark: SparkSession, sf_dir: str) -> DataFrame:
    order = ["l_shipdate", "l_linenumber", "l_partkey", "l_suppkey", "l_extendedprice", "l_quantity"]
    # one sorted pass: an order's first line sees the one that follows it
    w = W.partitionBy("l_orderkey").orderBy(*order)
    line = F.struct("l_linenumber", "l_suppkey", "l_quantity")
    lines = table(spark, sf_dir, "lineitem").select("l_orderkey", *order)
    sides = lines.select("l_orderkey", F.row_number().over(w).alias("place"), line.alias("h"), F.lead(line).over(w).alias("a")).where("place = 1 and a is not null")
    region = table(spark, sf_dir, "supplier").join(table(spark, sf_dir, "nation"), F.col("s_nationkey") == F.col("n_nationkey")).select("s_suppkey", "n_regionkey")
    home, away = region.toDF("home_team_id", "competition_id"), region.toDF("away_team_id", "away_region")
    orders = table(spark, sf_dir, "orders").select(F.col("o_orderkey").alias("l_orderkey"), "o_orderdate")
    joined = (
        sides.where("h.l_suppkey <> a.l_suppkey")
        .select("l_orderkey", "h", "a", F.col("h.l_suppkey").alias("home_team_id"), F.col("a.l_suppkey").alias("away_team_id"))
        .join(large(orders), "l_orderkey")
        .join(large(home), "home_team_id")
        .join(large(away), "away_team_id")
        .where("competition_id = away_region")
    )
    played = F.col("o_orderdate") <= F.lit(TODAY).cast("timestamp")
    goals = lambda side, n: F.when(played, F.col(f"{side}.l_quantity").cast("int") % n)
    out = joined.select(
        F.col("l_orderkey").alias("match_id"),
        F.col("competition_id").cast("long").alias("competition_id"),
        F.to_date("o_orderdate").alias("match_date"),
        F.concat(F.lpad((F.col("h.l_linenumber") + 11).cast("string"), 2, "0"), F.lit(":00:00")).alias("kickoff_time"),
        "home_team_id",
        "away_team_id",
        played.alias("is_played"),
        goals("h", 4).alias("home_goals"),
        goals("a", 3).alias("away_goals"),
    )
    return with_result(out).withColumn("start_year", season_start("match_date"))


def stored_contests(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The view written once, for plans that use it many times: they scan order lines once."""
    with cleaned(spark):  # all order lines are shuffled
        return stored(contests(spark, sf_dir), "contests")


def with_result(df: DataFrame) -> DataFrame:
    """result (H, D, A) and result_code (2, 1, 0) from the goals; null without goals."""
    diff = F.col("home_goals") - F.col("away_goals")
    return df.withColumns({
        "result": F.when(diff > 0, "H").when(diff < 0, "A").when(diff == 0, "D"),
        "result_code": F.when(diff > 0, 2).when(diff < 0, 0).when(diff == 0, 1),
    })


def season_start(date: str) -> F.Column:
    """A season runs from 1 August to 31 July and is named by its first year."""
    return F.year(date) - (F.month(date) < 8).cast("int")


CONTESTS_SQL = """
li AS (SELECT *, row_number() OVER (PARTITION BY l_orderkey ORDER BY l_shipdate, l_linenumber, l_partkey, l_suppkey, l_extendedprice, l_quantity) AS place FROM lineitem),
sr AS (SELECT s_suppkey, n_regionkey FROM supplier JOIN nation ON s_nationkey = n_nationkey),
cg AS (SELECT o_orderkey AS match_id, r1.n_regionkey::BIGINT AS competition_id, o_orderdate::DATE AS match_date,
    lpad((h.l_linenumber + 11)::VARCHAR, 2, '0') || ':00:00' AS kickoff_time, h.l_suppkey AS home_team_id, a.l_suppkey AS away_team_id,
    o_orderdate <= TIMESTAMP '2001-02-01' AS is_played,
    CASE WHEN o_orderdate <= TIMESTAMP '2001-02-01' THEN (h.l_quantity::INT % 4)::INT END AS home_goals,
    CASE WHEN o_orderdate <= TIMESTAMP '2001-02-01' THEN (a.l_quantity::INT % 3)::INT END AS away_goals
  FROM orders JOIN li h ON h.l_orderkey = o_orderkey AND h.place = 1 JOIN li a ON a.l_orderkey = o_orderkey AND a.place = 2
  JOIN sr r1 ON r1.s_suppkey = h.l_suppkey JOIN sr r2 ON r2.s_suppkey = a.l_suppkey
  WHERE h.l_suppkey <> a.l_suppkey AND r1.n_regionkey = r2.n_regionkey),
contests AS (SELECT *, CASE WHEN home_goals > away_goals THEN 'H' WHEN home_goals < away_goals THEN 'A' WHEN home_goals = away_goals THEN 'D' END AS result,
    CASE WHEN home_goals > away_goals THEN 2 WHEN home_goals < away_goals THEN 0 WHEN home_goals = away_goals THEN 1 END AS result_code,
    (year(match_date) - (month(match_date) < 8)::INT)::INT AS start_year FROM cg)
"""


def with_contests(sql: str, recursive: bool = False) -> str:
    """sql (a WITH list after contests, or a SELECT) over the contests view."""
    body = sql.strip()
    return f"WITH {'RECURSIVE ' if recursive else ''}{CONTESTS_SQL.strip()}{'' if body.upper().startswith('SELECT') else ','}\n{body}"
