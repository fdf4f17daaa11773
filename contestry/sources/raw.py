"""Raw result rows: the contests in the columns of a result file, with the faults such files have; and file sources."""

from __future__ import annotations

from functools import reduce

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from contestry.functions.scalars import utc_kickoff

FIELDS = ["Div", "Date", "Time", "HomeTeam", "AwayTeam", "FTHG", "FTAG", "FTR"]


def raw_rows(m: DataFrame) -> DataFrame:
    """rid and FIELDS (all strings): re-sent rows, moved dates, short years, spare spaces, wrong results, blank rows."""
    moved = (~F.col("is_played")) & (F.col("match_id") % 3 == 0)
    copies = F.when(moved | (F.col("match_id") % 5 == 0), F.array(F.lit(0), F.lit(1))).otherwise(F.array(F.lit(0)))
    rows = m.withColumn("copy", F.explode(copies))
    day = F.when(moved & (F.col("copy") == 1), F.date_add("match_date", 7)).otherwise(F.col("match_date"))
    short = F.col("match_id") % 7 == 0
    gap = F.when(F.col("match_id") % 11 == 0, "  ").otherwise(" ")
    blank = F.col("match_id") % 101 == 0
    wrong = F.col("is_played") & (F.col("match_id") % 97 == 0)
    shown = {
        "Div": F.concat(F.lit("C"), F.col("competition_id").cast("string")),
        "Date": F.when(short, F.date_format(day, "dd/MM/yy")).otherwise(F.date_format(day, "dd/MM/yyyy")),
        "Time": F.substring("kickoff_time", 1, 5),
        "HomeTeam": F.concat(F.lit("Team"), gap, F.col("home_team_id").cast("string")),
        "AwayTeam": F.concat(F.lit("Team"), gap, F.col("away_team_id").cast("string")),
        "FTHG": F.coalesce(F.col("home_goals").cast("string"), F.lit("")),
        "FTAG": F.coalesce(F.col("away_goals").cast("string"), F.lit("")),
        "FTR": F.coalesce(F.when(wrong, F.when(F.col("result") == "H", "A").otherwise("H")).otherwise(F.col("result")), F.lit("")),
    }
    return rows.select((F.col("match_id") * 2 + F.col("copy")).alias("rid"), *[F.when(blank, "").otherwise(c).alias(n) for n, c in shown.items()])


def read_results(spark: SparkSession, path: str) -> DataFrame:
    """Result files (CSV with a header): all strings, empty for null, with the file's name.

    Season files differ in their columns: files of one header are read together, and the groups are
    united by name. The files' first lines are collected, one a file, never their rows.
    """
    lines = spark.read.text(path).withColumn("file", F.col("_metadata.file_path")).withColumn("at", F.monotonically_increasing_id())
    heads = lines.groupBy("file").agg(F.min_by("value", "at").alias("head")).groupBy("head").agg(F.collect_list("file").alias("files")).collect()
    found = []
    for r in sorted(heads, key=lambda r: r.head):
        df = spark.read.option("header", True).option("inferSchema", False).csv(r.files)
        df = df.toDF(*[c.removeprefix("\ufeff") for c in df.columns])
        found.append(df.withColumn("source_file", F.col("_metadata.file_path")))
    return reduce(lambda a, b: a.unionByName(b, allowMissingColumns=True), found).fillna("")


def read_fixtures(spark: SparkSession, path: str, division: str) -> DataFrame:
    """Fixture files (JSON arrays) as result rows without scores."""
    feed = spark.read.schema("DateUtc string, HomeTeam string, AwayTeam string").option("multiLine", True).json(path)
    at = utc_kickoff(F.col("DateUtc"))
    return feed.select(F.lit(division).alias("Div"), F.date_format(at, "dd/MM/yyyy").alias("Date"), F.date_format(at, "HH:mm").alias("Time"), "HomeTeam", "AwayTeam", *[F.lit("").alias(c) for c in ("FTHG", "FTAG", "FTR")])


def write_csv(df: DataFrame, path: str) -> None:
    df.write.mode("overwrite").option("header", True).csv(path)


def write_json(df: DataFrame, path: str) -> None:
    df.write.mode("overwrite").json(path)
