"""Registered queries: streams that curate and rate."""

from __future__ import annotations

import uuid

from pyspark.sql import functions as F

from contestry.operators.curation import PAIRING
from contestry.plans.features import rounded
from contestry.sources import derived as d
from contestry.sources.contests import stored_contests, with_contests
from contestry.sources.raw import raw_rows
from contestry.sources.store import large, shared_dir
from contestry.streaming import curation

QUERIES: dict = {}
ORACLE: dict = {}

#: A file's contests, about: a file is one row group and is read by one task, so that files grow in number, not in size.
FILE_CONTESTS = 50_000


def query(name: str, sql: str | None = None):
    def add(f):
        QUERIES[name] = lambda spark, sf_dir: rounded(f(stored_contests(spark, sf_dir)))
        if sql:
            ORACLE[name] = with_contests(sql)
        return f

    return add


def feeds(m):
    """Raw rows of two feeds: the first lacks half of the live season's results and has some of its days wrong; the second, from 1999 on, lacks every ninth contest."""
    early = (F.col("start_year") == 2000) & (F.col("match_id") % 2 == 0)
    blank = {c: F.when(early, None).otherwise(F.col(c)) for c in ("home_goals", "away_goals", "result", "result_code")}
    first = m.withColumns({**blank, "is_played": F.col("is_played") & ~early, "match_date": F.when(early & (F.col("match_id") % 4 == 0), F.date_add("match_date", -3)).otherwise(F.col("match_date"))})
    second = m.where("start_year >= 1999 and match_id % 9 <> 0")
    return raw_rows(first).withColumn("feed", F.lit(1).cast("long")), raw_rows(second).withColumn("feed", F.lit(2).cast("long"))


def predicted(m):
    """PAIRING and the number of stored predictions of each contest."""
    name = lambda c: F.concat(F.lit("Team "), F.col(c).cast("string"))
    counts = d.predictions(m).groupBy("match_id").agg(F.count("*").alias("predictions"))
    rows = m.join(large(counts), "match_id").select(F.concat(F.lit("C"), F.col("competition_id").cast("string")).alias("competition"), "start_year", name("home_team_id").alias("home_team"), name("away_team_id").alias("away_team"), "predictions")
    return rows.groupBy(*PAIRING).agg(F.sum("predictions").alias("predictions"))


def curated_table(m):
    """The table after both feeds have streamed in, each in several files and two micro-batches, however many files those have."""
    path = f"{shared_dir(m.sparkSession)}/curation-{uuid.uuid4().hex}"
    first, second = feeds(m)
    table = curation.contest_table(m.sparkSession, f"{path}/contests")
    files = max(1, -(-m.count() // (2 * FILE_CONTESTS)))  # of a micro-batch
    for rows in (first, second):
        rows.repartition(2 * files, "rid").write.mode("append").parquet(f"{path}/in")
        stream = m.sparkSession.readStream.schema(rows.schema).option("maxFilesPerTrigger", files).parquet(f"{path}/in")
        curation.curate_stream(stream, table, f"{path}/state").awaitTermination()
    return table


FEEDS = d.PREDICTED + """,
f0 AS (SELECT *, start_year = 2000 AND match_id % 2 = 0 AS early FROM contests),
fc AS (SELECT match_id, competition_id, 1 AS feed, match_date - CASE WHEN early AND match_id % 4 = 0 THEN 3 ELSE 0 END AS match_date, kickoff_time, home_team_id, away_team_id, is_played AND NOT early AS is_played, CASE WHEN NOT early THEN home_goals END AS home_goals, CASE WHEN NOT early THEN away_goals END AS away_goals FROM f0
  UNION ALL SELECT match_id, competition_id, 2, match_date, kickoff_time, home_team_id, away_team_id, is_played, home_goals, away_goals FROM contests WHERE start_year >= 1999 AND match_id % 9 <> 0),
fm AS (SELECT *, NOT is_played AND match_id % 3 = 0 AS moved FROM fc),
fr AS (SELECT fm.*, feed * 1000000000000 + match_id * 2 + copy AS ord, match_id * 2 + copy AS rid, (match_date + CASE WHEN moved AND copy = 1 THEN 7 ELSE 0 END)::DATE AS day FROM fm, (VALUES (0), (1)) v(copy) WHERE (copy = 0 OR moved OR match_id % 5 = 0) AND match_id % 101 <> 0 AND NOT (is_played AND match_id % 97 = 0)),
fs AS (SELECT 'C' || competition_id AS competition, (year(day) - (month(day) < 8)::INT)::INT AS start_year, 'Team ' || home_team_id AS home_team, 'Team ' || away_team_id AS away_team, * EXCLUDE (competition_id, home_team_id, away_team_id) FROM fr),
fg AS (SELECT competition, start_year, home_team, away_team, coalesce(arg_min(day, ord) FILTER (is_played), arg_max(day, ord)) AS match_date, arg_max(kickoff_time, ord) AS kickoff_time, arg_max(home_goals, ord) FILTER (is_played) AS home_goals, arg_max(away_goals, ord) FILTER (is_played) AS away_goals, bool_or(is_played) AS is_played, min(rid) AS match_id, max(feed) AS feed FROM fs GROUP BY 1, 2, 3, 4),
pc AS (SELECT 'C' || c.competition_id AS competition, start_year, 'Team ' || home_team_id AS home_team, 'Team ' || away_team_id AS away_team, count(*) AS predictions FROM pd JOIN contests c USING (match_id) GROUP BY 1, 2, 3, 4),
fk AS (SELECT fg.*, coalesce(predictions, 0) AS predictions, feed < max(feed) OVER (PARTITION BY competition, start_year) AS lacking FROM fg LEFT JOIN pc USING (competition, start_year, home_team, away_team))"""


@query("x1_streaming_curation", FEEDS + " SELECT competition, start_year, home_team, away_team, match_date::VARCHAR AS match_date, kickoff_time, home_goals, away_goals, CASE WHEN home_goals > away_goals THEN 'H' WHEN home_goals < away_goals THEN 'A' WHEN home_goals = away_goals THEN 'D' END AS result, is_played, match_id FROM fk WHERE NOT lacking OR is_played OR predictions > 0")
def x1(m):
    """Two feeds with postponements, late results and contests that go: curated as a stream, then what the newest feed lacks retired."""
    table = curated_table(m)
    curation.retire(table, predicted(m))
    return curation.contests_of(table.read()).drop("row_hash", "result_code", "feed")


@query("d5_streamed_stale", FEEDS + " SELECT competition, start_year, home_team, away_team, match_id, concat_ws(', ', CASE WHEN is_played THEN 'already played' END, CASE WHEN predictions > 0 THEN predictions || ' stored prediction(s)' END) AS reasons, CASE WHEN is_played OR predictions > 0 THEN 'protected' ELSE 'delete' END AS fate FROM fk WHERE lacking")
def d5(m):
    return curation.stale_rows(curated_table(m), predicted(m))
