"""Registered queries: result and fixture files, and file sinks, written and read back."""

from __future__ import annotations

import uuid

from pyspark.sql import functions as F

from contestry.operators import curation as c
from contestry.operators import tables as t
from contestry.plans import reports
from contestry.plans.curations import RAW
from contestry.plans.features import rounded
from contestry.sources import raw
from contestry.sources.contests import stored_contests, with_contests
from contestry.sources.store import shared_dir, until_exit

QUERIES: dict = {}
ORACLE: dict = {}


def query(name: str, sql: str | None = None):
    def add(f):
        QUERIES[name] = lambda spark, sf_dir: rounded(f(stored_contests(spark, sf_dir)))
        if sql:
            ORACLE[name] = sql if sql.startswith("WITH") else with_contests(sql)
        return f

    return add


def folder(m, name: str) -> str:
    return f"{shared_dir(m.sparkSession)}/{name}-{uuid.uuid4().hex}"


@query("s1_result_files", RAW + """ SELECT vl.rid, vl.competition, vl.match_date::VARCHAR AS match_date, CASE WHEN c.start_year >= 1999 THEN vl.kickoff_time END AS kickoff_time, vl.home_team, vl.away_team, vl.home_goals, vl.away_goals, vl.result, CASE WHEN c.start_year >= 1999 THEN 'x' ELSE '' END AS referee
FROM vl JOIN contests c ON c.match_id = vl.rid // 2""")
def s1(m):
    """Season files of two layouts (older ones without kickoffs, newer ones with a further column in front), read by name, checked and curated."""
    spark, path = m.sparkSession, folder(m, "results")
    old, new = raw.raw_rows(m.where("start_year < 1999")).drop("Time"), raw.raw_rows(m.where("start_year >= 1999"))
    raw.write_csv(old, f"{path}/old")
    raw.write_csv(new.select(F.lit("x").alias("Referee"), *[F.col(x) for x in reversed(new.columns)]), f"{path}/new")
    until_exit(spark, path)
    rows = raw.read_results(spark, f"{path}/*")
    if missing := c.missing_columns(rows):
        raise ValueError(f"columns are missing: {missing}")
    rows = rows.withColumn("rid", F.col("rid").cast("long"))
    parsed = c.valid_rows(c.transform(c.without_blank_rows(rows)), strict=False)
    shown = parsed.select("rid", "competition", "match_date", "kickoff_time", "home_team", "away_team", "home_goals", "away_goals", "result")
    return shown.join(rows.select("rid", F.col("Referee").alias("referee")), "rid")


@query("s5_fixture_files", "SELECT 'C' || competition_id AS \"Div\", strftime(match_date, '%d/%m/%Y') AS \"Date\", left(kickoff_time, 5) AS \"Time\", 'Team ' || home_team_id AS \"HomeTeam\", 'Team ' || away_team_id AS \"AwayTeam\", '' AS \"FTHG\", '' AS \"FTAG\", '' AS \"FTR\" FROM contests WHERE NOT is_played AND competition_id = (SELECT min(competition_id) FROM contests WHERE NOT is_played)")
def s5(m):
    """The first competition's fixture file: days with a Z, an offset or no zone, and scores that don't count."""
    path, name = folder(m, "fixtures"), lambda c: F.concat(F.lit("Team "), F.col(c).cast("string"))
    at = F.to_timestamp(F.concat_ws(" ", F.col("match_date").cast("string"), F.col("kickoff_time")))
    ahead = F.date_format(at + F.expr("INTERVAL 2 HOURS"), "yyyy-MM-dd HH:mm:ss")
    plain = F.date_format(at, "yyyy-MM-dd HH:mm:ss")
    shown = F.when(F.col("match_id") % 3 == 0, F.concat(plain, F.lit("Z"))).when(F.col("match_id") % 3 == 1, F.concat(F.replace(ahead, F.lit(" "), F.lit("T")), F.lit("+02:00"))).otherwise(plain)
    entry = F.struct(shown.alias("DateUtc"), name("home_team_id").alias("HomeTeam"), name("away_team_id").alias("AwayTeam"), F.lit(3).alias("HomeTeamScore"))
    # a fixture file is one JSON array, a season's contests of a competition
    feed = m.where("not is_played").groupBy("competition_id").agg(F.to_json(F.collect_list(entry)).alias("value"))
    feed.write.partitionBy("competition_id").text(path)
    until_exit(m.sparkSession, path)
    first = m.where("not is_played").agg(F.min("competition_id")).first()[0]
    return raw.read_fixtures(m.sparkSession, f"{path}/competition_id={first}", f"C{first}")


@query("s16_csv_sink", reports.ORACLE["a6_league_table"])
def s16(m):
    """The league tables as CSV with a header, read back."""
    path, table = folder(m, "table"), t.league_table(m, "start_year")
    raw.write_csv(table, path)
    until_exit(m.sparkSession, path)
    return m.sparkSession.read.option("header", True).schema(table.schema).csv(path)


@query("s17_json_sink", reports.ORACLE["a6_league_table"])
def s17(m):
    """The league tables as JSON objects, read back."""
    path, table = folder(m, "table"), t.league_table(m, "start_year")
    raw.write_json(table, path)
    until_exit(m.sparkSession, path)
    return m.sparkSession.read.schema(table.schema).json(path)
