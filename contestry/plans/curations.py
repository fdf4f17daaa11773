"""Registered queries: curation and quality gates."""

from __future__ import annotations

from pyspark.sql import functions as F

from contestry.operators import curation as c
from contestry.operators import tables as t
from contestry.plans.features import rounded
from contestry.sources.contests import stored_contests, with_contests
from contestry.sources.raw import raw_rows

QUERIES: dict = {}
ORACLE: dict = {}


def query(name: str, sql: str | None = None):
    def add(f):
        QUERIES[name] = lambda spark, sf_dir: rounded(f(stored_contests(spark, sf_dir)))
        if sql:
            ORACLE[name] = with_contests(sql)
        return f

    return add


RAW = """
cp AS (SELECT *, NOT is_played AND match_id % 3 = 0 AS moved FROM contests),
rw AS (SELECT cp.*, copy, match_id * 2 + copy AS rid, match_date + CASE WHEN moved AND copy = 1 THEN 7 ELSE 0 END AS day FROM cp, (VALUES (0), (1)) v(copy) WHERE copy = 0 OR moved OR match_id % 5 = 0),
vl AS (SELECT rid, 'C' || competition_id AS competition, day::DATE AS match_date, kickoff_time, 'Team ' || home_team_id AS home_team, 'Team ' || away_team_id AS away_team, home_goals, away_goals, result, result_code, is_played,
  (year(day) - (month(day) < 8)::INT)::INT AS start_year FROM rw WHERE match_id % 101 <> 0 AND NOT (is_played AND match_id % 97 = 0)),
mg AS (SELECT competition, start_year, home_team, away_team, coalesce(arg_min(match_date, rid) FILTER (is_played), arg_max(match_date, rid)) AS match_date, arg_max(kickoff_time, rid) AS kickoff_time, arg_max(home_goals, rid) FILTER (is_played) AS home_goals,
  arg_max(away_goals, rid) FILTER (is_played) AS away_goals, arg_max(result, rid) FILTER (is_played) AS result, bool_or(is_played) AS is_played, min(rid) AS match_id FROM vl GROUP BY 1, 2, 3, 4)
"""


def curated(m):
    return c.valid_rows(c.transform(c.without_blank_rows(raw_rows(m))))


@query("n6_transform", RAW + " SELECT rid, competition, match_date::VARCHAR AS match_date, kickoff_time, home_team, away_team, home_goals, away_goals, result, is_played, start_year FROM vl")
def n6(m):
    return curated(m).select("rid", "competition", "match_date", "kickoff_time", "home_team", "away_team", "home_goals", "away_goals", "result", "is_played", "start_year")


@query("d3_merge", RAW + " SELECT competition, start_year, home_team, away_team, match_date::VARCHAR AS match_date, kickoff_time, home_goals, away_goals, result, is_played, match_id FROM mg")
def d3(m):
    return c.merge(curated(m)).drop("row_hash", "result_code")


def _existing(m):
    """Curated rows with a count of stored predictions."""
    return c.merge(curated(m)).withColumn("predictions", (F.col("match_id") % 4 == 0).cast("int"))


EXISTING = RAW + ", ex AS (SELECT *, (match_id % 4 = 0)::INT AS predictions FROM mg), fd AS (SELECT * FROM ex WHERE match_id % 9 <> 0 AND start_year >= 1999)"


@query("d5_stale", EXISTING + " SELECT match_id, concat_ws(', ', CASE WHEN is_played THEN 'already played' END, CASE WHEN predictions > 0 THEN predictions || ' stored prediction(s)' END) AS reasons, CASE WHEN is_played OR predictions > 0 THEN 'protected' ELSE 'delete' END AS fate FROM ex WHERE (competition, start_year) IN (SELECT competition, start_year FROM fd) AND NOT EXISTS (SELECT 1 FROM fd WHERE fd.competition = ex.competition AND fd.start_year = ex.start_year AND fd.home_team = ex.home_team AND fd.away_team = ex.away_team)")
def d5(m):
    existing = _existing(m)
    return c.stale(existing, existing.where("match_id % 9 <> 0 and start_year >= 1999"))


@query("d2_reschedule_targets", RAW + ", dl AS (SELECT vl.*, rid AS match_id, (rid % 4 = 0)::INT AS predictions FROM vl), rk AS (SELECT *, row_number() OVER (PARTITION BY competition, start_year, home_team, away_team ORDER BY is_played, (predictions > 0) DESC, match_id) AS p FROM dl) SELECT match_id, CASE WHEN p = 1 THEN 'target' WHEN is_played OR predictions > 0 THEN 'kept' ELSE 'dropped' END AS fate FROM rk")
def d2(m):
    rows = curated(m).withColumn("match_id", F.col("rid")).withColumn("predictions", (F.col("rid") % 4 == 0).cast("int"))
    return c.reschedule_targets(rows).select("match_id", "fate")


@query("s7_upsert", "o AS (SELECT match_id, home_goals AS goals, is_played FROM contests WHERE match_id % 2 = 0), n AS (SELECT match_id, away_goals AS goals, is_played FROM contests WHERE match_id % 3 = 0) SELECT match_id, CASE WHEN o.match_id IS NULL OR (n.match_id IS NOT NULL AND NOT o.is_played) THEN n.goals ELSE o.goals END AS goals, CASE WHEN o.match_id IS NULL THEN 'inserted' WHEN n.match_id IS NULL THEN 'unchanged' WHEN o.is_played THEN 'kept' ELSE 'updated' END AS change FROM o FULL JOIN n USING (match_id)")
def s7(m):
    """With the freeze of played rows (J14, D6)."""
    old = m.where("match_id % 2 = 0").select("match_id", F.col("home_goals").alias("goals"), "is_played")
    new = m.where("match_id % 3 = 0").select("match_id", F.col("away_goals").alias("goals"), "is_played")
    return c.upsert(old, new, ["match_id"], F.col("o.is_played")).drop("is_played")


@query("d10_season_problems", "sm AS (SELECT competition_id, start_year, count(*) AS matches, count(*) FILTER (is_played) AS played, count(*) FILTER (result_code = 1) AS draw FROM contests GROUP BY 1, 2) SELECT competition_id, start_year, unnest(list_filter([CASE WHEN start_year < 2000 AND matches <> 80 AND start_year BETWEEN 1995 AND 1999 THEN 'incomplete' END, CASE WHEN played >= 30 AND NOT draw / played BETWEEN 0.15 AND 0.35 THEN 'draw share' END], lambda x: x IS NOT NULL)) AS problem FROM sm")
def d10(m):
    catalog = m.select("competition_id").distinct().withColumns({"first_year": F.lit(1995), "last_year": F.lit(1999), "matches": F.lit(80)})
    return c.season_problems(t.season_summary(m), catalog, live=2000)


@query("d10_league_problems", """sm AS (SELECT competition_id, start_year, is_played, result_code FROM contests WHERE competition_id < 3 OR NOT (is_played AND match_id % 3 > 0)),
lg AS (SELECT competition_id, count(*) FILTER (NOT is_played AND start_year < 2001) AS unplayed, count(*) FILTER (is_played) AS played, count(*) FILTER (is_played AND result_code = 1 AND competition_id <> 1) AS draw, count(*) FILTER (is_played AND result_code = 1 AND competition_id = 1) AS uncoded FROM sm GROUP BY 1)
SELECT competition_id, 'unplayed in completed seasons' AS problem, unplayed AS rows FROM lg WHERE unplayed > 0 UNION ALL SELECT competition_id, 'nothing played', played FROM lg WHERE played = 0 UNION ALL SELECT competition_id, 'uncoded results', uncoded FROM lg WHERE uncoded <> 0 UNION ALL SELECT competition_id, 'draw share', played FROM lg WHERE played > 0 AND NOT draw / played BETWEEN 0.15 AND 0.35""")
def d10_league(m):
    """With 2001 as the live season: that before has unplayed contests. Competition 1 has lost the codes of its draws, and others rows."""
    spoiled = m.where("competition_id < 3 or not (is_played and match_id % 3 > 0)")
    coded = F.when((F.col("competition_id") == 1) & (F.col("result_code") == 1), F.lit(None)).otherwise(F.col("result_code"))
    return c.league_problems(t.season_summary(spoiled.withColumn("result_code", coded)), live=2001)


@query("d11_clubs_and_pairings", """sz AS (SELECT competition_id, start_year, count(DISTINCT team_id) + (start_year % 2) AS clubs FROM (SELECT competition_id, start_year, unnest([home_team_id, away_team_id]) AS team_id FROM contests) GROUP BY 1, 2)
SELECT competition_id, start_year, 'clubs' AS problem, (clubs - 1)::BIGINT AS rows FROM sz WHERE start_year % 2 = 1 UNION ALL SELECT competition_id, start_year, 'repeated pairings', count(*) FROM (SELECT competition_id, start_year, home_team_id, away_team_id FROM contests GROUP BY ALL HAVING count(*) > 1) GROUP BY 1, 2""")
def d11_clubs(m):
    """Odd seasons are said to have one club more."""
    sides = m.select("competition_id", "start_year", F.explode(F.array("home_team_id", "away_team_id")).alias("team_id"))
    sizes = sides.groupBy("competition_id", "start_year").agg((F.count_distinct("team_id") + F.col("start_year") % 2).alias("clubs"))
    return c.club_problems(m, sizes)
