"""Registered queries: tables, summaries, reports."""

from __future__ import annotations

from pyspark.sql import Window as W
from pyspark.sql import functions as F

from contestry.functions import scalars as s
from contestry.operators import tables as t
from contestry.plans.features import LONG, rounded
from contestry.sources.contests import contests, with_contests

QUERIES: dict = {}
ORACLE: dict = {}


def query(name: str, sql: str | None = None):
    def add(f):
        QUERIES[name] = lambda spark, sf_dir: rounded(f(contests(spark, sf_dir)))
        if sql:
            ORACLE[name] = with_contests(sql)
        return f

    return add


TABLE = LONG + """,
tb AS (SELECT competition_id, start_year, team_id, count(*) FILTER (is_played) AS played, coalesce(sum(points) FILTER (is_played), 0)::BIGINT AS points, coalesce(sum(goals_for) FILTER (is_played), 0)::BIGINT AS gf, coalesce(sum(goals_against) FILTER (is_played), 0)::BIGINT AS ga FROM lg GROUP BY 1, 2, 3),
lt AS (SELECT *, gf - ga AS gd, (row_number() OVER (PARTITION BY competition_id, start_year ORDER BY points DESC, gf - ga DESC, gf DESC, team_id))::INT AS position FROM tb)
"""


@query("a6_league_table", TABLE + " SELECT * FROM lt")
def a6(m):
    return t.league_table(m, "start_year")


@query("j24_table_ranks", TABLE + " SELECT c.match_id, h.position AS home_position, a.position AS away_position FROM contests c LEFT JOIN lt h ON h.competition_id = c.competition_id AND h.start_year = c.start_year AND h.team_id = c.home_team_id LEFT JOIN lt a ON a.competition_id = c.competition_id AND a.start_year = c.start_year AND a.team_id = c.away_team_id")
def j24(m):
    return t.with_positions(m, t.league_table(m, "start_year"), "start_year").select("match_id", "home_position", "away_position")


@query("m23_champions", TABLE + " SELECT competition_id, start_year, team_id, points FROM (SELECT *, row_number() OVER (PARTITION BY competition_id, start_year ORDER BY points DESC, gd DESC, gf DESC, team_id) AS p FROM lt WHERE played > 0) WHERE p = 1")
def m23(m):
    return t.champions(m)


@query("a2_season_summary", "SELECT competition_id, start_year, count(*) AS matches, count(*) FILTER (is_played) AS played, count(*) FILTER (NOT is_played) AS unplayed, count(*) FILTER (result_code = 0) AS away, count(*) FILTER (result_code = 1) AS draw, count(*) FILTER (result_code = 2) AS home FROM contests GROUP BY 1, 2")
def a2(m):
    return t.season_summary(m)


SPLIT = "sp AS (SELECT *, CASE WHEN match_date <= DATE '1998-07-31' THEN 'train' WHEN match_date <= DATE '1999-07-31' THEN 'valid' WHEN match_date <= DATE '2000-07-31' THEN 'test' END AS split FROM contests WHERE is_played)"


def _split(m):
    return m.where("is_played").withColumn("split", t.splits("1998-07-31", "1999-07-31", "2000-07-31"))


@query("d8_splits", SPLIT + " SELECT match_id, split FROM sp")
def d8(m):
    return _split(m).select("match_id", "split")


@query("a3_split_counts", SPLIT + " SELECT split, count(*) FILTER (result_code = 0) AS away, count(*) FILTER (result_code = 1) AS draw, count(*) FILTER (result_code = 2) AS home FROM sp WHERE split IS NOT NULL GROUP BY 1")
def a3(m):
    return t.split_counts(_split(m).where("split is not null"))


@query("d9_split_order", SPLIT + ", b AS (SELECT split, min(match_date) AS lo, max(match_date) AS hi FROM sp GROUP BY 1) SELECT (SELECT hi FROM b WHERE split = 'train') <= (SELECT lo FROM b WHERE split = 'valid') AND (SELECT hi FROM b WHERE split = 'valid') <= (SELECT lo FROM b WHERE split = 'test') AND (SELECT hi FROM b WHERE split = 'train') <= (SELECT lo FROM b WHERE split = 'test') AS chronological, 0::BIGINT AS unknown")
def d9(m):
    return t.split_problems(_split(m))


@query("a4_club_counts", LONG + " SELECT competition_id, start_year, count(DISTINCT team_id) AS clubs FROM lg GROUP BY 1, 2")
def a4(m):
    return t.club_counts(m)


@query("a5_repeated_pairings", "p AS (SELECT competition_id, start_year, home_team_id, away_team_id, count(*) AS c FROM contests GROUP BY 1, 2, 3, 4 HAVING count(*) > 1) SELECT competition_id, start_year, count(*) AS repeated, sum(c)::BIGINT AS rows FROM p GROUP BY 1, 2")
def a5(m):
    return t.repeated_pairings(m)


@query("t1_upcoming", "SELECT match_id, match_date::VARCHAR AS match_date, kickoff_time, home_team_id, away_team_id FROM contests WHERE NOT is_played ORDER BY contests.match_date, kickoff_time NULLS LAST, match_id")
def t1(m):
    return t.upcoming(m).select("match_id", "match_date", "kickoff_time", "home_team_id", "away_team_id")


@query("t2_latest_completed", "SELECT match_id, match_date::VARCHAR AS match_date FROM contests WHERE is_played ORDER BY contests.match_date DESC, kickoff_time DESC NULLS LAST, match_id DESC LIMIT 1")
def t2(m):
    return m.where("is_played").orderBy(F.col("match_date").desc(), F.col("kickoff_time").desc_nulls_last(), F.col("match_id").desc()).limit(1).select("match_id", "match_date")


@query("t3_page", "SELECT match_id, (row_number() OVER (ORDER BY match_date, match_id))::INT AS place FROM contests WHERE NOT is_played QUALIFY ceil(place / 20) = least(2, greatest(ceil(count(*) OVER () / 20), 1))")
def t3(m):
    return t.page(m.where("not is_played").select("match_id", "match_date"), [F.col("match_date"), F.col("match_id")], 2, 50).select("match_id", "place")


@query("t4_earlier_meetings", "e AS (SELECT c.match_id, h.match_id AS past_id, h.match_date AS past_date, h.home_goals, h.away_goals, (row_number() OVER (PARTITION BY c.match_id ORDER BY h.match_date DESC, h.match_id DESC))::INT AS place FROM contests c JOIN contests h ON NOT c.is_played AND h.is_played AND h.competition_id = c.competition_id AND least(h.home_team_id, h.away_team_id) = least(c.home_team_id, c.away_team_id) AND greatest(h.home_team_id, h.away_team_id) = greatest(c.home_team_id, c.away_team_id) AND h.match_date < c.match_date) SELECT * REPLACE (past_date::VARCHAR AS past_date) FROM e WHERE place <= 5")
def t4(m):
    return t.earlier_meetings(m)


@query("t5_by_date", "SELECT match_date::VARCHAR AS match_date, count(*) AS n, string_agg(match_id::VARCHAR, ',' ORDER BY kickoff_time, match_id) AS match_ids FROM contests WHERE NOT is_played GROUP BY contests.match_date")
def t5(m):
    return t.by_date(m.where("not is_played"))


@query("t9_settled", "SELECT match_id, result, (row_number() OVER (PARTITION BY competition_id ORDER BY match_date DESC, coalesce(kickoff_time, '00:00:00') DESC, match_id DESC))::INT AS place FROM contests WHERE is_played AND start_year = 2000")
def t9(m):
    """Newest first in each competition."""
    order = [F.col("match_date").desc(), F.coalesce("kickoff_time", F.lit("00:00:00")).desc(), F.col("match_id").desc()]
    return m.where("is_played and start_year = 2000").select("match_id", "result", F.row_number().over(W.partitionBy("competition_id").orderBy(*order)).alias("place"))


@query("t3_last_page", "SELECT match_id, (row_number() OVER (ORDER BY match_date, match_id))::INT AS place FROM contests WHERE is_played QUALIFY ceil(place / 10) = ceil(count(*) OVER () / 10)")
def t3_last(m):
    """A page beyond the last is the last; a size below 10 is 10."""
    return t.page(m.where("is_played").select("match_id", "match_date"), [F.col("match_date"), F.col("match_id")], 10**6, 3).select("match_id", "place")


@query("n12_team_filter", "SELECT match_id FROM contests WHERE (home_team_id = 7 OR away_team_id = 7) AND match_date BETWEEN DATE '1996-01-01' AND DATE '1999-12-31'")
def n12(m):
    return m.where(((F.col("home_team_id") == 7) | (F.col("away_team_id") == 7)) & F.col("match_date").between("1996-01-01", "1999-12-31")).select("match_id")


@query("u6_teams", "SELECT DISTINCT competition_id, unnest([home_team_id, away_team_id]) AS team_id FROM contests ORDER BY 1, 2")
def u6(m):
    return m.select("competition_id", F.explode(F.array("home_team_id", "away_team_id")).alias("team_id")).distinct().orderBy("competition_id", "team_id")


@query("w7_first_competition", "SELECT team_id, arg_min(competition_id, match_id) AS competition_id FROM (SELECT unnest([home_team_id, away_team_id]) AS team_id, competition_id, match_id FROM contests) GROUP BY 1")
def w7(m):
    return m.select("competition_id", "match_id", F.explode(F.array("home_team_id", "away_team_id")).alias("team_id")).groupBy("team_id").agg(F.min_by("competition_id", "match_id").alias("competition_id"))


CUT = LONG + """, cl AS (SELECT competition_id, start_year, count(DISTINCT team_id) AS clubs FROM lg GROUP BY 1, 2),
nm AS (SELECT contests.*, row_number() OVER (PARTITION BY contests.competition_id, contests.start_year ORDER BY match_date, kickoff_time, match_id) AS n, clubs FROM contests JOIN cl USING (competition_id, start_year) WHERE is_played),
ck AS (SELECT competition_id, start_year, g::INT AS checkpoint, match_date AS cutoff FROM nm, (VALUES (1), (2), (3)) v(g) WHERE n = g * clubs // 2)"""


@query("w8_checkpoint_cutoffs", CUT + " SELECT competition_id, start_year, checkpoint, cutoff::VARCHAR AS cutoff FROM ck")
def w8(m):
    return t.checkpoint_cutoffs(m, [1, 2, 3])


@query("a21_games_at_cutoff", CUT + ", gm AS (SELECT lg.competition_id, lg.start_year, checkpoint, team_id, count(*) AS games FROM lg JOIN ck ON lg.competition_id = ck.competition_id AND lg.start_year = ck.start_year WHERE is_played AND match_date <= cutoff GROUP BY 1, 2, 3, 4) SELECT competition_id, start_year, checkpoint, min(games) AS least, median(games)::DOUBLE AS median, max(games) AS most FROM gm GROUP BY 1, 2, 3")
def a21(m):
    return t.games_at_cutoff(m, t.checkpoint_cutoffs(m, [1, 2, 3]))


@query("n24_seasons", "SELECT match_id, start_year, make_date(start_year, 8, 1)::VARCHAR AS season_start, make_date(start_year + 1, 7, 31)::VARCHAR AS season_end, printf('%d/%02d', start_year, (start_year + 1) % 100) AS season FROM contests")
def n24(m):
    y = F.col("start_year")
    return m.select("match_id", "start_year", F.make_date(y, F.lit(8), F.lit(1)).alias("season_start"), F.make_date(y + 1, F.lit(7), F.lit(31)).alias("season_end"), s.season_name(y).alias("season"))


@query("n18_ordinals", TABLE + " SELECT team_id, competition_id, start_year, position::VARCHAR || CASE WHEN position % 100 BETWEEN 10 AND 20 THEN 'th' WHEN position % 10 = 1 THEN 'st' WHEN position % 10 = 2 THEN 'nd' WHEN position % 10 = 3 THEN 'rd' ELSE 'th' END AS place FROM lt")
def n18(m):
    return t.league_table(m, "start_year").select("team_id", "competition_id", "start_year", s.ordinal(F.col("position")).alias("place"))
