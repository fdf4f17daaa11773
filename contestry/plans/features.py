"""Registered queries: features and tables of contests."""

from __future__ import annotations

import re

from pyspark.sql import functions as F

from contestry.operators import form
from contestry.sources.contests import contests, stored_contests, with_contests

QUERIES: dict = {}
ORACLE: dict = {}


def rounded(df, digits: int = 6):
    shown = {"double": lambda c: F.round(c, digits), "date": lambda c: F.date_format(c, "yyyy-MM-dd")}
    return df.select(*[shown.get(kind, F.col)(c).alias(c) for c, kind in df.dtypes])


def query(name: str, sql: str | None = None, recursive: bool = False):
    def add(f):
        QUERIES[name] = lambda spark, sf_dir: rounded(f(spark, sf_dir))
        if sql:
            ORACLE[name] = with_contests(sql, recursive)
        return f

    return add


LONG = """
lf AS (SELECT match_id, competition_id, match_date, kickoff_time, is_played, start_year, home_team_id AS team_id, away_team_id AS opponent_id, TRUE AS is_home, home_goals::BIGINT AS goals_for, away_goals::BIGINT AS goals_against FROM contests
  UNION ALL SELECT match_id, competition_id, match_date, kickoff_time, is_played, start_year, away_team_id, home_team_id, FALSE, away_goals, home_goals FROM contests),
lg AS (SELECT *, goals_for - goals_against AS goal_diff, goals_for + goals_against AS goals_total, (goals_for > goals_against)::INT::DOUBLE AS win, (goals_for = goals_against)::INT::DOUBLE AS draw,
  (CASE WHEN goals_for > goals_against THEN 3 WHEN goals_for = goals_against THEN 1 WHEN goals_for < goals_against THEN 0 END)::BIGINT AS points FROM lf)
"""
FORM_COLUMNS = """round(avg(win) OVER o, 6) AS win_rate_l5, round(avg(draw) OVER o, 6) AS draw_rate_l5, round(avg(goals_for) OVER o, 6) AS goals_scored_avg_l5, round(avg(goals_against) OVER o, 6) AS goals_conceded_avg_l5,
  round(avg(goals_total) OVER o, 6) AS goals_total_avg_l5, (sum(points) OVER o)::BIGINT AS points_l5, (sum(goal_diff) OVER o)::BIGINT AS gd_l5, count(*) OVER o AS prior_n,
  round(avg(win) OVER v, 6) AS venue_win_rate_l5, round(avg(draw) OVER v, 6) AS venue_draw_rate_l5"""
WINDOWS = """WINDOW o AS (PARTITION BY competition_id, team_id ORDER BY match_date, kickoff_time, match_id ROWS BETWEEN 5 PRECEDING AND 1 PRECEDING),
  v AS (PARTITION BY competition_id, team_id, is_home ORDER BY match_date, kickoff_time, match_id ROWS BETWEEN 5 PRECEDING AND 1 PRECEDING)"""


@query("s11_contests", "SELECT * REPLACE (match_date::VARCHAR AS match_date) FROM contests")
def s11(spark, sf_dir):
    return contests(spark, sf_dir)


@query("u1_long_form", LONG + " SELECT match_id, competition_id, match_date::VARCHAR AS match_date, kickoff_time, is_played, start_year, team_id, opponent_id, is_home, goals_for, goals_against, goal_diff, goals_total, win, draw, points FROM lg")
def u1(spark, sf_dir):
    return form.long_form(contests(spark, sf_dir))


@query("w1_trailing_form", LONG + f" SELECT match_id, is_home, {FORM_COLUMNS} FROM lg WHERE is_played {WINDOWS}")
def w1(spark, sf_dir):
    return form.trailing_form(contests(spark, sf_dir).where("is_played"))


ASOF = """
j AS (SELECT t.match_id, t.is_home, h.win, h.draw, h.goals_for, h.goals_against, h.goals_total, h.points, h.goal_diff,
    row_number() OVER (PARTITION BY t.match_id, t.is_home ORDER BY h.match_date DESC, h.match_id DESC) AS rn,
    h.is_home = t.is_home AS same_venue, row_number() OVER (PARTITION BY t.match_id, t.is_home, h.is_home = t.is_home ORDER BY h.match_date DESC, h.match_id DESC) AS rv
  FROM lg t JOIN lg h ON NOT t.is_played AND h.is_played AND t.competition_id = h.competition_id AND t.team_id = h.team_id AND (h.match_date < t.match_date OR (h.match_date = t.match_date AND h.match_id < t.match_id)))
"""


@query("j3_asof_form", LONG + "," + ASOF + """ SELECT t.match_id, t.is_home, round(avg(win) FILTER (rn <= 5), 6) AS win_rate_l5, round(avg(draw) FILTER (rn <= 5), 6) AS draw_rate_l5, round(avg(goals_for) FILTER (rn <= 5), 6) AS goals_scored_avg_l5,
  round(avg(goals_against) FILTER (rn <= 5), 6) AS goals_conceded_avg_l5, round(avg(goals_total) FILTER (rn <= 5), 6) AS goals_total_avg_l5, (sum(points) FILTER (rn <= 5))::BIGINT AS points_l5, (sum(goal_diff) FILTER (rn <= 5))::BIGINT AS gd_l5,
  count(*) FILTER (rn <= 5) AS prior_n, round(avg(win) FILTER (same_venue AND rv <= 5), 6) AS venue_win_rate_l5, round(avg(draw) FILTER (same_venue AND rv <= 5), 6) AS venue_draw_rate_l5
  FROM (SELECT match_id, is_home FROM lg WHERE NOT is_played) t LEFT JOIN j ON t.match_id = j.match_id AND t.is_home = j.is_home GROUP BY 1, 2""")
def j3(spark, sf_dir):
    return form.asof_form(stored_contests(spark, sf_dir))


H2H = """
h2 AS (SELECT c.match_id, avg(CASE WHEN h.match_id IS NULL THEN NULL WHEN (h.home_team_id = c.home_team_id AND h.result = 'H') OR (h.away_team_id = c.home_team_id AND h.result = 'A') THEN 1.0 ELSE 0.0 END) AS w,
    avg(CASE WHEN h.match_id IS NULL THEN NULL WHEN h.result = 'D' THEN 1.0 ELSE 0.0 END) AS d
  FROM contests c LEFT JOIN contests h ON h.is_played AND h.competition_id = c.competition_id AND least(h.home_team_id, h.away_team_id) = least(c.home_team_id, c.away_team_id)
    AND greatest(h.home_team_id, h.away_team_id) = greatest(c.home_team_id, c.away_team_id) AND (h.match_date < c.match_date OR (h.match_date = c.match_date AND h.match_id < c.match_id)) GROUP BY 1)
"""


@query("j5_head_to_head", H2H + " SELECT match_id, round(w, 6) AS h2h_home_win_rate_n, round(d, 6) AS h2h_draw_rate_n FROM h2")
def j5(spark, sf_dir):
    return form.head_to_head(contests(spark, sf_dir))


ELO = """
sq AS (SELECT *, row_number() OVER (PARTITION BY competition_id ORDER BY match_date, kickoff_time, match_id) AS rn FROM contests),
el AS (SELECT competition_id, 0::BIGINT AS rn, MAP {-1::BIGINT: 0.0::DOUBLE} AS m, NULL::BIGINT AS match_id, NULL::DOUBLE AS h, NULL::DOUBLE AS a FROM (SELECT DISTINCT competition_id FROM contests)
  UNION ALL SELECT competition_id, rn, CASE WHEN is_played THEN map_concat(m, MAP {home_team_id: h + 20 * (actual - e), away_team_id: a - 20 * (actual - e)}) ELSE m END, match_id, h, a FROM (
    SELECT *, 1 / (1 + pow(10, (a - h - 100) / 400.0)) AS e FROM (
      SELECT s.*, el.m, coalesce(el.m[s.home_team_id], 1500.0)::DOUBLE AS h, coalesce(el.m[s.away_team_id], 1500.0)::DOUBLE AS a, CASE s.result WHEN 'H' THEN 1.0 WHEN 'A' THEN 0.0 ELSE 0.5 END AS actual
      FROM el JOIN sq s ON s.competition_id = el.competition_id AND s.rn = el.rn + 1)))
"""


@query("w4_elo", ELO + " SELECT match_id, round(h, 6) AS home_elo, round(a, 6) AS away_elo FROM el WHERE rn > 0", recursive=True)
def w4(spark, sf_dir):
    return form.elo(contests(spark, sf_dir))


_RAW = lambda sql: re.sub(r"round\((.*?), 6\)", r"\1", sql)
_J3 = ORACLE["j3_asof_form"].partition("SELECT t.match_id, t.is_home, round(avg(win)")
_SIDE = ["win_rate_l5", "draw_rate_l5", "goals_scored_avg_l5", "goals_conceded_avg_l5", "goals_total_avg_l5", "points_l5", "gd_l5", "prior_n"]
_SHOWN = [f"round({s}.{c}, 6) AS {n}_{c}" if "avg" in c or "rate" in c else f"{s}.{c} AS {n}_{c}" for s, n in (("h", "home"), ("a", "away")) for c in _SIDE]
#: ft: the whole feature table.
FEATURE_SQL = LONG + "," + ASOF + "," + H2H + "," + ELO + f""",
wf AS (SELECT match_id, is_home, {_RAW(FORM_COLUMNS)} FROM lg WHERE is_played {WINDOWS}),
af AS ({_RAW(_J3[1] + _J3[2])}),
fm AS (SELECT * FROM wf UNION ALL BY NAME SELECT * FROM af),
ft AS (SELECT h.match_id, {", ".join(_SHOWN)}, round(h.venue_win_rate_l5, 6) AS home_home_win_rate_l5, round(h.venue_draw_rate_l5, 6) AS home_home_draw_rate_l5, round(a.venue_win_rate_l5, 6) AS away_away_win_rate_l5, round(a.venue_draw_rate_l5, 6) AS away_away_draw_rate_l5,
  round(h2.w, 6) AS h2h_home_win_rate_n, round(h2.d, 6) AS h2h_draw_rate_n, round(el.h, 6) AS home_elo, round(el.a, 6) AS away_elo, round(abs(el.h - el.a), 6) AS elo_abs_diff,
  round(h.points_l5 / greatest(h.prior_n, 1) - a.points_l5 / greatest(a.prior_n, 1), 6) AS ppg_diff_l5, round(h.goals_scored_avg_l5 - a.goals_scored_avg_l5, 6) AS gf_diff_l5, round(h.goals_conceded_avg_l5 - a.goals_conceded_avg_l5, 6) AS ga_diff_l5,
  round((h.goals_total_avg_l5 + a.goals_total_avg_l5) / 2, 6) AS recent_total_goals_avg_l5, 'v1' AS feature_version
  FROM fm h JOIN fm a ON h.match_id = a.match_id AND h.is_home AND NOT a.is_home JOIN h2 ON h2.match_id = h.match_id JOIN el ON el.match_id = h.match_id)
"""


@query("n26_feature_table", FEATURE_SQL + " SELECT * FROM ft", recursive=True)
def n26(spark, sf_dir):
    return form.feature_table(stored_contests(spark, sf_dir))
