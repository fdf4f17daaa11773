"""Registered queries: training rows, gates, checkpoint features, run registry."""

from __future__ import annotations

import re

from pyspark.sql import functions as F

from contestry.operators import curation as c
from contestry.operators import evaluate, form, registry, training
from contestry.operators import tables as t
from contestry.plans.features import ELO, FEATURE_SQL, LONG, rounded
from contestry.plans.payloads import PRODUCTION, SETTLED, in_use, named, settled_rows
from contestry.sources import derived as d
from contestry.sources.contests import stored_contests, with_contests
from contestry.sources.store import stored

QUERIES: dict = {}
ORACLE: dict = {}
ENDS = ("1998-07-31", "1999-07-31", "2000-07-31")
CHECKPOINTS = (5, 10, 15, 20, 25, 30)


def query(name: str, sql: str | None = None, recursive: bool = False):
    def add(f):
        QUERIES[name] = lambda spark, sf_dir: rounded(f(stored_contests(spark, sf_dir)))
        if sql:
            ORACLE[name] = with_contests(sql, recursive)
        return f

    return add


def rows_of(m):
    return stored(training.training_rows(m, form.feature_table(m), *ENDS), "training")


ROWS = FEATURE_SQL + """,
tw AS (SELECT ft.*, c.match_date, c.start_year, c.competition_id, c.result, c.result_code, CASE WHEN match_date <= DATE '1998-07-31' THEN 'train' WHEN match_date <= DATE '1999-07-31' THEN 'valid' ELSE 'test' END AS split
  FROM ft JOIN contests c USING (match_id) WHERE is_played AND result_code IS NOT NULL AND home_prior_n >= 1 AND away_prior_n >= 1 AND match_date <= DATE '2000-07-31')"""


@query("d7_training_rows", ROWS + " SELECT * REPLACE (match_date::VARCHAR AS match_date) FROM tw", recursive=True)
def d7(m):
    return rows_of(m)


@query("a22_split_summary", ROWS + " SELECT competition_id, split, count(*) AS n, min(match_date)::VARCHAR AS first_day, max(match_date)::VARCHAR AS last_day, count(*) FILTER (result_code = 0) AS away, count(*) FILTER (result_code = 1) AS draw, count(*) FILTER (result_code = 2) AS home FROM tw GROUP BY 1, 2", recursive=True)
def a22(m):
    return training.split_summary(rows_of(m), "competition_id")


@query("d13_training_problems", ROWS + """, sp AS (SELECT * REPLACE (CASE WHEN match_id % 7 = 0 THEN 3 ELSE result_code END AS result_code, CASE WHEN match_id % 5 = 0 THEN NULL ELSE away_elo END AS away_elo) FROM tw WHERE split <> 'valid')
SELECT 'no ' || s || ' rows' AS "check", (count(*) FILTER (split = s) = 0)::BIGINT AS rows FROM (VALUES ('train'), ('valid'), ('test')) v(s) LEFT JOIN sp ON true GROUP BY s UNION ALL SELECT 'invalid result', count(*) FILTER (result_code NOT IN (0, 1, 2)) FROM sp UNION ALL SELECT 'missing elo', count(*) FILTER (home_elo IS NULL OR away_elo IS NULL) FROM sp""", recursive=True)
def d13(m):
    """Of rows without a validation split, with spoiled results and ratings."""
    at = lambda k: F.col("match_id") % k == 0
    spoiled = rows_of(m).where("split <> 'valid'").withColumns({"result_code": F.when(at(7), 3).otherwise(F.col("result_code")), "away_elo": F.when(~at(5), F.col("away_elo"))})
    return training.training_problems(spoiled)


@query("s14_history", ROWS + " SELECT ft.*, tw.start_year, result_code, match_date::VARCHAR AS match_date FROM tw JOIN ft ON ft.match_id = tw.match_id WHERE tw.start_year < 1998", recursive=True)
def s14(m):
    return training.history_before(m, form.feature_table(m), 1998)


@query("s13_upcoming_frame", FEATURE_SQL + " SELECT ft.*, 'Team ' || home_team_id AS home_team, 'Team ' || away_team_id AS away_team FROM ft JOIN contests USING (match_id) WHERE NOT is_played", recursive=True)
def s13(m):
    return form.feature_table(m).join(named(m.where("not is_played")).select("match_id", "home_team", "away_team"), "match_id")


@query("u4_fold_problems", """fr AS (SELECT match_id, match_date, fold, CASE WHEN start_year < fold THEN 'train' ELSE 'valid' END AS role FROM contests, (VALUES (1997), (1998), (1999)) v(fold) WHERE is_played AND start_year <= fold),
en AS (SELECT fold, max(match_date) FILTER (role = 'train') AS l, min(match_date) FILTER (role = 'valid') AS f FROM fr GROUP BY 1)
SELECT 'holdout in validation' AS "check", count(*) AS rows FROM fr JOIN contests c USING (match_id) WHERE role = 'valid' AND c.start_year = 1999 UNION ALL SELECT 'empty role', count(*) FROM en WHERE l IS NULL OR f IS NULL UNION ALL SELECT 'train after valid', count(*) FROM en WHERE l > f""")
def u4(m):
    """With a fold that reaches into the holdout season of 1999."""
    return training.fold_problems(evaluate.folds(m, [1997, 1998, 1999]), m.where("start_year = 1999"))


# Features at a checkpoint.


def cutoffs(m):
    seasons = m.where("is_played and start_year between 1996 and 1999")
    return stored(t.checkpoint_cutoffs(seasons, list(CHECKPOINTS)), "cutoffs")


def played_and_rest(m):
    played = m.where("is_played")
    return played, form.remaining(played, cutoffs(m))


FROZEN = LONG + """, cl AS (SELECT competition_id, start_year, count(DISTINCT team_id) AS clubs FROM lg WHERE is_played AND start_year BETWEEN 1996 AND 1999 GROUP BY 1, 2),
nm AS (SELECT contests.*, row_number() OVER (PARTITION BY contests.competition_id, contests.start_year ORDER BY match_date, kickoff_time, match_id) AS n, clubs FROM contests JOIN cl USING (competition_id, start_year) WHERE is_played),
ck AS (SELECT competition_id, start_year AS season, g::INT AS checkpoint, match_date AS cutoff FROM nm, (VALUES (5), (10), (15), (20), (25), (30)) v(g) WHERE n = g * clubs // 2),
tg AS (SELECT c.*, checkpoint, cutoff FROM contests c JOIN ck ON c.competition_id = ck.competition_id AND c.start_year = ck.season WHERE is_played AND match_date > cutoff)"""


@query("w10_form_at_checkpoint", FROZEN + """, j AS (SELECT t.match_id, t.checkpoint, s.is_home, h.win, h.draw, h.goals_for, h.goals_against, h.goals_total, h.points, h.goal_diff,
  row_number() OVER (PARTITION BY t.match_id, t.checkpoint, s.is_home ORDER BY h.match_date DESC, h.kickoff_time DESC, h.match_id DESC) AS rn, h.is_home = s.is_home AS sv,
  row_number() OVER (PARTITION BY t.match_id, t.checkpoint, s.is_home, h.is_home = s.is_home ORDER BY h.match_date DESC, h.kickoff_time DESC, h.match_id DESC) AS rv
  FROM tg t JOIN lg s ON s.match_id = t.match_id JOIN lg h ON h.is_played AND h.competition_id = t.competition_id AND h.team_id = s.team_id AND h.match_date <= t.cutoff)
SELECT t.match_id, t.checkpoint, b AS is_home, round(avg(win) FILTER (rn <= 5), 6) AS win_rate_l5, round(avg(draw) FILTER (rn <= 5), 6) AS draw_rate_l5, round(avg(goals_for) FILTER (rn <= 5), 6) AS goals_scored_avg_l5, round(avg(goals_against) FILTER (rn <= 5), 6) AS goals_conceded_avg_l5, round(avg(goals_total) FILTER (rn <= 5), 6) AS goals_total_avg_l5,
  (sum(points) FILTER (rn <= 5))::BIGINT AS points_l5, (sum(goal_diff) FILTER (rn <= 5))::BIGINT AS gd_l5, count(*) FILTER (rn <= 5) AS prior_n, round(avg(win) FILTER (sv AND rv <= 5), 6) AS venue_win_rate_l5, round(avg(draw) FILTER (sv AND rv <= 5), 6) AS venue_draw_rate_l5
FROM tg t CROSS JOIN (VALUES (true), (false)) v(b) LEFT JOIN j ON j.match_id = t.match_id AND j.checkpoint = t.checkpoint AND j.is_home = b GROUP BY 1, 2, 3""")
def w10(m):
    return form.checkpoint_form(*played_and_rest(m)).select("match_id", "checkpoint", "is_home", *form.FORM, "venue_win_rate_l5", "venue_draw_rate_l5")


@query("w11_meetings_at_checkpoint", FROZEN + """ SELECT t.match_id, t.checkpoint, round(avg(((h.home_team_id = t.home_team_id AND h.result = 'H') OR (h.away_team_id = t.home_team_id AND h.result = 'A'))::INT), 6) AS h2h_home_win_rate_n, round(avg((h.result = 'D')::INT), 6) AS h2h_draw_rate_n
FROM tg t LEFT JOIN contests h ON h.is_played AND h.competition_id = t.competition_id AND h.match_date <= t.cutoff AND least(h.home_team_id, h.away_team_id) = least(t.home_team_id, t.away_team_id) AND greatest(h.home_team_id, h.away_team_id) = greatest(t.home_team_id, t.away_team_id) GROUP BY 1, 2""")
def w11(m):
    return form.checkpoint_meetings(*played_and_rest(m))


_W10, _W11 = (re.sub(r"round\((avg\(.*?\) FILTER \(.*?\)|avg\(\(.*?\)::INT\)), 6\)", r"\1", ORACLE[k].rpartition(" SELECT t.match_id" if k.startswith("w11") else "\nSELECT t.match_id")[2]) for k in ("w10_form_at_checkpoint", "w11_meetings_at_checkpoint"))
_SIDES = [f"{s}.{c} AS {n}_{c}" if c in ("points_l5", "gd_l5", "prior_n") else f"round({s}.{c}, 6) AS {n}_{c}" for s, n in (("h", "home"), ("a", "away")) for c in form.FORM]
#: Features at checkpoints: the form and meetings above, and the ratings after the last contest up to the cutoff.
CHECKPOINT_FEATURES = FROZEN + ", " + ELO + """,
ea AS (SELECT c.competition_id, c.match_date, c.kickoff_time, c.match_id, unnest([home_team_id, away_team_id]) AS team_id, unnest([h + d, a - d]) AS elo FROM (SELECT match_id, h, a, 20 * (CASE result WHEN 'H' THEN 1.0 WHEN 'A' THEN 0.0 ELSE 0.5 END - 1 / (1 + pow(10, (a - h - 100) / 400.0))) AS d FROM el JOIN contests USING (match_id) WHERE rn > 0 AND is_played) x JOIN contests c USING (match_id)),
ec AS (SELECT t.match_id, t.checkpoint, s.is_home, arg_max(e.elo, (e.match_date, e.kickoff_time, e.match_id)) AS elo FROM tg t JOIN lg s ON s.match_id = t.match_id JOIN ea e ON e.competition_id = t.competition_id AND e.team_id = s.team_id AND e.match_date <= t.cutoff GROUP BY 1, 2, 3),
j AS (SELECT t.match_id, t.checkpoint, s.is_home, h.win, h.draw, h.goals_for, h.goals_against, h.goals_total, h.points, h.goal_diff,
  row_number() OVER (PARTITION BY t.match_id, t.checkpoint, s.is_home ORDER BY h.match_date DESC, h.kickoff_time DESC, h.match_id DESC) AS rn, h.is_home = s.is_home AS sv,
  row_number() OVER (PARTITION BY t.match_id, t.checkpoint, s.is_home, h.is_home = s.is_home ORDER BY h.match_date DESC, h.kickoff_time DESC, h.match_id DESC) AS rv
  FROM tg t JOIN lg s ON s.match_id = t.match_id JOIN lg h ON h.is_played AND h.competition_id = t.competition_id AND h.team_id = s.team_id AND h.match_date <= t.cutoff),
cf AS (SELECT t.match_id""" + _W10 + """),
cm AS (SELECT t.match_id""" + _W11 + f""")
SELECT h.match_id, h.checkpoint, {", ".join(_SIDES)}, round(h.venue_win_rate_l5, 6) AS home_home_win_rate_l5, round(h.venue_draw_rate_l5, 6) AS home_home_draw_rate_l5, round(a.venue_win_rate_l5, 6) AS away_away_win_rate_l5, round(a.venue_draw_rate_l5, 6) AS away_away_draw_rate_l5,
  round(h2h_home_win_rate_n, 6) AS h2h_home_win_rate_n, round(h2h_draw_rate_n, 6) AS h2h_draw_rate_n, round(he, 6) AS home_elo, round(ae, 6) AS away_elo, round(abs(he - ae), 6) AS elo_abs_diff,
  round(h.points_l5 / greatest(h.prior_n, 1) - a.points_l5 / greatest(a.prior_n, 1), 6) AS ppg_diff_l5, round(h.goals_scored_avg_l5 - a.goals_scored_avg_l5, 6) AS gf_diff_l5, round(h.goals_conceded_avg_l5 - a.goals_conceded_avg_l5, 6) AS ga_diff_l5,
  round((h.goals_total_avg_l5 + a.goals_total_avg_l5) / 2, 6) AS recent_total_goals_avg_l5
FROM (SELECT cf.*, coalesce(ec.elo, 1500.0)::DOUBLE AS he FROM cf LEFT JOIN ec USING (match_id, checkpoint, is_home) WHERE is_home) h
JOIN (SELECT cf.*, coalesce(ec.elo, 1500.0)::DOUBLE AS ae FROM cf LEFT JOIN ec USING (match_id, checkpoint, is_home) WHERE NOT is_home) a ON a.match_id = h.match_id AND a.checkpoint = h.checkpoint JOIN cm ON cm.match_id = h.match_id AND cm.checkpoint = h.checkpoint"""


@query("m21_features_at_checkpoint", CHECKPOINT_FEATURES, recursive=True)
def m21(m):
    """All features of the contests that remain at a checkpoint; ratings stand as they were then."""
    return form.checkpoint_features(m.where("is_played"), cutoffs(m))


# The registry of runs.


def _runs(m):
    """A run a fold and competition, with its scores."""
    folds = evaluate.folds(m, [1997, 1998])
    ends = folds.groupBy("fold", "competition_id").agg(
        *[F.count_if(F.col("role") == r).alias(f"n_{n}") for r, n in (("train", "train"), ("valid", "test"))],
        *[f(F.when(F.col("role") == r, F.col("match_date"))).alias(f"{n}_{e}") for r, n in (("train", "train"), ("valid", "test")) for e, f in (("start", F.min), ("end", F.max))],
    )
    valid = evaluate.uniform(folds.where("role = 'valid'"))
    scores = evaluate.metrics(valid, ["fold", "competition_id"]).select("fold", "competition_id", F.col("log_loss").alias("test_log_loss"), F.col("accuracy").alias("walkforward_mean_log_loss"))
    return registry.fingerprinted(ends.join(scores, ["fold", "competition_id"]).withColumns({"algorithm": F.lit("uniform"), "feature_version": F.lit("v1")}))


RUN = """fr AS (SELECT contests.*, fold::INT AS fold, CASE WHEN start_year < fold THEN 'train' ELSE 'valid' END AS role FROM contests, (VALUES (1997), (1998)) v(fold) WHERE is_played AND start_year <= fold),
rr AS (SELECT fold, competition_id, sha256(concat_ws('|', 'uniform', 'v1', competition_id::VARCHAR, count(*) FILTER (role = 'train'), count(*) FILTER (role = 'valid'), coalesce((min(match_date) FILTER (role = 'train'))::VARCHAR, '-'), coalesce((max(match_date) FILTER (role = 'train'))::VARCHAR, '-'),
  (min(match_date) FILTER (role = 'valid'))::VARCHAR, (max(match_date) FILTER (role = 'valid'))::VARCHAR, printf('%.10f', avg((result_code = 0)::INT) FILTER (role = 'valid')), '1.0986122887')) AS fingerprint FROM fr GROUP BY 1, 2 HAVING count(*) FILTER (role = 'valid') > 0)"""


@query("d17_run_reuse", RUN + " SELECT fold, competition_id, fingerprint, CASE WHEN fold = 1997 THEN competition_id * 10 + 1 END AS reused_id FROM rr")
def d17(m):
    """Against a registry that holds the runs of the first fold, each twice."""
    new = _runs(m)
    old = new.where("fold = 1997").select("algorithm", "competition_id", "feature_version", "fingerprint", F.explode(F.array(F.lit(0), F.lit(1))).alias("i"))
    old = old.select("*", (F.col("competition_id") * 10 + F.col("i")).alias("model_run_id"), F.col("i").alias("trained_at"))
    return registry.reusable(new, old).select("fold", "competition_id", "fingerprint", "reused_id")


@query("d18_production_models", PRODUCTION + " SELECT competition_id, model_run_id, algorithm, feature_version, artifact, strftime(trained_at, '%Y-%m-%dT%H:%M:%S') AS trained_at FROM pm")
def d18(m):
    from contestry.functions.scalars import iso_stamp

    return in_use(m).select("competition_id", "model_run_id", "algorithm", "feature_version", "artifact", iso_stamp(F.col("trained_at")).alias("trained_at"))


@query("t7_newest_run", PRODUCTION + " SELECT competition_id, model_run_id FROM mr WHERE artifact IS NOT NULL QUALIFY row_number() OVER (PARTITION BY competition_id ORDER BY trained_at DESC, model_run_id DESC) = 1")
def t7(m):
    from contestry.operators.reports import production_runs

    return production_runs(d.model_runs(m)).select("competition_id", "model_run_id")


def _snapshots(m):
    seen = m.where("start_year = 2000").groupBy("competition_id").agg(F.count_if("is_played").alias("n_completed"), F.count_if(~F.col("is_played")).alias("n_remaining"))
    updated = d.predictions(m).groupBy("competition_id").agg(F.max("created_at").alias("updated_at"))
    return in_use(m).select("competition_id", "model_run_id").join(seen, "competition_id").join(updated, "competition_id")


@query("d19_stale_forecasts", PRODUCTION + ", sn AS (SELECT pm.competition_id, pm.model_run_id, (SELECT count(*) FROM contests c WHERE c.competition_id = pm.competition_id AND start_year = 2000 AND is_played) AS n_completed, (SELECT count(*) FROM contests c WHERE c.competition_id = pm.competition_id AND start_year = 2000 AND NOT is_played) AS n_remaining FROM pm WHERE EXISTS (SELECT 1 FROM pd WHERE pd.competition_id = pm.competition_id) AND EXISTS (SELECT 1 FROM contests c WHERE c.competition_id = pm.competition_id AND start_year = 2000)) SELECT competition_id, model_run_id, n_completed + competition_id % 2 AS n_completed, n_remaining, competition_id % 2 = 0 AS current FROM sn")
def d19(m):
    """Forecasts of competitions with odd ids were made one contest later."""
    now = stored(_snapshots(m), "snapshots")
    old = now.withColumn("n_completed", F.col("n_completed") + F.col("competition_id") % 2)
    return registry.stale_forecasts(old, now).drop("updated_at")


@query("d20_stage_summary", "sm AS (SELECT competition_id, count(*) AS n, count(*) FILTER (is_played) AS p FROM contests GROUP BY 1) SELECT competition_id, '{\"contests\":{\"rows\":' || n || '},\"played\":{\"rows\":' || p || '}}' AS summary FROM sm")
def d20(m):
    """Two stages' reports, the first of them sent twice."""
    counts = m.groupBy("competition_id").agg(F.count("*").alias("n"), F.count_if("is_played").alias("p"))
    stages = F.array(*[F.struct(F.lit(s).alias("stage"), F.lit(at).alias("at"), v.alias("rows")) for s, at, v in (("contests", 1, F.lit(0).cast("long")), ("contests", 2, F.col("n")), ("played", 1, F.col("p")))])
    reports = counts.select("competition_id", F.explode(stages).alias("s")).select("competition_id", "s.stage", "s.at", F.to_json(F.struct("s.rows")).alias("report"))
    return registry.stage_summary(reports)


# Gates over real rows.


@query("j12_unpredicted", PRODUCTION + " SELECT match_id FROM contests c WHERE NOT is_played AND NOT EXISTS (SELECT 1 FROM pd JOIN pm USING (model_run_id) WHERE pd.match_id = c.match_id)")
def j12(m):
    from contestry.operators.reports import run_predictions

    return m.where("not is_played").select("match_id").join(run_predictions(d.predictions(m), in_use(m)), "match_id", "left_anti")


@query("j15_latest_prediction", SETTLED + " SELECT match_id, lp.model_run_id, round(lp.p_home, 6) AS p_home FROM contests LEFT JOIN lp USING (match_id)")
def j15(m):
    from contestry.operators.reports import latest_predictions

    return m.select("match_id").join(latest_predictions(d.predictions(m), in_use(m)).select("match_id", "model_run_id", "p_home"), "match_id", "left")


@query("d6_frozen_predictions", d.PREDICTED + """, o AS (SELECT match_id, model_run_id, p_home, is_played FROM pd JOIN contests USING (match_id) WHERE run < 4 OR match_id % 2 = 0), n AS (SELECT match_id, model_run_id, 0.5::DOUBLE AS p_home, is_played FROM pd JOIN contests USING (match_id) WHERE run IN (2, 4))
SELECT match_id, model_run_id, round(CASE WHEN o.match_id IS NULL OR (n.match_id IS NOT NULL AND NOT o.is_played) THEN n.p_home ELSE o.p_home END, 6) AS p_home, CASE WHEN o.match_id IS NULL THEN 'inserted' WHEN n.match_id IS NULL THEN 'unchanged' WHEN o.is_played THEN 'kept' ELSE 'updated' END AS change FROM o FULL JOIN n USING (match_id, model_run_id)""")
def d6(m):
    """Predictions stored by contest and run; those of played contests stay."""
    every = d.predictions(m).join(m.select("match_id", "is_played"), "match_id")
    columns = ["match_id", "model_run_id", "p_home", "is_played"]
    old = every.where("run < 4 or match_id % 2 = 0").select(*columns)
    new = every.where("run in (2, 4)").withColumn("p_home", F.lit(0.5)).select(*columns)
    return c.upsert(old, new, ["match_id", "model_run_id"], F.col("o.is_played")).drop("is_played")


def _spoiled(m):
    """Contests with faults put in by id."""
    at = lambda k: F.col("match_id") % k == 0
    return m.withColumns({
        "result": F.when(F.col("is_played") & at(7), F.lit(None)).otherwise(F.col("result")),
        "home_goals": F.when(~F.col("is_played") & at(3), 1).when(at(11), -1).otherwise(F.col("home_goals")),
        "away_team_id": F.when(at(13), F.col("home_team_id")).otherwise(F.col("away_team_id")),
        "result_code": F.when(at(5), 0).otherwise(F.col("result_code")),
    }).unionByName(m.where("match_id % 17 = 0"))


SPOILED = """sp AS (SELECT * REPLACE (CASE WHEN is_played AND match_id % 7 = 0 THEN NULL ELSE result END AS result, CASE WHEN NOT is_played AND match_id % 3 = 0 THEN 1 WHEN match_id % 11 = 0 THEN -1 ELSE home_goals END AS home_goals,
  CASE WHEN match_id % 13 = 0 THEN home_team_id ELSE away_team_id END AS away_team_id, CASE WHEN match_id % 5 = 0 THEN 0 ELSE result_code END AS result_code) FROM contests UNION ALL SELECT * FROM contests WHERE match_id % 17 = 0)"""


@query("d11_match_problems", SPOILED + """ SELECT 'played without result' AS "check", count(*) FILTER (is_played AND result IS NULL) AS rows FROM sp UNION ALL SELECT 'unplayed with score', count(*) FILTER (NOT is_played AND (home_goals IS NOT NULL OR away_goals IS NOT NULL)) FROM sp UNION ALL SELECT 'same teams', count(*) FILTER (home_team_id = away_team_id) FROM sp
UNION ALL SELECT 'negative goals', count(*) FILTER (home_goals < 0 OR away_goals < 0) FROM sp UNION ALL SELECT 'result against goals', count(*) FILTER (result <> CASE WHEN home_goals > away_goals THEN 'H' WHEN home_goals < away_goals THEN 'A' ELSE 'D' END) FROM sp UNION ALL SELECT 'code against result', count(*) FILTER (result_code <> CASE result WHEN 'H' THEN 2 WHEN 'D' THEN 1 ELSE 0 END) FROM sp
UNION ALL SELECT 'duplicate ids', count(*) FROM (SELECT match_id FROM sp GROUP BY 1 HAVING count(*) > 1)""")
def d11(m):
    return c.match_problems(_spoiled(m))


@query("d14_prediction_problems", d.PREDICTED + """, sp AS (SELECT * REPLACE (CASE WHEN match_id % 5 = 0 THEN p_away - 1 ELSE p_away END AS p_away, CASE WHEN match_id % 7 = 0 THEN (predicted_class + 1) % 3 ELSE predicted_class END AS predicted_class) FROM pd)
SELECT 'negative' AS "check", count(*) FILTER (p_away < 0 OR p_draw < 0 OR p_home < 0) AS rows FROM sp UNION ALL SELECT 'sum', count(*) FILTER (abs(p_away + p_draw + p_home - 1) > 0.01) FROM sp UNION ALL SELECT 'class', count(*) FILTER (predicted_class <> CASE WHEN p_away >= p_draw AND p_away >= p_home THEN 0 WHEN p_draw >= p_home THEN 1 ELSE 2 END) FROM sp""")
def d14(m):
    p = d.predictions(m)
    p = p.withColumns({"p_away": F.when(F.col("match_id") % 5 == 0, F.col("p_away") - 1).otherwise(F.col("p_away")), "predicted_class": F.when(F.col("match_id") % 7 == 0, (F.col("predicted_class") + 1) % 3).otherwise(F.col("predicted_class"))})
    return c.prediction_problems(p)


@query("d12_feature_problems", FEATURE_SQL + """, sp AS (SELECT * REPLACE (CASE WHEN match_id % 7 = 0 THEN 999 ELSE home_elo END AS home_elo, CASE WHEN match_id % 5 = 0 THEN NULL ELSE feature_version END AS feature_version) FROM ft WHERE match_id % 3 <> 0)
SELECT 'without features' AS "check", count(*) AS rows FROM contests WHERE match_id NOT IN (SELECT match_id FROM sp) UNION ALL SELECT 'elo out of range', count(*) FILTER (home_elo NOT BETWEEN 1000 AND 2200 OR away_elo NOT BETWEEN 1000 AND 2200) FROM sp UNION ALL SELECT 'prior out of range', count(*) FILTER (home_prior_n NOT BETWEEN 0 AND 5 OR away_prior_n NOT BETWEEN 0 AND 5) FROM sp
UNION ALL SELECT 'without version', count(*) FILTER (feature_version IS NULL) FROM sp""", recursive=True)
def d12(m):
    """Of features that lack a third of the contests, with spoiled ratings and versions."""
    at = lambda k: F.col("match_id") % k == 0
    kept = form.feature_table(m).where("match_id % 3 <> 0")
    spoiled = kept.withColumns({"home_elo": F.when(at(7), 999.0).otherwise(F.col("home_elo")), "feature_version": F.when(at(5), F.lit(None)).otherwise(F.col("feature_version"))})
    return c.feature_problems(m, stored(spoiled, "features"))
