"""Registered queries: Dixon-Coles predictions and their evaluation."""

from __future__ import annotations

from functools import reduce

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from contestry.functions import scalars as s
from contestry.operators import evaluate as e
from contestry.operators import poisson
from contestry.plans.features import rounded
from contestry.sources.contests import stored_contests, with_contests
from contestry.sources.store import stored

QUERIES: dict = {}
ORACLE: dict = {}
YEARS = [1996, 1997, 1998]
MODELS = ["uniform", "empirical", "dixon_coles"]
KEYS = ["fold", "competition_id"]
COLUMNS = ["model", *KEYS, "match_id", "result_code", *e.TRIPLE]


def query(name: str, sql: str | None = None):
    def add(f):
        QUERIES[name] = lambda spark, sf_dir: rounded(f(stored_contests(spark, sf_dir)))
        if sql:
            ORACLE[name] = with_contests(sql)
        return f

    return add


def fold_predictions(m: DataFrame, years: list[int] = YEARS) -> DataFrame:
    """Predictions of all baseline models on every fold's validation season; the folds are written once."""
    rows = stored(e.folds(m, years), "folds")
    train, valid = rows.where("role = 'train'"), rows.where("role = 'valid'")
    made = {"uniform": e.uniform(valid), "empirical": e.empirical(train, valid, KEYS), "dixon_coles": poisson.fit_and_predict(train, valid, KEYS)}
    return reduce(DataFrame.unionByName, [df.withColumn("model", F.lit(name)).select(*COLUMNS) for name, df in made.items()])


def frozen(m: DataFrame, season: int = 2000) -> DataFrame:
    """Predictions of one season's contests from all played before it."""
    keys = ["competition_id"]
    train = m.where(f"is_played and start_year < {season}")
    out = poisson.fit_and_predict(train, m.where(F.col("start_year") == season), keys)
    return out.withColumn("predicted_class", s.argmax_class(*map(F.col, e.TRIPLE)))


FOLD = """
fr AS (SELECT contests.*, fold::INT AS fold, CASE WHEN start_year < fold THEN 'train' ELSE 'valid' END AS role FROM contests, (VALUES (1996), (1997), (1998)) v(fold) WHERE is_played AND start_year <= fold),
tr AS (SELECT * FROM fr WHERE role = 'train'), va AS (SELECT * FROM fr WHERE role = 'valid'),
mn AS (SELECT fold, competition_id, avg(home_goals) AS mh, avg(away_goals) AS ma FROM tr GROUP BY 1, 2),
sd AS (SELECT fold, competition_id, home_team_id AS team_id, home_goals / greatest(mh, 1e-6) AS sc, away_goals / greatest(ma, 1e-6) AS cn FROM tr JOIN mn USING (fold, competition_id)
  UNION ALL SELECT fold, competition_id, away_team_id, away_goals / greatest(ma, 1e-6), home_goals / greatest(mh, 1e-6) FROM tr JOIN mn USING (fold, competition_id)),
tm AS (SELECT fold, competition_id, team_id, avg(sc) AS att, avg(cn) AS def FROM sd GROUP BY 1, 2, 3),
rt AS (SELECT x.*, greatest(mh * coalesce(h.att, 1) * coalesce(a.def, 1), 1e-6) AS lam, greatest(ma * coalesce(a.att, 1) * coalesce(h.def, 1), 1e-6) AS mu
  FROM fr x JOIN mn USING (fold, competition_id) LEFT JOIN tm h ON h.fold = x.fold AND h.competition_id = x.competition_id AND h.team_id = x.home_team_id LEFT JOIN tm a ON a.fold = x.fold AND a.competition_id = x.competition_id AND a.team_id = x.away_team_id),
gr AS (SELECT unnest(range(0, 13)) AS i), rg AS (SELECT round(-0.15 + 0.025 * i, 4)::DOUBLE AS rho FROM gr),
k AS (SELECT unnest(range(0, 11)) AS k),
nl AS (SELECT fold, competition_id, rho, round(-sum(ln(greatest(exp(-lam - mu) * pow(lam, home_goals) * pow(mu, away_goals) / factorial(home_goals) / factorial(away_goals)
    * CASE WHEN home_goals = 0 AND away_goals = 0 THEN 1 - lam * mu * rho WHEN home_goals = 0 AND away_goals = 1 THEN 1 + lam * rho WHEN home_goals = 1 AND away_goals = 0 THEN 1 + mu * rho WHEN home_goals = 1 AND away_goals = 1 THEN 1 - rho ELSE 1 END
    / (list_sum(list_transform(range(0, 11), lambda z: exp(-lam) * pow(lam, z) / factorial(z::INT))) * list_sum(list_transform(range(0, 11), lambda z: exp(-mu) * pow(mu, z) / factorial(z::INT)))), 1e-12))), 9) AS nll FROM rt, rg WHERE role = 'train' GROUP BY 1, 2, 3),
br AS (SELECT fold, competition_id, arg_min(rho, (nll, rho)) AS rho FROM nl GROUP BY 1, 2),
cells AS (SELECT match_id, fold, x.k AS i, y.k AS j, exp(-lam - mu) * pow(lam, x.k) * pow(mu, y.k) / factorial(x.k::INT) / factorial(y.k::INT)
    * CASE WHEN x.k = 0 AND y.k = 0 THEN 1 - lam * mu * rho WHEN x.k = 0 AND y.k = 1 THEN 1 + lam * rho WHEN x.k = 1 AND y.k = 0 THEN 1 + mu * rho WHEN x.k = 1 AND y.k = 1 THEN 1 - rho ELSE 1 END AS p
  FROM rt JOIN br USING (fold, competition_id), k x, k y WHERE role = 'valid'),
dc AS (SELECT match_id, fold, sum(p) FILTER (i < j) / sum(p) AS p_away, sum(p) FILTER (i = j) / sum(p) AS p_draw, sum(p) FILTER (i > j) / sum(p) AS p_home FROM cells GROUP BY 1, 2),
sh AS (SELECT fold, competition_id, avg((result_code = 0)::INT) AS p_away, avg((result_code = 1)::INT) AS p_draw, avg((result_code = 2)::INT) AS p_home FROM tr GROUP BY 1, 2),
pr AS (SELECT 'dixon_coles' AS model, va.fold, va.competition_id, va.match_id, result_code, p_away, p_draw, p_home FROM va JOIN dc ON dc.match_id = va.match_id AND dc.fold = va.fold
  UNION ALL SELECT 'uniform', fold, competition_id, match_id, result_code, 1 / 3, 1 / 3, 1 / 3 FROM va
  UNION ALL SELECT 'empirical', va.fold, va.competition_id, match_id, result_code, p_away, p_draw, p_home FROM va JOIN sh USING (fold, competition_id)),
pc AS (SELECT *, CASE WHEN p_away >= p_draw AND p_away >= p_home THEN 0 WHEN p_draw >= p_home THEN 1 ELSE 2 END AS pred, CASE result_code WHEN 0 THEN p_away WHEN 1 THEN p_draw ELSE p_home END AS py FROM pr),
sc AS (SELECT model, fold, competition_id, count(*) AS n, avg((pred = result_code)::INT) AS accuracy, avg(-ln(least(greatest(py, 2.220446049250313e-16), 1))) AS log_loss,
  avg(pow(p_away - (result_code = 0)::INT, 2) + pow(p_draw - (result_code = 1)::INT, 2) + pow(p_home - (result_code = 2)::INT, 2)) AS brier FROM pc GROUP BY 1, 2, 3)
"""


@query("m7_fold_predictions", FOLD + " SELECT model, fold, competition_id, match_id, result_code, round(p_away, 6) AS p_away, round(p_draw, 6) AS p_draw, round(p_home, 6) AS p_home FROM pr")
def m7(m):
    return fold_predictions(m)


@query("j21_folds", FOLD + " SELECT match_id, fold, role FROM fr")
def j21(m):
    return e.folds(m, YEARS).select("match_id", "fold", "role")


def scores(m):
    return e.metrics(fold_predictions(m), ["model", *KEYS])


@query("a7_metrics", FOLD + " SELECT model, fold, competition_id, n, round(accuracy, 6) AS accuracy, round(log_loss, 6) AS log_loss, round(brier, 6) AS brier FROM sc")
def a7(m):
    return scores(m).select("model", *KEYS, "n", "accuracy", "log_loss", "brier")


CONFUSION = ", ".join(f"count(*) FILTER (result_code = {i} AND pred = {j}) AS c{i}{j}" for i in range(3) for j in range(3))


@query("a7_confusion", FOLD + f" SELECT model, {CONFUSION}, round(avg(p_draw), 6) AS draw_mean, round(median(p_draw), 6) AS draw_median, round(avg(p_draw) FILTER (result_code = 1), 6) AS draw_mean_when_draw FROM pc GROUP BY 1")
def a7_confusion(m):
    out = e.metrics(fold_predictions(m), ["model"])
    return out.select("model", *[f"c{i}{j}" for i in range(3) for j in range(3)], "draw_mean", "draw_median", "draw_mean_when_draw")


PRF = "cf AS (SELECT model, c.c, count(*) FILTER (result_code = c.c AND pred = c.c) AS tp, count(*) FILTER (pred = c.c) AS pp, count(*) FILTER (result_code = c.c) AS ap FROM pc, (VALUES (0), (1), (2)) c(c) GROUP BY 1, 2), pf AS (SELECT model, c, CASE WHEN pp > 0 THEN tp / pp ELSE 0 END AS p, CASE WHEN ap > 0 THEN tp / ap ELSE 0 END AS r FROM cf)"


@query("a7_f1", FOLD + "," + PRF + " SELECT model, round(avg(p), 6) AS precision_macro, round(avg(r), 6) AS recall_macro, round(avg(CASE WHEN p + r > 0 THEN 2 * p * r / (p + r) ELSE 0 END), 6) AS f1_macro FROM pf GROUP BY 1")
def a7_f1(m):
    return e.metrics(fold_predictions(m), ["model"]).select("model", "precision_macro", "recall_macro", "f1_macro")


OVER = "ov AS (SELECT model, competition_id, avg(log_loss) AS log_loss_mean, median(log_loss) AS log_loss_median, coalesce(stddev_samp(log_loss), 0) AS log_loss_std, min(log_loss) AS log_loss_min, max(log_loss) AS log_loss_max FROM sc GROUP BY 1, 2)"


#: The metrics that are summed up over folds.
OVER_FOLDS = ["log_loss", "accuracy", "brier", *[f"{k}_{c}" for k in ("precision", "recall", "f1") for c in ("away", "draw", "home", "macro")], "draw_argmax_share"]
_STATS = {"mean": "avg({})", "median": "median({})", "std": "coalesce(stddev_samp({}), 0)", "min": "min({})", "max": "max({})"}
BY_FOLD = PRF.replace("cf AS (SELECT model,", "cf AS (SELECT model, fold, competition_id,").replace("c(c) GROUP BY 1, 2)", "c(c) GROUP BY 1, 2, 3, 4)").replace("pf AS (SELECT model,", "pf AS (SELECT model, fold, competition_id,") + """,
p1 AS (SELECT *, CASE WHEN p + r > 0 THEN 2 * p * r / (p + r) ELSE 0 END AS f FROM pf),
p3 AS (SELECT model, fold, competition_id, """ + ", ".join(f"max({k}) FILTER (c = {c}) AS {n}_{name}" for k, n in (("p", "precision"), ("r", "recall"), ("f", "f1")) for c, name in ((0, "away"), (1, "draw"), (2, "home"))) + ", " + ", ".join(f"avg({k}) AS {n}_macro" for k, n in (("p", "precision"), ("r", "recall"), ("f", "f1"))) + """ FROM p1 GROUP BY 1, 2, 3),
da AS (SELECT model, fold, competition_id, avg((pred = 1)::INT) AS draw_argmax_share FROM pc GROUP BY 1, 2, 3),
sa AS (SELECT * FROM sc JOIN p3 USING (model, fold, competition_id) JOIN da USING (model, fold, competition_id))"""


@query("a12_over_folds", FOLD + "," + BY_FOLD + " SELECT model, competition_id, " + ", ".join(f"round({f.format(c)}, 6) AS {c}_{n}" for c in OVER_FOLDS for n, f in _STATS.items()) + " FROM sa GROUP BY 1, 2")
def a12(m):
    return e.over_folds(scores(m), ["model", "competition_id"], OVER_FOLDS)


@query("t6_selected_model", FOLD + "," + OVER + " SELECT competition_id, arg_min(model, (log_loss_mean, log_loss_median, log_loss_std, model)) AS model FROM ov GROUP BY 1")
def t6(m):
    return e.selected(a12(m), ["competition_id"])


@query("a17_folds_won", FOLD + ", bw AS (SELECT competition_id, fold, arg_min(model, (log_loss, CASE model WHEN 'uniform' THEN 1 WHEN 'empirical' THEN 2 ELSE 3 END)) AS model FROM sc GROUP BY 1, 2) SELECT model, count(*) AS folds_won FROM bw GROUP BY 1")
def a17(m):
    return e.folds_won(scores(m), MODELS)


@query("a8_reliability_bins", FOLD + " SELECT model, least(floor(p_draw * 10), 9)::INT AS bin, count(*) AS n, round(avg(p_draw), 6) AS mean_predicted, round(avg((result_code = 1)::INT), 6) AS mean_observed FROM pc GROUP BY 1, 2")
def a8(m):
    return e.reliability_bins(fold_predictions(m), ["model"], "p_draw", F.col("result_code") == 1)


@query("a9_reliability_table")
def a9(m):
    return e.reliability_table(fold_predictions(m), ["model"], "p_draw", F.col("result_code") == 1)


ORACLE["a9_reliability_table"] = with_contests(FOLD + """, ed AS (SELECT model, greatest(ceil(round(max(p_draw) / 0.05, 9)), floor(round(min(p_draw) / 0.05, 9)) + 1) - 1 AS last FROM pc GROUP BY 1),
bn AS (SELECT model, least(floor(round(p_draw / 0.05, 9)), last)::BIGINT AS bin, count(*) AS n, sum(p_draw) AS sp, sum((result_code = 1)::INT) AS sy FROM pc JOIN ed USING (model) GROUP BY 1, 2),
nb AS (SELECT *, row_number() OVER (PARTITION BY model ORDER BY bin) AS rn FROM bn),
rc AS (SELECT model, rn, 1 AS g, n AS acc FROM nb WHERE rn = 1 UNION ALL SELECT nb.model, nb.rn, CASE WHEN acc >= 30 THEN g + 1 ELSE g END, CASE WHEN acc >= 30 THEN nb.n ELSE acc + nb.n END FROM rc JOIN nb ON nb.model = rc.model AND nb.rn = rc.rn + 1),
gt AS (SELECT model, g, sum(n) AS total FROM rc JOIN nb USING (model, rn) GROUP BY 1, 2),
fg AS (SELECT rc.model, rn, CASE WHEN total < 30 AND g > 1 THEN g - 1 ELSE g END AS g FROM rc JOIN gt USING (model, g))
SELECT model, round(min(bin) * 0.05::DOUBLE, 6) AS lo, round((max(bin) + 1) * 0.05::DOUBLE, 6) AS hi, sum(n)::BIGINT AS n, round(sum(sp) / sum(n), 6) AS mean_predicted, round(sum(sy) / sum(n), 6) AS mean_observed, round(sum(sy) / sum(n) - sum(sp) / sum(n), 6) AS difference FROM fg JOIN nb USING (model, rn) GROUP BY model, g""", recursive=True)


CLASS = "lc AS (SELECT model, 'away' AS class, p_away AS p, (result_code = 0)::INT AS hit, (pred = 0)::INT AS top FROM pc UNION ALL SELECT model, 'draw', p_draw, (result_code = 1)::INT, (pred = 1)::INT FROM pc UNION ALL SELECT model, 'home', p_home, (result_code = 2)::INT, (pred = 2)::INT FROM pc)"


@query("a10_class_summary", FOLD + "," + CLASS + " SELECT model, class, count(*) AS n, round(avg(p), 6) AS mean_predicted, round(avg(hit), 6) AS frequency, round(avg(hit) - avg(p), 6) AS difference, round(avg((p - hit) * (p - hit)), 6) AS brier, round(min(p), 6) AS least, round(max(p), 6) AS most, round(avg(top), 6) AS argmax_share FROM lc GROUP BY 1, 2")
def a10(m):
    return e.class_summary(fold_predictions(m), ["model"])


@query("m17_verdict", FOLD + ", g AS (SELECT model, avg((result_code = 1)::INT) - avg(p_draw) AS d FROM pc GROUP BY 1) SELECT model, CASE WHEN abs(d) <= 0.015 THEN 'well_calibrated' WHEN d > 0 THEN 'underpredicted' ELSE 'overpredicted' END AS verdict FROM g")
def m17(m):
    return a10(m).where("class = 'draw'").select("model", e.verdict(F.col("difference")).alias("verdict"))


BLENDS = [("half", "dixon_coles", 0.5), ("half", "empirical", 0.5), ("mostly", "dixon_coles", 0.8), ("mostly", "empirical", 0.2), ("thirds", "dixon_coles", 1.0), ("thirds", "empirical", 1.0), ("thirds", "uniform", 1.0)]
WEIGHTS = "wt(candidate, model, weight) AS (VALUES " + ", ".join(f"('{c}', '{m}', {w}::DOUBLE)" for c, m, w in BLENDS) + ")"


@query("m10_blends", FOLD + "," + WEIGHTS + " SELECT candidate AS model, fold, competition_id, match_id, result_code, round(sum(p_away * weight) / sum(weight), 6) AS p_away, round(sum(p_draw * weight) / sum(weight), 6) AS p_draw, round(sum(p_home * weight) / sum(weight), 6) AS p_home FROM pr JOIN wt USING (model) GROUP BY 1, 2, 3, 4, 5")
def m10(m):
    weights = m.sparkSession.createDataFrame(BLENDS, "candidate string, model string, weight double")
    return e.blend(fold_predictions(m), weights, [*KEYS, "match_id", "result_code"])


@query("w9_inverse_loss_weights", FOLD + ", iv AS (SELECT competition_id, fold, model, 1 / ((sum(log_loss) OVER (PARTITION BY competition_id, model) - log_loss) / (count(*) OVER (PARTITION BY competition_id, model) - 1)) AS raw FROM sc) SELECT competition_id, fold, model, round(raw / sum(raw) OVER (PARTITION BY competition_id, fold), 6) AS weight FROM iv")
def w9(m):
    return e.inverse_loss_weights(scores(m))


@query("a14_scorecard", FOLD + " SELECT competition_id, count(*) AS n, count(*) FILTER (pred = result_code) AS correct, round(avg((pred = result_code)::INT), 6) AS accuracy, round(avg(-ln(py)), 6) AS log_loss FROM pc WHERE model = 'dixon_coles' GROUP BY 1")
def a14(m):
    settled = fold_predictions(m).where("model = 'dixon_coles'").withColumn("predicted_class", s.argmax_class(*map(F.col, e.TRIPLE)))
    return e.scorecard(settled, ["competition_id"]).select("competition_id", "n", "correct", "accuracy", "log_loss")


@query("n14_match_notes", FOLD + " SELECT model, fold, match_id, CASE WHEN pred <> 1 AND p_draw >= 0.25 THEN 'Draw watch' WHEN list_reverse_sort([p_away, p_draw, p_home])[1] - list_reverse_sort([p_away, p_draw, p_home])[2] < 0.08 THEN 'Close match' END AS note, CASE pred WHEN 0 THEN 'away' WHEN 1 THEN 'draw' ELSE 'home' END AS predicted, round_even(p_home * 100, 0)::BIGINT AS home_percent FROM pc WHERE model <> 'uniform'")
def n14(m):
    p = fold_predictions(m).where("model <> 'uniform'").withColumn("c", s.argmax_class(*map(F.col, e.TRIPLE)))
    return p.select("model", "fold", "match_id", s.match_note(*map(F.col, e.TRIPLE), F.col("c")).alias("note"), s.class_name(F.col("c")).alias("predicted"), s.as_percent(F.col("p_home")).alias("home_percent"))
