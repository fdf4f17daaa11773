"""Registered queries: walk-forward training by competition, blends, candidates and the holdout."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from contestry.operators import evaluate as e
from contestry.operators import fits, form, learn
from contestry.plans.features import rounded
from contestry.plans.forecasts import SIM
from contestry.plans.models import CLASS, COLUMNS, FOLD, KEYS, PRF, fold_predictions
from contestry.sources import derived as d
from contestry.sources.contests import stored_contests, with_contests
from contestry.sources.store import large, stored

QUERIES: dict = {}
ORACLE: dict = {}
#: Seasons of the folds, and the holdout season.
YEARS, HOLDOUT = [1996, 1997, 1998], 1999
#: The blends of models by weight.
BLENDS = {
    "ensemble_lr_xgb_50_50": {"logistic_regression": 0.5, "xgboost": 0.5},
    "ensemble_lr_xgb_60_40": {"logistic_regression": 0.6, "xgboost": 0.4},
    "ensemble_lr_xgb_70_30": {"logistic_regression": 0.7, "xgboost": 0.3},
    "ensemble_lr_poisson_50_50": {"logistic_regression": 0.5, "poisson_dixon_coles": 0.5},
    "ensemble_lr_poisson_70_30": {"logistic_regression": 0.7, "poisson_dixon_coles": 0.3},
    "ensemble_xgb_poisson_50_50": {"xgboost": 0.5, "poisson_dixon_coles": 0.5},
    "ensemble_xgb_poisson_70_30": {"xgboost": 0.7, "poisson_dixon_coles": 0.3},
    "ensemble_lr_xgb_poisson_equal": {"logistic_regression": 1.0, "xgboost": 1.0, "poisson_dixon_coles": 1.0},
    "ensemble_lr_xgb_poisson_50_30_20": {"logistic_regression": 0.5, "xgboost": 0.3, "poisson_dixon_coles": 0.2},
}
INVERSE = "ensemble_invll"


def query(name: str, sql: str | None = None):
    def add(f):
        QUERIES[name] = lambda spark, sf_dir: rounded(f(stored_contests(spark, sf_dir)))
        if sql:
            ORACLE[name] = with_contests(sql)
        return f

    return add


#: Predictions made in this session, by application and data: three queries read the same fits.
_MADE: dict[tuple[str, str], DataFrame] = {}


def fold_rows(m: DataFrame) -> DataFrame:
    """The rows of every fold, the holdout season among them, with their features."""
    return e.folds(m, [*YEARS, HOLDOUT]).select("match_id", *KEYS, "role", "result_code").join(large(form.feature_table(m)), "match_id")


def model_predictions(spark, sf_dir: str) -> DataFrame:
    """Predictions of the four fitted models and of Dixon-Coles on every fold, the holdout season among them."""
    key = (spark.sparkContext.applicationId, sf_dir)
    if key not in _MADE:
        m = stored_contests(spark, sf_dir)
        fitted = learn.walk_forward(stored(fold_rows(m), "rows"), KEYS)
        goals = fold_predictions(m, [*YEARS, HOLDOUT]).where("model = 'dixon_coles'").withColumn("model", F.lit("poisson_dixon_coles"))
        _MADE[key] = stored(fitted.select(*COLUMNS).unionByName(goals.select(*COLUMNS)), "predictions")
    return _MADE[key]


def whole_query(f):
    """A query over the session's predictions instead of the contests; no SQL can fit its models."""
    QUERIES[f.__name__] = lambda spark, sf_dir: rounded(f(model_predictions(spark, sf_dir)))
    return f


def blends(predictions: DataFrame) -> DataFrame:
    """The nine fixed blends, and the one by inverse losses (of the other folds)."""
    spark, keys = predictions.sparkSession, [*KEYS, "match_id", "result_code"]
    weights = spark.createDataFrame([(c, model, w) for c, parts in BLENDS.items() for model, w in parts.items()], "candidate string, model string, weight double")
    fixed = e.blend(predictions, weights, keys)
    members = predictions.where(F.col("model").isin("logistic_regression", "xgboost", "poisson_dixon_coles"))
    inverse = e.inverse_loss_weights(e.metrics(members, ["model", *KEYS])).withColumn("candidate", F.lit(INVERSE))
    mixed = e.blend_by(members, inverse, keys, KEYS)
    return fixed.select(*COLUMNS).unionByName(mixed.select(*COLUMNS))


def candidates(predictions: DataFrame) -> DataFrame:
    return stored(predictions.unionByName(blends(predictions)), "candidates")


def comparison(found: DataFrame) -> DataFrame:
    """Of each competition's candidates: losses over the folds, folds won, the holdout's loss, and their place."""
    scores = stored(e.metrics(found, ["model", *KEYS]), "scores")
    over = e.over_folds(scores.where(F.col("fold") < HOLDOUT), ["model", "competition_id"], ["log_loss", "accuracy"])
    won = scores.where(F.col("fold") < HOLDOUT).groupBy("competition_id", "fold").agg(F.min_by("model", F.struct("log_loss", "model")).alias("model")).groupBy("competition_id", "model").agg(F.count("*").alias("folds_won"))
    held = scores.where(F.col("fold") == HOLDOUT).select("model", "competition_id", F.col("log_loss").alias("holdout_log_loss"))
    out = over.join(won, ["competition_id", "model"], "left").join(held, ["competition_id", "model"], "left").fillna(0, ["folds_won"])
    return out.withColumn("place", e.place("competition_id", "log_loss_mean", "log_loss_median", "log_loss_std", "model"))


@whole_query
def m9_walk_forward(predictions):
    """One row a model, fold and competition, the holdout's fold last."""
    return e.metrics(predictions, ["model", *KEYS])


@query("m9_unfitted", """fr AS (SELECT fold::INT AS fold, competition_id, count(*) FILTER (start_year < fold) AS train, count(*) FILTER (start_year = fold) AS valid FROM contests, (VALUES (1994), (1996), (1997), (1998), (1999), (2001)) v(fold) WHERE is_played AND start_year <= fold GROUP BY 1, 2)
SELECT fold, competition_id, CASE WHEN train = 0 THEN 'no training rows' ELSE 'nothing to predict' END AS reason FROM fr WHERE train = 0 OR valid = 0""")
def m9_unfitted(m):
    """Why a fold of a competition has no model: with a fold before all seasons and one after the last played one."""
    return fits.unfitted(e.folds(m, [1994, *YEARS, HOLDOUT, 2001]), KEYS)


@whole_query
def m11_blends(predictions):
    """The metrics of every blend over all folds and competitions."""
    return e.metrics(blends(predictions), ["model"])


@whole_query
def m12_candidates(predictions):
    return comparison(candidates(predictions))


@whole_query
def m15_recommendations(predictions):
    """The winner of each competition against logistic regression: gains over the folds and on the holdout, and what to do."""
    table = stored(comparison(candidates(predictions)), "comparison")
    now = table.where("model = 'logistic_regression'").select("competition_id", F.col("log_loss_mean").alias("now"), F.col("holdout_log_loss").alias("now_held"))
    best = table.where("place = 1").join(now, "competition_id")
    gain, held = F.col("now") - F.col("log_loss_mean"), F.col("now_held") - F.col("holdout_log_loss")
    return best.select("competition_id", "model", gain.alias("wf_gain"), held.alias("holdout_gain"), e.recommendation(F.lit("logistic_regression"), F.col("model"), gain, held, ["poisson_dixon_coles", INVERSE, *BLENDS]).alias("action"))


FOLD4 = FOLD.replace("(1996), (1997), (1998)", "(1996), (1997), (1998), (1999)")


@query("m13_recommendation", FOLD4 + """, ov AS (SELECT model, competition_id, avg(log_loss) FILTER (fold < 1999) AS wf, max(log_loss) FILTER (fold = 1999) AS ho FROM sc GROUP BY 1, 2), ws AS (SELECT competition_id, arg_min(model, (wf, model)) AS winner, min(wf) AS best, arg_min(ho, (wf, model)) AS best_ho, max(wf) FILTER (model = 'empirical') AS prod, max(ho) FILTER (model = 'empirical') AS prod_ho FROM ov GROUP BY 1)
SELECT competition_id, winner, round(prod - best, 6) AS wf_gain, round(prod_ho - best_ho, 6) AS holdout_gain, CASE WHEN winner = 'empirical' THEN 'KEEP CURRENT PRODUCTION' WHEN prod - best < need OR prod_ho - best_ho IS NULL OR prod_ho - best_ho < need THEN 'INSUFFICIENT IMPROVEMENT' ELSE 'SWITCH TO NEW MODEL' END AS action FROM (SELECT *, CASE WHEN winner = 'dixon_coles' THEN 0.010 ELSE 0.005 END AS need FROM ws)""")
def m13(m):
    """Of the baselines, against class shares: gains over three folds and on the holdout season."""
    scores = stored(e.metrics(fold_predictions(m, [*YEARS, HOLDOUT]), ["model", *KEYS]), "scores")
    held = F.col("fold") == HOLDOUT
    table = scores.groupBy("model", "competition_id").agg(F.avg(F.when(~held, F.col("log_loss"))).alias("wf"), F.max(F.when(held, F.col("log_loss"))).alias("ho"))
    least = F.struct("wf", "model")
    now = lambda c: F.max(F.when(F.col("model") == "empirical", F.col(c)))
    out = table.groupBy("competition_id").agg(F.min_by("model", least).alias("winner"), (now("wf") - F.min("wf")).alias("wf_gain"), (now("ho") - F.min_by("ho", least)).alias("holdout_gain"))
    return out.withColumn("action", e.recommendation(F.lit("empirical"), F.col("winner"), F.col("wf_gain"), F.col("holdout_gain"), ["dixon_coles"]))


@query("a11_calibration_blocks", FOLD4 + "," + CLASS.replace("SELECT model,", "SELECT model, fold,") + """, bl AS (SELECT *, unnest([CASE WHEN fold < 1999 THEN 'walk_forward' ELSE 'test' END, 'pooled']) AS block FROM lc) SELECT block, model, class, count(*) AS n, round(avg(p), 6) AS mean_predicted, round(avg(hit), 6) AS frequency, round(avg((p - hit) * (p - hit)), 6) AS brier FROM bl GROUP BY 1, 2, 3""")
def a11(m):
    block = F.explode(F.array(F.when(F.col("fold") < HOLDOUT, "walk_forward").otherwise("test"), F.lit("pooled")))
    rows = fold_predictions(m, [*YEARS, HOLDOUT]).withColumn("block", block)
    return e.class_summary(rows, ["block", "model"]).select("block", "model", "class", "n", "mean_predicted", "frequency", "brier")


@query("m16_out_of_sample", FOLD4 + " SELECT match_id, competition_id, CASE WHEN fold < 1999 THEN 'walk_forward' ELSE 'test' END AS source, result_code, round(p_away, 6) AS p_away, round(p_draw, 6) AS p_draw, round(p_home, 6) AS p_home FROM pr WHERE model = 'dixon_coles'")
def m16(m):
    source = F.when(F.col("fold") < HOLDOUT, "walk_forward").otherwise("test").alias("source")
    return fold_predictions(m, [*YEARS, HOLDOUT]).where("model = 'dixon_coles'").select("match_id", "competition_id", source, "result_code", *e.TRIPLE)


def with_source(predictions: DataFrame) -> DataFrame:
    return predictions.withColumn("source", F.when(F.col("fold") < HOLDOUT, "walk_forward").otherwise("test"))


@query("m16_stored_first", FOLD4 + "," + d.PREDICTED + """, st AS (SELECT match_id, p_away, p_draw, p_home FROM pd QUALIFY row_number() OVER (PARTITION BY match_id ORDER BY created_at DESC, run DESC) = 1)
SELECT pr.competition_id, pr.match_id, CASE WHEN st.match_id IS NOT NULL THEN 'stored' WHEN fold < 1999 THEN 'walk_forward' ELSE 'test' END AS source, result_code, round(coalesce(st.p_away, pr.p_away), 6) AS p_away, round(coalesce(st.p_draw, pr.p_draw), 6) AS p_draw, round(coalesce(st.p_home, pr.p_home), 6) AS p_home
FROM pr LEFT JOIN st USING (match_id) WHERE model = 'dixon_coles'""")
def m16_stored_first(m):
    """Out-of-sample predictions of every validated contest: the stored one where there is one, else Dixon-Coles of its fold."""
    computed = with_source(fold_predictions(m, [*YEARS, HOLDOUT]).where("model = 'dixon_coles'"))
    return e.out_of_sample(d.predictions(m), computed, ["competition_id"])


QUERIES["m16_calibration"] = lambda spark, sf_dir: rounded(calibration(spark, sf_dir))


def calibration(spark, sf_dir: str) -> DataFrame:
    """Of every model's out-of-sample predictions, stored ones first: how each class is met, by model and source; no SQL can fit the models."""
    made = d.predictions(stored_contests(spark, sf_dir))
    rows = e.out_of_sample(made, with_source(model_predictions(spark, sf_dir)), ["model", "competition_id"])
    found = e.class_summary(rows, ["model", "source"])
    return found.withColumn("verdict", e.verdict(F.col("difference")))


@query("a13_flat_metrics", FOLD + "," + PRF.replace("GROUP BY 1, 2), pf", "GROUP BY 1, 2), pf") + ", ".join(["", "fl AS (SELECT model, c, p, r, CASE WHEN p + r > 0 THEN 2 * p * r / (p + r) ELSE 0 END AS f FROM pf) SELECT model"]) + ", " + ", ".join(f"round(max({k}) FILTER (c = {c}), 6) AS {n}_{name}" for k, n in (("p", "precision"), ("r", "recall"), ("f", "f1")) for c, name in ((0, "away"), (1, "draw"), (2, "home"))) + " FROM fl GROUP BY 1")
def a13(m):
    return e.metrics(fold_predictions(m), ["model"]).select("model", *[f"{k}_{c}" for k in ("precision", "recall", "f1") for c in ("away", "draw", "home")])


@query("a16_candidate_blocks", FOLD + "," + CLASS + ", ov AS (SELECT model, avg(log_loss) AS m, median(log_loss) AS d FROM (SELECT model, fold, avg(-ln(least(greatest(py, 2.220446049250313e-16), 1))) AS log_loss FROM pc GROUP BY 1, 2) GROUP BY 1) SELECT model, round(max(m), 6) AS log_loss_mean, round(max(d), 6) AS log_loss_median, round(avg(hit) FILTER (class = 'draw') - avg(p) FILTER (class = 'draw'), 6) AS draw_gap, round(avg(top) FILTER (class = 'draw'), 6) AS draw_share FROM ov JOIN lc USING (model) GROUP BY 1")
def a16(m):
    p = fold_predictions(m)
    over = e.over_folds(e.metrics(p, ["model", "fold"]), ["model"], ["log_loss"])
    draws = e.class_summary(p, ["model"]).where("class = 'draw'").select("model", F.col("difference").alias("draw_gap"), F.col("argmax_share").alias("draw_share"))
    return over.join(draws, "model").select("model", "log_loss_mean", "log_loss_median", "draw_gap", "draw_share")


@query("t8_forecast_order", SIM + ", fo AS (SELECT competition_id, team_id, avg((place = 1)::INT) AS t, avg(place) AS x FROM pl GROUP BY 1, 2) SELECT competition_id, team_id, (row_number() OVER (PARTITION BY competition_id ORDER BY t DESC, x, team_id))::INT AS forecast_place FROM fo")
def t8(m):
    from contestry.plans.forecasts import m19

    return m19(m).select("competition_id", "team_id", e.place("competition_id", F.col("title_prob").desc(), "expected_position", "team_id").alias("forecast_place"))
