"""Registered queries: stored models predict the contests to come, and predictions of played ones stay frozen."""

from __future__ import annotations

from pyspark.sql import functions as F

from contestry.functions.scalars import argmax_class
from contestry.operators import form, learn, training
from contestry.operators.evaluate import TRIPLE
from contestry.plans.features import FEATURE_SQL, rounded
from contestry.sources.contests import stored_contests, with_contests
from contestry.sources.store import large, stored
from contestry.sources.versioned import fresh_table

QUERIES: dict = {}
ORACLE: dict = {}
LIVE, TRAIN_END, RUN = 2000, "2000-07-31", 4
KEY = ["competition_id"]


def query(name: str, sql: str | None = None, recursive: bool = False):
    def add(f):
        QUERIES[name] = lambda spark, sf_dir: rounded(f(stored_contests(spark, sf_dir)))
        if sql:
            ORACLE[name] = with_contests(sql, recursive)
        return f

    return add


def run_id(competition: str = "competition_id"):
    return (F.col(competition) * 10 + RUN).cast("long").alias("model_run_id")


def scored_upcoming(m, features, models, algorithm: str):
    """match_id, competition_id, model_run_id, triple and class of every unplayed contest, by its competition's stored model."""
    rows = m.where("not is_played").select("match_id", *KEY).join(large(features), "match_id")
    p = learn.score(rows, models, KEY, algorithm)
    return p.select("match_id", *KEY, run_id(), *TRIPLE, argmax_class(*map(F.col, TRIPLE)).alias("predicted_class"), F.lit(False).alias("is_played"))


def stored_earlier(m):
    """A table of predictions by contest and run: thirds for every second contest of the live season, played or not."""
    table = fresh_table(m.sparkSession, "predictions", ["competition_id", "match_id", "model_run_id"], ["competition_id"])
    rows = m.where((F.col("start_year") == LIVE) & (F.col("match_id") % 2 == 0))
    table.replace(rows.select("match_id", *KEY, run_id(), *[F.lit(1 / 3).alias(t) for t in TRIPLE], F.lit(0).alias("predicted_class"), "is_played"))
    return table


# Fixed weights, so that SQL can follow: by feature i (the intercept last) and class c.

N = len(learn.FEATURES)
WEIGHTS = [[((3 * i + c) % 7 - 3) / 20 for c in range(3)] for i in range(N + 1)]
MIDDLE, MEAN, SCALE = [i / 10 for i in range(N)], [float(i % 3) for i in range(N)], [1.0 + i % 4 for i in range(N)]


def fixed_models(m):
    """A stored logistic regression for each competition."""
    numbers = lambda v: F.array(*[F.lit(float(x)) for x in v])
    none = F.array().cast("array<double>")
    return m.select(*KEY).distinct().select(
        *KEY, F.lit("logistic_regression").alias("algorithm"), numbers(MIDDLE).alias("middle"), numbers(MEAN).alias("mean"), numbers(SCALE).alias("scale"),
        F.array(*[none] * N).alias("edges"), numbers([1, 1, 1]).alias("counts"), numbers([w for row in WEIGHTS for w in row]).alias("weights"), none.alias("pending"),
    )


def _logit(c: int) -> str:
    given = lambda i, f: f"coalesce({f}, 0.5)" if f.startswith("h2h") else f"coalesce({f}, {MIDDLE[i]})"
    return " + ".join([*[f"({given(i, f)} - {MEAN[i]}) / {SCALE[i]} * ({WEIGHTS[i][c]})::DOUBLE" for i, f in enumerate(learn.FEATURES)], f"({WEIGHTS[N][c]})::DOUBLE"])


FIXED = FEATURE_SQL + f""",
lo AS (SELECT match_id, competition_id, exp({_logit(0)}) AS a, exp({_logit(1)}) AS d, exp({_logit(2)}) AS h FROM ft JOIN contests USING (match_id) WHERE NOT is_played),
nw AS (SELECT match_id, competition_id, a / (a + d + h) AS p_away, d / (a + d + h) AS p_draw, h / (a + d + h) AS p_home FROM lo),
od AS (SELECT match_id, competition_id, is_played FROM contests WHERE start_year = {LIVE} AND match_id % 2 = 0)"""


@query("m18_fixed_model", FIXED + f""" SELECT match_id, competition_id, (competition_id * 10 + {RUN})::BIGINT AS model_run_id, round(coalesce(nw.p_away, 1 / 3), 6) AS p_away, round(coalesce(nw.p_draw, 1 / 3), 6) AS p_draw, round(coalesce(nw.p_home, 1 / 3), 6) AS p_home,
  CASE WHEN nw.match_id IS NULL OR (nw.p_away >= nw.p_draw AND nw.p_away >= nw.p_home) THEN 0 WHEN nw.p_draw >= nw.p_home THEN 1 ELSE 2 END AS predicted_class, coalesce(od.is_played, false) AS is_played,
  CASE WHEN competition_id NOT IN (SELECT competition_id FROM nw) THEN 'inserted' WHEN nw.match_id IS NULL THEN 'unchanged' WHEN od.match_id IS NULL THEN 'inserted' ELSE 'updated' END AS change
FROM nw FULL JOIN od USING (match_id, competition_id)""", recursive=True)
def m18_fixed(m):
    """Stored models of fixed weights are read back, score the unplayed contests, and are put in by contest and run."""
    models = fresh_table(m.sparkSession, "models", KEY, KEY)
    models.replace(fixed_models(m))
    table = stored_earlier(m)
    table.upsert(scored_upcoming(m, stored(rounded(form.feature_table(m)), "features"), models.read(), "logistic_regression"), F.col("o.is_played"))
    return table.read(changes=True).drop("write")


@query("m18_predict_upcoming")
def m18(m):
    """Each competition's model is trained on its seasons so far, stored by version, and predicts what is to come."""
    features = stored(form.feature_table(m), "features")
    rows = m.select("match_id", *KEY, "match_date", "is_played", "result_code").join(large(features), "match_id").where(training.eligible(test_end=TRAIN_END))
    models = fresh_table(m.sparkSession, "models", KEY, KEY)
    models.replace(learn.trained(rows, KEY, "logistic_regression"))
    table = stored_earlier(m)
    table.upsert(scored_upcoming(m, features, models.read(), "logistic_regression"), F.col("o.is_played"))
    return table.read(changes=True).drop("write")
