"""Tables beside the contests that the queries run on: clubs, model runs and their predictions, raw payloads.

All of them follow from the contests: predictions are the class shares of the contests played before a run.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from contestry.functions.scalars import argmax_class
from contestry.operators.evaluate import TRIPLE
from contestry.sources.store import again, stored

#: run, algorithm, trained on what was played before, first and last day it predicts, when, artifact.
RUNS = [
    (1, "logistic_regression", "1999-08-01", "1999-08-01", "2000-07-31", "1999-08-01 06:00:00", "models/run-1"),
    (2, "poisson_dixon_coles", "2000-08-01", "2000-08-01", "2001-05-31", "2000-08-01 06:00:00", "models/run-2"),
    (3, "poisson_dixon_coles", "2001-02-02", "2001-02-02", "2001-05-31", "2001-02-02 06:00:00", None),
    (4, "logistic_regression", "2001-02-02", "2001-02-02", "2001-06-15", "2001-02-03 06:00:00", "models/run-4"),
]
FEATURES = "v1"


def clubs(m: DataFrame) -> DataFrame:
    """competition_id, team_id, name."""
    sides = m.select("competition_id", F.explode(F.array("home_team_id", "away_team_id")).alias("team_id")).distinct()
    return sides.withColumn("name", F.concat(F.lit("Team "), F.col("team_id").cast("string")))


def run_table(spark: SparkSession) -> DataFrame:
    runs = spark.createDataFrame(RUNS, "run int, algorithm string, before string, first_day string, last_day string, trained_at string, artifact string")
    return runs.withColumns({**{c: F.col(c).cast("date") for c in ("before", "first_day", "last_day")}, "trained_at": F.col("trained_at").cast("timestamp")})


def model_runs(m: DataFrame) -> DataFrame:
    """competition_id, model_run_id, run, algorithm, feature_version, trained_at, artifact."""
    runs = F.broadcast(run_table(m.sparkSession))  # a fixed list
    each = m.select("competition_id").distinct().join(runs)
    return each.select("competition_id", run_id(F.col("competition_id"), F.col("run")), "run", "algorithm", F.lit(FEATURES).alias("feature_version"), "trained_at", "artifact")


def run_id(competition, run):
    return (competition * 10 + run).cast("long").alias("model_run_id")


def predictions(m: DataFrame) -> DataFrame:
    """match_id, competition_id, run, model_run_id, algorithm, created_at, p_away, p_draw, p_home, predicted_class.

    Of a stored view they are written once, however often a query asks for them.
    """
    if not hasattr(m, "stored_in"):
        return _predicted(m)
    if not hasattr(m, "predicted"):
        m.predicted = stored(_predicted(m), "predictions")
    return again(m.predicted)


def _predicted(m: DataFrame) -> DataFrame:
    # the runs are a fixed list: a row takes those that concern it, without a join
    runs = F.array(*[F.struct(F.lit(r).alias("run"), F.lit(a).alias("algorithm"), *[F.lit(x).cast("date").alias(n) for n, x in (("before", b), ("first_day", f), ("last_day", t))], F.lit(at).cast("timestamp").alias("created_at")) for r, a, b, f, t, at, _ in RUNS])
    concerned = lambda kept: F.explode(F.filter(runs, kept)).alias("r")
    played = m.where("is_played").select("competition_id", "result_code", concerned(lambda r: F.col("match_date") < r["before"]))
    shares = played.groupBy(F.col("r.run").alias("run"), "competition_id").agg(*[F.avg((F.col("result_code") == c).cast("double")).alias(p) for c, p in enumerate(TRIPLE)])
    rows = m.select("match_id", "competition_id", concerned(lambda r: F.col("match_date").between(r["first_day"], r["last_day"]))).select("match_id", "competition_id", "r.run", "r.algorithm", "r.created_at")
    out = rows.join(shares, ["run", "competition_id"]).select("match_id", "competition_id", "run", run_id(F.col("competition_id"), F.col("run")), "algorithm", "created_at", *TRIPLE)
    return out.withColumn("predicted_class", argmax_class(*map(F.col, TRIPLE)))


def _value(x) -> str:
    return "NULL" if x is None else str(x) if isinstance(x, int) else f"'{x}'"


PREDICTED = f"""
rl(run, algorithm, before, first_day, last_day, trained_at, artifact) AS (VALUES {", ".join("(" + ", ".join(map(_value, r)) + ")" for r in RUNS)}),
rn AS (SELECT run::INT AS run, algorithm, before::DATE AS before, first_day::DATE AS first_day, last_day::DATE AS last_day, trained_at::TIMESTAMP AS trained_at, artifact FROM rl),
mr AS (SELECT competition_id, (competition_id * 10 + run)::BIGINT AS model_run_id, run, algorithm, '{FEATURES}' AS feature_version, trained_at, artifact FROM rn, (SELECT DISTINCT competition_id FROM contests)),
hs AS (SELECT run, competition_id, avg((result_code = 0)::INT) AS p_away, avg((result_code = 1)::INT) AS p_draw, avg((result_code = 2)::INT) AS p_home FROM contests JOIN rn ON is_played AND match_date < before GROUP BY 1, 2),
pd AS (SELECT match_id, c.competition_id, run, (c.competition_id * 10 + run)::BIGINT AS model_run_id, algorithm, trained_at AS created_at, p_away, p_draw, p_home,
    CASE WHEN p_away >= p_draw AND p_away >= p_home THEN 0 WHEN p_draw >= p_home THEN 1 ELSE 2 END AS predicted_class
  FROM contests c JOIN rn ON c.match_date BETWEEN first_day AND last_day JOIN hs USING (run, competition_id))
"""

#: The statistics of a payload: key, home and away field, which side leads.
STATISTICS = [
    ("shots", "HS", "AS", "higher"),
    ("shots_on_target", "HST", "AST", "higher"),
    ("possession", "HPoss", "APoss", "higher"),
    ("passes", "HPass", "APass", "higher"),
    ("pass_accuracy", "HPassAcc", "APassAcc", "higher"),
    ("fouls", "HF", "AF", "lower"),
    ("yellow_cards", "HY", "AY", "lower"),
    ("red_cards", "HR", "AR", "lower"),
    ("offsides", "HOff", "AOff", "lower"),
    ("corners", "HC", "AC", "higher"),
]


def payloads(m: DataFrame) -> DataFrame:
    """season_key, source_file, row_number, payload (JSON of strings): a file a season, contests in date order, some of them twice.

    Row numbers count inside a file. Statistics follow from the goals; some are blank or no numbers.
    """
    from pyspark.sql import Window as W

    text = lambda c: F.coalesce(c.cast("string"), F.lit(""))
    fields = {
        "HomeTeam": F.concat(F.lit("Team "), F.col("home_team_id").cast("string")),
        "AwayTeam": F.concat(F.lit("Team "), F.col("away_team_id").cast("string")),
        "FTHG": text(F.col("home_goals")),
        "FTAG": text(F.col("away_goals")),
        "HS": F.when(F.col("match_id") % 6 == 0, "").otherwise(text(F.col("home_goals") * 4 + F.col("match_id") % 5)),
        "AS": text(F.col("away_goals") * 4 + F.col("match_id") % 3),
        "HF": F.concat(text(F.col("match_id") % 7), F.lit(".0")),
        "AF": F.when(F.col("match_id") % 5 == 0, "n/a").otherwise(text(F.col("match_id") % 4)),
    }
    twice = F.explode(F.when(F.col("match_id") % 8 == 0, F.array(F.lit("a"), F.lit("b"))).otherwise(F.array(F.lit("a"))))
    rows = m.withColumn("part", twice)
    file = F.concat(F.lit("C"), F.col("competition_id").cast("string"), F.lit("_"), F.col("start_year").cast("string"), F.col("part"))
    rows = rows.withColumn("source_file", file)
    number = F.row_number().over(W.partitionBy("source_file").orderBy("match_date", "match_id"))
    return rows.select("competition_id", "start_year", "source_file", number.alias("row_number"), "match_id", F.to_json(F.struct(*[c.alias(k) for k, c in fields.items()])).alias("payload"))


PAYLOADS = """
pl0 AS (SELECT *, unnest(CASE WHEN match_id % 8 = 0 THEN ['a', 'b'] ELSE ['a'] END) AS part FROM contests),
pl AS (SELECT competition_id, start_year, 'C' || competition_id || '_' || start_year || part AS source_file, (row_number() OVER (PARTITION BY competition_id, start_year, part ORDER BY match_date, match_id))::INT AS row_number, match_id,
  coalesce(home_goals::VARCHAR, '') AS fthg, 'Team ' || home_team_id AS home, 'Team ' || away_team_id AS away,
  CASE WHEN match_id % 6 = 0 OR home_goals IS NULL THEN NULL ELSE home_goals * 4 + match_id % 5 END AS hs, away_goals * 4 + match_id % 3 AS "as", match_id % 7 AS hf, CASE WHEN match_id % 5 = 0 THEN NULL ELSE match_id % 4 END AS af FROM pl0)
"""
