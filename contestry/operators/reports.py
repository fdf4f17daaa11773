"""Report rows: fixtures with their predictions, results, scorecards and contest details."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import Window as W

from contestry.functions import scalars as s
from contestry.operators.tables import latest_per_key

#: What models are called in reports.
LABELS = {
    "logistic_regression": "Logistic regression",
    "logistic_regression_balanced": "Logistic regression (class-weighted)",
    "random_forest": "Random forest",
    "xgboost": "XGBoost",
    "poisson_dixon_coles": "Poisson / Dixon–Coles",
}


def with_names(m: DataFrame, clubs: DataFrame) -> DataFrame:
    """Both sides' names: the clubs once for each role."""
    for side in ("home", "away"):
        named = clubs.select("competition_id", F.col("team_id").alias(f"{side}_team_id"), F.col("name").alias(f"{side}_team"))
        m = m.join(named, ["competition_id", f"{side}_team_id"])
    return m


def production_runs(runs: DataFrame, reported: DataFrame | None = None) -> DataFrame:
    """Of each competition the newest run with an artifact, one of the reported algorithm first.

    runs: competition_id, model_run_id, algorithm, trained_at, artifact; reported: competition_id, reported.
    """
    kept = runs.where("artifact is not null")
    kept = kept.join(reported, "competition_id", "left") if reported is not None else kept.withColumn("reported", F.lit(None).cast("string"))
    rank = F.struct(F.coalesce(F.col("algorithm") == F.col("reported"), F.lit(False)), "trained_at", "model_run_id")
    return latest_per_key(kept.withColumn("rank_", rank), "competition_id", "rank_").drop("rank_", "reported")


def latest_predictions(predictions: DataFrame, production: DataFrame) -> DataFrame:
    """Each contest's newest prediction by its competition's production algorithm, whichever run made it."""
    mine = predictions.join(production.select("competition_id", F.col("algorithm").alias("in_use")), "competition_id").where("algorithm = in_use").drop("in_use")
    return latest_per_key(mine.withColumn("at_", F.struct("created_at", "run")), "match_id", "at_").drop("at_")


def run_predictions(predictions: DataFrame, production: DataFrame) -> DataFrame:
    """The predictions of each competition's production run itself."""
    return predictions.join(production.select("competition_id", "model_run_id"), ["competition_id", "model_run_id"], "left_semi")


def fixture_rows(m: DataFrame, predictions: DataFrame, results: bool) -> DataFrame:
    """Contests (with home_team, away_team) as report rows: text dates, percents, labels, notes; results where asked for."""
    p = predictions.drop("competition_id", "run").withColumnRenamed("match_id", "predicted_id")
    x = m.join(p, F.col("match_id") == F.col("predicted_id"), "left")
    has = F.col("predicted_class").isNotNull() & F.col("p_home").isNotNull()
    out = {
        "match_id": F.col("match_id"),
        "competition_id": F.col("competition_id"),
        "kickoff_date": s.iso_date(F.col("match_date")),
        "kickoff_time": s.iso_minute(F.col("kickoff_time")),
        "home_team": F.col("home_team"),
        "away_team": F.col("away_team"),
        "has_prediction": has,
        **{f"{t}_pct": F.when(has, s.as_percent(F.col(t))) for t in ("p_home", "p_draw", "p_away")},
        "predicted_class": F.when(has, F.col("predicted_class")),
        "predicted_outcome": F.when(has, s.outcome(F.col("predicted_class"), F.col("home_team"), F.col("away_team"))),
        "model_name": F.when(has, s.title_of(F.col("algorithm"), LABELS)),
        "predicted_at": F.when(has, s.iso_stamp(F.col("created_at"))),
        "note": F.when(has, s.match_note(F.col("p_away"), F.col("p_draw"), F.col("p_home"), F.col("predicted_class"))),
    }
    if results:
        out |= {
            "home_goals": F.col("home_goals"),
            "away_goals": F.col("away_goals"),
            "result_code": F.col("result_code"),
            "actual_outcome": s.outcome(F.col("result_code"), F.col("home_team"), F.col("away_team")),
            "result_label": s.side_label(F.col("result_code")),
            "correct": F.when(has, F.col("result_code") == F.col("predicted_class")),
        }
    return x.select(*[c.alias(n) for n, c in out.items()])


def statistics(payload: Column, fields: list[tuple[str, str, str, str]]) -> Column:
    """The statistics that a JSON payload has numbers for on both sides: array of (key, home, away, leader)."""
    number = lambda k: F.floor(F.trim(F.get_json_object(payload, f"$.{k}")).try_cast("double")).cast("int")
    every = F.array(*[F.struct(F.lit(key).alias("key"), number(h).alias("home"), number(a).alias("away"), F.lit(better == "higher").alias("more")) for key, h, a, better in fields])

    def shown(x: Column) -> Column:
        ahead = F.when(x["home"] == x["away"], F.lit(None)).when((x["home"] > x["away"]) == x["more"], "home").otherwise("away")
        return F.struct(x["key"].alias("key"), x["home"].alias("home"), x["away"].alias("away"), ahead.alias("leader"))

    return F.transform(F.filter(every, lambda x: x["home"].isNotNull() & x["away"].isNotNull()), shown)


def raw_payloads(m: DataFrame, payloads: DataFrame, own_file: Column) -> DataFrame:
    """match_id, payload: the first payload with a score for each contest (with names), one of its own file before others.

    payloads: competition_id, start_year, source_file, row_number, payload. Names are read from the JSON
    and joined as keys.
    """
    field = lambda k: F.get_json_object("payload", f"$.{k}")
    scored = payloads.select("competition_id", "start_year", "source_file", "row_number", "payload", field("HomeTeam").alias("home_team"), field("AwayTeam").alias("away_team"), field("FTHG").alias("score"))
    scored = scored.where("score is not null and score <> ''")
    met = m.withColumn("own_file", own_file).join(scored, ["competition_id", "start_year", "home_team", "away_team"])
    order = F.struct(F.col("source_file") != F.col("own_file"), "source_file", "row_number")
    return met.groupBy("match_id").agg(F.min_by("payload", order).alias("payload"))


def class_rates(settled: DataFrame, keys: list[str]) -> DataFrame:
    """keys, by (actual or predicted), class, n, correct, rate: three rows for each way, also where a class is empty."""
    right = F.col("predicted_class") == F.col("result_code")
    both = F.explode(F.array(*[F.struct(F.lit(by).alias("by"), F.col(c).alias("code"), right.alias("right")) for by, c in (("actual", "result_code"), ("predicted", "predicted_class"))]))
    rows = settled.select(*keys, both.alias("x")).select(*keys, "x.*")
    sums = rows.groupBy(*keys, "by").agg(*[F.struct(F.count_if(F.col("code") == c).alias("n"), F.count_if((F.col("code") == c) & F.col("right")).alias("correct")).alias(name) for c, name in enumerate(("away", "draw", "home"))])
    each = F.explode(F.array(*[F.struct(F.lit(name).alias("class"), F.col(name)["n"].alias("n"), F.col(name)["correct"].alias("correct")) for name in ("away", "draw", "home")]))
    return sums.select(*keys, "by", each.alias("x")).select(*keys, "by", "x.*", (F.col("x.correct") / F.nullif(F.col("x.n"), F.lit(0))).alias("rate"))


def paged(df: DataFrame, keys: list[str], order: list[Column], number: int, size: int) -> DataFrame:
    """A page of each group: place, pages and total with the rows; sizes within 10 and 20, numbers within the pages."""
    size = min(max(size, 10), 20)
    placed = df.withColumns({"place": F.row_number().over(W.partitionBy(*keys).orderBy(*order)), "total": F.count("*").over(W.partitionBy(*keys))})
    pages = F.greatest(F.ceil(F.col("total") / size), F.lit(1)).cast("int")
    at = F.least(F.greatest(F.lit(number), F.lit(1)), F.col("pages"))
    return placed.withColumn("pages", pages).withColumn("page", at).where(F.ceil(F.col("place") / size) == F.col("page"))
