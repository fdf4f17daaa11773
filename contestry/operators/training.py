"""Training rows: eligibility, splits, gates and walk-forward guards."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from contestry.operators.curation import problems
from contestry.operators.tables import CLASSES, splits
from contestry.sources.store import large

LEAST_PRIOR = 1


def eligible(least_prior: int = LEAST_PRIOR, test_end: str | None = None) -> Column:
    """Played, with a result, enough earlier contests on both sides, and not after the test season."""
    ok = F.col("is_played") & F.col("result_code").isNotNull() & (F.col("home_prior_n") >= least_prior) & (F.col("away_prior_n") >= least_prior)
    return ok if test_end is None else ok & (F.col("match_date") <= F.lit(test_end).cast("date"))


def training_rows(matches: DataFrame, features: DataFrame, train_end: str, valid_end: str, test_end: str, least_prior: int = LEAST_PRIOR) -> DataFrame:
    """Eligible contests with their features and split; one equi join."""
    if least_prior < 1:
        raise ValueError("opening contests have no form: at least one earlier contest is needed")
    labels = matches.select("match_id", "match_date", "start_year", "competition_id", "is_played", "result", "result_code")
    rows = labels.join(large(features), "match_id").where(eligible(least_prior, test_end)).drop("is_played")
    return rows.withColumn("split", splits(train_end, valid_end, test_end))


def training_problems(rows: DataFrame) -> DataFrame:
    """check, rows: empty splits, results that are no class, missing ratings; one scan."""
    counts = rows.agg(
        *[(F.count_if(F.col("split") == s) == 0).cast("long").alias(f"no {s} rows") for s in ("train", "valid", "test")],
        F.count_if(~F.coalesce(F.col("result_code").isin(*CLASSES), F.lit(False))).alias("invalid result"),
        F.count_if(F.col("home_elo").isNull() | F.col("away_elo").isNull()).alias("missing elo"),
    )
    each = F.explode(F.array(*[F.struct(F.lit(c).alias("check"), F.col(f"`{c}`").alias("rows")) for c in counts.columns]))
    return counts.select(each.alias("x")).select("x.*")


def split_summary(rows: DataFrame, *keys: str) -> DataFrame:
    """n, first and last day and results of each split."""
    return rows.groupBy(*keys, "split").agg(
        F.count("*").alias("n"), F.min("match_date").alias("first_day"), F.max("match_date").alias("last_day"),
        *[F.count_if(F.col("result_code") == c).alias(name) for c, name in CLASSES.items()],
    )


def fold_problems(folds: DataFrame, holdout: DataFrame) -> DataFrame:
    """check, rows: validation contests of the holdout, empty roles, and training days after validation begins.

    folds: fold, role, match_id, match_date; holdout: match_id.
    """
    valid = folds.where("role = 'valid'")
    reach = valid.select("match_id").join(holdout.select("match_id"), "match_id", "left_semi")
    ends = folds.groupBy("fold").agg(
        F.max(F.when(F.col("role") == "train", F.col("match_date"))).alias("last_train"), F.min(F.when(F.col("role") == "valid", F.col("match_date"))).alias("first_valid")
    )
    return problems(
        ("holdout in validation", reach),
        ("empty role", ends.where("last_train is null or first_valid is null")),
        ("train after valid", ends.where("last_train > first_valid")),
    )


def history_before(matches: DataFrame, features: DataFrame, season: int, least_prior: int = LEAST_PRIOR) -> DataFrame:
    """Features of eligible contests of the seasons before one."""
    rows = matches.select("match_id", "start_year", "match_date", "is_played", "result_code").where(F.col("start_year") < season).join(large(features), "match_id")
    return rows.where(eligible(least_prior)).drop("is_played")
