"""Model runs: fingerprints, reuse, and the staleness of forecasts; stage summaries."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from contestry.operators.tables import latest_per_key

#: What identifies a run, in this order.
IDENTITY = ["algorithm", "feature_version", "competition_id", "n_train", "n_test", "train_start", "train_end", "test_start", "test_end", "walkforward_mean_log_loss", "test_log_loss"]

#: What a stored run is found by.
RUN_KEYS = ["algorithm", "feature_version", "fingerprint"]


def fingerprinted(runs: DataFrame) -> DataFrame:
    """runs with a fingerprint: a digest of IDENTITY, scores rounded to ten places. Nothing is gathered: a run is a row."""
    kinds = dict(runs.dtypes)
    shown = [F.format_number(F.col(c), 10) if kinds[c] in ("double", "float") else F.col(c).cast("string") for c in IDENTITY]
    return runs.withColumn("fingerprint", F.sha2(F.concat_ws("|", *[F.coalesce(c, F.lit("-")) for c in shown]), 256))


def reusable(new: DataFrame, stored: DataFrame) -> DataFrame:
    """new runs with reused_id: the newest stored run of the same fingerprint, or null where the run is to be inserted.

    Both have algorithm, competition_id, feature_version, fingerprint; stored also model_run_id, trained_at.
    """
    keys = ["competition_id", *RUN_KEYS]
    old = stored.groupBy(*keys).agg(F.max_by("model_run_id", F.struct("trained_at", "model_run_id")).alias("reused_id"))
    return new.join(old, keys, "left")


def stale_forecasts(forecasts: DataFrame, snapshots: DataFrame) -> DataFrame:
    """forecasts with current: whether model run, counts and the predictions' time are those of the season's snapshot."""
    keys = ["model_run_id", "n_completed", "n_remaining", "updated_at"]
    now = snapshots.select("competition_id", *[F.col(k).alias(f"{k}_now") for k in keys])
    same = F.lit(True)
    for k in keys:
        same = same & F.col(k).eqNullSafe(F.col(f"{k}_now"))
    joined = forecasts.join(now, "competition_id", "left")
    return joined.withColumn("current", same & F.col("n_completed_now").isNotNull()).drop(*[f"{k}_now" for k in keys])


def stage_summary(reports: DataFrame) -> DataFrame:
    """The latest report of each competition and stage, as one JSON object a competition: stage -> report.

    reports: competition_id, stage, at, report (JSON); stages are a handful.
    """
    latest = latest_per_key(reports.withColumn("key_", F.struct("competition_id", "stage")), "key_", "at").drop("key_")
    listed = F.transform(F.array_sort(F.collect_list(F.struct("stage", "report"))), lambda x: F.concat(F.lit('"'), x["stage"], F.lit('":'), x["report"]))
    return latest.groupBy("competition_id").agg(F.concat(F.lit("{"), F.array_join(listed, ","), F.lit("}")).alias("summary"))
