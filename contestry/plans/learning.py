"""Registered queries: models on the feature table, and the rating stream."""

from __future__ import annotations

import uuid

from pyspark.sql import functions as F

from contestry.operators import evaluate as e
from contestry.operators.form import feature_table
from contestry.operators.learn import fit_predict
from contestry.plans.features import ELO, rounded
from contestry.sources.contests import stored_contests, with_contests
from contestry.sources.store import large, shared_dir, stored
from contestry.streaming.elo import FIELDS, corrected, start_elo

QUERIES: dict = {}
ORACLE: dict = {}


def _model_query(name: str):
    def run(spark, sf_dir):
        """Fitted on played contests of seasons before 1998, scored on season 1998."""
        m = stored_contests(spark, sf_dir)
        rows = stored(feature_table(m).join(large(m.where("is_played").select("match_id", "start_year", "result_code")), "match_id"), "rows")
        train, valid = rows.where("start_year < 1998").drop("start_year"), rows.where("start_year = 1998").drop("start_year")
        scored = fit_predict(name, train, valid).withColumn("model", F.lit(name))
        return rounded(e.metrics(scored, ["model"]).select("model", "n", "accuracy", "log_loss", "brier", "f1_macro"))

    return run


for key, name in {"m1": "logreg", "m2": "logreg_balanced", "m3": "random_forest", "m4": "boosted"}.items():
    QUERIES[f"{key}_{name}"] = _model_query(name)


def x2_streaming_elo(spark, sf_dir):
    """Contests out of order in three micro-batches: half of a season comes with the next ones, a few years late in the odd
    competitions, which a batch run then corrects; a last row closes each competition."""
    path = f"{shared_dir(spark)}/elo-{uuid.uuid4().hex}"
    m = stored_contests(spark, sf_dir)
    shown = m.select("competition_id", F.date_format("match_date", "yyyy-MM-dd").alias("match_date"), *FIELDS[1:])
    late = "start_year = 1995 and competition_id % 2 = 1 and match_id % 20 = 0"
    first = F.expr(f"start_year < 1998 and not (start_year = 1997 and match_id % 2 = 0) and not ({late})")
    closing = m.select("competition_id").distinct().select("competition_id", *[F.lit(None).cast(shown.schema[c].dataType).alias(c) for c in FIELDS])
    for rows in (shown.where(first), shown.where(~first), closing):
        rows.repartition(3).write.mode("append").parquet(f"{path}/in")
        stream = spark.readStream.schema(shown.schema).parquet(f"{path}/in")
        start_elo(stream, f"{path}/out", f"{path}/state", wait=400, partitions=4).awaitTermination()
    return rounded(corrected(spark.read.parquet(f"{path}/out"), m).drop("competition_id"))


QUERIES["x2_streaming_elo"] = x2_streaming_elo
ORACLE["x2_streaming_elo"] = with_contests(ELO + " SELECT match_id, round(h, 6) AS home_elo, round(a, 6) AS away_elo FROM el WHERE rn > 0", recursive=True)
