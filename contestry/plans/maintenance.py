"""Registered queries: features, training rows, predictions and runs kept in versioned tables, by key and partition."""

from __future__ import annotations

from pyspark.sql import functions as F

from contestry.operators import form, registry, training
from contestry.plans.features import FEATURE_SQL, rounded
from contestry.plans.trainings import RUN, _runs
from contestry.sources import derived as d
from contestry.sources.contests import stored_contests, with_contests
from contestry.sources.store import large, stored
from contestry.sources.versioned import fresh_table

QUERIES: dict = {}
ORACLE: dict = {}
#: Ends of the splits when training rows are first assembled, and a season later.
EARLIER, LATER = ("1997-07-31", "1998-07-31", "1999-07-31"), ("1998-07-31", "1999-07-31", "2000-07-31")


def query(name: str, sql: str | None = None, recursive: bool = False):
    def add(f):
        QUERIES[name] = lambda spark, sf_dir: rounded(f(stored_contests(spark, sf_dir)))
        if sql:
            ORACLE[name] = with_contests(sql, recursive)
        return f

    return add


def keyed_features(m):
    return form.feature_table(m).join(large(m.select("match_id", "competition_id")), "match_id")


@query("s15_feature_upsert", FEATURE_SQL + """ SELECT ft.* REPLACE (CASE WHEN competition_id % 2 = 1 THEN 'v1' ELSE 'v0' END AS feature_version), competition_id, CASE WHEN competition_id % 2 = 1 AND match_id % 2 = 0 THEN 'updated' ELSE 'inserted' END AS change
FROM ft JOIN contests USING (match_id) WHERE competition_id % 2 = 1 OR match_id % 2 = 0""", recursive=True)
def s15(m):
    """Features of half the contests stored as v0, then those of the odd competitions put in by key as v1."""
    features = stored(keyed_features(m), "features")
    table = fresh_table(m.sparkSession, "features", ["competition_id", "match_id"], ["competition_id"])
    table.replace(features.where("match_id % 2 = 0").withColumn("feature_version", F.lit("v0")))
    table.upsert(features.where("competition_id % 2 = 1"))
    return table.read(changes=True).drop("write")


def training_sql(ends: tuple, name: str) -> str:
    train, valid, test = ends
    return f"""{name} AS (SELECT match_id, competition_id, result_code, home_elo, away_elo, CASE WHEN match_date <= DATE '{train}' THEN 'train' WHEN match_date <= DATE '{valid}' THEN 'valid' ELSE 'test' END AS split
  FROM ft JOIN contests USING (match_id) WHERE is_played AND result_code IS NOT NULL AND home_prior_n >= 1 AND away_prior_n >= 1 AND match_date <= DATE '{test}')"""


@query("j22_replaced_training", FEATURE_SQL + ", " + training_sql(EARLIER, "t1") + ", " + training_sql(LATER, "t2") + """ SELECT *, true AS same_files FROM t1 WHERE competition_id % 2 = 0 UNION ALL SELECT *, false FROM t2 WHERE competition_id % 2 = 1""", recursive=True)
def j22_training(m):
    """Training rows of all competitions, then those of the odd ones assembled again a season later: the others keep their files."""
    features = stored(form.feature_table(m), "features")
    table = fresh_table(m.sparkSession, "training", ["competition_id", "match_id"], ["competition_id"])
    first = table.replace(training.training_rows(m, features, *EARLIER))
    table.replace(training.training_rows(m, features, *LATER).where("competition_id % 2 = 1"))
    rows = table.read(changes=True)
    return rows.select("match_id", "competition_id", "result_code", "home_elo", "away_elo", "split", (F.col("write") == first.write).alias("same_files"))


STORED = d.PREDICTED + ", un AS (SELECT match_id, competition_id FROM contests WHERE NOT is_played AND competition_id % 2 = 1 AND match_id % 3 = 0)"


@query("j22_delete_using", STORED + """, dl AS (SELECT count(*) AS deleted FROM pd WHERE match_id IN (SELECT match_id FROM un))
SELECT match_id, competition_id, model_run_id, p_home, deleted FROM (SELECT match_id, competition_id, model_run_id, round(p_home, 6) AS p_home FROM pd WHERE match_id NOT IN (SELECT match_id FROM un)), dl""")
def j22_delete(m):
    """Stored predictions of contests that have gone are deleted with them, and counted."""
    stored_rows = stored(d.predictions(m).select("match_id", "competition_id", "model_run_id", "p_home"), "predictions")
    table = fresh_table(m.sparkSession, "predictions", ["competition_id", "match_id"], ["competition_id"])
    table.replace(stored_rows)
    _, deleted = table.delete_using(m.where("not is_played and competition_id % 2 = 1 and match_id % 3 = 0"))
    return table.read().withColumn("deleted", F.lit(deleted).cast("long"))


@query("j22_update_from", """fd AS (SELECT match_id, (match_date + 7)::DATE AS day, '20:00:00' AS kickoff FROM contests WHERE start_year = 2000 AND match_id % 3 = 0)
SELECT c.match_id, c.competition_id, start_year, home_team_id, away_team_id, is_played, (CASE WHEN hit THEN day ELSE match_date END)::DATE::VARCHAR AS match_date, CASE WHEN hit THEN kickoff ELSE kickoff_time END AS kickoff_time, CASE WHEN hit THEN 'updated' WHEN start_year = 2000 AND competition_id IN (SELECT competition_id FROM contests WHERE start_year = 2000 AND match_id % 3 = 0) THEN 'unchanged' ELSE 'inserted' END AS change
FROM (SELECT contests.*, day, kickoff, day IS NOT NULL AND NOT is_played AS hit FROM contests LEFT JOIN fd USING (match_id)) c""")
def j22_update(m):
    """A feed of the live season moves contests; played ones stay where they were. Other seasons' files aren't read."""
    table = fresh_table(m.sparkSession, "contests", ["competition_id", "start_year", "match_id"], ["competition_id", "start_year"])
    table.replace(m.select("match_id", "competition_id", "start_year", "home_team_id", "away_team_id", "is_played", "match_date", "kickoff_time"))
    feed = m.where("start_year = 2000 and match_id % 3 = 0").select("competition_id", "start_year", "match_id", F.date_add("match_date", 7).alias("match_date"), F.lit("20:00:00").alias("kickoff_time"))
    table.update_from(feed, where=~F.col("o.is_played"))
    return table.read(changes=True).drop("write")


@query("d6_stored_predictions", d.PREDICTED + """, o AS (SELECT match_id, model_run_id, p_home, is_played FROM pd JOIN contests USING (match_id) WHERE run < 4 OR match_id % 2 = 0), n AS (SELECT match_id, model_run_id, 0.5::DOUBLE AS p_home, is_played FROM pd JOIN contests USING (match_id) WHERE run IN (2, 4))
SELECT match_id, model_run_id, round(CASE WHEN o.match_id IS NULL OR (n.match_id IS NOT NULL AND NOT o.is_played) THEN n.p_home ELSE o.p_home END, 6) AS p_home, 2::BIGINT AS versions FROM o FULL JOIN n USING (match_id, model_run_id)""")
def d6(m):
    """Predictions by contest and run, those of played contests frozen. A writer dies before its commit, and the next one's batch is sent twice."""
    every = d.predictions(m).join(m.select("match_id", "is_played"), "match_id").select("competition_id", "match_id", "model_run_id", "run", "p_home", "is_played")
    every = stored(every, "predictions")
    table = fresh_table(m.sparkSession, "predictions", ["competition_id", "match_id", "model_run_id"], ["competition_id"])
    table.replace(every.where("run < 4 or match_id % 2 = 0").drop("run"))
    new = every.where("run in (2, 4)").withColumn("p_home", F.lit(0.5)).drop("run")
    table.stage(new.withColumn("p_home", F.lit(9.0)))  # the writer that dies: files, and no commit
    for _ in range(2):
        table.upsert(new, F.col("o.is_played"), batch=("predictions", 1))
    return table.read().select("match_id", "model_run_id", "p_home").withColumn("versions", F.lit(len(table.versions())).cast("long"))


@query("d17_run_registry", RUN + " SELECT fold, competition_id, fingerprint, (fold * 10 + competition_id)::BIGINT AS model_run_id, CASE WHEN fold = 1997 THEN 'kept' ELSE 'inserted' END AS change FROM rr WHERE competition_id IN (SELECT competition_id FROM rr WHERE fold = 1998) UNION ALL SELECT fold, competition_id, fingerprint, (fold * 10 + competition_id)::BIGINT, 'inserted' FROM rr WHERE competition_id NOT IN (SELECT competition_id FROM rr WHERE fold = 1998)")
def d17(m):
    """The first fold's runs are stored, then those of both folds: a run whose fingerprint is there keeps its id."""
    runs = stored(_runs(m), "runs").select("competition_id", "algorithm", "feature_version", "fingerprint", "fold")
    table = fresh_table(m.sparkSession, "runs", ["competition_id", *registry.RUN_KEYS], ["competition_id"])
    first = runs.where("fold = 1997").withColumn("model_run_id", (F.col("fold") * 10 + F.col("competition_id")).cast("long"))
    table.replace(first)
    later = runs.withColumn("model_run_id", (F.col("fold") * 10 + F.col("competition_id") + F.when(F.col("fold") == 1997, 5000).otherwise(0)).cast("long"))
    table.upsert(later, frozen=F.lit(True))
    return table.read(changes=True).select("fold", "competition_id", "fingerprint", "model_run_id", "change")
