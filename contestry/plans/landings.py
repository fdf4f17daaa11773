"""Registered queries: landing of payloads, dimensions and the catalog."""

from __future__ import annotations

import uuid

from pyspark.sql import functions as F

from contestry.functions import scalars
from contestry.operators import curation, landing
from contestry.operators import tables as t
from contestry.plans.features import rounded
from contestry.plans.reports import TABLE
from contestry.sources import derived as d
from contestry.plans.curations import RAW, curated
from contestry.sources.contests import stored_contests, with_contests
from contestry.sources.raw import raw_rows
from contestry.sources.store import shared_dir
from contestry.streaming.landing import land_stream
from contestry.streaming.landing import landed as landed_rows

QUERIES: dict = {}
ORACLE: dict = {}


def query(name: str, sql: str | None = None):
    def add(f):
        QUERIES[name] = lambda spark, sf_dir: rounded(f(stored_contests(spark, sf_dir)))
        if sql:
            ORACLE[name] = with_contests(sql)
        return f

    return add


def _landed(m):
    """Payloads of seasons before 2000, then those from 1999 on: a season is sent twice."""
    rows = d.payloads(m).withColumn("code", F.concat(F.lit("C"), F.col("competition_id").cast("string"))).drop("competition_id", "match_id")
    old, new = rows.where("start_year < 2000"), rows.where("start_year >= 1999").withColumn("payload", F.concat("payload", F.lit(" ")))
    return landing.land(old, new), new


LANDED = d.PAYLOADS + ", ld AS (SELECT 'C' || competition_id AS code, start_year, source_file, row_number, CASE WHEN start_year < 1999 THEN 'unchanged' WHEN start_year = 1999 THEN 'updated' ELSE 'inserted' END AS change FROM pl)"


@query("s7_landing", LANDED + " SELECT source_file, row_number, change FROM ld")
def s7(m):
    return _landed(m)[0].select("source_file", "row_number", "change")


@query("s9_ingest_counts", LANDED + " SELECT code, start_year, count(*) AS rows, count(*) FILTER (change = 'inserted') AS inserted, count(*) FILTER (change = 'updated') AS updated FROM ld WHERE start_year BETWEEN 1999 AND 2000 GROUP BY 1, 2")
def s9(m):
    landed, new = _landed(m)
    return landing.landing_counts(landing.of_years(landed, 1999, 2000), new, "code", "start_year")


NAMED = {"C1": ("First League", "Somewhere"), "C2": ("Second League", "Elsewhere")}


@query("s8_dimensions", d.PAYLOADS + " SELECT DISTINCT 'C' || competition_id AS code, start_year, printf('%d/%02d', start_year, (start_year + 1) % 100) AS season, CASE competition_id WHEN 1 THEN 'First League' WHEN 2 THEN 'Second League' ELSE 'C' || competition_id END AS competition, CASE competition_id WHEN 1 THEN 'Somewhere' WHEN 2 THEN 'Elsewhere' ELSE '' END AS country FROM pl")
def s8(m):
    competitions, seasons = landing.dimensions(_landed(m)[0], NAMED)
    return seasons.withColumnRenamed("name", "season").join(competitions.withColumnRenamed("name", "competition"), "code")


@query("s10_payload_scan", d.PAYLOADS + " SELECT 'C' || competition_id AS code, start_year, source_file, row_number, '1999/00' AS season, 'First League' AS competition FROM pl WHERE competition_id = 1 AND start_year = 1999")
def s10(m):
    landed, _ = _landed(m)
    competitions, seasons = landing.dimensions(landed, NAMED)
    return landing.payload_scan(landed, seasons, competitions, "C1", 1999).select("code", "start_year", "source_file", "row_number", "season", "competition")


@query("s18_season_sizes", "sn AS (SELECT DISTINCT 'C' || competition_id AS code, start_year FROM contests) SELECT code, start_year, CASE WHEN code = 'C1' AND start_year BETWEEN 1996 AND 1998 THEN 10 WHEN code IN ('C1', 'C2') THEN 20 END AS clubs, CASE WHEN code = 'C1' AND start_year BETWEEN 1996 AND 1998 THEN 90 WHEN code IN ('C1', 'C2') THEN 380 END AS contests FROM sn")
def s18(m):
    spark = m.sparkSession
    seasons = m.select(F.concat(F.lit("C"), F.col("competition_id").cast("string")).alias("code"), "start_year").distinct()
    usual = spark.createDataFrame([("C1", 20, 380), ("C2", 20, 380)], "code string, clubs int, contests int")
    other = spark.createDataFrame([("C1", 1996, 1998, 10, 90)], "code string, first int, last int, clubs int, contests int")
    return landing.season_sizes(seasons, usual, other)


@query("s18_bands", TABLE + ", tm AS (SELECT *, count(*) OVER (PARTITION BY competition_id, start_year) AS clubs FROM lt) SELECT competition_id, start_year, team_id, CASE WHEN position <= 1 THEN 'ucl' WHEN position <= 2 THEN 'europa' WHEN position <= 3 THEN 'conference' WHEN position > clubs - 2 THEN 'relegation' END AS band FROM tm")
def s18_bands(m):
    table = t.league_table(m, "start_year")
    clubs = table.groupBy("competition_id", "start_year").agg(F.count("*").alias("clubs"))
    places = [F.lit(x) for x in (2, 1, 2, 3)]
    return table.join(clubs, ["competition_id", "start_year"]).select("competition_id", "start_year", "team_id", landing.band(F.col("position"), F.col("clubs"), *places).alias("band"))


@query("x1_incremental_landing", d.PAYLOADS + " SELECT source_file, row_number, CASE WHEN start_year >= 1999 THEN 1 ELSE 0 END AS sent_again FROM pl")
def x1(m):
    """All payloads, then the seasons from 1999 on once more, each taken up by the stream as one micro-batch of several files."""
    path = f"{shared_dir(m.sparkSession)}/landing-{uuid.uuid4().hex}"
    rows = d.payloads(m).select("source_file", "row_number", "start_year", "payload")
    for sent in (rows, rows.where("start_year >= 1999")):
        sent.write.mode("append").parquet(f"{path}/in")
        stream = m.sparkSession.readStream.schema(rows.schema).parquet(f"{path}/in")
        land_stream(stream, f"{path}/out", f"{path}/state").awaitTermination()
    return landed_rows(m.sparkSession, f"{path}/out").select("source_file", "row_number", F.col("batch").alias("sent_again"))


@query("d1_team_resolution", "tm AS (SELECT DISTINCT 'C' || competition_id AS competition, unnest([home_team_id, away_team_id]) AS id FROM contests) SELECT competition, 'Team ' || id AS source, CASE WHEN id % 3 < 2 THEN id END AS team_id, CASE WHEN id % 3 = 0 THEN 'canonical' WHEN id % 3 = 1 THEN 'source' ELSE 'new' END AS how FROM tm")
def d1(m):
    """Clubs of which a third are known by their name, a third by an older source name, and a third not at all."""
    clubs = d.clubs(m).select(F.concat(F.lit("C"), F.col("competition_id").cast("string")).alias("competition"), "team_id", F.col("name").alias("source"))
    known = clubs.where("team_id % 3 < 2").select("competition", "team_id", F.when(F.col("team_id") % 3 == 0, F.col("source")).otherwise(F.concat(F.lit("Old "), F.col("source"))).alias("canonical"), "source")
    return curation.resolve_teams(known, clubs.select("competition", "source", F.col("source").alias("canonical"))).drop("canonical")


@query("n7_division", RAW + " SELECT rid, competition FROM vl WHERE competition = 'C1'")
def n7(m):
    return curation.of_competition(curated(m), "C1").select("rid", "competition")


@query("n20_prediction_texts", d.PREDICTED + " SELECT match_id, model_run_id, CASE algorithm WHEN 'logistic_regression' THEN 'Logistic Regression' ELSE 'Poisson Dixon Coles' END AS label, printf('Home %.0f%% / Draw %.0f%% / Away %.0f%%', round(p_home * 100, 9), round(p_draw * 100, 9), round(p_away * 100, 9)) AS shown FROM pd")
def n20(m):
    p = d.predictions(m)
    steady = lambda c: F.round(F.col(c), 11)  # noqa: E731  sums differ in their last digits by the order of rows
    return p.select("match_id", "model_run_id", scalars.title_of(F.col("algorithm"), {}).alias("label"), scalars.prediction_text(steady("p_away"), steady("p_draw"), steady("p_home")).alias("shown"))


@query("s4_violations", """cp AS (SELECT * FROM contests), rw AS (SELECT match_id * 2 AS rid, match_id % 101 = 0 AS blank, CASE WHEN match_id % 101 <> 0 THEN match_id % 6 END AS k, is_played, match_id FROM cp)
SELECT rule, count(*) AS rows FROM (SELECT CASE k WHEN 0 THEN 'date' WHEN 1 THEN 'kickoff' WHEN 2 THEN 'team' WHEN 3 THEN 'same teams' WHEN 4 THEN 'goals' ELSE CASE WHEN is_played THEN 'one score' END END AS rule FROM rw WHERE NOT blank UNION ALL SELECT 'result without goals' FROM rw WHERE NOT blank AND k IN (4, 5) AND is_played UNION ALL SELECT 'one score' FROM rw WHERE NOT blank AND k = 4 UNION ALL SELECT 'result' FROM rw WHERE NOT blank AND is_played AND k < 4 AND match_id % 97 = 0) WHERE rule IS NOT NULL GROUP BY 1""")
def s4(m):
    """Each row breaks a rule by its id: dates, kickoffs, names, equal names, goals, scores of one side; some results are wrong."""
    raw = raw_rows(m).where("rid % 2 = 0")
    k = F.when(F.col("Div") != "", F.floor(F.col("rid") / 2) % 6)
    change = {"Date": (0, "31/02/2020"), "Time": (1, "25:00"), "HomeTeam": (2, " "), "FTHG": (4, "x")}
    spoiled = raw.withColumns({c: F.when(k == i, F.lit(v)).otherwise(F.col(c)) for c, (i, v) in change.items()})
    spoiled = spoiled.withColumns({"AwayTeam": F.when(k == 3, F.col("HomeTeam")).otherwise(F.col("AwayTeam")), "FTAG": F.when((k == 4) | (k == 5), "").otherwise(F.col("FTAG"))})
    bad = curation.transform(curation.without_blank_rows(spoiled)).select(F.explode("violations").alias("rule"))
    return bad.groupBy("rule").agg(F.count("*").alias("rows"))


@query("n25_season_boundaries", """dy AS (SELECT DISTINCT match_date AS day, start_year AS live FROM contests WHERE start_year >= 1998)
SELECT day::VARCHAR AS day, live, live - 1 AS holdout, (live - 2) || '-07-31' AS train_end, (live - 1) || '-07-31' AS valid_end, live || '-07-31' AS test_end, array_to_string(range(greatest(live - 4, 1996), live - 1), ' ') AS fold_seasons FROM dy""")
def n25(m):
    """For every day of the contests as today: three folds at most, history from 1994 on."""
    days = m.where("start_year >= 1998").select(F.col("match_date").alias("day")).distinct()
    return landing.season_boundaries(days, "day", folds=3, first=1994).withColumn("fold_seasons", F.array_join(F.col("fold_seasons").cast("array<string>"), " "))


@query("d1_contested_renames", """tm AS (SELECT DISTINCT 'C' || competition_id AS competition, unnest([home_team_id, away_team_id]) AS id FROM contests),
kn AS (SELECT competition, id AS team_id, CASE WHEN id % 4 = 1 THEN 'Old Team ' || id ELSE 'Team ' || id END AS canonical, 'Source ' || id AS source FROM tm WHERE id % 4 < 3),
ic AS (SELECT competition, 'Source ' || id AS source, 'Team ' || id AS canonical FROM tm UNION ALL SELECT competition, 'Source ' || id, 'Team ' || (id + 1) FROM tm WHERE id % 4 = 0 UNION ALL SELECT competition, 'Other ' || id, 'Team ' || id FROM tm WHERE id % 12 = 1),
rs AS (SELECT i.*, n.team_id AS by_name, s.team_id AS by_source, s.canonical AS old FROM ic i LEFT JOIN kn n USING (competition, canonical) LEFT JOIN kn s ON s.competition = i.competition AND s.source = i.source),
cl AS (SELECT *, CASE WHEN by_name IS NULL AND by_source IS NOT NULL THEN row_number() OVER (PARTITION BY competition, canonical, by_name IS NULL AND by_source IS NOT NULL ORDER BY by_source, source) END AS claim,
  row_number() OVER (PARTITION BY competition, by_source, by_name IS NULL AND by_source IS NOT NULL ORDER BY canonical) AS own FROM rs)
SELECT competition, source, canonical, coalesce(by_name, by_source) AS team_id, CASE WHEN by_name IS NOT NULL THEN 'canonical' WHEN by_source IS NULL THEN 'new' WHEN claim = 1 AND own = 1 THEN 'renamed' ELSE 'contested' END AS how FROM cl""")
def d1_contested(m):
    """Names that are known, renamed by their source, claimed by two clubs at once, or new."""
    ids = d.clubs(m).select(F.concat(F.lit("C"), F.col("competition_id").cast("string")).alias("competition"), F.col("team_id").alias("id"))
    named = lambda word, k=0: F.concat(F.lit(f"{word} "), (F.col("id") + k).cast("string"))
    known = ids.where("id % 4 < 3").select("competition", F.col("id").alias("team_id"), F.when(F.col("id") % 4 == 1, named("Old Team")).otherwise(named("Team")).alias("canonical"), named("Source").alias("source"))
    row = lambda where, source, canonical: ids.where(where).select("competition", source.alias("source"), canonical.alias("canonical"))
    incoming = row("true", named("Source"), named("Team")).unionByName(row("id % 4 = 0", named("Source"), named("Team", 1))).unionByName(row("id % 12 = 1", named("Other"), named("Team")))
    return curation.resolve_teams(known, incoming, renames=True)
