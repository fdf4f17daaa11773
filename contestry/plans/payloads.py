"""Registered queries: report payloads over stored predictions and raw payloads."""

from __future__ import annotations

from pyspark.sql import functions as F

from contestry.operators import reports as r
from contestry.operators import tables as t
from contestry.operators.evaluate import scorecard
from contestry.plans.features import rounded
from contestry.plans.reports import TABLE
from contestry.sources import derived as d
from contestry.sources.contests import stored_contests, with_contests

QUERIES: dict = {}
ORACLE: dict = {}
LIVE = 2000


def query(name: str, sql: str | None = None):
    def add(f):
        QUERIES[name] = lambda spark, sf_dir: rounded(f(stored_contests(spark, sf_dir)))
        if sql:
            ORACLE[name] = with_contests(sql)
        return f

    return add


def in_use(m):
    return r.production_runs(d.model_runs(m), m.select("competition_id").distinct().withColumn("reported", F.lit("poisson_dixon_coles")))


def named(m):
    return r.with_names(m, d.clubs(m))


def upcoming_rows(m):
    return r.fixture_rows(named(m.where("not is_played")), r.run_predictions(d.predictions(m), in_use(m)), False)


def settled_rows(m):
    """Played contests of the live season that have a prediction by the algorithm in use."""
    live = m.where(f"is_played and start_year = {LIVE}")
    return r.fixture_rows(named(live), r.latest_predictions(d.predictions(m), in_use(m)), True).where("has_prediction")


PRODUCTION = d.PREDICTED + """,
pm AS (SELECT * FROM mr WHERE artifact IS NOT NULL QUALIFY row_number() OVER (PARTITION BY competition_id ORDER BY (algorithm = 'poisson_dixon_coles') DESC, trained_at DESC, model_run_id DESC) = 1)"""
SHOWN = """match_id, c.competition_id, c.match_date::VARCHAR AS kickoff_date, left(kickoff_time, 5) AS kickoff_time, 'Team ' || home_team_id AS home_team, 'Team ' || away_team_id AS away_team, p.p_home IS NOT NULL AS has_prediction,
  round_even(p.p_home * 100, 0)::BIGINT AS p_home_pct, round_even(p.p_draw * 100, 0)::BIGINT AS p_draw_pct, round_even(p.p_away * 100, 0)::BIGINT AS p_away_pct, p.predicted_class,
  CASE p.predicted_class WHEN 2 THEN 'Team ' || home_team_id WHEN 0 THEN 'Team ' || away_team_id WHEN 1 THEN 'Draw' END AS predicted_outcome,
  CASE p.algorithm WHEN 'logistic_regression' THEN 'Logistic regression' WHEN 'poisson_dixon_coles' THEN 'Poisson / Dixon–Coles' END AS model_name, strftime(p.created_at, '%Y-%m-%dT%H:%M:%S') AS predicted_at,
  CASE WHEN p.predicted_class <> 1 AND p.p_draw >= 0.25 THEN 'Draw watch' WHEN list_reverse_sort([p.p_away, p.p_draw, p.p_home])[1] - list_reverse_sort([p.p_away, p.p_draw, p.p_home])[2] < 0.08 THEN 'Close match' END AS note"""
UP = f", up AS (SELECT {SHOWN} FROM contests c LEFT JOIN (SELECT pd.* FROM pd JOIN pm USING (competition_id, model_run_id)) p USING (match_id) WHERE NOT is_played)"
UPCOMING = PRODUCTION + UP
SETTLED = PRODUCTION + f""", lp AS (SELECT pd.* FROM pd JOIN pm ON pm.competition_id = pd.competition_id AND pm.algorithm = pd.algorithm QUALIFY row_number() OVER (PARTITION BY match_id ORDER BY created_at DESC, pd.run DESC) = 1),
st AS (SELECT {SHOWN}, home_goals, away_goals, result_code, CASE result_code WHEN 2 THEN 'Team ' || home_team_id WHEN 0 THEN 'Team ' || away_team_id ELSE 'Draw' END AS actual_outcome, CASE result_code WHEN 2 THEN 'Home win' WHEN 0 THEN 'Away win' ELSE 'Draw' END AS result_label, result_code = p.predicted_class AS correct
  FROM contests c JOIN lp p USING (match_id) WHERE is_played AND start_year = {LIVE})"""
PAGE = "(row_number() OVER (PARTITION BY competition_id ORDER BY {order}))::INT AS place, count(*) OVER (PARTITION BY competition_id) AS total"


@query("m24_upcoming", UPCOMING + f", pg AS (SELECT *, {PAGE.format(order='kickoff_date, kickoff_time NULLS LAST, match_id')} FROM up), pz AS (SELECT *, greatest(ceil(total / 16), 1)::INT AS pages FROM pg) SELECT *, least(2, pages)::INT AS page FROM pz WHERE ceil(place / 16) = least(2, pages)")
def m24_upcoming(m):
    """The second page of each competition's fixtures with the production run's predictions."""
    order = [F.col("kickoff_date"), F.col("kickoff_time").asc_nulls_last(), F.col("match_id")]
    return r.paged(upcoming_rows(m), ["competition_id"], order, 2, 16)


@query("m24_results", SETTLED + f", pg AS (SELECT *, {PAGE.format(order='kickoff_date DESC, kickoff_time DESC, match_id DESC')} FROM st), pz AS (SELECT *, greatest(ceil(total / 16), 1)::INT AS pages FROM pg) SELECT *, 1::INT AS page FROM pz WHERE ceil(place / 16) = 1")
def m24_results(m):
    order = [F.col("kickoff_date").desc(), F.coalesce("kickoff_time", F.lit("00:00")).desc(), F.col("match_id").desc()]
    return r.paged(settled_rows(m), ["competition_id"], order, 1, 16)


def _triples(m):
    latest = r.latest_predictions(d.predictions(m), in_use(m)).drop("competition_id")
    return m.where(f"is_played and start_year = {LIVE}").join(latest, "match_id")


RATES = """SELECT competition_id, v.by, c.class, count(*) FILTER (code = c.k) AS n, count(*) FILTER (code = c.k AND correct) AS correct, round(count(*) FILTER (code = c.k AND correct) / nullif(count(*) FILTER (code = c.k), 0), 6) AS rate
  FROM (SELECT competition_id, 'actual' AS by, result_code AS code, correct FROM st UNION ALL SELECT competition_id, 'predicted', predicted_class, correct FROM st) v, (VALUES (0, 'away'), (1, 'draw'), (2, 'home')) c(k, class) GROUP BY 1, 2, 3"""


@query("m24_performance", SETTLED + " " + RATES)
def m24_performance(m):
    return r.class_rates(_triples(m), ["competition_id"])


@query("m24_overview", SETTLED + UP + """, sl AS (SELECT st.*, lp.p_away, lp.p_draw, lp.p_home FROM st JOIN lp USING (match_id)),
sx AS (SELECT competition_id, count(*) AS n_settled, count(*) FILTER (correct) AS correct, round(avg(correct::INT), 6) AS accuracy, round(avg(-ln(CASE result_code WHEN 0 THEN greatest(p_away, 1e-15) WHEN 1 THEN greatest(p_draw, 1e-15) ELSE greatest(p_home, 1e-15) END / (greatest(p_away, 1e-15) + greatest(p_draw, 1e-15) + greatest(p_home, 1e-15)))), 6) AS log_loss FROM sl GROUP BY 1),
ux AS (SELECT competition_id, count(*) AS n_upcoming FROM up GROUP BY 1), ax AS (SELECT competition_id, strftime(max(created_at), '%Y-%m-%dT%H:%M:%S') AS predictions_updated_at FROM pd GROUP BY 1),
lx AS (SELECT competition_id, arg_max(match_id, (match_date, kickoff_time, match_id)) AS latest_completed FROM contests WHERE is_played GROUP BY 1),
tx AS (SELECT competition_id, count(DISTINCT t) AS n_teams FROM (SELECT competition_id, unnest([home_team_id, away_team_id]) AS t FROM contests) GROUP BY 1)
SELECT tx.competition_id, pm.model_run_id, pm.algorithm, strftime(pm.trained_at, '%Y-%m-%dT%H:%M:%S') AS trained_at, n_teams, coalesce(n_upcoming, 0) AS n_upcoming, coalesce(n_settled, 0) AS n_settled, coalesce(correct, 0) AS correct, accuracy, log_loss, predictions_updated_at, latest_completed
FROM tx LEFT JOIN pm USING (competition_id) LEFT JOIN sx USING (competition_id) LEFT JOIN ux USING (competition_id) LEFT JOIN ax USING (competition_id) LEFT JOIN lx USING (competition_id)""")
def m24_overview(m):
    """One row a competition: model in use, counts, live scorecard, latest contest, last update."""
    key = "competition_id"
    from contestry.functions.scalars import iso_stamp

    score = scorecard(_triples(m), [key]).select(key, F.col("n").alias("n_settled"), "correct", "accuracy", "log_loss")
    ahead = m.where("not is_played").groupBy(key).agg(F.count("*").alias("n_upcoming"))
    updated = d.predictions(m).groupBy(key).agg(iso_stamp(F.max("created_at")).alias("predictions_updated_at"))
    latest = m.where("is_played").groupBy(key).agg(F.max_by("match_id", F.struct("match_date", "kickoff_time", "match_id")).alias("latest_completed"))
    model = in_use(m).select(key, "model_run_id", "algorithm", iso_stamp(F.col("trained_at")).alias("trained_at"))
    out = d.clubs(m).groupBy(key).agg(F.count("*").alias("n_teams"))
    for part in (model, score, ahead, updated, latest):
        out = out.join(part, key, "left")
    return out.fillna(0, ["n_upcoming", "n_settled", "correct"])


STATS = d.PAYLOADS + """, rp AS (SELECT c.match_id, pl.hs, pl."as", pl.hf, pl.af FROM contests c JOIN pl ON pl.competition_id = c.competition_id AND pl.start_year = c.start_year AND pl.home = 'Team ' || c.home_team_id AND pl.away = 'Team ' || c.away_team_id AND fthg <> ''
  WHERE c.is_played QUALIFY row_number() OVER (PARTITION BY c.match_id ORDER BY (pl.source_file <> 'C' || c.competition_id || '_' || c.start_year || 'a'), pl.source_file, pl.row_number) = 1),
ms AS (SELECT match_id, 'shots' AS key, hs::INT AS home, "as"::INT AS away, CASE WHEN hs > "as" THEN 'home' WHEN hs < "as" THEN 'away' END AS leader FROM rp WHERE hs IS NOT NULL AND "as" IS NOT NULL
  UNION ALL SELECT match_id, 'fouls', hf::INT, af::INT, CASE WHEN hf < af THEN 'home' WHEN hf > af THEN 'away' END FROM rp WHERE hf IS NOT NULL AND af IS NOT NULL)"""


def _payload_of(m):
    own = F.concat(F.lit("C"), F.col("competition_id").cast("string"), F.lit("_"), F.col("start_year").cast("string"), F.lit("a"))
    return r.raw_payloads(named(m.where("is_played")), d.payloads(m), own)


@query("n19_match_statistics", STATS + " SELECT * FROM ms")
def n19(m):
    stats = F.inline(r.statistics(F.col("payload"), d.STATISTICS))
    return _payload_of(m).select("match_id", stats)


@query("j17_prediction_counts", d.PREDICTED + " SELECT match_id, (SELECT count(*) FROM pd WHERE pd.match_id = contests.match_id) AS n_predictions FROM contests")
def j17(m):
    counts = d.predictions(m).groupBy("match_id").agg(F.count("*").alias("n_predictions"))
    return m.select("match_id").join(counts, "match_id", "left").fillna(0)


@query("j18_predictions_of_runs", d.PREDICTED + " SELECT match_id, model_run_id, pd.algorithm, feature_version, predicted_class FROM pd JOIN mr USING (model_run_id) JOIN contests USING (match_id) WHERE is_played")
def j18(m):
    runs = d.model_runs(m).select("model_run_id", "feature_version")
    return d.predictions(m).join(runs, "model_run_id").join(m.where("is_played").select("match_id"), "match_id").select("match_id", "model_run_id", "algorithm", "feature_version", "predicted_class")


DETAIL = SETTLED + ", " + TABLE.strip() + "," + STATS.strip() + f""",
h5 AS (SELECT c.match_id, least(count(*), 5) AS h2h_count FROM contests c JOIN contests h ON h.is_played AND h.competition_id = c.competition_id AND least(h.home_team_id, h.away_team_id) = least(c.home_team_id, c.away_team_id) AND greatest(h.home_team_id, h.away_team_id) = greatest(c.home_team_id, c.away_team_id) AND h.match_date < c.match_date GROUP BY 1),
dt AS (SELECT {SHOWN}, is_played, start_year, home_team_id, away_team_id FROM contests c LEFT JOIN lp p USING (match_id) WHERE start_year = {LIVE} AND (is_played OR p.p_home IS NOT NULL))
SELECT dt.match_id, CASE WHEN is_played THEN 'Full-time' ELSE 'Upcoming' END AS status, dt.has_prediction, predicted_outcome, h.position AS home_position, a.position AS away_position, coalesce(h2h_count, 0) AS h2h_count, coalesce(n_stats, 0) AS n_stats
FROM dt LEFT JOIN lt h ON h.competition_id = dt.competition_id AND h.start_year = {LIVE} AND h.team_id = dt.home_team_id LEFT JOIN lt a ON a.competition_id = dt.competition_id AND a.start_year = {LIVE} AND a.team_id = dt.away_team_id
LEFT JOIN h5 USING (match_id) LEFT JOIN (SELECT match_id, count(*) AS n_stats FROM ms GROUP BY 1) USING (match_id)"""


@query("m24_match_detail", DETAIL)
def m24_match_detail(m):
    """Every contest of the live season: status, prediction, table places, earlier meetings, statistics."""
    live = named(m.where(f"start_year = {LIVE}"))
    shown = r.fixture_rows(live, r.latest_predictions(d.predictions(m), in_use(m)), False).select("match_id", "has_prediction", "predicted_outcome")
    placed = t.with_positions(live, t.league_table(m, "start_year"), "start_year").select("match_id", "is_played", "home_position", "away_position")
    met = t.meetings_before(m).select("match_id", F.least("met", F.lit(5)).alias("h2h_count"))
    stats = _payload_of(m).select("match_id", F.size(r.statistics(F.col("payload"), d.STATISTICS)).cast("long").alias("n_stats"))
    out = placed.join(shown, "match_id").where("is_played or has_prediction").join(met, "match_id", "left").join(stats, "match_id", "left").fillna(0, ["h2h_count", "n_stats"])
    return out.select("match_id", F.when(F.col("is_played"), "Full-time").otherwise("Upcoming").alias("status"), "has_prediction", "predicted_outcome", "home_position", "away_position", "h2h_count", "n_stats")
