"""Leakage, scope and order of the features."""

import datetime as dt

from pyspark.sql import functions as F

from contestry.operators import form
from contestry.sources.contests import with_result

SCHEMA = "match_id long, competition_id long, match_date date, kickoff_time string, home_team_id long, away_team_id long, is_played boolean, home_goals int, away_goals int, start_year int"


def make(spark, rows):
    out = [(i, c, dt.date(2000, 1, d), "15:00:00", h, a, g is not None, *(g or (None, None)), 1999) for i, c, d, h, a, g in rows]
    return with_result(spark.createDataFrame(out, SCHEMA))


def by_id(df):
    return {r.match_id: r for r in df.collect()}


ROWS = [(1, 0, 1, 10, 20, (2, 0)), (2, 0, 2, 20, 10, (1, 1)), (3, 0, 3, 10, 20, (0, 3)), (4, 0, 4, 10, 20, None), (5, 1, 2, 10, 20, (5, 0))]


def test_later_results_do_not_change_earlier_features(spark):
    changed = [r if r[0] != 3 else (*r[:5], (9, 0)) for r in ROWS]
    a, b = (by_id(form.feature_table(make(spark, rows))) for rows in (ROWS, changed))
    for i in (1, 2, 3):
        assert a[i] == b[i]
    assert a[4] != b[4]


def test_first_contest_has_no_history(spark):
    first = by_id(form.feature_table(make(spark, ROWS)))[1]
    assert first.home_prior_n == 0 and first.home_win_rate_l5 is None and first.h2h_draw_rate_n is None
    assert first.home_elo == form.ELO_START


def test_competitions_do_not_mix(spark):
    other = by_id(form.feature_table(make(spark, ROWS)))[5]
    assert other.home_prior_n == 0 and other.home_elo == form.ELO_START


def test_upcoming_uses_played_history_only(spark):
    target = by_id(form.feature_table(make(spark, ROWS)))[4]
    assert target.home_prior_n == 3 and target.home_points_l5 == 4 and target.h2h_home_win_rate_n == 1 / 3


def test_elo_moves_after_the_contest(spark):
    found = by_id(form.elo(make(spark, ROWS)))
    assert found[2].away_elo > form.ELO_START > found[2].home_elo


def many(n=160, seed=9):
    import random

    r, rows = random.Random(seed), []
    for i in range(n):
        league = r.choice([1, 1, 2])
        home, away = r.sample(range(league * 10, league * 10 + 5), 2)
        rows.append((i, league, f"2020-{1 + i // 16:02d}-{1 + r.randrange(28):02d}", r.choice(["12:00:00", "15:00:00"]), home, away, r.randrange(4), r.randrange(4)))
    return rows


def test_elo_holds_no_competition_at_once(spark):
    rows = [(*x, True) for x in many()]
    m = with_result(spark.createDataFrame(rows, "match_id long, competition_id long, match_date string, kickoff_time string, home_team_id long, away_team_id long, home_goals int, away_goals int, is_played boolean").withColumn("match_date", F.to_date("match_date")))
    wanted = by_id(form.elo(m))
    before = spark.conf.get("spark.sql.execution.arrow.maxRecordsPerBatch")
    try:
        for size in (1, 7):  # batches smaller than a season
            spark.conf.set("spark.sql.execution.arrow.maxRecordsPerBatch", size)
            assert by_id(form.elo(m.repartition(5))) == wanted
    finally:
        spark.conf.set("spark.sql.execution.arrow.maxRecordsPerBatch", before)
    ratings = {}
    for i, league, day, kick, home, away, hg, ag in sorted(many(), key=lambda x: (x[2], x[3], x[0])):
        assert (wanted[i].home_elo, wanted[i].away_elo) == next(form.rate([(home, away, None, None)], ratings))
        list(form.rate([(home, away, hg, ag)], ratings))


def test_features_at_a_checkpoint_are_those_of_a_history_that_ends_there(spark):
    schema = "match_id long, competition_id long, match_date string, kickoff_time string, home_team_id long, away_team_id long, home_goals int, away_goals int, is_played boolean, start_year int"
    m = with_result(spark.createDataFrame([(*x, True, 2019 if x[2] < "2020-05" else 2020) for x in many()], schema).withColumns({"match_date": F.to_date("match_date"), "kickoff_time": F.lit("12:00:00")}))
    cutoffs = spark.createDataFrame([(1, 2020, 5, "2020-07-15"), (1, 2020, 10, "2020-09-01"), (2, 2020, 5, "2020-06-20")], "competition_id long, start_year int, checkpoint int, cutoff string").withColumn("cutoff", F.to_date("cutoff"))
    found = form.checkpoint_features(m, cutoffs).collect()
    assert len(found) > 60
    for league, _, checkpoint, day in [tuple(r) for r in cutoffs.collect()]:
        known = F.col("match_date") <= F.lit(day)
        cut = m.where(F.col("competition_id") == league).withColumns({c: F.when(known, F.col(c)) for c in ("home_goals", "away_goals", "result", "result_code")}).withColumn("is_played", known)
        rest = {r.match_id for r in m.where((F.col("competition_id") == league) & (F.col("start_year") == 2020) & ~known).collect()}
        # each contest that remains moved to the day after the cutoff: then as-of form is form at the cutoff
        alone = by_id(form.feature_table(cut.withColumn("match_date", F.when(known, F.col("match_date")).otherwise(F.date_add(F.lit(day), 1)))))
        for r in (x for x in found if x.checkpoint == checkpoint and x.match_id in rest):
            wanted = alone[r.match_id].asDict()
            for c in ("home_elo", "away_elo", "h2h_home_win_rate_n", "h2h_draw_rate_n", "home_prior_n", "away_points_l5", "away_gd_l5"):
                a, b = r[c], wanted[c]
                assert (a is None and b is None) or abs(a - b) < 1e-9, c
