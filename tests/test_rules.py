"""Scalar rules, curation rules and gates on small tables."""

import datetime as dt
import hashlib
from collections import Counter

import numpy as np
import pytest
from pyspark.sql import functions as F

from contestry.functions import scalars as s
from contestry.operators import curation as c
from contestry.operators import evaluate as e
from contestry.operators import landing, reports
from contestry.operators import tables as t
from contestry.plans import forecasts
from contestry.plans.models import frozen
from contestry.sources import raw
from contestry.sources.contests import contests
from tests.test_fits import fit_logistic


def one(spark, expr, value, kind="string"):
    return spark.createDataFrame([(value,)], f"x {kind}").select(expr(F.col("x"))).first()[0]


@pytest.mark.parametrize(("text", "day"), [("05/08/2023", dt.date(2023, 8, 5)), ("05/08/23", dt.date(2023, 8, 5)), ("05/08/95", dt.date(1995, 8, 5)), ("2023-08-05", None), ("", None), (None, None)])
def test_dates(spark, text, day):
    assert one(spark, s.match_date, text) == day


@pytest.mark.parametrize(("text", "goals"), [("3", 3), (" 3 ", 3), ("3.0", None), ("-1", None), ("", None), ("x", None)])
def test_goals(spark, text, goals):
    assert one(spark, s.goal, text) == goals


@pytest.mark.parametrize(("n", "text"), [(1, "1st"), (2, "2nd"), (3, "3rd"), (11, "11th"), (21, "21st"), (112, "112th")])
def test_ordinals(spark, n, text):
    assert one(spark, s.ordinal, n, "int") == text


def test_team_aliases(spark):
    assert one(spark, lambda x: s.team_name(x, {"man utd": "Manchester United"}), "  Man   UTD ") == "Manchester United"
    assert one(spark, lambda x: s.team_name(x, {}), "  ") is None


def test_fixture_times(spark):
    assert str(one(spark, s.utc_kickoff, "2024-08-16T20:00:00+01:00")) == "2024-08-16 19:00:00"
    assert str(one(spark, s.utc_kickoff, "2024-08-16 19:00:00Z")) == "2024-08-16 19:00:00"
    assert one(spark, s.utc_kickoff, "soon") is None


def test_argmax_ties_go_to_away_then_draw(spark):
    rows = spark.createDataFrame([(0.4, 0.4, 0.2), (0.2, 0.4, 0.4), (0.2, 0.3, 0.5)], "a double, d double, h double")
    assert [r[0] for r in rows.select(s.argmax_class(F.col("a"), F.col("d"), F.col("h"))).collect()] == [0, 1, 2]


def rows_of(spark, *rows):
    return spark.createDataFrame([(i, "E0", *r) for i, r in enumerate(rows)], "rid long, Div string, Date string, Time string, HomeTeam string, AwayTeam string, FTHG string, FTAG string, FTR string")


def test_violations(spark):
    bad = rows_of(spark, ("05/08/2023", "15:00", "A", "B", "2", "", ""), ("x", "", "A", "A", "1", "0", "H"), ("05/08/2023", "", "A", "B", "1", "0", "A"), ("05/08/2023", "", "A", "B", "", "", "D"), ("05/08/2023", "15:00", "A", "B", "1", "0", "H"))
    found = {r.rid: set(r.violations) for r in c.transform(bad).collect()}
    assert found == {0: {"one score"}, 1: {"date", "same teams"}, 2: {"result"}, 3: {"result without goals"}, 4: set()}
    with pytest.raises(Exception, match="row 0"):
        c.valid_rows(c.transform(bad.where("rid = 0")), strict=True).collect()


def test_postponed_contest_keeps_its_row_and_final_date(spark):
    rows = rows_of(spark, ("05/08/2023", "15:00", "A", "B", "", "", ""), ("12/08/2023", "", "A", "B", "", "", ""), ("19/08/2023", "", "A", "B", "1", "0", "H"), ("26/08/2023", "", "A", "B", "1", "0", "H"))
    found = c.merge(c.transform(rows)).collect()
    assert len(found) == 1
    assert (str(found[0].match_date), found[0].kickoff_time, found[0].home_goals, found[0].match_id) == ("2023-08-19", "15:00:00", 1, 0)


def test_upsert_keeps_frozen_rows(spark):
    old = spark.createDataFrame([(1, "a", True), (2, "b", False)], "k int, v string, played boolean")
    new = spark.createDataFrame([(1, "x", True), (2, "y", False), (3, "z", False)], "k int, v string, played boolean")
    found = {r.k: (r.v, r.change) for r in c.upsert(old, new, ["k"], F.col("o.played")).collect()}
    assert found == {1: ("a", "kept"), 2: ("y", "updated"), 3: ("z", "inserted")}


def test_teams_resolve_by_name_then_source(spark):
    known = spark.createDataFrame([("E0", 1, "Alpha", "alpha fc"), ("E0", 2, "Beta", "beta fc")], "competition string, team_id int, canonical string, source string")
    new = spark.createDataFrame([("E0", "alpha", "Alpha"), ("E0", "beta fc", "Beta United"), ("E0", "gamma", "Gamma"), ("D1", "alpha", "Alpha")], "competition string, source string, canonical string")
    found = {(r.competition, r.canonical): (r.team_id, r.how) for r in c.resolve_teams(known, new).collect()}
    assert found == {("E0", "Alpha"): (1, "canonical"), ("E0", "Beta United"): (2, "source"), ("E0", "Gamma"): (None, "new"), ("D1", "Alpha"): (None, "new")}


def test_result_files(spark, tmp_path):
    (tmp_path / "E0.csv").write_text("﻿Div,Date,HomeTeam,AwayTeam,FTHG,FTAG,FTR\nE0,05/08/2023,A,B,1,,\n", encoding="utf-8")
    df = raw.read_results(spark, str(tmp_path / "E0.csv"))
    assert c.missing_columns(df) == [] and df.first().FTAG == "" and df.first().source_file.endswith("E0.csv")
    assert c.missing_columns(df.drop("FTR")) == ["FTR"]
    raw.write_json(df, str(tmp_path / "out"))
    assert spark.read.json(str(tmp_path / "out")).count() == 1


def test_files_of_other_columns_are_read_by_name(spark, tmp_path):
    (tmp_path / "a.csv").write_text("Div,Date,Time,HomeTeam,AwayTeam,FTHG,FTAG,FTR\nE0,05/08/2023,15:00,A,B,1,0,H\n")
    (tmp_path / "b.csv").write_text("\ufeffDiv,Date,HomeTeam,AwayTeam,FTHG,FTAG,FTR,HS\nE0,06/08/2019,C,D,2,2,D,7\n")
    rows = {r.HomeTeam: r for r in raw.read_results(spark, str(tmp_path)).collect()}
    assert (rows["A"].Time, rows["A"].FTR, rows["A"].HS) == ("15:00", "H", "") and (rows["C"].Time, rows["C"].AwayTeam, rows["C"].FTR, rows["C"].HS) == ("", "D", "D", "7")
    assert rows["C"].source_file.endswith("b.csv")


def test_sinks_write_headers_and_objects(spark, tmp_path):
    df = spark.createDataFrame([(1, "a")], "n int, t string")
    raw.write_csv(df, str(tmp_path / "c"))
    raw.write_json(df, str(tmp_path / "j"))
    assert spark.read.option("header", True).csv(str(tmp_path / "c")).collect()[0].asDict() == {"n": "1", "t": "a"} and spark.read.json(str(tmp_path / "j")).first().t == "a"


def test_competition_lists_and_years():
    assert landing.competition_codes("all") == landing.competition_codes(None) == ["E0", "SP1", "D1", "I1", "F1"]
    assert landing.competition_codes(" la-liga, d1") == ["SP1", "D1"]
    with pytest.raises(ValueError):
        landing.competition_codes("nowhere")
    assert [landing.year_parameter(x) for x in (None, " auto", "", 2019, "2020", 2021.0)] == [None, None, None, 2019, 2020, 2021]
    for bad in (True, "soon", 2020.5, "20 20", float("nan")):
        with pytest.raises(ValueError):
            landing.year_parameter(bad)


def test_holdout_is_never_validated(spark):
    days = spark.createDataFrame([(dt.date(2026, 7, 31),), (dt.date(2026, 8, 1),), (dt.date(2027, 1, 15),), (dt.date(2024, 2, 29),)], "day date")
    found = {r.day: r for r in landing.season_boundaries(days, "day").collect()}
    for r in found.values():
        assert r.holdout == r.live - 1 and max(r.fold_seasons) == r.holdout - 1 and r.train_end < r.valid_end < r.test_end and len(r.fold_seasons) <= 4
    r = found[dt.date(2024, 2, 29)]
    assert (r.live, r.train_end, r.test_end, r.fold_seasons) == (2023, dt.date(2021, 7, 31), dt.date(2023, 7, 31), [2020, 2021])
    with pytest.raises(Exception, match="no fold"):
        landing.season_boundaries(days.limit(1), "day", first=2024).collect()


def test_a_contested_name_goes_to_the_lowest_id(spark):
    known = spark.createDataFrame([("L", 1, "A", "a"), ("L", 2, "B", "b"), ("L", 3, "C", "c"), ("M", 1, "X", "a")], "competition string, team_id long, canonical string, source string")
    incoming = spark.createDataFrame([("L", "a", "New"), ("L", "b", "New"), ("L", "c", "B"), ("L", "z", "Z"), ("M", "a", "New"), ("M", "a", "Newer")], "competition string, source string, canonical string")
    found = c.resolve_teams(known, incoming, renames=True)
    assert {(r.competition, r.source, r.canonical): (r.team_id, r.how) for r in found.collect()} == {
        ("L", "a", "New"): (1, "renamed"), ("L", "b", "New"): (2, "contested"), ("L", "c", "B"): (2, "canonical"), ("L", "z", "Z"): (None, "new"),
        ("M", "a", "New"): (1, "renamed"), ("M", "a", "Newer"): (1, "contested"),
    }
    assert {(r.competition, r.team_id): r.canonical for r in c.renamed_teams(known, found).collect()} == {("L", 1): "New", ("L", 2): "B", ("L", 3): "C", ("M", 1): "New"}


def test_catalog_sizes_follow_the_year(spark):
    seasons = spark.createDataFrame([("F1", y) for y in (2017, 2018, 2019, 2021, 2023)] + [("E0", 2019), ("XX", 2019)], "code string, start_year int")
    found = {(r.code, r.start_year): (r.clubs, r.contests) for r in landing.season_sizes(seasons).collect()}
    assert found[("F1", 2019)] == (20, 279) and found[("F1", 2021)] == (20, 380) and found[("F1", 2023)] == (18, 306) and found[("E0", 2019)] == (20, 380) and found[("XX", 2019)] == (None, None)


def test_years_of_a_scan_are_checked(spark):
    with pytest.raises(ValueError):
        landing.of_years(spark.range(1), 2001, 2000)


def test_logistic_regression_is_at_its_optimum():
    r = np.random.default_rng(1)
    x, y, weight = r.normal(size=(200, 4)), r.integers(0, 3, 200), r.uniform(0.5, 2, 200)
    w = fit_logistic(x, y, weight)

    def loss(w):
        z = np.column_stack([x, np.ones(200)]) @ w
        return float((weight * (np.log(np.exp(z).sum(1)) - z[np.arange(200), y])).sum() + (w[:-1] ** 2).sum() / 2)

    for _ in range(100):
        assert loss(w) <= loss(w + r.normal(0, 0.01, w.shape)) + 1e-6


def test_sums_of_zero_fail_where_strict(spark):
    rows = spark.createDataFrame([(0.0, 0.0, 0.0)], "p_away double, p_draw double, p_home double")
    assert abs(e.normalised(rows).first().p_draw - 1 / 3) < 1e-9
    with pytest.raises(Exception, match="sum to 0"):
        e.normalised(rows, strict=True).collect()


def test_statistics_need_numbers_on_both_sides(spark):
    fields = [("shots", "HS", "AS", "higher"), ("fouls", "HF", "AF", "lower"), ("corners", "HC", "AC", "higher")]
    rows = spark.createDataFrame([('{"HS": "12", "AS": "9.0", "HF": "3", "AF": "n/a", "HC": "4", "AC": "4"}',), (None,)], "p string")
    found = [[tuple(x) for x in r[0]] for r in rows.select(reports.statistics(F.col("p"), fields)).collect()]
    assert found == [[("shots", 12, 9, "home"), ("corners", 4, 4, None)], []]


def test_fixture_files_have_no_scores(spark, tmp_path):
    (tmp_path / "f.json").write_text('[{"DateUtc": "2024-08-16 19:00:00Z", "HomeTeam": "A", "AwayTeam": "B", "HomeTeamScore": 3}]')
    row = raw.read_fixtures(spark, str(tmp_path / "f.json"), "E0").first()
    assert (row.Date, row.Time, row.FTHG) == ("16/08/2024", "19:00", "")


def test_pages_are_clamped(spark):
    df = spark.range(45).withColumnRenamed("id", "k")
    assert [r.k for r in t.page(df, [F.col("k")], 99, 5).orderBy("k").collect()] == list(range(40, 45))


def test_uniform_log_loss_is_log_three(spark):
    rows = e.uniform(spark.createDataFrame([(0,), (1,), (2,)], "result_code int"))
    found = e.metrics(rows.withColumn("g", F.lit(1)), ["g"]).first()
    assert abs(found.log_loss - 1.0986122886681098) < 1e-12 and found.c00 == 1


def test_small_bins_merge(spark):
    p = [0.05 * i / 10 + 0.21 for i in range(60)]
    df = spark.createDataFrame([(1, x, i % 4 == 0) for i, x in enumerate(p)], "g int, p double, hit boolean")
    found = e.reliability_table(df, ["g"], "p", F.col("hit")).orderBy("lo").collect()
    assert sum(r.n for r in found) == 60 and all(r.n >= 30 for r in found)




def test_recommendations(spark):
    rows = spark.createDataFrame([("lr", "lr", 0.0, 0.0), ("lr", "xgb", 0.006, 0.006), ("lr", "poisson", 0.006, 0.006), ("lr", "xgb", 0.006, None)], "p string, w string, a double, b double")
    found = [r[0].split()[0] for r in rows.select(e.recommendation(F.col("p"), F.col("w"), F.col("a"), F.col("b"), ["poisson"])).collect()]
    assert found == ["KEEP", "SWITCH", "INSUFFICIENT", "INSUFFICIENT"]


def test_gate_fails_with_the_checks_names(spark):
    found = spark.createDataFrame([("sum", 2), ("class", 0)], "check string, rows long")
    with pytest.raises(ValueError, match=r"predictions: sum \(2\)"):
        c.fail_on(found, "predictions")


def test_live_outlook_equals_brute_force_of_20_000_seasons(spark):
    m = contests(spark, "/root/testdata/sf0.001")
    table = t.league_table(m.where("start_year = 2000")).select("competition_id", "team_id", "points", "gd", "gf").collect()
    rest = frozen(m).where("not is_played").collect()
    firsts, sims = Counter(), 20_000
    for sim in range(1, sims + 1):
        final = {(r.competition_id, r.team_id): r.points for r in table}
        for r in rest:
            u = (int(hashlib.md5(f"202627|{sim}|{r.match_id}".encode()).hexdigest()[:13], 16) + 0.5) / 2**52
            every = r.p_away + r.p_draw + r.p_home
            home, away = (0, 3) if u < r.p_away / every else (1, 1) if u < (r.p_away + r.p_draw) / every else (3, 0)
            for team, won in ((r.home_team_id, home), (r.away_team_id, away)):
                if (r.competition_id, team) in final:
                    final[r.competition_id, team] += won
        best = {}
        for r in table:
            key = (-final[r.competition_id, r.team_id], -r.gd, -r.gf, r.team_id)
            best[r.competition_id] = min(best.get(r.competition_id, key), key)
        firsts.update((c, key[3]) for c, key in best.items())
    found = forecasts.QUERIES["m20_live_outlook"](spark, "/root/testdata/sf0.001").collect()
    assert rest and len(found) == len(table)
    for r in found:
        assert abs(r.title_prob - firsts[r.competition_id, r.team_id] / sims) < 2e-6


def test_backtest_takes_the_checkpoints_of_the_reference(spark, monkeypatch):
    monkeypatch.setattr(forecasts, "SIMS", 20)
    found = forecasts.QUERIES["a20_by_checkpoint"](spark, "/root/testdata/sf0.001").collect()
    assert {r.checkpoint: r.n for r in found} == {5: 10, 10: 3, 15: 1}
