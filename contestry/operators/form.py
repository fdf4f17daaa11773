"""Leakage-safe features of a contest: what was known before it began."""

from __future__ import annotations

from collections.abc import Iterator

import pandas as pd
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import Window as W

from contestry.sources.store import large

LAST = 5
ELO_START, ELO_K, ELO_HOME = 1500.0, 20.0, 100.0
FEATURE_VERSION = "v1"
MEASURES = {"win_rate_l5": "win", "draw_rate_l5": "draw", "goals_scored_avg_l5": "goals_for", "goals_conceded_avg_l5": "goals_against", "goals_total_avg_l5": "goals_total"}


def long_form(matches: DataFrame, *more: str) -> DataFrame:
    """Two rows a contest, one for each side, from a single scan; more: columns to carry."""
    def side(mine: str, other: str, is_home: bool) -> Column:
        return F.struct(
            F.col(f"{mine}_team_id").alias("team_id"),
            F.col(f"{other}_team_id").alias("opponent_id"),
            F.lit(is_home).alias("is_home"),
            F.col(f"{mine}_goals").cast("long").alias("goals_for"),
            F.col(f"{other}_goals").cast("long").alias("goals_against"),
        )

    keys = list(dict.fromkeys(["match_id", "competition_id", "match_date", "kickoff_time", "is_played", "start_year", *more]))
    sides = matches.select(*keys, F.explode(F.array(side("home", "away", True), side("away", "home", False))).alias("s")).select(*keys, "s.*")
    diff = F.col("goals_for") - F.col("goals_against")
    return sides.withColumns({
        "goal_diff": diff,
        "goals_total": F.col("goals_for") + F.col("goals_against"),
        "win": (diff > 0).cast("double"),
        "draw": (diff == 0).cast("double"),
        "points": F.when(diff > 0, 3).when(diff == 0, 1).when(diff < 0, 0).cast("long"),
    })


def trailing_form(played: DataFrame) -> DataFrame:
    """Each side's last five played contests before this one, overall and at the same venue."""
    grain = long_form(played)
    order = ("match_date", "kickoff_time", "match_id")
    overall = W.partitionBy("competition_id", "team_id").orderBy(*order).rowsBetween(-LAST, -1)
    venue = W.partitionBy("competition_id", "team_id", "is_home").orderBy(*order).rowsBetween(-LAST, -1)
    return grain.select(
        "match_id",
        "is_home",
        *[F.avg(c).over(overall).alias(name) for name, c in MEASURES.items()],
        F.sum("points").over(overall).alias("points_l5"),
        F.sum("goal_diff").over(overall).alias("gd_l5"),
        F.count("*").over(overall).alias("prior_n"),
        F.avg("win").over(venue).alias("venue_win_rate_l5"),
        F.avg("draw").over(venue).alias("venue_draw_rate_l5"),
    )


def asof_form(matches: DataFrame) -> DataFrame:
    """Form of the sides of unplayed contests from played ones that lie earlier by (date, id).

    A team's played contests are numbered; a target looks up the five numbers before its own by an equi
    join, instead of a range join with all its history.
    """
    grain = long_form(matches)
    w_all = W.partitionBy("competition_id", "team_id").orderBy("match_date", "match_id").rowsBetween(W.unboundedPreceding, -1)
    w_venue = W.partitionBy("competition_id", "team_id", "is_home").orderBy("match_date", "match_id").rowsBetween(W.unboundedPreceding, -1)
    numbered = grain.withColumns({
        "n_before": F.count_if("is_played").over(w_all),
        "n_before_venue": F.count_if("is_played").over(w_venue),
    })
    history_rows = numbered.where("is_played")
    targets = numbered.where("not is_played")

    def summary(count: str, keys: list[str], measures: list[Column]) -> DataFrame:
        wanted = targets.select("match_id", "is_home", "team_id", "competition_id", F.explode(F.sequence(F.greatest(F.col(count) - LAST, F.lit(0)), F.col(count) - 1)).alias("k")).where("k >= 0 and k is not null")
        past = history_rows.select("team_id", "competition_id", *([F.col("is_home").alias("at_home")] if keys else []), F.col(count).alias("k"), *MEASURES.values(), "points", "goal_diff")
        on = ["team_id", "competition_id", "k"]
        joined = wanted.join(large(past), on) if not keys else wanted.withColumn("at_home", F.col("is_home")).join(large(past), [*on, "at_home"])
        return joined.groupBy("match_id", "is_home").agg(*measures)

    overall = summary("n_before", [], [*[F.avg(c).alias(n) for n, c in MEASURES.items()], F.sum("points").alias("points_l5"), F.sum("goal_diff").alias("gd_l5"), F.count("*").alias("prior_n")])
    venue = summary("n_before_venue", ["is_home"], [F.avg("win").alias("venue_win_rate_l5"), F.avg("draw").alias("venue_draw_rate_l5")])
    both = targets.select("match_id", "is_home").join(large(overall), ["match_id", "is_home"], "left").join(large(venue), ["match_id", "is_home"], "left")
    return both.fillna({"prior_n": 0})


FORM = [*MEASURES, "points_l5", "gd_l5", "prior_n"]


def sides_in_columns(form: DataFrame, *keys: str, more: dict[str, str] | None = None) -> DataFrame:
    """One row a contest (or of other keys) with home_ and away_ columns; more: further columns and their names."""
    def of(is_home: bool, side: str) -> list[Column]:
        names = {**{c: f"{side}_{c}" for c in FORM}, **{c: f"{side}_{n}" for c, n in (more or {}).items()}, "venue_win_rate_l5": f"{side}_{side}_win_rate_l5", "venue_draw_rate_l5": f"{side}_{side}_draw_rate_l5"}
        return [F.max(F.when(F.col("is_home") == is_home, F.col(c))).alias(n) for c, n in names.items()]

    return form.groupBy(*(keys or ("match_id",))).agg(*of(True, "home"), *of(False, "away"))


def head_to_head(matches: DataFrame) -> DataFrame:
    """Shares of earlier meetings (by date, id) that the home side won and that were drawn; null without one.

    A running count for each unordered pair takes the place of a self-join.
    """
    low, high = F.least("home_team_id", "away_team_id"), F.greatest("home_team_id", "away_team_id")
    won_by_low = F.when(F.col("home_team_id") == F.col("low"), F.col("result") == "H").otherwise(F.col("result") == "A")
    w = W.partitionBy("competition_id", "low", "high").orderBy("match_date", "match_id").rowsBetween(W.unboundedPreceding, -1)
    counted = matches.withColumns({"low": low, "high": high}).withColumn("low_won", won_by_low)
    counted = counted.select(
        "match_id", (F.col("home_team_id") == F.col("low")).alias("home_is_low"),
        F.count_if("is_played").over(w).alias("n"),
        F.count_if(F.col("is_played") & F.col("low_won")).over(w).alias("low_wins"),
        F.count_if(F.col("is_played") & (F.col("result") == "D")).over(w).alias("draws"),
    )
    home_wins = F.when(F.col("home_is_low"), F.col("low_wins")).otherwise(F.col("n") - F.col("draws") - F.col("low_wins"))
    share = lambda k: F.when(F.col("n") > 0, k / F.col("n"))
    return counted.select("match_id", share(home_wins).alias("h2h_home_win_rate_n"), share(F.col("draws")).alias("h2h_draw_rate_n"))


def rate(rows: Iterator[tuple], ratings: dict[int, float]) -> Iterator[tuple[float, float]]:
    """Ratings before each contest (home, away, goals for either or None), in order; ratings is updated."""
    for home, away, home_goals, away_goals in rows:
        h, a = ratings.get(home, ELO_START), ratings.get(away, ELO_START)
        yield h, a
        if home_goals is None or away_goals is None:
            continue
        expected = 1.0 / (1.0 + 10.0 ** ((a - h - ELO_HOME) / 400.0))
        actual = 1.0 if home_goals > away_goals else 0.0 if home_goals < away_goals else 0.5
        ratings[home], ratings[away] = h + ELO_K * (actual - expected), a - ELO_K * (actual - expected)


def elo(matches: DataFrame) -> DataFrame:
    """Ratings before each contest.

    Contests of a competition depend on each other in turn: they come to one task in order, sorted by Spark, and
    are rated batch by batch as they stream through it. The task holds a batch and its competitions' ratings, never
    a competition's history; competitions run in parallel.
    """
    order = ["competition_id", "match_date", "kickoff_time", "match_id"]

    def run(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        last, ratings = None, {}
        for pdf in batches:
            found = []
            for competition, own in pdf.groupby("competition_id", sort=False, dropna=False):
                if last is None or competition != last:
                    last, ratings = competition, {}
                goals = [(None, None) if not p else (h, a) for p, h, a in zip(own["is_played"], own["home_goals"], own["away_goals"])]
                found += rate(((h, a, *g) for h, a, g in zip(own["home_team_id"], own["away_team_id"], goals)), ratings)
            yield pd.DataFrame({"match_id": pdf["match_id"].to_numpy(), "home_elo": [x for x, _ in found], "away_elo": [x for _, x in found]})

    light = matches.select("competition_id", "match_date", F.coalesce("kickoff_time", F.lit("")).alias("kickoff_time"), "match_id", "home_team_id", "away_team_id", "is_played", "home_goals", "away_goals")
    return light.repartition("competition_id").sortWithinPartitions(*order).mapInPandas(run, "match_id long, home_elo double, away_elo double")


def elo_after(rated: DataFrame) -> DataFrame:
    """rated (contests with home_elo and away_elo) with home_after and away_after: the ratings once the contest is over."""
    goals = F.col("home_goals") - F.col("away_goals")
    actual = F.when(goals > 0, 1.0).when(goals < 0, 0.0).otherwise(0.5)
    moved = F.lit(ELO_K) * (actual - 1.0 / (1.0 + F.pow(F.lit(10.0), (F.col("away_elo") - F.col("home_elo") - ELO_HOME) / 400.0)))
    moved = F.when(F.col("is_played") & goals.isNotNull(), moved).otherwise(0.0)
    return rated.withColumns({"home_after": F.col("home_elo") + moved, "away_after": F.col("away_elo") - moved})


def feature_table(matches: DataFrame) -> DataFrame:
    """The 25 features of every contest, played or not."""
    form = trailing_form(matches.where("is_played")).unionByName(asof_form(matches))
    out = sides_in_columns(form).join(large(head_to_head(matches)), "match_id", "left").join(large(elo(matches)), "match_id", "left")
    return differentials(out).withColumn("feature_version", F.lit(FEATURE_VERSION))


def differentials(df: DataFrame) -> DataFrame:
    c = F.col
    ppg = lambda s: c(f"{s}_points_l5") / F.greatest(c(f"{s}_prior_n"), F.lit(1))
    return df.withColumns({
        "elo_abs_diff": F.abs(c("home_elo") - c("away_elo")),
        "ppg_diff_l5": ppg("home") - ppg("away"),
        "gf_diff_l5": c("home_goals_scored_avg_l5") - c("away_goals_scored_avg_l5"),
        "ga_diff_l5": c("home_goals_conceded_avg_l5") - c("away_goals_conceded_avg_l5"),
        "recent_total_goals_avg_l5": (c("home_goals_total_avg_l5") + c("away_goals_total_avg_l5")) / 2.0,
    })


# At a checkpoint. What is known is looked up as of its day: a history gets the running figures of its keys once, and marks (a
# contest that remains, and the checkpoint's day) take the newest of them that isn't later. History isn't copied by checkpoint.


def remaining(played: DataFrame, cutoffs: DataFrame) -> DataFrame:
    """The contests of each season that lie behind each checkpoint's cutoff, with checkpoint and cutoff."""
    return played.join(F.broadcast(cutoffs), ["competition_id", "start_year"]).where("match_date > cutoff")


def as_of(marks: DataFrame, history: DataFrame, keys: list[str], day: str, found: str) -> DataFrame:
    """marks with found: the newest value of the history with the same keys up to the mark's day, or null.

    history: keys, match_date, kickoff_time, match_id and value (a struct). One window over both.
    """
    columns = marks.columns
    mark = marks.select(*keys, F.col(day).alias("day_"), F.lit(1).alias("mark_"), F.lit(None).cast("string").alias("kick_"), F.lit(None).cast("long").alias("id_"), F.struct(*columns).alias("row_"))
    past = history.select(*keys, F.col("match_date").alias("day_"), F.lit(0).alias("mark_"), F.col("kickoff_time").alias("kick_"), F.col("match_id").alias("id_"), "value")
    w = W.partitionBy(*keys).orderBy("day_", "mark_", "kick_", "id_").rowsBetween(W.unboundedPreceding, W.currentRow)
    both = past.unionByName(mark, allowMissingColumns=True).withColumn(found, F.last("value", ignorenulls=True).over(w))
    return both.where("mark_ = 1").select("row_.*", found)


def checkpoint_form(played: DataFrame, rest: DataFrame, rated: DataFrame | None = None) -> DataFrame:
    """match_id, checkpoint, is_home, form of the side (overall and at the venue) over its last five contests up to the cutoff, and elo where rated is given.

    played: contests with results; rest: of remaining; rated: of elo_after.
    """
    known = played if rated is None else played.join(large(rated.select("match_id", "home_after", "away_after")), "match_id")
    ratings = ["home_after", "away_after"] if rated is not None else []
    order = ("match_date", "kickoff_time", "match_id")
    grain = long_form(known, *ratings)
    last = W.partitionBy("competition_id", "team_id").orderBy(*order).rowsBetween(1 - LAST, 0)
    venue = W.partitionBy("competition_id", "team_id", "is_home").orderBy(*order).rowsBetween(1 - LAST, 0)
    rating = [F.when(F.col("is_home"), F.col("home_after")).otherwise(F.col("away_after")).alias("elo")] if ratings else []
    overall = [*[F.avg(c).over(last).alias(n) for n, c in MEASURES.items()], F.sum("points").over(last).alias("points_l5"), F.sum("goal_diff").over(last).alias("gd_l5"), F.count("*").over(last).alias("prior_n"), *rating]
    at_venue = [F.avg("win").over(venue).alias("venue_win_rate_l5"), F.avg("draw").over(venue).alias("venue_draw_rate_l5")]
    history = grain.select("competition_id", "team_id", "is_home", *order, F.struct(*overall).alias("overall"), F.struct(*at_venue).alias("at_venue"))
    sides = F.explode(F.array(F.struct(F.col("home_team_id").alias("team_id"), F.lit(True).alias("is_home")), F.struct(F.col("away_team_id").alias("team_id"), F.lit(False).alias("is_home"))))
    marks = rest.select("competition_id", "match_id", "checkpoint", "cutoff", sides.alias("s")).select("competition_id", "match_id", "checkpoint", "cutoff", "s.*")
    marks = as_of(marks, history.withColumnRenamed("overall", "value").drop("at_venue"), ["competition_id", "team_id"], "cutoff", "o")
    marks = as_of(marks, history.withColumnRenamed("at_venue", "value").drop("overall"), ["competition_id", "team_id", "is_home"], "cutoff", "v")
    return marks.select("match_id", "checkpoint", "is_home", "o.*", "v.*").fillna({"prior_n": 0})


def checkpoint_meetings(played: DataFrame, rest: DataFrame) -> DataFrame:
    """match_id, checkpoint and the head-to-head shares over all meetings up to the cutoff; null without one."""
    pair = {"low": F.least("home_team_id", "away_team_id"), "high": F.greatest("home_team_id", "away_team_id")}
    keys = ["competition_id", *pair]
    low_won = F.when(F.col("home_team_id") == F.col("low"), F.col("result") == "H").otherwise(F.col("result") == "A")
    w = W.partitionBy(*keys).orderBy("match_date", "kickoff_time", "match_id").rowsBetween(W.unboundedPreceding, W.currentRow)
    counts = F.struct(F.count("*").over(w).alias("n"), F.count_if("low_won").over(w).alias("low_wins"), F.count_if(F.col("result") == "D").over(w).alias("draws"))
    history = played.withColumns(pair).withColumn("low_won", low_won).select(*keys, "match_date", "kickoff_time", "match_id", counts.alias("value"))
    marks = rest.withColumns(pair).select(*keys, "match_id", "checkpoint", "cutoff", (F.col("home_team_id") == F.col("low")).alias("home_is_low"))
    met = as_of(marks, history, keys, "cutoff", "m")
    wins = F.when(F.col("home_is_low"), F.col("m.low_wins")).otherwise(F.col("m.n") - F.col("m.draws") - F.col("m.low_wins"))
    return met.select("match_id", "checkpoint", (wins / F.col("m.n")).alias("h2h_home_win_rate_n"), (F.col("m.draws") / F.col("m.n")).alias("h2h_draw_rate_n"))


def checkpoint_features(played: DataFrame, cutoffs: DataFrame) -> DataFrame:
    """match_id, checkpoint and all features of what remains at each checkpoint, as they stood then."""
    rest = remaining(played, cutoffs)
    sides = checkpoint_form(played, rest, elo_after(elo(played).join(large(played), "match_id")))
    out = sides_in_columns(sides.fillna({"elo": ELO_START}), "match_id", "checkpoint", more={"elo": "elo"})
    return differentials(out).join(large(checkpoint_meetings(played, rest)), ["match_id", "checkpoint"], "left")
