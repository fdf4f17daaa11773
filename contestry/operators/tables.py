"""League tables, summaries and report queries over contests."""

from __future__ import annotations

from functools import reduce

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import Window as W

from contestry.operators.form import long_form

CLASSES = {0: "away", 1: "draw", 2: "home"}


def league_table(matches: DataFrame, *season: str) -> DataFrame:
    """Points, goals and rank of every team of a competition (and season); teams yet to play have zeros."""
    keys = ["competition_id", *season]
    sides = long_form(matches, *season)
    summed = lambda c: F.coalesce(F.sum(F.when(F.col("is_played"), F.col(c))), F.lit(0)).cast("long")
    table = sides.groupBy(*keys, "team_id").agg(
        F.count_if("is_played").alias("played"), summed("points").alias("points"), summed("goals_for").alias("gf"), summed("goals_against").alias("ga")
    )
    table = table.withColumn("gd", F.col("gf") - F.col("ga"))
    return table.withColumn("position", F.row_number().over(ranking(keys)))


def ranking(keys: list[str], points: str = "points"):
    return W.partitionBy(*keys).orderBy(F.col(points).desc(), F.col("gd").desc(), F.col("gf").desc(), "team_id")


def with_positions(matches: DataFrame, table: DataFrame, *season: str) -> DataFrame:
    """Both sides' places in the table, null where a team is in none."""
    keys = ["competition_id", *season]
    for side in ("home", "away"):
        place = table.select(*keys, F.col("team_id").alias(f"{side}_team_id"), F.col("position").alias(f"{side}_position"))
        matches = matches.join(place, [*keys, f"{side}_team_id"], "left")
    return matches


def season_summary(matches: DataFrame) -> DataFrame:
    """Contests, played and unplayed, and results of each season of a competition."""
    count = lambda c, name: F.count_if(c).alias(name)
    return matches.groupBy("competition_id", "start_year").agg(
        F.count("*").alias("matches"), count(F.col("is_played"), "played"), count(~F.col("is_played"), "unplayed"),
        *[count(F.col("result_code") == code, name) for code, name in CLASSES.items()],
    )


def club_counts(matches: DataFrame) -> DataFrame:
    """Distinct clubs of a season, home or away: an explode takes the place of an OR join."""
    return long_form(matches).groupBy("competition_id", "start_year").agg(F.count_distinct("team_id").alias("clubs"))


def repeated_pairings(matches: DataFrame) -> DataFrame:
    """How many ordered pairings occur more than once in a season."""
    pairs = matches.groupBy("competition_id", "start_year", "home_team_id", "away_team_id").count().where("count > 1")
    return pairs.groupBy("competition_id", "start_year").agg(F.count("*").alias("repeated"), F.sum("count").alias("rows"))


def splits(train_end: str, valid_end: str, test_end: str | None = None) -> Column:
    """train, valid or test by date; null after test_end."""
    d = F.col("match_date")
    late = F.lit("test") if test_end is None else F.when(d <= F.lit(test_end).cast("date"), "test")
    return F.when(d <= F.lit(train_end).cast("date"), "train").when(d <= F.lit(valid_end).cast("date"), "valid").otherwise(late)


def split_counts(rows: DataFrame) -> DataFrame:
    """Rows of each split by result."""
    pivoted = rows.groupBy("split").pivot("result_code", list(CLASSES)).count().fillna(0)
    return reduce(lambda df, c: df.withColumnRenamed(str(c), CLASSES[c]), CLASSES, pivoted)


def split_problems(rows: DataFrame) -> DataFrame:
    """One row: whether the splits follow each other in time, and rows of unknown splits."""
    ends = {f"{f.__name__}_{s}": f(F.when(F.col("split") == s, F.col("match_date"))) for s in ("train", "valid", "test") for f in (F.min, F.max)}
    out = rows.agg(*[c.alias(n) for n, c in ends.items()], F.count_if(~F.col("split").isin("train", "valid", "test")).alias("unknown"))
    good = lambda a, b: F.coalesce(F.col(f"max_{a}") <= F.col(f"min_{b}"), F.lit(True))
    return out.select((good("train", "valid") & good("valid", "test") & good("train", "test")).alias("chronological"), "unknown")


def upcoming(matches: DataFrame) -> DataFrame:
    """Unplayed contests in order, kickoff nulls last."""
    return matches.where("not is_played").orderBy("match_date", F.col("kickoff_time").asc_nulls_last(), "match_id")


def page(df: DataFrame, order: list[Column], number: int, size: int) -> DataFrame:
    """One page: sizes are kept within 10 and 20, numbers within the pages there are; place counts from 1."""
    size = min(max(size, 10), 20)
    pages = max(1, -(-df.count() // size))
    number = min(max(number, 1), pages)
    shown = df.orderBy(*order).offset((number - 1) * size).limit(size)
    return shown.withColumn("place", F.row_number().over(W.orderBy(*order)) + (number - 1) * size)


def by_date(df: DataFrame) -> DataFrame:
    """Contests of each date as a list in kickoff order."""
    item = F.struct("kickoff_time", "match_id")
    return df.groupBy("match_date").agg(F.count("*").alias("n"), F.array_join(F.transform(F.sort_array(F.collect_list(item)), lambda x: x["match_id"].cast("string")), ",").alias("match_ids"))


def _pairs(matches: DataFrame) -> DataFrame:
    return matches.withColumns({"low": F.least("home_team_id", "away_team_id"), "high": F.greatest("home_team_id", "away_team_id")})


def meetings_before(matches: DataFrame) -> DataFrame:
    """matches with low, high and met: how often the pair met in a played contest on a strictly earlier date."""
    dates = W.partitionBy("competition_id", "low", "high").orderBy("match_date").rangeBetween(W.unboundedPreceding, W.currentRow)
    day = W.partitionBy("competition_id", "low", "high", "match_date")
    played = lambda w: F.count_if("is_played").over(w)
    return _pairs(matches).withColumn("met", played(dates) - played(day))


def earlier_meetings(matches: DataFrame, last: int = 5) -> DataFrame:
    """The last played meetings of each unplayed contest's pair on strictly earlier dates.

    A pair's played contests are numbered; a target looks its last numbers up by an equi join, instead of
    a join with all its history.
    """
    pair = ["competition_id", "low", "high"]
    targets = meetings_before(matches).where("not is_played")
    numbers = F.explode(F.sequence(F.lit(1), F.least("met", F.lit(last).cast("long"))))
    wanted = targets.where("met > 0").select("match_id", *pair, "met", numbers.alias("place")).withColumn("k", F.col("met") - F.col("place") + 1)
    order = W.partitionBy(*pair).orderBy("match_date", "match_id")
    past = _pairs(matches.where("is_played")).select(*pair, F.row_number().over(order).cast("long").alias("k"), F.col("match_id").alias("past_id"), F.col("match_date").alias("past_date"), "home_goals", "away_goals")
    return wanted.join(past, [*pair, "k"]).select("match_id", F.col("place").cast("int").alias("place"), "past_id", "past_date", "home_goals", "away_goals")


def latest_per_key(df: DataFrame, key: str, order: str) -> DataFrame:
    """Of each key the row with the largest order."""
    row = F.struct(*df.columns)
    return df.groupBy(key).agg(F.max_by(row, order).alias("r")).select("r.*")


def checkpoint_cutoffs(matches: DataFrame, games: list[int]) -> DataFrame:
    """For each season and checkpoint: the date of its (games x clubs / 2)-th contest, and what was played by then."""
    keys = ["competition_id", "start_year"]
    played = matches.where("is_played")
    order = W.partitionBy(*keys).orderBy("match_date", F.coalesce("kickoff_time", F.lit("")), "match_id")
    marks = played.withColumn("n", F.row_number().over(order)).join(F.broadcast(club_counts(matches)), keys)  # a row a season
    marks = marks.withColumn("checkpoint", F.explode(F.array(*[F.lit(g) for g in games])))
    return marks.where(F.col("n") == F.floor(F.col("checkpoint") * F.col("clubs") / 2)).select(*keys, "checkpoint", F.col("match_date").alias("cutoff"))


def games_at_cutoff(matches: DataFrame, cutoffs: DataFrame) -> DataFrame:
    """Least, median and most games of the teams at each checkpoint."""
    sides = long_form(matches.where("is_played"))
    at = sides.join(F.broadcast(cutoffs), ["competition_id", "start_year"]).where("match_date <= cutoff")
    games = at.groupBy("competition_id", "start_year", "checkpoint", "team_id").agg(F.count("*").alias("games"))
    return games.groupBy("competition_id", "start_year", "checkpoint").agg(F.min("games").alias("least"), F.median("games").alias("median"), F.max("games").alias("most"))


def champions(matches: DataFrame) -> DataFrame:
    """First of each season's final table."""
    return league_table(matches.where("is_played"), "start_year").where("position = 1").select("competition_id", "start_year", "team_id", "points")
