"""Landing of payload rows by file and row number, dimensions, and the competition catalog."""

from __future__ import annotations

import re

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from contestry.functions.scalars import season_name
from contestry.operators.curation import upsert
from contestry.sources.contests import season_start


def land(old: DataFrame, new: DataFrame) -> DataFrame:
    """Payloads upserted by (source_file, row_number), with change; a file that is sent again updates its rows."""
    return upsert(old, new, ["source_file", "row_number"])


def landing_counts(landed: DataFrame, new: DataFrame, *keys: str) -> DataFrame:
    """rows, inserted and updated of each of the new rows' keys (file, season, ...)."""
    touched = landed.where("change in ('inserted', 'updated')")
    return touched.groupBy(*keys).agg(F.count("*").alias("rows"), F.count_if(F.col("change") == "inserted").alias("inserted"), F.count_if(F.col("change") == "updated").alias("updated"))


def dimensions(rows: DataFrame, names: dict[str, tuple[str, str]] | None = None) -> tuple[DataFrame, DataFrame]:
    """(competitions: code, name, country; seasons: code, start_year, name) that rows (code, start_year) speak of."""
    spark = rows.sparkSession
    named = spark.createDataFrame([(c, n, k) for c, (n, k) in (names or {}).items()], "code string, name string, country string")
    codes = rows.select("code").distinct().join(F.broadcast(named), "code", "left")  # a fixed list
    competitions = codes.select("code", F.coalesce("name", "code").alias("name"), F.coalesce("country", F.lit("")).alias("country"))
    seasons = rows.select("code", "start_year").distinct().withColumn("name", season_name(F.col("start_year")))
    return competitions, seasons


def of_years(rows: DataFrame, first: int, last: int) -> DataFrame:
    """Payloads of a range of seasons."""
    if last < first:
        raise ValueError(f"the last year {last} is before the first {first}")
    return rows.where(F.col("start_year").between(first, last))


def payload_scan(payloads: DataFrame, seasons: DataFrame, competitions: DataFrame, code: str | None = None, year: int | None = None) -> DataFrame:
    """Payloads with their season and competition, of one competition and year where given."""
    out = payloads.join(seasons.withColumnRenamed("name", "season"), ["code", "start_year"]).join(competitions.withColumnRenamed("name", "competition"), "code")
    out = out if code is None else out.where(F.col("code") == code)
    return out if year is None else out.where(F.col("start_year") == year)


# The catalog.

#: Code, slug, name, country, clubs, contests, relegated, last places of the three cups.
COMPETITIONS = [
    ("E0", "premier-league", "Premier League", "England", 20, 380, 3, 4, 5, 6),
    ("SP1", "la-liga", "La Liga", "Spain", 20, 380, 3, 4, 5, 6),
    ("D1", "bundesliga", "Bundesliga", "Germany", 18, 306, 2, 4, 5, 6),
    ("I1", "serie-a", "Serie A", "Italy", 20, 380, 3, 4, 5, 6),
    ("F1", "ligue-1", "Ligue 1", "France", 18, 306, 2, 3, 4, 5),
]
#: Seasons of another size: code, first and last year, clubs, contests.
SIZES = [("F1", 2018, 2018, 20, 380), ("F1", 2019, 2019, 20, 279), ("F1", 2020, 2022, 20, 380)]
#: Words that name all competitions.
EVERY = ["all", "top5", "top-5"]


def catalog(spark) -> DataFrame:
    return spark.createDataFrame(COMPETITIONS, "code string, slug string, name string, country string, clubs int, contests int, relegated int, ucl int, europa int, conference int")


def season_sizes(seasons: DataFrame, competitions: DataFrame | None = None, sizes: DataFrame | None = None) -> DataFrame:
    """seasons (code, start_year) with the expected clubs and contests: a range's where one holds the year, else the competition's."""
    spark = seasons.sparkSession
    usual = competitions if competitions is not None else catalog(spark)
    usual = usual.select("code", F.col("clubs").alias("u_clubs"), F.col("contests").alias("u_contests"))
    other = sizes if sizes is not None else spark.createDataFrame(SIZES, "code string, first int, last int, clubs int, contests int")
    # one row for each year of a range: an equi join takes the place of a range join
    years = other.select("code", F.explode(F.sequence("first", "last")).alias("start_year"), "clubs", "contests")
    out = seasons.join(usual, "code", "left").join(years, ["code", "start_year"], "left")
    return out.select("code", "start_year", F.coalesce("clubs", "u_clubs").alias("clubs"), F.coalesce("contests", "u_contests").alias("contests"))


def band(position: Column, clubs: Column, relegated: Column, ucl: Column, europa: Column, conference: Column) -> Column:
    """What a table place leads to."""
    return F.when(position <= ucl, "ucl").when(position <= europa, "europa").when(position <= conference, "conference").when(position > clubs - relegated, "relegation")


def competition_codes(value: str | list[str] | None) -> list[str]:
    """Codes of a code, a slug, a comma list, or all."""
    known = {name: code for code, slug, *_ in COMPETITIONS for name in (code.lower(), slug)}
    words = [w.strip().lower() for w in (value if isinstance(value, list) else (value or "all").split(",")) if w.strip()]
    if not words or set(words) & set(EVERY):
        return [c[0] for c in COMPETITIONS]
    unknown = [w for w in words if w not in known]
    if unknown:
        raise ValueError(f"unknown competition: {', '.join(unknown)}")
    return [known[w] for w in words]


# Years.

#: Words of a year parameter that leave the year to its default.
DEFAULT_WORDS = ["auto", "current", "none", "null"]
YEAR = re.compile(r"[+-]?[0-9]+(\.0*)?")


def year_parameter(value: object) -> int | None:
    """The year that a parameter names, given as text or a number; None where it is blank or a word for the default."""
    shown = "" if value is None else str(value).strip()
    if not shown or shown.lower() in DEFAULT_WORDS:
        return None
    if not YEAR.fullmatch(shown):
        raise ValueError(f"not a year: {value!r}")
    return int(shown.partition(".")[0])


def season_boundaries(days: DataFrame, day: str, folds: int = 4, first: int = 2018, behind: int = 2) -> DataFrame:
    """days with what follows from each: live and holdout season, train_end, valid_end and test_end (ends of seasons), and fold_seasons.

    The holdout is the season before the live one. Walk-forward folds validate on the newest `folds` seasons before it
    that have `behind` seasons of history, which begins in `first`; a day without any is an error.
    """
    live = season_start(day)
    ends = {name: F.make_date(live - back, F.lit(7), F.lit(31)) for name, back in (("train_end", 2), ("valid_end", 1), ("test_end", 0))}
    usable = F.when(live - 2 >= first + behind, F.sequence(F.lit(first + behind), live - 2))
    found = F.coalesce(F.slice(usable, F.greatest(F.size(usable) - folds + 1, F.lit(1)), F.lit(max(folds, 0))), F.array().cast("array<int>"))
    error = F.raise_error(F.concat(F.lit("no fold has enough seasons behind it on "), F.col(day).cast("string")))
    return days.withColumns({"live": live, "holdout": live - 1, **ends, "fold_seasons": F.when(F.size(found) > 0, found).otherwise(error.cast("array<int>"))})
