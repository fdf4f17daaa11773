"""Raw result rows to curated contests: parsing, rules, keyed upserts and the reschedule merge."""

from __future__ import annotations

from functools import reduce

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import Window as W

from contestry.functions import scalars as s
from contestry.sources.contests import season_start, with_result
from contestry.sources.store import large

#: The columns a result file must have.
REQUIRED = ["Div", "Date", "HomeTeam", "AwayTeam", "FTHG", "FTAG", "FTR"]
PAIRING = ["competition", "start_year", "home_team", "away_team"]


def missing_columns(df: DataFrame) -> list[str]:
    """Required columns that the file lacks; a byte-order mark before the first name doesn't count."""
    names = {c.removeprefix("﻿") for c in df.columns}
    return [c for c in REQUIRED if c not in names]


def without_blank_rows(raw: DataFrame) -> DataFrame:
    return raw.where(F.concat_ws("", *[F.trim(F.coalesce(F.col(c), F.lit(""))) for c in REQUIRED]) != "")


def transform(raw: DataFrame, aliases: dict[str, str] | None = None) -> DataFrame:
    """rid and the curated columns of each raw row, with an array of the rules it breaks."""
    blank = lambda c: s.is_blank(F.col(c))
    parsed = raw.select(
        "rid", F.trim("Div").alias("competition"),
        s.match_date(F.col("Date")).alias("match_date"), s.kickoff(F.col("Time")).alias("kickoff_time"),
        s.team_name(F.col("HomeTeam"), aliases or {}).alias("home_team"), s.team_name(F.col("AwayTeam"), aliases or {}).alias("away_team"),
        s.goal(F.col("FTHG")).alias("home_goals"), s.goal(F.col("FTAG")).alias("away_goals"),
        F.upper(F.trim(F.coalesce("FTR", F.lit("")))).alias("ftr"),
        (~blank("FTHG")).alias("has_hg"), (~blank("FTAG")).alias("has_ag"), (~blank("Time")).alias("has_time"),
    )
    parsed = with_result(parsed)
    rules = {
        "date": F.col("match_date").isNull(),
        "kickoff": F.col("has_time") & F.col("kickoff_time").isNull(),
        "team": F.col("home_team").isNull() | F.col("away_team").isNull(),
        "same teams": F.col("home_team") == F.col("away_team"),
        "goals": (F.col("has_hg") & F.col("home_goals").isNull()) | (F.col("has_ag") & F.col("away_goals").isNull()),
        "one score": F.col("has_hg") != F.col("has_ag"),
        "result without goals": (F.col("ftr") != "") & ~(F.col("has_hg") & F.col("has_ag")),
        "result": ~F.col("ftr").isin("", "H", "D", "A") | ((F.col("ftr") != "") & F.coalesce(F.col("ftr") != F.col("result"), F.lit(False))),
    }
    broken = F.array_compact(F.array(*[F.when(cond, F.lit(name)) for name, cond in rules.items()]))
    out = parsed.withColumns({"violations": broken, "is_played": F.col("home_goals").isNotNull() & F.col("away_goals").isNotNull(), "start_year": season_start("match_date")})
    content = ["competition", "match_date", "kickoff_time", "home_team", "away_team", "home_goals", "away_goals", "result"]
    return out.withColumn("row_hash", F.sha2(F.to_json(F.struct(*content)), 256)).drop("ftr", "has_hg", "has_ag", "has_time")


def valid_rows(parsed: DataFrame, strict: bool = False) -> DataFrame:
    """Rows without violations; strict fails on the first bad row instead of leaving it out."""
    good = F.size("violations") == 0
    if strict:
        return parsed.where(F.assert_true(good, F.concat(F.lit("row "), F.col("rid").cast("string"))).isNull())
    return parsed.where(good)


def of_competition(parsed: DataFrame, code: str) -> DataFrame:
    """Rows of a division; rows that name none belong to it."""
    return parsed.where((F.col("competition") == code) | (F.coalesce("competition", F.lit("")) == ""))


def merge(rows: DataFrame) -> DataFrame:
    """One contest for each pairing of a season, from all its rows in rid order, as one aggregation.

    Scores come from the last played row; the kickoff from the last that has one; the date from the
    first played row (it is frozen then), else from the last.
    """
    played = F.col("is_played")
    last_played = lambda c: F.max_by(c, F.when(played, F.col("rid")))
    return rows.groupBy(*PAIRING).agg(
        F.coalesce(F.min_by("match_date", F.when(played, F.col("rid"))), F.max_by("match_date", "rid")).alias("match_date"),
        F.max_by("kickoff_time", F.when(F.col("kickoff_time").isNotNull(), F.col("rid"))).alias("kickoff_time"),
        *[last_played(c).alias(c) for c in ("home_goals", "away_goals", "result", "result_code")],
        F.bool_or(played).alias("is_played"),
        F.coalesce(last_played("row_hash"), F.max_by("row_hash", "rid")).alias("row_hash"),
        F.min("rid").alias("match_id"),
    )


def reschedule_targets(existing: DataFrame) -> DataFrame:
    """Of several rows of a pairing the one that takes a new payload: unplayed first, then predicted, then the oldest.

    existing: PAIRING, match_id, is_played, predictions. The others go where neither played nor predicted.
    """
    predicted = F.col("predictions") > 0
    w = W.partitionBy(*PAIRING).orderBy("is_played", predicted.desc(), "match_id")
    placed = existing.withColumn("place", F.row_number().over(w))
    fate = F.when(F.col("place") == 1, "target").when(F.col("is_played") | predicted, "kept").otherwise("dropped")
    return placed.withColumn("fate", fate).drop("place")


def stale(existing: DataFrame, feed: DataFrame) -> DataFrame:
    """Rows of the feed's seasons that the feed lacks: deleted, or protected with the reasons."""
    season = ["competition", "start_year"]
    gone = existing.join(feed.select(*season).distinct(), season, "left_semi").join(feed.select(*PAIRING).distinct(), PAIRING, "left_anti")
    reasons = F.array_compact(F.array(F.when(F.col("is_played"), "already played"), F.when(F.col("predictions") > 0, F.concat(F.col("predictions").cast("string"), F.lit(" stored prediction(s)")))))
    return gone.select("match_id", F.array_join(reasons, ", ").alias("reasons"), F.when(F.size(reasons) == 0, "delete").otherwise("protected").alias("fate"))


def upsert(old: DataFrame, new: DataFrame, keys: list[str], frozen: Column | None = None) -> DataFrame:
    """old with new's rows put in by key; where frozen (over the old row, as a column of `o`) holds, the old row stays.

    change tells inserted, updated, unchanged and kept (frozen).
    """
    values = [c for c in old.columns if c not in keys]
    o = old.select(*keys, F.struct(*values).alias("o"), F.lit(True).alias("in_old"))
    n = new.select(*keys, F.struct(*[F.col(c) for c in values]).alias("n"), F.lit(True).alias("in_new"))
    both = o.join(large(n), keys, "full_outer")
    held = F.coalesce(frozen if frozen is not None else F.lit(False), F.lit(False))
    change = F.when(F.col("in_old").isNull(), "inserted").when(F.col("in_new").isNull(), "unchanged").when(held, "kept").otherwise("updated")
    both = both.withColumn("change", change)
    taken = F.when(F.col("change").isin("inserted", "updated"), F.col("n")).otherwise(F.col("o"))
    return both.select(*keys, taken.alias("v"), "change").select(*keys, "v.*", "change")


def resolve_teams(known: DataFrame, incoming: DataFrame, renames: bool = False) -> DataFrame:
    """Each incoming name's team: by canonical name, then by source name, else new.

    known: competition, team_id, canonical, source; incoming: competition, source, canonical. With renames a team found
    by its source takes the incoming canonical name (how: renamed), unless that name is taken: by another known
    team, or by a claim that comes first, of the lowest id. A team takes one name. What loses is contested, and
    keeps its team under the old name.
    """
    by_name = known.select("competition", "canonical", F.col("team_id").alias("by_name"))
    by_source = known.groupBy("competition", "source").agg(F.min("team_id").alias("by_source"))
    out = incoming.join(by_name, ["competition", "canonical"], "left").join(by_source, ["competition", "source"], "left")
    how = F.when(F.col("by_name").isNotNull(), "canonical").when(F.col("by_source").isNotNull(), "source").otherwise("new")
    out = out.select("competition", "source", "canonical", F.coalesce("by_name", "by_source").alias("team_id"), how.alias("how"))
    if not renames:
        return out
    claims = F.col("how") == "source"
    # of a name's claims the lowest id's, of a team's claims the first name; other rows are numbered apart and unused
    claim = F.row_number().over(W.partitionBy("competition", "canonical", claims).orderBy("team_id", "source"))
    own = F.row_number().over(W.partitionBy("competition", "team_id", claims).orderBy("canonical"))
    placed = out.withColumns({"claim": claim, "own": own})
    return placed.withColumn("how", F.when(~claims, F.col("how")).when((F.col("claim") == 1) & (F.col("own") == 1), "renamed").otherwise("contested")).drop("claim", "own")


def renamed_teams(known: DataFrame, resolved: DataFrame) -> DataFrame:
    """known under the canonical names that resolve_teams let them take."""
    new = resolved.where("how = 'renamed'").select("competition", "team_id", F.col("canonical").alias("new_name"))
    return known.join(new, ["competition", "team_id"], "left").withColumn("canonical", F.coalesce("new_name", "canonical")).drop("new_name")


def problems(*checks: tuple[str, DataFrame]) -> DataFrame:
    """One row a check: its name and how many rows break it."""
    return reduce(DataFrame.unionByName, [df.agg(F.count("*").alias("rows")).withColumn("check", F.lit(name)) for name, df in checks]).select("check", "rows")


def match_problems(m: DataFrame) -> DataFrame:
    """Broken rules of curated contests, counted in one scan, and duplicate keys."""
    rules = {
        "played without result": F.col("is_played") & F.col("result").isNull(),
        "unplayed with score": ~F.col("is_played") & (F.col("home_goals").isNotNull() | F.col("away_goals").isNotNull()),
        "same teams": F.col("home_team_id") == F.col("away_team_id"),
        "negative goals": (F.col("home_goals") < 0) | (F.col("away_goals") < 0),
        "result against goals": F.col("result") != F.when(F.col("home_goals") > F.col("away_goals"), "H").when(F.col("home_goals") < F.col("away_goals"), "A").otherwise("D"),
        "code against result": F.col("result_code") != F.when(F.col("result") == "H", 2).when(F.col("result") == "D", 1).otherwise(0),
    }
    counts = m.agg(*[F.count_if(F.coalesce(c, F.lit(False))).alias(n) for n, c in rules.items()])
    listed = F.explode(F.array(*[F.struct(F.lit(n).alias("check"), F.col(f"`{n}`").alias("rows")) for n in rules]))
    twice = m.groupBy("match_id").count().where("count > 1")
    return counts.select(listed.alias("x")).select("x.*").unionByName(problems(("duplicate ids", twice)))


def season_problems(summary: DataFrame, catalog: DataFrame, live: int) -> DataFrame:
    """Seasons whose size isn't the catalog's (a live one may be smaller), or whose draw share is odd.

    catalog: competition_id, first_year, last_year, matches; years without a range have no expectation.
    """
    # one row for each year of a range: an equi join takes the place of a range join
    years = catalog.select("competition_id", F.explode(F.sequence("first_year", "last_year")).alias("start_year"), F.col("matches").alias("expected"))
    sized = summary.join(years, ["competition_id", "start_year"], "left")
    share = F.col("draw") / F.nullif(F.col("played"), F.lit(0))
    found = F.array_compact(F.array(
        F.when((F.col("start_year") < live) & (F.col("matches") != F.col("expected")), "incomplete"),
        F.when((F.col("start_year") >= live) & (F.col("matches") > F.col("expected")), "oversized"),
        F.when((F.col("played") >= 30) & ~share.between(0.15, 0.35), "draw share"),
        F.when(F.col("played") != F.col("away") + F.col("draw") + F.col("home"), "uncoded results"),
    ))
    return sized.select("competition_id", "start_year", F.explode(found).alias("problem"))


def league_problems(summary: DataFrame, live: int, least: float = 0.15, most: float = 0.35) -> DataFrame:
    """competition_id, problem, rows: unplayed contests of completed seasons, played ones without a code, nothing played, and an odd share of draws over all seasons.

    summary: of season_summary; rows counts the contests that a problem is about.
    """
    all_of = lambda c: F.sum(c).cast("long")
    whole = summary.groupBy("competition_id").agg(
        all_of(F.when(F.col("start_year") < live, F.col("matches") - F.col("played")).otherwise(0)).alias("unplayed"), all_of("played").alias("played"), all_of("draw").alias("draw"),
        all_of(F.col("played") - F.col("away") - F.col("draw") - F.col("home")).alias("uncoded"),
    )
    share = F.col("draw") / F.nullif(F.col("played"), F.lit(0))
    rules = {"unplayed in completed seasons": (F.col("unplayed") > 0, "unplayed"), "nothing played": (F.col("played") == 0, "played"), "uncoded results": (F.col("uncoded") != 0, "uncoded"), "draw share": (~share.between(least, most), "played")}
    found = F.array_compact(F.array(*[F.when(broken, F.struct(F.lit(name).alias("problem"), F.col(rows).alias("rows"))) for name, (broken, rows) in rules.items()]))
    return whole.select("competition_id", F.explode(found).alias("x")).select("competition_id", "x.*")


def club_problems(m: DataFrame, sizes: DataFrame) -> DataFrame:
    """competition_id, start_year, problem, rows: seasons with another number of clubs than expected, and pairings that were stored more than once.

    sizes: competition_id, start_year, clubs; seasons without a size have no expectation.
    """
    season = ["competition_id", "start_year"]
    sides = m.select(*season, F.explode(F.array("home_team_id", "away_team_id")).alias("team_id"))
    clubs = sides.groupBy(*season).agg(F.count_distinct("team_id").alias("rows")).join(sizes, season)
    split = clubs.where("rows <> clubs").select(*season, F.lit("clubs").alias("problem"), "rows")
    again = m.groupBy(*season, "home_team_id", "away_team_id").agg(F.count("*").alias("n")).where("n > 1")
    return split.unionByName(again.groupBy(*season).agg(F.count("*").alias("rows")).withColumn("problem", F.lit("repeated pairings")))


def feature_problems(m: DataFrame, features: DataFrame) -> DataFrame:
    """Contests without features, ratings and priors out of range."""
    lacking = m.select("match_id").join(features, "match_id", "left_anti")
    odd = lambda c, lo, hi: ~F.coalesce(F.col(c).between(lo, hi), F.lit(False))
    return problems(
        ("without features", lacking),
        ("elo out of range", features.where(odd("home_elo", 1000, 2200) | odd("away_elo", 1000, 2200))),
        ("prior out of range", features.where(odd("home_prior_n", 0, 5) | odd("away_prior_n", 0, 5))),
        ("without version", features.where("feature_version is null")),
    )


def prediction_problems(p: DataFrame) -> DataFrame:
    """Negative or unnormalised triples, and classes that aren't the argmax."""
    every = F.col("p_away") + F.col("p_draw") + F.col("p_home")
    return problems(
        ("negative", p.where((F.col("p_away") < 0) | (F.col("p_draw") < 0) | (F.col("p_home") < 0))),
        ("sum", p.where(F.abs(every - 1) > 0.01)),
        ("class", p.where(F.col("predicted_class") != s.argmax_class(F.col("p_away"), F.col("p_draw"), F.col("p_home")))),
    )


def fail_on(found: DataFrame, stage: str) -> None:
    """Raise with the names of all broken checks; the table has one row a check."""
    broken = found.where("rows > 0").collect()
    if broken:
        raise ValueError(f"{stage}: " + "; ".join(f"{r['check']} ({r['rows']})" for r in broken))
