"""Scalar rules of contest data as column expressions."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

BLANK = r"^\s*$"


def text(c: Column) -> Column:
    return F.coalesce(F.trim(F.regexp_replace(c, r"\s+", " ")), F.lit(""))


def team_name(name: Column, aliases: dict[str, str]) -> Column:
    """Known aliases (any case, any white space) to their club; other names cleaned; null for an empty one."""
    cleaned = text(name)
    pairs = [F.lit(x) for pair in aliases.items() for x in pair]
    known = F.try_element_at(F.create_map(*pairs), F.lower(cleaned)) if pairs else F.lit(None)
    return F.when(cleaned != "", F.coalesce(known, cleaned))


def match_date(c: Column) -> Column:
    """dd/MM/yyyy or dd/MM/yy (69 to 99 are of the last century); null where neither fits."""
    c = F.trim(c)
    short = F.try_to_date(c, "d/M/yy")
    short = F.when(F.year(short) >= 2069, F.add_months(short, -1200)).otherwise(short)
    return F.when(c.rlike(r"^\d{1,2}/\d{1,2}/\d{4}$"), F.try_to_date(c, "d/M/yyyy")).when(c.rlike(r"^\d{1,2}/\d{1,2}/\d{2}$"), short)


def kickoff(c: Column) -> Column:
    """HH:mm or HH:mm:ss to HH:mm:ss; null where blank or not a time."""
    c = F.trim(c)
    parts = F.split(c, ":")
    ok = c.rlike(r"^([01]?\d|2[0-3]):[0-5]?\d(:[0-5]?\d)?$")
    return F.when(ok, F.concat_ws(":", F.lpad(parts[0], 2, "0"), F.lpad(parts[1], 2, "0"), F.lpad(F.coalesce(F.get(parts, F.lit(2)), F.lit("00")), 2, "0")))


def goal(c: Column) -> Column:
    """A whole number of 0 or more; else null."""
    n = F.trim(c).try_cast("int")
    return F.when(n >= 0, n)


def is_blank(c: Column) -> Column:
    return F.coalesce(c.rlike(BLANK), F.lit(True))


def utc_kickoff(c: Column) -> Column:
    """yyyy-MM-dd[ T]HH:mm:ss with Z, an offset or none (UTC) to a timestamp; null where it doesn't fit."""
    c = F.trim(F.regexp_replace(c, "T", " "))
    zone = F.regexp_extract(c, r"(Z|[+-]\d{2}:?\d{2})$", 1)
    plain = F.try_to_timestamp(F.substring(c, 1, 19), F.lit("yyyy-MM-dd HH:mm:ss"))
    sign = F.when(F.substring(zone, 1, 1) == "-", -1).otherwise(1)
    digits = F.regexp_replace(zone, r"[^0-9]", "")
    minutes = sign * (F.substring(digits, 1, 2).try_cast("int") * 60 + F.substring(digits, 3, 2).try_cast("int"))
    offset = F.when(zone.isin("", "Z"), 0).otherwise(minutes)
    fits = c.rlike(r"^\d{4}-\d{2}-\d{2} \d{2}:\d{2}:\d{2} ?(Z|[+-]\d{2}:?\d{2})?$")
    return F.when(fits, plain - F.make_dt_interval(mins=offset))


def as_percent(c: Column) -> Column:
    """The nearest whole percent, halves to even."""
    return F.bround(c * 100).cast("long")


def argmax_class(p_away: Column, p_draw: Column, p_home: Column) -> Column:
    """The likeliest of away, draw, home (0, 1, 2); ties go to the first."""
    return F.when((p_away >= p_draw) & (p_away >= p_home), 0).when(p_draw >= p_home, 1).otherwise(2)


def class_name(c: Column) -> Column:
    return F.when(c == 0, "away").when(c == 1, "draw").when(c == 2, "home")


def match_note(p_away: Column, p_draw: Column, p_home: Column, predicted: Column) -> Column:
    """Draw watch: a draw of 25 % or more that isn't predicted; close match: the best two within 8 points."""
    ordered = F.sort_array(F.array(p_away, p_draw, p_home), asc=False)
    return F.when((predicted != 1) & (p_draw >= 0.25), "Draw watch").when(ordered[0] - ordered[1] < 0.08, "Close match")


def ordinal(n: Column) -> Column:
    last = F.when((n % 100).between(10, 20), "th").when(n % 10 == 1, "st").when(n % 10 == 2, "nd").when(n % 10 == 3, "rd").otherwise("th")
    return F.concat(n.cast("string"), last)


def season_name(start_year: Column) -> Column:
    """2000/01."""
    return F.format_string("%d/%02d", start_year, (start_year + 1) % 100)


def title_of(code: Column, labels: dict[str, str]) -> Column:
    """A label, or the code in title case with spaces."""
    pairs = [F.lit(x) for pair in labels.items() for x in pair]
    return F.coalesce(F.try_element_at(F.create_map(*pairs), code), F.initcap(F.translate(code, "_", " ")))


def prediction_text(p_away: Column, p_draw: Column, p_home: Column) -> Column:
    return F.format_string("Home %.0f%% / Draw %.0f%% / Away %.0f%%", p_home * 100, p_draw * 100, p_away * 100)


def uniform_draw(seed: int, *keys: Column) -> Column:
    """A number from 0 to 1 that depends on seed and keys only, whatever the partitioning; SQL can repeat it."""
    bits = F.conv(F.substring(F.md5(F.concat_ws("|", F.lit(str(seed)), *[k.cast("string") for k in keys])), 1, 13), 16, 10).cast("long")
    return (bits + F.lit(0.5)) / F.lit(float(1 << 52))


def outcome(code: Column, home: Column, away: Column) -> Column:
    """The winner's name, or Draw."""
    return F.when(code == 2, home).when(code == 0, away).when(code == 1, "Draw")


def side_label(code: Column) -> Column:
    return F.when(code == 0, "Away win").when(code == 1, "Draw").when(code == 2, "Home win")


def iso_date(d: Column) -> Column:
    return F.date_format(d, "yyyy-MM-dd")


def iso_minute(kickoff: Column) -> Column:
    """HH:mm of a kickoff."""
    return F.substring(kickoff, 1, 5)


def iso_stamp(t: Column) -> Column:
    return F.date_format(t, "yyyy-MM-dd'T'HH:mm:ss")
