"""Streaming curation: raw rows of feeds as a stream, merged into a versioned table of contests.

A pairing of a season is one row, kept as a mergeable state: the newest played row, the first played
row, the newest row and the newest kickoff, each with its place (feed, row). States combine in any
order, so late, repeated or split feeds give the contests that one run over all their rows would. A
micro-batch reads and writes the seasons it speaks of and no others, and is taken once however often it
is sent.
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql.streaming import StreamingQuery

from contestry.operators.curation import PAIRING, stale, transform, valid_rows, without_blank_rows
from contestry.sources.store import large
from contestry.sources.versioned import CHANGE, Table

SEASON = ["competition", "start_year"]
SCORE = ["home_goals", "away_goals", "result", "result_code", "row_hash"]
#: The parts of a state, and which of two wins.
NEWEST, FIRST = ("last_played", "last_row", "last_kickoff"), ("first_played", "match_id")


def contest_table(spark, path: str) -> Table:
    return Table(spark, path, PAIRING, SEASON)


def states(rows: DataFrame) -> DataFrame:
    """One mergeable state for each pairing of curated rows, whose rid is a struct of feed and rid."""
    played, at = F.col("is_played"), F.col("rid")
    newest = {
        "last_played": F.when(played, F.struct(at.alias("at"), *SCORE)),
        "last_row": F.struct(at.alias("at"), "match_date", "row_hash"),
        "last_kickoff": F.when(F.col("kickoff_time").isNotNull(), F.struct(at.alias("at"), "kickoff_time")),
    }
    first = {"first_played": F.when(played, F.struct(at.alias("at"), "match_date")), "match_id": F.col("rid.rid")}
    return rows.groupBy(*PAIRING).agg(*[F.max(c).alias(n) for n, c in newest.items()], *[F.min(c).alias(n) for n, c in first.items()])


def combined(old: DataFrame, new: DataFrame) -> DataFrame:
    """The states of old with those of new put in, by pairing; change tells inserted, updated (the new one counted) and unchanged."""
    parts = [*NEWEST, *FIRST]
    o = old.select(*PAIRING, F.struct(*parts).alias("o"))
    both = o.join(large(new.select(*PAIRING, F.struct(*parts).alias("n"))), PAIRING, "full_outer")
    pick = lambda f, c: f(F.col(f"o.{c}"), F.col(f"n.{c}")).alias(c)  # noqa: E731  nulls don't count
    out = both.select(*PAIRING, *[pick(F.greatest, c) for c in NEWEST], *[pick(F.least, c) for c in FIRST], "o")
    change = F.when(F.col("o").isNull(), "inserted").when(F.struct(*parts).eqNullSafe(F.col("o")), "unchanged").otherwise("updated")
    return out.withColumn(CHANGE, change).drop("o")


def contests_of(found: DataFrame) -> DataFrame:
    """The contests that states stand for: the newest score, the date of the first played row (frozen then) or else the newest, the newest kickoff."""
    c = F.col
    return found.select(
        *PAIRING, F.coalesce("first_played.match_date", "last_row.match_date").alias("match_date"), c("last_kickoff.kickoff_time").alias("kickoff_time"),
        *[c(f"last_played.{s}").alias(s) for s in SCORE if s != "row_hash"], c("last_played").isNotNull().alias("is_played"),
        F.coalesce("last_played.row_hash", "last_row.row_hash").alias("row_hash"), "match_id", c("last_row.at.feed").alias("feed"),
    )


def curate_stream(stream: DataFrame, table: Table, checkpoint: str, aliases: dict[str, str] | None = None) -> StreamingQuery:
    """Raw rows (feed, rid and the columns of a result file) into the table, a version a micro-batch; bad rows are left out."""

    def add(batch: DataFrame, batch_id: int) -> None:
        placed = batch.withColumn("rid", F.struct("feed", "rid"))  # feeds in turn, and their rows in turn
        rows = valid_rows(transform(without_blank_rows(placed), aliases))
        table.change(states(rows), combined, batch=(checkpoint, batch_id))

    return stream.writeStream.foreachBatch(add).option("checkpointLocation", checkpoint).trigger(availableNow=True).start()


def stale_rows(table: Table, predicted: DataFrame) -> DataFrame:
    """PAIRING, reasons and fate (delete, protected) of rows that their season's newest feed lacks.

    predicted: PAIRING and predictions, the number of stored predictions. To be asked for once a feed is
    in whole: a feed may come in several files and micro-batches.
    """
    now = contests_of(table.read())
    newest = now.groupBy(*SEASON).agg(F.max("feed").alias("newest"))
    known = now.join(newest, SEASON).join(large(predicted.select(*PAIRING, "predictions")), PAIRING, "left").fillna({"predictions": 0})
    # a day that crosses into another season leaves its contest in both, under one id: rows are told apart by their pairing
    whole = known.withColumn("match_id", F.struct(*PAIRING, "match_id"))
    return stale(whole, known.where("feed = newest")).select("match_id.*", "reasons", "fate")


def retire(table: Table, predicted: DataFrame) -> int:
    """Delete what stale_rows gives up: rows neither played nor predicted; how many went."""
    _, gone = table.delete_using(stale_rows(table, predicted).where("fate = 'delete'"))
    return gone
