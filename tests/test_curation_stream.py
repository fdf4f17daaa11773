"""Curation as a stream beside curation of all rows at once."""

import itertools
import tempfile

import pytest
from pyspark.sql import functions as F

from contestry.operators import curation as c
from contestry.plans import streams
from contestry.sources.contests import stored_contests
from contestry.sources.raw import FIELDS
from contestry.streaming import curation

RAW = "feed long, rid long, " + ", ".join(f"{f} string" for f in FIELDS)


def row(feed, rid, date, home, away, score=("", "", ""), time="15:00", div="L1"):
    return (feed, rid, div, date, time, home, away, *score)


#: A fixture, its postponement, its result, a corrected result whose day no longer moves; a contest that goes; a bad row; another league.
ROWS = [
    row(1, 1, "01/09/2020", "A", "B"), row(1, 2, "02/09/2020", "B", "A"), row(1, 3, "03/09/2020", "A", "C", ("1", "0", "H")), row(1, 4, "04/09/2020", "C", "A"),
    row(2, 5, "08/09/2020", "A", "B", time=""), row(2, 6, "02/09/2020", "B", "A", ("0", "0", "D")), row(2, 7, "31/02/2020", "B", "C"),
    row(3, 8, "09/09/2020", "A", "B", ("2", "1", "H"), "18:30"), row(3, 9, "10/09/2020", "A", "B", ("2", "2", "D")), row(3, 10, "05/09/2021", "A", "B"), row(3, 11, "01/09/2020", "A", "B", div="L2"),
]


@pytest.fixture
def made(spark):
    rows = spark.createDataFrame(ROWS, RAW)
    whole = c.merge(c.valid_rows(c.transform(c.without_blank_rows(rows))))
    return rows, sorted(map(str, whole.drop("row_hash").select(sorted(set(whole.columns) - {"row_hash"})).collect()))


def shown(found):
    return sorted(map(str, curation.contests_of(found).drop("row_hash", "feed").select(sorted(set(curation.contests_of(found).columns) - {"row_hash", "feed"})).collect()))


def states_of(rows):
    return curation.states(c.valid_rows(c.transform(c.without_blank_rows(rows.withColumn("rid", F.struct("feed", "rid"))))))


def test_states_combine_in_any_order(spark, made):
    rows, whole = made
    by_feed = [states_of(rows.where(F.col("feed") == f)) for f in (1, 2, 3)]
    for a, b, d in itertools.permutations(by_feed):
        assert shown(curation.combined(curation.combined(a, b), d)) == whole
    assert {r.change for r in curation.combined(by_feed[0], by_feed[0]).collect()} == {"unchanged"}


def test_a_stream_of_late_and_repeated_feeds(spark, made):
    rows, whole = made
    path = tempfile.mkdtemp(prefix="spark-")
    table = curation.contest_table(spark, f"file://{path}/contests")
    for feed in (2, 1, 3):
        rows.where(F.col("feed") == feed).repartition(2, "rid").write.mode("append").parquet(f"{path}/in")
        stream = spark.readStream.schema(rows.schema).option("maxFilesPerTrigger", 1).parquet(f"{path}/in")
        curation.curate_stream(stream, table, f"{path}/state").awaitTermination()
    assert shown(table.read()) == whole
    before = table.version()
    curation.curate_stream(spark.readStream.schema(rows.schema).parquet(f"{path}/in"), table, f"{path}/state").awaitTermination()
    assert table.version().number == before.number  # nothing new came
    # the last feed lacks a played and an unplayed contest of L1's season of 2020
    none = spark.createDataFrame([], "competition string, start_year int, home_team string, away_team string, predictions long")
    fates = {(r.home_team, r.away_team): (r.fate, r.reasons) for r in curation.stale_rows(table, none).collect()}
    assert fates == {("B", "A"): ("protected", "already played"), ("A", "C"): ("protected", "already played"), ("C", "A"): ("delete", "")}
    kept = spark.createDataFrame([("L1", 2020, "C", "A", 2)], none.schema)
    assert curation.retire(table, kept) == 0 and curation.retire(table, none) == 1
    after = table.version()
    assert after.parts["competition=L2/start_year=2020"] == before.parts["competition=L2/start_year=2020"]
    assert ("C", "A") not in {(r.home_team, r.away_team) for r in table.read().collect()}


def test_files_of_a_micro_batch_grow_in_number(spark, monkeypatch):
    m = stored_contests(spark, "/root/testdata/sf0.001")
    few = streams.curated_table(m)
    monkeypatch.setattr(streams, "FILE_CONTESTS", m.count() // 8)
    many = streams.curated_table(m)
    files = lambda table: len([n for n in table._names("../in") if n.endswith(".parquet")])
    assert files(few) == 4 and files(many) >= 16
    assert many.version().number == few.version().number == 4
    assert shown(many.read()) == shown(few.read())
