"""Tables that change as whole versions."""

import pytest
from pyspark.sql import functions as F

from contestry.sources.versioned import Conflict, fresh_table

ROW = "league int, id long, score int, played boolean"


def rows(spark, *found):
    return spark.createDataFrame(list(found), ROW)


def content(table, number=None):
    return {(r.league, r.id): (r.score, r.played) for r in table.read(number).collect()}


@pytest.fixture
def table(spark):
    made = fresh_table(spark, "table", ["league", "id"], ["league"])
    made.replace(rows(spark, (1, 1, 10, True), (1, 2, 20, False), (2, 3, 30, True), (3, 4, 40, False)))
    return made


def counts(table):
    return {r.change: r.rows for r in table.changes().collect()}


def test_untouched_partitions_keep_their_files(spark, table):
    before = table.version().parts
    table.replace(rows(spark, (1, 9, 90, True)))
    after = table.version().parts
    assert content(table) == {(1, 9): (90, True), (2, 3): (30, True), (3, 4): (40, False)}
    assert after["league=2"] == before["league=2"] and after["league=3"] == before["league=3"] and after["league=1"] != before["league=1"]
    assert content(table, 1)[1, 1] == (10, True) and counts(table) == {"inserted": 1}


def test_upsert_keeps_frozen_rows_and_counts(spark, table):
    table.upsert(rows(spark, (1, 1, 11, True), (1, 2, 21, True), (1, 5, 50, False), (4, 6, 60, False)), F.col("o.played"))
    assert content(table) == {(1, 1): (10, True), (1, 2): (21, True), (1, 5): (50, False), (2, 3): (30, True), (3, 4): (40, False), (4, 6): (60, False)}
    assert counts(table) == {"kept": 1, "updated": 1, "inserted": 2}


def test_delete_using_and_update_from(spark, table):
    _, gone = table.delete_using(rows(spark, (1, 2, 0, True), (3, 4, 0, True), (3, 99, 0, True), (7, 1, 0, True)))
    assert gone == 2 and content(table) == {(1, 1): (10, True), (2, 3): (30, True)} and set(table.version().parts) == {"league=1", "league=2"}
    table.update_from(rows(spark, (1, 1, 12, False), (1, 8, 80, False), (2, 3, 33, False)).drop("played"), F.col("n.score") < 20)
    assert content(table) == {(1, 1): (12, True), (2, 3): (30, True)} and counts(table) == {"updated": 1, "unchanged": 1}


def test_a_writer_that_dies_leaves_the_old_version(spark, table):
    before = content(table)
    staged = table.stage(rows(spark, (1, 9, 90, True)))  # files are there, and then the writer is gone
    assert content(table) == before and table.versions() == [1]
    assert table.vacuum() == 1 and content(table) == before
    with pytest.raises(Exception, match="boom"):
        table.replace(rows(spark, (1, 9, 90, True)).select("*").where(F.raise_error(F.lit("boom")).isNull()))
    assert content(table) == before and staged not in table.version().parts.values()


def test_a_repeated_batch_is_taken_once(spark, table):
    table.upsert(rows(spark, (1, 2, 21, False)), batch=("feed", 0))
    table.upsert(rows(spark, (1, 2, 99, False)), batch=("feed", 0))
    assert content(table)[1, 2] == (21, False) and table.versions() == [1, 2]
    table.upsert(rows(spark, (1, 2, 22, False)), batch=("feed", 1))
    assert content(table)[1, 2] == (22, False)


def test_two_writers(spark, table):
    seen, schema = table.version(), table.version().schema
    one, two, three = (table.stage(rows(spark, r)) for r in ((1, 9, 90, True), (2, 9, 91, True), (1, 8, 92, True)))
    table.commit(one, schema, [], seen)
    table.commit(two, schema, [], seen)  # other partitions: taken up
    with pytest.raises(Conflict):
        table.commit(three, schema, [], seen)
    assert content(table) == {(1, 9): (90, True), (2, 9): (91, True), (3, 4): (40, False)}


def test_vacuum_keeps_what_versions_name(spark, table):
    table.replace(rows(spark, (1, 9, 90, True)))
    table.replace(rows(spark, (2, 9, 91, True)))
    before = content(table)
    table.vacuum()
    assert content(table) == before and table.versions() == [3]
    table.replace(rows(spark, (2, 7, 70, True)))
    assert table.versions() == [3, 4]


def test_two_partition_columns_and_null_partitions(spark):
    table = fresh_table(spark, "table", ["league", "year", "id"], ["league", "year"])
    made = spark.createDataFrame([("a b", 1, 1), ("a b", 2, 2), (None, 1, 3)], "league string, year int, id long")
    table.replace(made)
    assert sorted(map(str, table.read().collect())) == sorted(map(str, made.collect()))
    assert len(table.version().parts) == 3
    assert table.read(only=["league=a b/year=2"]).collect()[0].id == 2
