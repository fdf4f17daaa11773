"""Ratings as a stream beside ratings of all contests at once."""

import random
import tempfile

import pandas as pd
from pyspark.sql import functions as F

from contestry.operators import form
from contestry.streaming.elo import BUCKETS, CONTEST, FIELDS, Ratings, corrected, start_elo

SCHEMA = f"competition_id long, {CONTEST}"


def contests(n, seed=4):
    r, out = random.Random(seed), []
    for i in range(n):
        league, home, away = r.randrange(2), *r.sample(range(8), 2)
        played = r.random() < 0.9
        out.append((league, f"2020-{1 + i * 11 // n:02d}-{1 + i % 28:02d}", r.choice(["12:00:00", None]), i, home + 10 * league, away + 10 * league, played, *((r.randrange(4), r.randrange(4)) if played else (None, None))))
    return out


def streamed(spark, batches, wait):
    path = tempfile.mkdtemp(prefix="spark-")
    for rows in batches:
        spark.createDataFrame(rows, SCHEMA).coalesce(1).write.mode("append").parquet(f"{path}/in")
        start_elo(spark.readStream.schema(SCHEMA).parquet(f"{path}/in"), f"file://{path}/out", f"file://{path}/state", wait).awaitTermination()
    return spark.read.parquet(f"{path}/out")


def of(df):
    return {r.match_id: (round(r.home_elo, 9), round(r.away_elo, 9)) for r in df.collect()}


CLOSING = [(league, *[None] * len(FIELDS)) for league in (0, 1)]


def test_shuffled_arrival_and_late_contests(spark):
    rows = contests(120)
    whole = spark.createDataFrame(rows, SCHEMA).withColumn("match_date", F.to_date("match_date"))
    wanted = of(form.elo(whole))
    shuffled = random.Random(1).sample(rows, len(rows))
    assert of(streamed(spark, [shuffled[:50], shuffled[50:], CLOSING], 400)) == wanted
    # a contest of league 0 comes after later ones were rated
    last = next(r for r in rows[20:] if r[0] == 0 and r[6])
    rated = streamed(spark, [[r for r in rows if r != last], CLOSING, [last]], 5)
    assert [r.match_id for r in rated.where("late").collect()] == [last[3]]
    assert of(rated.where("competition_id = 1")) == {k: v for k, v in wanted.items() if rows[k][0] == 1}
    assert of(corrected(rated, whole)) == wanted


def test_contests_wait_for_their_day(spark):
    rows = contests(60)
    rated = streamed(spark, [rows], 7)
    newest = {league: max(r[1] for r in rows if r[0] == league) for league in (0, 1)}
    assert 0 < rated.count() < 60
    waiting = {r[3] for r in rows} - {r.match_id for r in rated.collect()}
    assert all(rows[i][1] >= newest[rows[i][0]][:8] + "00" or rows[i][1] > "2020-09" for i in waiting)


class Store:
    """State of one key in memory that counts the values it is asked for and given."""

    def __init__(self):
        self.kept, self.trips = {}, 0

    def getMapState(self, name, key, value):  # noqa: N802
        return self

    def getListState(self, name, schema):  # noqa: N802
        return Values(self)

    def getValueState(self, name, schema):  # noqa: N802
        return Values(self)

    def containsKey(self, key):  # noqa: N802
        self.trips += 1
        return key in self.kept

    def getValue(self, key):  # noqa: N802
        self.trips += 1
        return self.kept[key]

    def updateValue(self, key, value):  # noqa: N802
        self.trips += 1
        self.kept[key] = value


class Values:
    def __init__(self, store):
        self.store, self.kept = store, ()

    def get(self):
        return iter(self.kept) if isinstance(self.kept, list) else self.kept

    def put(self, values):
        self.kept, self.store.trips = values, self.store.trips + len(values)

    def update(self, values):
        self.kept = values

    def clear(self):
        self.kept = ()


def test_trips_to_the_state_grow_with_buckets_and_blocks(spark):
    n, clubs = 6000, 2000
    r = random.Random(2)
    rows = [(f"2020-{1 + i % 12:02d}-{1 + i % 28:02d}", "12:00:00", i, *r.sample(range(clubs), 2), True, r.randrange(4), r.randrange(4)) for i in range(n)]
    frame = pd.DataFrame(rows, columns=FIELDS)
    store, ratings = Store(), Ratings(100)
    ratings.init(store)
    closing = pd.DataFrame([[None] * len(FIELDS)], columns=FIELDS)
    found = pd.concat([out for part in (frame[::2], frame[1::2], closing) for out in ratings.handleInputRows((1,), iter([part]), None)])
    assert store.trips < 3 * 5 * BUCKETS + n / 100  # a batch reads its late and its due buckets, after asking for each, and writes those
    late = set(found[found["late"]]["match_id"])
    taken = sorted(x for x in rows if x[2] not in late)
    wanted = dict(zip([x[2] for x in taken], form.rate(((x[3], x[4], x[6], x[7]) for x in taken), {})))
    got = {m: (h, a) for m, h, a in found[~found["late"].astype(bool)][["match_id", "home_elo", "away_elo"]].itertuples(index=False)}
    assert got == wanted
