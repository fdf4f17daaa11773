"""Elo ratings as a stream with state.

A competition's state is a map of ratings by bucket of clubs, a list of blocks of contests that still wait,
and the place up to which it has rated: each value that a task asks the store for is a trip of its own, so
that trips grow with buckets and blocks, not with clubs and contests. Contests wait until the competition's newest day is WAIT days past theirs, so
arrival may be shuffled within that time; then they are rated in order, and only the buckets of clubs
that played are read and written. A row without match_id closes a competition: all that waits is rated.
In a stream that never ends a timer does so, when nothing has come for HOLD of processing time; a run that
stops with the data at hand has no timers, as Spark would wait for them.

A contest from before the place already rated is late: it comes out marked, with the ratings of now, and
changes none. `corrected` reads the late rows and rates the competitions they belong to anew.
"""

from __future__ import annotations

import json
from collections.abc import Iterator

import pandas as pd
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql.streaming.query import StreamingQuery
from pyspark.sql.streaming.stateful_processor import StatefulProcessor, StatefulProcessorHandle

from contestry.operators.form import elo, rate
from contestry.sources.store import large

OUT = "match_id long, competition_id long, home_elo double, away_elo double, late boolean"
CONTEST = "match_date string, kickoff_time string, match_id long, home_team_id long, away_team_id long, is_played boolean, home_goals int, away_goals int"
FIELDS = [c.split()[0] for c in CONTEST.split(", ")]
WAIT, HOLD = 7, 24 * 3600 * 1000
#: Buckets of a competition's clubs, and contests of a block: how the state is cut.
BUCKETS, BLOCK = 256, 1_000
STATE_STORE = "spark.sql.streaming.stateStore.providerClass"
ROCKS = "org.apache.spark.sql.execution.streaming.state.RocksDBStateStoreProvider"


class Ratings(StatefulProcessor):
    def __init__(self, wait: int = WAIT, timers: bool = False):
        self.wait, self.timers = wait, timers

    def init(self, handle: StatefulProcessorHandle) -> None:
        self.handle = handle
        self.ratings = handle.getMapState("ratings", "bucket int", "ratings string")
        self.waiting = handle.getListState("waiting", "contests string")
        self.place = handle.getValueState("place", "day string, kickoff string, match long, newest string")

    def handleInputRows(self, key, rows: Iterator[pd.DataFrame], timerValues) -> Iterator[pd.DataFrame]:
        came = pd.concat(list(rows))  # a micro-batch's rows of one competition: the source bounds their number
        closing = bool(came["match_id"].isna().any())
        contests = _plain(came[came["match_id"].notna()])
        *place, newest = self.place.get() or ("", "", 0, "")
        late = [c for c in contests if c[:3] <= tuple(place)]
        if late:
            yield self._late(key, late)
        waiting = self._waiting() + [c for c in contests if c[:3] > tuple(place)]
        newest = max([newest, *(c[0] for c in contests)])
        yield self._rate(key, waiting, "9999" if closing else _days_before(newest, self.wait), tuple(place), newest)
        if not self.timers:
            return
        for timer in list(self.handle.listTimers()):
            self.handle.deleteTimer(timer)
        self.handle.registerTimer(timerValues.getCurrentProcessingTimeInMs() + HOLD)

    def handleExpiredTimer(self, key, timerValues, expiredTimerInfo) -> Iterator[pd.DataFrame]:
        *place, newest = self.place.get() or ("", "", 0, "")
        yield self._rate(key, self._waiting(), "9999", tuple(place), newest)

    def close(self) -> None:
        pass

    def _waiting(self) -> list[tuple]:
        return [tuple(c) for (block,) in self.waiting.get() for c in json.loads(block)]

    def _known(self, contests: list[tuple]) -> dict[int, float]:
        """Ratings of the contests' clubs and of those that share a bucket with them."""
        buckets = sorted({t % BUCKETS for c in contests for t in c[3:5]})
        return {t: r for b in buckets if self.ratings.containsKey((b,)) for t, r in json.loads(self.ratings.getValue((b,))[0])}

    def _keep(self, known: dict[int, float]) -> None:
        """Write ratings, which hold whole buckets."""
        buckets: dict[int, list] = {}
        for team, rating in known.items():
            buckets.setdefault(team % BUCKETS, []).append((team, rating))
        for b, ratings in buckets.items():
            self.ratings.updateValue((b,), (json.dumps(ratings),))

    def _rate(self, key, waiting: list[tuple], upto: str, place: tuple, newest: str) -> pd.DataFrame:
        """Rate what waits from days before upto, in order."""
        due = sorted(c for c in waiting if c[0] < upto)
        known = self._known(due)
        found = list(rate(((c[3], c[4], *(c[6:8] if c[5] else (None, None))) for c in due), known))
        self._keep(known)
        rest = [c for c in waiting if c[0] >= upto]
        self.waiting.put([(json.dumps(rest[i : i + BLOCK]),) for i in range(0, len(rest), BLOCK)]) if rest else self.waiting.clear()
        self.place.update((*(due[-1][:3] if due else place), newest))
        return pd.DataFrame([(c[2], key[0], *e, False) for c, e in zip(due, found)], columns=[c.split()[0] for c in OUT.split(", ")])

    def _late(self, key, contests: list[tuple]) -> pd.DataFrame:
        known = self._known(contests)
        found = [next(rate([(c[3], c[4], None, None)], known)) for c in contests]
        return pd.DataFrame([(c[2], key[0], *e, True) for c, e in zip(contests, found)], columns=[c.split()[0] for c in OUT.split(", ")])


def _plain(came: pd.DataFrame) -> list[tuple]:
    """Contests as tuples of plain values, nulls as None."""
    def column(name: str, kind, null) -> list:
        return [null if na else kind(x) for x, na in zip(came[name].tolist(), came[name].isna())]

    ids = [column(c, int, None) for c in ("match_id", "home_team_id", "away_team_id")]
    goals = [column(c, int, None) for c in ("home_goals", "away_goals")]
    return list(zip(came["match_date"].tolist(), column("kickoff_time", str, ""), *ids, column("is_played", bool, False), *goals))


def _days_before(day: str, n: int) -> str:
    return str((pd.Timestamp(day) - pd.Timedelta(days=n)).date()) if day else ""


def streaming_elo(stream: DataFrame, wait: int = WAIT, timers: bool = True) -> DataFrame:
    """Ratings before each contest of a stream (competition_id and the columns of CONTEST), as described above."""
    return stream.select("competition_id", *FIELDS).groupBy("competition_id").transformWithStateInPandas(Ratings(wait, timers), OUT, "Append", "ProcessingTime" if timers else "None")


def start_elo(stream: DataFrame, out: str, checkpoint: str, wait: int = WAIT, partitions: int | None = None) -> StreamingQuery:
    """The stream's ratings as Parquet under out.

    Its state needs the RocksDB store, for which the session is set while the query starts; partitions, of the state,
    are the session's where not given, and stay what they were when the checkpoint was made.
    """
    spark = stream.sparkSession
    wanted = {STATE_STORE: ROCKS, **({"spark.sql.shuffle.partitions": str(partitions)} if partitions else {})}
    before = {k: spark.conf.get(k) for k in wanted}
    for k, v in wanted.items():
        spark.conf.set(k, v)
    try:
        writer = streaming_elo(stream, wait, timers=False).writeStream.format("parquet").option("path", out)
        return writer.option("checkpointLocation", checkpoint).trigger(availableNow=True).start()
    finally:
        for k, v in before.items():
            spark.conf.set(k, v)


def corrected(rated: DataFrame, matches: DataFrame) -> DataFrame:
    """match_id, competition_id, home_elo, away_elo: the stream's ratings, and those of competitions with late rows from a batch run over matches."""
    wrong = rated.where("late").select("competition_id").distinct()
    again = elo(matches.join(wrong, "competition_id", "left_semi")).join(large(matches.select("match_id", "competition_id")), "match_id")
    columns = ["match_id", "competition_id", "home_elo", "away_elo"]
    return rated.join(wrong, "competition_id", "left_anti").select(*columns).unionByName(again.select(*columns))
