"""Simulations in rounds: the same seasons, and only one round's results on disk at a time."""

import os
import random

from contestry.operators import forecast
from contestry.sources import store


def test_rounds_leave_nothing_and_change_nothing(spark, monkeypatch):
    monkeypatch.setattr(forecast, "SEATS", 3)
    monkeypatch.setattr(forecast, "BLOCK", 7)
    rng = random.Random(4)
    table = spark.createDataFrame([(1, t, rng.randrange(6), rng.randrange(3), rng.randrange(2)) for t in range(1, 9)], "g int, team_id long, points int, gd int, gf int")
    rest = spark.createDataFrame([(1, 100 + 9 * h + a, h, a, 0.3, 0.3, 0.4) for h in range(1, 9) for a in range(h + 1, 10)], "g int, match_id long, home_team_id long, away_team_id long, p_away double, p_draw double, p_home double")
    on_disk, most = [], []

    def watched(df, name):
        out = store.stored(df, name)
        if name == "sides":
            on_disk.append(out.stored_in.removeprefix("file://"))
            most.append(sum(map(os.path.exists, on_disk)))
        return out

    monkeypatch.setattr(forecast, "stored", watched)
    outlooks = []
    for room, rounds in ((1, 4), (2 << 30, 1)):  # 25 simulations are four blocks
        monkeypatch.setattr(forecast, "ROUND_BYTES", room)
        on_disk.clear()
        outlooks.append(sorted(map(tuple, forecast.simulate(table, rest, 25, ["g"]).collect())))
        assert len(on_disk) == rounds and not any(map(os.path.exists, on_disk))
    assert outlooks[0] == outlooks[1] and len(outlooks[0]) == 8 and set(most) == {1}


def test_shuffle_files_go_with_their_query(spark):
    name = "spark.sql.classic.shuffleDependency.fileCleanup.enabled"
    before = spark.conf.get(name, None)
    with store.cleaned(spark):
        assert spark.conf.get(name) == "true"
    assert spark.conf.get(name, None) == before
