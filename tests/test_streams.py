"""Batch sinks of the streams do not depend on the order of deliveries."""

import random
from datetime import datetime, timedelta
from types import SimpleNamespace

import numpy as np
import pandas as pd
import pytest
from pyspark.sql import functions as F

from hydrosignal.operators import rolling
from hydrosignal.session import scratch_dir
from hydrosignal.streaming import hourly, rain_state


@pytest.mark.parametrize("newest_first", [False, True])
def test_newest_version_wins_in_any_order(spark, newest_first):
    old = spark.createDataFrame([(1, "d1", "old", 1), (2, "d1", "only", 1)], "k int, day string, v string, version int")
    new = spark.createDataFrame([(1, "d1", "new", 2)], old.schema)
    path = scratch_dir(spark, "versions")
    sink = hourly.upsert_sink(path, old.schema, ["k"], [F.col("version").desc()], "day", newer_only=True)
    for i, batch in enumerate([new, old, new] if newest_first else [old, new, old]):
        sink(batch, i)
    assert {r["k"]: r["v"] for r in spark.read.parquet(path).collect()} == {1: "new", 2: "only"}


@pytest.mark.parametrize("order", [(0, 1, 2), (2, 0, 1)])
def test_antecedent_grid_of_deliveries_equals_whole(spark, order):
    rnd = random.Random(5)
    start = datetime(2024, 1, 1, 5)
    rows = [(s, start + timedelta(hours=i), rnd.choice([0.0, 0.0, 0.1, 0.4])) for s in "ab" for i in range(150)]
    df = spark.createDataFrame(rows, "series_id string, hour timestamp, precip double").withColumn("day", F.to_date("hour"))
    hours_path, grid_path = scratch_dir(spark, "hours"), scratch_dir(spark, "grid")
    sink = hourly.antecedent_sink(hours_path, grid_path, df.schema, ["series_id"], "hour", widths=(6, 24), lag_hours=(0, 7))
    cut = [start + timedelta(hours=h) for h in (0, 40, 101, 150)]
    for i in order:
        sink(df.filter(F.col("hour").between(cut[i], cut[i + 1] - timedelta(hours=1))), i)
    got = spark.read.parquet(grid_path).drop("day")
    want = rolling.antecedent(df.drop("day"), ["series_id"], "hour", widths=(6, 24), lag_hours=(0, 7))
    assert got.count() == 300 and got.select(want.columns).exceptAll(want).isEmpty()


class _State:
    """The state of one series, kept in memory."""

    def __init__(self):
        self.value, self.map, self.timers = None, {}, []

    getValueState = getMapState = lambda self, *_: self
    registerTimer = lambda self, at: self.timers.append(at)
    exists = lambda self: self.value is not None
    get = lambda self: self.value
    update = lambda self, v: setattr(self, "value", v)
    containsKey = lambda self, k: k in self.map
    getValue = lambda self, k: self.map[k]
    updateValue = lambda self, k, v: self.map.update({k: v})
    removeKey = lambda self, k: self.map.pop(k)


def _plain_events(rain, start):
    """Events of a complete series by the batch rules: first hour -> (last hour, number, wet, depth, peak)."""
    n, wet = len(rain), rain > 0
    runs = np.split(np.arange(n), np.flatnonzero(np.diff(wet.astype(int))) + 1)
    for r in runs:
        wet[r] = wet[r][0] or len(r) < 8
    for r in np.split(np.arange(n), np.flatnonzero(np.diff(wet.astype(int))) + 1):
        wet[r] = rain[r].sum() > 0.1
    out = {}
    for k, r in enumerate(np.split(np.arange(n), np.flatnonzero(np.diff(wet.astype(int))) + 1)):
        w = bool(wet[r[0]])
        out[start + int(r[0])] = (start + int(r[-1]), k + int(wet[0]), int(w), round(rain[r].sum() * w, 9), rain[r].max() * w)
    return out


@pytest.mark.parametrize("seed", range(12))
def test_events_of_deliveries_equal_batch(seed):
    """Hours in any order within the delay, some missing, some twice; the table after every delivery equals the batch."""
    rnd = np.random.default_rng(seed)
    n, start = int(rnd.integers(30, 400)), 450_000 + int(rnd.integers(0, 24))
    rain = np.where(rnd.random(n) < rnd.choice([0.05, 0.15, 0.4]), rnd.choice([0.02, 0.06, 0.3], n), 0.0)
    here = (rain > 0) | (rnd.random(n) < 0.7)
    here[[0, -1]] = True
    come = np.flatnonzero(here) + rnd.integers(0, 20, here.sum())  # arrival, at most 20 hours late
    order = np.flatnonzero(here)[np.argsort(come, kind="stable")]
    state, table, newest = _State(), {}, 0
    rule = rain_state.RainEvents("hour", "precip", 0.1, 8, (0.1, 0.5))
    rule.init(state)
    for part in np.array_split(order, int(rnd.integers(1, 9))):
        part = np.append(part, part[:1])
        passed = SimpleNamespace(getCurrentWatermarkInMs=lambda: max(0, (newest - 24) * rain_state.HOUR_MS))
        frame = pd.DataFrame({"hour": pd.to_datetime((start + part) * 3600, unit="s"), "precip": rain[part]})
        for out in rule.handleInputRows(("s",), iter([frame[: len(part) // 2], frame[len(part) // 2 :]]), passed):
            for r in out.itertuples():
                table[r.first_hour] = r
        newest = max(newest, start + int(part.max()))
        seen = order[: np.flatnonzero(order == part[-2])[0] + 1] if len(part) > 1 else part
        got = {int(k.timestamp()) // 3600: (int(r.last_hour.timestamp()) // 3600, r.event_id, r.wet, round(r.event_precip_sum, 9), r.event_precip_max) for k, r in table.items() if not pd.isna(r.event_id)}
        known = np.zeros(seen.max() - seen.min() + 1)
        known[seen - seen.min()] = rain[seen]
        assert got == _plain_events(known, start + int(seen.min()))
    list(rule.handleExpiredTimer(("s",), passed, None))
    assert len(state.map) <= 3


def test_a_quiet_series_is_worked_off_by_its_timer():
    state = _State()
    rule = rain_state.RainEvents("hour", "precip", 0.1, 8, (0.1,))
    rule.init(state)
    frame = pd.DataFrame({"hour": pd.to_datetime([450_000 * 3600, 450_001 * 3600, None], unit="s"), "precip": [0.2, None, 3.0]})
    early = SimpleNamespace(getCurrentWatermarkInMs=lambda: 0)
    assert len(next(iter(rule.handleInputRows(("s",), iter([frame]), early)))) == 1 and state.timers and state.map
    late = SimpleNamespace(getCurrentWatermarkInMs=lambda: state.timers[0] + 1)
    out = next(iter(rule.handleExpiredTimer(("s",), late, None)))
    assert out.wet.tolist() == [1] and out.event_precip_sum.tolist() == [0.2] and len(state.map) == 1
