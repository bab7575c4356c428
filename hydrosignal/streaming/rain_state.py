"""Rain events of arriving hours, segmented in keyed state with event-time timers.

A series keeps a few numbers: the running event, the wet spell that may still grow, and the hours
that the watermark has not passed yet, one array per day. Hours before the watermark are worked off
for good; later ones are only looked at, so that every call hands on the events as the batch
operator would see them at that moment. Events are named by their first hour; a later row of the
same name replaces the earlier one, and an event that a late hour has joined to another is handed on
once more without a number.
"""

from __future__ import annotations

from collections.abc import Iterator, Sequence
from contextlib import contextmanager
from dataclasses import asdict, dataclass, fields

import numpy as np
import pandas as pd
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.streaming.stateful_processor import StatefulProcessor

from hydrosignal.operators.events import EVENT_MIN_DEPTH, INTEREVENT_HOURS, SINCE_DEPTHS, since_name

HOURS_PER_DAY = 24
HOUR_MS = 3_600_000
PROVIDER = "spark.sql.streaming.stateStore.providerClass"
ROCKS = "org.apache.spark.sql.execution.streaming.state.RocksDBStateStoreProvider"

EVENTS = (
    "series_id string, first_hour timestamp, last_hour timestamp, event_id long, wet int, event_precip_sum double, "
    "event_precip_max double, first_wet timestamp, last_wet timestamp, series_start timestamp, last_hits array<timestamp>, closed boolean, version long"
)


@dataclass
class Track:
    """What is known of a series up to the hour before ``next``; hours are numbers since 1970.

    ``first``, ``number``, ``wet``, ``total``, ``peak``: the running event. ``spell`` starts the wet
    spell whose dry run has not ended it yet (-1: none), with its first and last rainy hour, depth and peak.
    ``hits`` are the last hours of the latest events of each depth, ``shown`` the first hours of the
    events that were handed on and may still change, both as text.
    """

    start: int
    next: int
    newest: int
    first: int
    number: int = 0
    wet: int = 0
    total: float = 0.0
    peak: float = 0.0
    spell: int = -1
    rain_from: int = -1
    rain_at: int = -1
    depth: float = 0.0
    height: float = 0.0
    hits: str = ""
    shown: str = ""
    version: int = 0

    def rained(self) -> tuple[int | None, int | None]:
        """First and last rainy hour of the running event; none of a dry one."""
        return (self.rain_from, self.rain_at) if self.wet else (None, None)

    def last_hits(self, n: int) -> list[int]:
        return [int(h) for h in self.hits.split()] if self.hits else [self.start - 1] * n


_KINDS = {"int": "long", "float": "double", "str": "string"}
TRACK = ", ".join(f"{f.name} {_KINDS[f.type]}" for f in fields(Track))


def advance(t: Track, rain: np.ndarray, min_depth: float, gap: int, depths: Sequence[float]) -> list[tuple]:
    """Works off the hours from ``t.next``; returns the events that they end.

    Only rainy hours are visited one by one: a dry run matters by its length alone.
    """
    closed: list[tuple] = []

    def close(last: int) -> None:
        if last >= t.first:
            closed.append((t.first, last, t.number, t.wet, t.total, t.peak, *t.rained(), t.last_hits(len(depths)), True))
        if t.wet:
            t.hits = " ".join(str(last if t.total >= d else h) for d, h in zip(depths, t.last_hits(len(depths)), strict=True))

    def dry_until(hour: int) -> None:
        """No rain fell from the hour after ``rain_at`` to ``hour``."""
        if t.spell < 0 or hour - t.rain_at < gap:
            return
        if t.wet:
            close(t.rain_at)
            t.first, t.number, t.wet, t.total, t.peak = t.rain_at + 1, t.number + 1, 0, 0.0, 0.0
        t.spell = -1

    begin = t.next
    for i in np.flatnonzero(rain > 0).tolist():
        hour, fell = begin + i, float(rain[i])
        dry_until(hour - 1)
        if t.spell < 0:
            # a short dry run at the start of the series belongs to its first spell
            t.spell = t.start if t.rain_at < 0 and hour - t.start < gap else hour
            t.rain_from, t.depth, t.height = hour, 0.0, 0.0
        t.rain_at = hour
        t.depth += fell
        t.height = max(t.height, fell)
        if not t.wet and t.depth > min_depth:
            if t.spell > t.first:
                close(t.spell - 1)
            t.first, t.number, t.wet = t.spell, t.number + 1, 1
        if t.wet:
            t.total, t.peak = t.depth, t.height
    t.next = begin + len(rain)
    dry_until(t.next - 1)
    return closed


class RainEvents(StatefulProcessor):
    """Segments the hours of each series; see the module's text."""

    def __init__(self, time: str, precip: str, min_depth: float, gap: int, depths: Sequence[float]):
        self.time, self.precip = time, precip
        self.rule = (min_depth, gap, tuple(depths))

    def init(self, handle) -> None:
        self.handle = handle
        self.track = handle.getValueState("track", TRACK)
        self.days = handle.getMapState("days", "day long", "hours binary")

    def close(self) -> None:
        pass

    def handleInputRows(self, key, rows: Iterator[pd.DataFrame], timerValues) -> Iterator[pd.DataFrame]:
        t = self._load()
        for part in rows:
            hours = part[self.time].to_numpy("datetime64[h]").astype(np.int64)
            fell = part[self.precip].to_numpy(np.float64, na_value=0.0)
            known = ~pd.isna(part[self.time]).to_numpy()
            hours, fell = hours[known], np.nan_to_num(fell[known])
            if not len(hours):
                continue
            if t is None:
                t = Track(int(hours.min()), int(hours.min()), int(hours.max()), int(hours.min()))
            elif t.next == t.start and hours.min() < t.start:
                # nothing has been worked off yet, so the series may still begin earlier
                t.start = t.next = t.first = int(hours.min())
            hours, fell = hours[hours >= t.next], fell[hours >= t.next]
            for day in np.unique(hours // HOURS_PER_DAY).tolist():
                inside = hours // HOURS_PER_DAY == day
                held = self._day(day).copy()
                np.maximum.at(held, hours[inside] % HOURS_PER_DAY, fell[inside])
                self.days.updateValue((day,), (held.tobytes(),))
            t.newest = max(t.newest, int(hours.max(initial=t.newest)))
        yield from self._hand_on(key, t, timerValues)

    def handleExpiredTimer(self, key, timerValues, expiredTimerInfo) -> Iterator[pd.DataFrame]:
        yield from self._hand_on(key, self._load(), timerValues)

    def _load(self) -> Track | None:
        return Track(*self.track.get()) if self.track.exists() else None

    def _day(self, day: int) -> np.ndarray:
        if self.days.containsKey((day,)):
            return np.frombuffer(self.days.getValue((day,))[0])
        return np.zeros(HOURS_PER_DAY)

    def _rain(self, a: int, b: int) -> Iterator[np.ndarray]:
        """Rain of the hours from a up to b, a day at a time; an hour that never came is dry."""
        while a < b:
            stop = min((a // HOURS_PER_DAY + 1) * HOURS_PER_DAY, b)
            yield self._day(a // HOURS_PER_DAY)[a % HOURS_PER_DAY : (stop - 1) % HOURS_PER_DAY + 1]
            a = stop

    def _hand_on(self, key, t: Track | None, timers) -> Iterator[pd.DataFrame]:
        if t is None:
            return
        passed = max(timers.getCurrentWatermarkInMs(), 0) // HOUR_MS // HOURS_PER_DAY * HOURS_PER_DAY
        final = min(max(passed, t.next), t.newest + 1)
        found: list[tuple] = []
        begin = t.next
        for rain in self._rain(begin, final):
            found += advance(t, rain, *self.rule)
        for day in range(begin // HOURS_PER_DAY, t.next // HOURS_PER_DAY):
            if self.days.containsKey((day,)):
                self.days.removeKey((day,))
        t.version += 1
        seen = Track(**asdict(t))
        for rain in self._rain(t.next, t.newest + 1):
            found += [(*e[:-1], False) for e in advance(seen, rain, *self.rule)]
        # nothing of an event that has just ended may be left to show, not even an hour
        if seen.newest >= seen.first:
            found.append((seen.first, seen.newest, seen.number, seen.wet, seen.total, seen.peak, *seen.rained(), seen.last_hits(len(self.rule[2])), False))
        names = {e[0] for e in found}
        found += [(int(h), int(h), None, None, None, None, None, None, [], False) for h in t.shown.split() if int(h) not in names]
        t.shown = " ".join(str(e[0]) for e in found if not e[-1] and e[2] is not None)
        self.track.update(tuple(asdict(t).values()))
        if t.next <= t.newest:
            self.handle.registerTimer((t.newest // HOURS_PER_DAY + 1) * HOURS_PER_DAY * HOUR_MS)
        yield self._frame(key, t, found)

    def _frame(self, key, t: Track, found: list[tuple]) -> pd.DataFrame:
        def instant(hours):
            return pd.to_datetime(pd.array(hours, "Int64") * 3600, unit="s").as_unit("us")

        first, last, number, wet, total, peak, wet_from, wet_to, hits, closed = zip(*found, strict=True) if found else [()] * 10
        return pd.DataFrame(
            {
                "series_id": [key[0]] * len(found),
                "first_hour": instant(first),
                "last_hour": instant(last),
                "event_id": pd.array(number, "Int64"),
                "wet": pd.array(wet, "Int32"),
                "event_precip_sum": np.asarray(total, float),
                "event_precip_max": np.asarray(peak, float),
                "first_wet": instant(wet_from),
                "last_wet": instant(wet_to),
                "series_start": instant([t.start] * len(found)),
                "last_hits": [list(instant(h).to_pydatetime()) if h else [] for h in hits],
                "closed": np.asarray(closed, bool),
                "version": np.full(len(found), t.version, np.int64),
            }
        )


def rain_event_stream(
    hours: DataFrame,
    key: str,
    time: str,
    precip: str = "precip",
    delay: str = "1 day",
    min_depth: float = EVENT_MIN_DEPTH,
    gap_hours: int = INTEREVENT_HOURS,
    depths: Sequence[float] = SINCE_DEPTHS,
) -> DataFrame:
    """Events of each series in update mode, one row per event and delivery that touches it.

    ``hours`` is a stream of (series, hour, precip): hours may come in any order within ``delay``,
    repeated (the larger value counts) or not at all (a missing hour between others is dry). Later
    ones are dropped, as the watermark says. Hours without a series or time count for nothing, a
    null precip as 0. ``last_hits`` has, for each of ``depths``, the last hour of the latest event
    before this one that reached it (``first_wet`` and ``last_wet`` are the ends of its own rain); before any, the hour before the series starts. Rows with the
    same (series, first_hour) are the same event, the greatest ``version`` counts; where that has no
    event_id, the event is gone. The state of a
    series is bounded by the delay. Needs the state store that ``rocks_state`` sets.
    """
    known = hours.filter(F.col(key).isNotNull() & F.col(time).isNotNull()).select(F.col(key).cast("string").alias("series_id"), time, precip)
    return (
        known.withWatermark(time, delay)
        .groupBy("series_id")
        .transformWithStateInPandas(
            RainEvents(time, precip, min_depth, gap_hours, depths), outputStructType=EVENTS, outputMode="Update", timeMode="EventTime"
        )
    )


@contextmanager
def rocks_state(spark: SparkSession):
    """Streams started inside keep their state in RocksDB, which keyed state with timers needs."""
    before = spark.conf.get(PROVIDER, None)
    spark.conf.set(PROVIDER, ROCKS)
    try:
        yield
    finally:
        if before is None:
            spark.conf.unset(PROVIDER)
        else:
            spark.conf.set(PROVIDER, before)


def event_hours(events: DataFrame, depths: Sequence[float] = SINCE_DEPTHS, time: str = "hour") -> DataFrame:
    """Every hour of the events: its place, the event's figures, and the hours since an event of each depth."""
    hour = F.explode(F.expr("sequence(first_hour, last_hour, interval 1 hour)")).alias(time)
    each = events.filter("event_id IS NOT NULL").select("*", hour)
    apart = lambda a: ((F.unix_seconds(F.col(time)) - F.unix_seconds(a)) / 3600).cast("long")
    return each.select(
        "series_id",
        time,
        "event_id",
        "wet",
        (apart(F.col("first_hour")) + 1).cast("int").alias("event_hour"),
        ((F.unix_seconds("last_hour") - F.unix_seconds("first_hour")) / 3600 + 1).cast("long").alias("event_duration"),
        F.when(F.col("wet") == 1, "Wet").otherwise("Dry").alias("event_type"),
        "event_precip_sum",
        "event_precip_max",
        *[
            F.when(F.col("event_precip_sum") >= d, F.lit(0).cast("long")).otherwise(apart(F.col("last_hits")[i])).alias(since_name(d))
            for i, d in enumerate(depths)
        ],
    )
