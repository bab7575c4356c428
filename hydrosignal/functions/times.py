"""Instant, wall-clock and calendar expressions."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

# Abbreviations by UTC offset in hours for the default local zone.
EASTERN_NAMES = {-5: "EST", -4: "EDT"}
EASTERN = "US/Eastern"


def as_instant(ts: Column) -> Column:
    """Zone-less timestamps become instants; read under a UTC session they keep their clock value."""
    return ts.cast("timestamp")


def from_parts(year, month, day, hour, minute) -> Column:
    """Instant (UTC) from string or numeric parts; unparsable parts give null."""
    part = lambda c, n: F.lpad(c.cast("string"), n, "0")
    text = F.concat_ws(
        " ",
        F.concat_ws("-", part(year, 4), part(month, 2), part(day, 2)),
        F.concat_ws(":", part(hour, 2), part(minute, 2)),
    )
    return F.try_to_timestamp(text, F.lit("yyyy-MM-dd HH:mm"))


def floor_hour(ts: Column) -> Column:
    return F.date_trunc("hour", ts)


def ceil_hour(ts: Column) -> Column:
    """The hour a reading belongs to: 06:54 goes to 07:00, an exact hour stays."""
    start = F.date_trunc("hour", ts)
    return F.when(ts == start, ts).otherwise(start + F.expr("INTERVAL 1 HOUR"))


def wall_clock(ts: Column, tz: str = EASTERN) -> Column:
    return F.from_utc_timestamp(ts, tz)


def instant_of(wall: Column, tz: str = EASTERN) -> Column:
    return F.to_utc_timestamp(wall, tz)


def local_date(ts: Column, tz: str = "UTC") -> Column:
    return F.to_date(ts if tz == "UTC" else F.from_utc_timestamp(ts, tz))


def calendar(ts: Column, tz: str = "UTC") -> dict[str, Column]:
    """Calendar parts of an instant in one zone, by column name."""
    wall = ts if tz == "UTC" else F.from_utc_timestamp(ts, tz)
    return {
        "date": F.to_date(wall),
        "year": F.year(wall),
        "month": F.month(wall),
        "day": F.dayofmonth(wall),
        "jday": F.dayofyear(wall),
        "hour": F.hour(wall),
        "minute": F.minute(wall),
    }


def day_label(ts: Column, tz: str = EASTERN) -> Column:
    return F.date_format(F.from_utc_timestamp(ts, tz), "MMM dd yyyy")


def local_text(ts: Column, tz: str = EASTERN, zone_names: dict[int, str] | None = None) -> Column:
    """Text such as ``Jan 5 2024 13:04 pm EST``."""
    wall = F.from_utc_timestamp(ts, tz)
    offset = (F.unix_seconds(wall) - F.unix_seconds(ts)) / 3600
    zone = F.lit(tz)
    for hours, label in (zone_names or EASTERN_NAMES).items():
        zone = F.when(offset == hours, F.lit(label)).otherwise(zone)
    return F.concat_ws(
        " ", F.date_format(wall, "MMM d yyyy H:mm"), F.lower(F.date_format(wall, "a")), zone
    )


def parse_local(text: Column, tz: str = EASTERN) -> Column:
    """Accepts ``2017-10-01 07:00`` and ``201710010700``; anything else is null."""
    wall = F.coalesce(
        F.try_to_timestamp(text, F.lit("yyyy-MM-dd HH:mm")),
        F.try_to_timestamp(text, F.lit("yyyyMMddHHmm")),
    )
    return F.to_utc_timestamp(wall, tz)


def day_bounds(day: Column, tz: str = EASTERN) -> tuple[Column, Column]:
    """First and last second of a local day as UTC instants (23 or 25 h on DST days)."""
    start = F.to_utc_timestamp(day.cast("timestamp"), tz)
    end = F.to_utc_timestamp(F.date_add(day, 1).cast("timestamp"), tz) - F.expr("INTERVAL 1 SECOND")
    return start, end
