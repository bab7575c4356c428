"""Hourly weather series and weather predictors."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from hydrosignal.functions import times
from hydrosignal.operators import events, fill, grid, rolling
from hydrosignal.sources import payloads

METAR_VARIABLES = ("temp", "dewpt", "wspd", "pressure")
DOCUMENT_VARIABLES = ("temp", "dewpt", "hum", "wspd", "vis", "pressure")
DOCUMENT_PREDICTORS = ("temp", "dewpt", "hum", "wspd", "pressure")


def hourly_from_observations(
    obs: DataFrame, keys: Sequence[str], time: str, variables: Sequence[str], precip: str = "precip"
) -> DataFrame:
    """Observations to a complete hourly series: means interpolated over gaps, missing rain 0."""
    hours = grid.hourly_series(obs, keys, time, variables, [precip])
    return fill.interpolate(hours, keys, "hour", variables)


def metar_series(docs: DataFrame, keys: Sequence[str], start: Column, end: Column) -> DataFrame:
    rows = payloads.metar_units(payloads.metar_hourly(docs, start, end), list(keys))
    return hourly_from_observations(rows, keys, "timestamp", METAR_VARIABLES)


def document_series(docs: DataFrame, keys: Sequence[str]) -> DataFrame:
    rows = payloads.clean_weather(payloads.weather_observations(docs), list(keys))
    return hourly_from_observations(rows, keys, "utc_timestamp", DOCUMENT_VARIABLES)


def prior_day_means(
    hours: DataFrame, keys: Sequence[str], time: str, cols: Sequence[str], day_tz: str = "UTC"
) -> DataFrame:
    """Adds the mean of the calendar day before, null when that day has no hours.

    A range frame of exactly one day back, so the daily table is neither built nor joined
    and the hourly series is computed once.
    """
    day = F.datediff(times.local_date(F.col(time), day_tz), F.lit("1970-01-01").cast("date"))
    before = Window.partitionBy(*keys).orderBy(day).rangeBetween(-1, -1)
    return hours.withColumns({f"{c}_mean_p1d": F.avg(c).over(before) for c in cols})


def weather_predictors(
    hours: DataFrame,
    keys: Sequence[str],
    time: str = "hour",
    variables: Sequence[str] = METAR_VARIABLES,
    precip: str = "precip",
    day_tz: str = "UTC",
) -> DataFrame:
    """All weather predictors of an hourly series as columns of one frame.

    After the roll-up there is one shuffle, by series; every window reuses it and nothing
    is joined.
    """
    w = hours.withColumn("date", times.local_date(F.col(time), day_tz))
    w = events.rain_events(w, keys, time, precip)
    w = events.event_columns(w, keys, time, precip)
    w = events.hours_since(w, keys, time)
    w = rolling.rolling_means(w, keys, time, variables)
    w = rolling.changes(w, keys, time, variables)
    w = rolling.antecedent(w, keys, time, precip)
    w = prior_day_means(w, keys, time, variables, day_tz)
    rain = [
        f"{precip}_{a}_p{k}hr_lag{n}hr" for k in rolling.RAIN_WIDTHS for n in rolling.RAIN_LAGS for a in ("sum", "max")
    ]
    trend = [f"{v}_{m}_p{k}hr" for k in rolling.WEATHER_WIDTHS for m in ("mean", "change") for v in variables]
    return w.select(
        *keys,
        "date",
        time,
        *variables,
        *trend,
        *[f"{v}_mean_p1d" for v in variables],
        "event_type",
        *[events.since_name(d) for d in events.SINCE_DEPTHS],
        *rain,
    )
