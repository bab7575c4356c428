"""Daily flow series and flow predictors."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from hydrosignal.operators import fill, grid, reshape, rolling

LAG_DAYS = (1, 2, 3, 4, 5)
CHANGE_DAYS = (2, 3, 4, 5)


def flow_series(flow: DataFrame, keys: Sequence[str], start: Column, end: Column, date: str = "date") -> DataFrame:
    """Daily flow of the given range, every day of every station present."""
    wanted = flow.filter(F.col(date).between(start, end)).select(*keys, date, "flow")
    return grid.complete_between(wanted, keys, date, start, end)


def flow_features(flow: DataFrame, keys: Sequence[str], date: str = "date") -> DataFrame:
    """Lags and lag differences of flow and log flow: 18 columns per row."""
    log = flow.withColumn("logflow", F.log10(F.when(F.col("flow") > 0, F.col("flow"))))
    out = rolling.lags(log, keys, date, ["flow", "logflow"], LAG_DAYS)
    return rolling.lag_changes(out, keys, date, ["flow", "logflow"], CHANGE_DAYS).drop("flow", "logflow")


def feature_names() -> list[str]:
    return [f"{v}_p{d}d" for d in LAG_DAYS for v in ("flow", "logflow")] + [
        f"{v}_change_p{d}d_p1d" for d in CHANGE_DAYS for v in ("flow", "logflow")
    ]


def flow_predictors(flow: DataFrame, site: str, sites: Sequence[str], date: str = "date") -> DataFrame:
    """One row per date with the 18 features of every listed site side by side."""
    return reshape.pivot_series(flow_features(flow, [site], date), [date], site, sites, feature_names())


def hourly_flow(
    flow: DataFrame, keys: Sequence[str], time: str, values: Sequence[str], carried: Sequence[str] = ()
) -> DataFrame:
    """Daily flow on an hourly grid: values interpolated, descriptive columns carried forward."""
    hours = grid.fill_gaps(flow, keys, time, "1 hour").drop("missing")
    if carried:
        hours = fill.forward_fill(hours, keys, time, carried)
    # pandas-style interpolation repeats the last value at the tail; the grid ends at a known day
    return fill.interpolate(hours, keys, time, values)


def flow_derivative(flow: DataFrame, keys: Sequence[str], time: str, col: str = "flow") -> DataFrame:
    return flow.withColumn(
        f"{col}_deriv", F.col(col) - F.lag(col, 1).over(Window.partitionBy(*keys).orderBy(time))
    )
