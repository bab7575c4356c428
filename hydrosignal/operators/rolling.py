"""Bounded look-back features: lags, changes, rolling means, antecedent rainfall.

All windows here run on grids with at most one row per series and step, so a series is
bounded by the calendar (a century of hours is 876,600 rows) however many raw readings it
has. For sub-hourly grids ``in_time_parts`` cuts a series into parts with a halo.
"""

from __future__ import annotations

from collections.abc import Callable, Sequence
from functools import reduce
from math import gcd

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from hydrosignal.operators.ordered import time_part

# Rainfall windows and lags (hours) and weather windows (hours).
RAIN_WIDTHS = (12, 24, 36, 48, 72, 168)
RAIN_LAGS = (0, 6, 12, 18, 24, 36, 48)
WEATHER_WIDTHS = (24, 48, 72)


def quoted(name: str) -> str:
    return "`" + name.replace("`", "``") + "`"


def _w(keys: Sequence[str], time: str):
    return Window.partitionBy(*keys).orderBy(time)


def row_numbers(df: DataFrame, keys: Sequence[str], time: str, name: str = "row") -> DataFrame:
    return df.withColumn(name, F.row_number().over(_w(keys, time)))


def lags(df: DataFrame, keys, time, cols: Sequence[str], steps: Sequence[int], suffix: str = "d") -> DataFrame:
    w = _w(keys, time)
    return df.withColumns({f"{c}_p{n}{suffix}": F.lag(c, n).over(w) for n in steps for c in cols})


def lag_changes(df: DataFrame, keys, time, cols, steps: Sequence[int], suffix: str = "d") -> DataFrame:
    """``lag 1 - lag n``: how the value moved over the n-1 steps before the last one."""
    w = _w(keys, time)
    return df.withColumns(
        {
            f"{c}_change_p{n}{suffix}_p1{suffix}": F.lag(c, 1).over(w) - F.lag(c, n).over(w)
            for n in steps
            for c in cols
        }
    )


def first_difference(df: DataFrame, keys, time, col: str, name: str) -> DataFrame:
    return df.withColumn(name, F.col(col) - F.lag(col, 1).over(_w(keys, time)))


def rolling_means(df: DataFrame, keys, time, cols, widths=WEATHER_WIDTHS) -> DataFrame:
    """Trailing means, null until the window is full and free of nulls."""
    w = _w(keys, time)
    new = {}
    for k in widths:
        frame = w.rowsBetween(-(k - 1), 0)
        for c in cols:
            full = F.count(c).over(frame) == k
            new[f"{c}_mean_p{k}hr"] = F.when(full, F.avg(c).over(frame))
    return df.withColumns(new)


def changes(df: DataFrame, keys, time, cols, widths=WEATHER_WIDTHS) -> DataFrame:
    w = _w(keys, time)
    return df.withColumns(
        {f"{c}_change_p{k}hr": F.col(c) - F.lag(c, k).over(w) for k in widths for c in cols}
    )


#: Beyond so many blocks a frame per width is cheaper than lagged copies.
MOST_BLOCKS = 48


def _antecedent_by_frames(df, keys, time, col, widths, lag_hours, digits) -> DataFrame:
    """``antecedent`` with one frame per width, for widths without a large common divisor."""
    scale = f"{10 ** digits}D"
    by = f"PARTITION BY {', '.join(map(quoted, keys))} ORDER BY {quoted(time)}"
    value, full = quoted(col), []
    for k in widths:
        frame = f"OVER ({by} ROWS BETWEEN {k - 1} PRECEDING AND CURRENT ROW)"
        for a, f in (("sum", "sum"), ("max", "max")):
            inside = f"CASE WHEN count({value}) {frame} = {k} THEN {f}({value}) {frame} ELSE 0D END"
            full.append(f"rint({inside} * {scale}) / {scale} AS _{a}{k}")
    wide = df.selectExpr(*map(quoted, df.columns), *full)
    return wide.selectExpr(
        *map(quoted, df.columns),
        *[
            (f"lag(_{a}{k}, {n}, 0D) OVER ({by})" if n else f"_{a}{k}") + f" AS {quoted(f'{col}_{a}_p{k}hr_lag{n}hr')}"
            for k in widths
            for n in lag_hours
            for a in ("sum", "max")
        ],
    )


def antecedent(
    df: DataFrame,
    keys: Sequence[str],
    time: str,
    col: str = "precip",
    widths: Sequence[int] = RAIN_WIDTHS,
    lag_hours: Sequence[int] = RAIN_LAGS,
    digits: int = 8,
) -> DataFrame:
    """Trailing sum and max for every width x lag; 0 until the window is full.

    A wide trailing window is a chain of equal blocks, so only one short frame (the
    common divisor of the widths) slides over the rows and wider windows add or compare
    lagged copies of it: 12 frame reads per row instead of 360. Values are rounded before
    they are lagged, which keeps the projections small enough to be compiled. All windows
    share one sort.
    """
    block = reduce(gcd, widths)
    if max(widths) // block > MOST_BLOCKS:
        return _antecedent_by_frames(df, keys, time, col, widths, lag_hours, digits)
    w = _w(keys, time)
    frame = w.rowsBetween(-(block - 1), 0)
    full = F.count(col).over(frame) == block
    base = df.withColumns(
        {"_s": F.when(full, F.sum(col).over(frame)), "_m": F.when(full, F.max(col).over(frame))}
    )
    # many columns: SQL text is much quicker to build than column objects
    over = f"OVER (PARTITION BY {', '.join(map(quoted, keys))} ORDER BY {quoted(time)})"
    blocks = max(widths) // block
    shifted = base.selectExpr(
        "*", *[f"lag(_{a}, {j * block}) {over} AS _{a}{j}" for j in range(blocks) for a in "sm"]
    )
    # rint on a scaled value: round() on doubles goes through decimals, many times slower
    scale = f"{10 ** digits}D"
    full = []
    for k in widths:
        n = k // block
        total = " + ".join(f"_s{j}" for j in range(n))
        # greatest() skips nulls, but the window counts only when all its blocks are full
        peak = f"greatest({', '.join(f'_m{j}' for j in range(n))})" if n > 1 else "_m0"
        full.append(f"rint(coalesce({total}, 0D) * {scale}) / {scale} AS _sum{k}")
        full.append(f"rint(CASE WHEN {total} IS NULL THEN 0D ELSE {peak} END * {scale}) / {scale} AS _max{k}")
    wide = shifted.selectExpr(*map(quoted, df.columns), *full)
    return wide.selectExpr(
        *map(quoted, df.columns),
        *[
            (f"lag(_{a}{k}, {n}, 0D) {over}" if n else f"_{a}{k}") + f" AS {quoted(f'{col}_{a}_p{k}hr_lag{n}hr')}"
            for k in widths
            for n in lag_hours
            for a in ("sum", "max")
        ],
    )


def in_time_parts(
    df: DataFrame,
    keys: Sequence[str],
    time: str,
    part_seconds: int,
    halo_seconds: int,
    feature: Callable[[DataFrame, list[str]], DataFrame],
) -> DataFrame:
    """Run a look-back feature on parts of a long series instead of on whole series.

    Rows in the last ``halo_seconds`` of a part are also given to the next part as
    history and dropped afterwards. ``feature(df, keys)`` must not look back further than
    the halo; the result is the same as on whole series.
    """
    if halo_seconds > part_seconds:
        raise ValueError("the halo must fit into one part")
    home = time_part(F.col(time), part_seconds)
    near_end = F.pmod(F.unix_seconds(F.col(time)), F.lit(part_seconds)) >= part_seconds - halo_seconds
    spread = df.withColumn("_home", home).withColumn(
        "_cell",
        F.explode(F.when(near_end, F.array("_home", F.col("_home") + 1)).otherwise(F.array("_home"))),
    )
    done = feature(spread, [*keys, "_cell"])
    return done.filter(F.col("_cell") == F.col("_home")).drop("_home", "_cell")
