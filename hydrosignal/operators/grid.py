"""Roll-ups to a regular step and complete grids."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from hydrosignal.functions import times


def hourly_rollup(
    df: DataFrame,
    keys: Sequence[str],
    time: str,
    means: Sequence[str] = (),
    maxima: Sequence[str] = (),
    out: str = "hour",
) -> DataFrame:
    """One row per (series, hour), hour labelled by its end; map-side combined."""
    return (
        df.groupBy(*keys, times.ceil_hour(F.col(time)).alias(out))
        .agg(
            F.count(F.lit(1)).alias("n_hour"),
            *[F.avg(c).alias(c) for c in means],
            *[F.max(c).alias(c) for c in maxima],
        )
    )


def daily_rollup(
    df: DataFrame,
    keys: Sequence[str],
    time: str,
    spread: Sequence[str] = (),
    depth: str | None = None,
    count: str | None = None,
    day_tz: str = "UTC",
) -> DataFrame:
    """Daily hours, observation count, min/max/mean per variable, sum/max of the depth column."""
    aggs = [F.count(F.lit(1)).alias("n_day")]
    if count:
        aggs.append(F.sum(count).alias(count))
    for c in spread:
        aggs += [F.min(c).alias(f"{c}_min"), F.max(c).alias(f"{c}_max"), F.avg(c).alias(f"{c}_mean")]
    if depth:
        aggs += [F.sum(depth).alias(f"{depth}_sum"), F.max(depth).alias(f"{depth}_max")]
    return df.groupBy(*keys, times.local_date(F.col(time), day_tz).alias("date")).agg(*aggs)


def fill_gaps(df: DataFrame, keys: Sequence[str], time: str, step: str = "1 hour") -> DataFrame:
    """Insert the missing steps between the first and last row of every series.

    Each row expands to itself plus the steps up to its successor, so no second scan and
    no join is needed and the series partitioning is kept for the windows that follow.
    Inserted rows have nulls and ``missing`` = true. Input has one row per (series, step).
    """
    step_expr = f"INTERVAL {step}"
    following = F.lead(time).over(Window.partitionBy(*keys).orderBy(time))
    values = [c for c in df.columns if c not in (*keys, time)]
    # An inserted row lies strictly after the row it was expanded from.
    expanded = df.withColumn("_until", F.coalesce(following - F.expr(step_expr), F.col(time))).select(
        *keys,
        F.explode(F.sequence(F.col(time), F.greatest("_until", time), F.expr(step_expr))).alias("_step"),
        F.col(time).alias("_own"),
        *values,
    )
    own = F.col("_step") == F.col("_own")
    return expanded.select(
        *keys,
        F.col("_step").alias(time),
        *[F.when(own, F.col(c)).alias(c) for c in values],
        (~own).alias("missing"),
    )


def complete_between(
    df: DataFrame, keys: Sequence[str], time: str, start: Column, end: Column, step: str = "1 day"
) -> DataFrame:
    """Every step between two given bounds for every series; absent rows get nulls."""
    grid = df.select(*keys).distinct().withColumn(time, F.explode(F.sequence(start, end, F.expr(f"INTERVAL {step}"))))
    return grid.join(df, [*keys, time], "left")


def time_sequence(spark, start: Column, end: Column, step: str, name: str = "timestamp") -> DataFrame:
    """A driver-free time sequence with any step."""
    return spark.range(1).select(F.explode(F.sequence(start, end, F.expr(f"INTERVAL {step}"))).alias(name))


def hourly_series(
    df: DataFrame,
    keys: Sequence[str],
    time: str,
    means: Sequence[str] = (),
    maxima: Sequence[str] = (),
) -> DataFrame:
    """Roll-up on a complete hourly grid: missing hours flagged, maxima (rain depth) set to 0."""
    rolled = hourly_rollup(df, keys, time, means, maxima)
    filled = fill_gaps(rolled, keys, "hour")
    zero = {c: F.coalesce(F.col(c), F.lit(0.0)) for c in maxima}
    return filled.withColumns({"n_hour": F.coalesce("n_hour", F.lit(0)), **zero}).withColumnRenamed(
        "missing", "missing_hour"
    )
