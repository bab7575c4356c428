"""Arriving observations: de-duplication, hourly windows, rain sessions, sliding sums, upserts."""

from __future__ import annotations

from collections.abc import Callable, Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from hydrosignal.operators import rolling
from hydrosignal.operators.ordered import first_per_key
from hydrosignal.session import scratch_dir
from hydrosignal.sources.keyed import upsert, write_partitions

_JUST_BEFORE = "INTERVAL 1 MICROSECOND"


def deduplicated(obs: DataFrame, time: str, identity: Sequence[str], delay: str = "1 day") -> DataFrame:
    """First delivery of every observation; state is kept for the allowed lateness only."""
    return obs.withWatermark(time, delay).dropDuplicatesWithinWatermark(list(identity))


def hourly_windows(
    obs: DataFrame, keys: Sequence[str], time: str, means: Sequence[str], maxima: Sequence[str], delay: str = "1 day"
) -> DataFrame:
    """Hourly roll-up labelled by the window end.

    Times move back one microsecond so that a reading on the exact hour belongs to the
    hour that ends there, as in the batch roll-up.
    """
    shifted = obs.withColumn("_t", F.col(time) - F.expr(_JUST_BEFORE)).withWatermark("_t", delay)
    return (
        shifted.groupBy(F.window("_t", "1 hour"), *keys)
        .agg(
            F.count(F.lit(1)).alias("n_hour"),
            *[F.avg(c).alias(c) for c in means],
            *[F.max(c).alias(c) for c in maxima],
        )
        .select(*keys, F.col("window.end").alias("hour"), "n_hour", *means, *maxima)
    )


def sliding_sums(
    hours: DataFrame, keys: Sequence[str], time: str, value: str, width_hours: int, delay: str = "1 day"
) -> DataFrame:
    """Trailing sum and max of one width for every hour, on hour-labelled rows."""
    shifted = hours.withColumn("_t", F.col(time) - F.expr(_JUST_BEFORE)).withWatermark("_t", delay)
    return (
        shifted.groupBy(F.window("_t", f"{width_hours} hours", "1 hour"), *keys)
        .agg(F.sum(value).alias("total"), F.max(value).alias("peak"), F.count(F.lit(1)).alias("n"))
        .select(
            *keys,
            F.col("window.end").alias("hour"),
            F.round("total", 8).alias(f"{value}_sum_p{width_hours}hr_lag0hr"),
            F.round("peak", 8).alias(f"{value}_max_p{width_hours}hr_lag0hr"),
            "n",
        )
    )


def rain_sessions(
    hours: DataFrame,
    keys: Sequence[str],
    time: str,
    precip: str = "precip",
    gap: str = "8 hours",
    min_depth: float = 0.1,
    delay: str = "1 day",
) -> DataFrame:
    """Rain events as sessions of wet hours; spells not deeper than the minimum are left out."""
    # The condition mentions the time so that it is not moved below the watermark: dry
    # hours must advance it, or an event would stay open until the next rain.
    fell = F.when(F.col(time).isNotNull(), F.col(precip)) > 0
    wet = hours.withWatermark(time, delay).filter(fell)
    return (
        wet.groupBy(F.session_window(time, gap), *keys)
        .agg(
            F.min(time).alias("first_wet"),
            F.max(time).alias("last_wet"),
            F.sum(precip).alias("depth"),
            F.max(precip).alias("peak"),
        )
        .select(*keys, "first_wet", "last_wet", "depth", "peak")
        .filter(F.col("depth") > min_depth)
    )


def _stored(spark, path: str, schema) -> DataFrame:
    try:
        return spark.read.schema(schema).parquet(path)
    except Exception as missing:  # first batch: no table yet
        if "PATH_NOT_FOUND" not in str(missing):
            raise
        return spark.createDataFrame([], schema)


def _replace_days(merged: DataFrame, path: str, day: str, name: str) -> None:
    """The merged days are staged first, because a partition cannot be overwritten while it is read."""
    stage = scratch_dir(merged.sparkSession, name)
    merged.write.parquet(stage)
    write_partitions(merged.sparkSession.read.schema(merged.schema).parquet(stage), path, [day])


def upsert_sink(
    path: str, schema, keys: Sequence[str], version: Sequence[Column], day: str, newer_only: bool = False
) -> Callable:
    """A batch sink that merges re-delivered and late rows into a table partitioned by day.

    Only the days present in the batch are read and rewritten; a repeated batch gives the
    same table. A delivered row beats the stored one; with ``newer_only`` stored and
    delivered rows are compared by ``version``, so that the table does not depend on the
    order of deliveries. Rows of one key stay in one day.
    """

    def merge(batch: DataFrame, batch_id: int) -> None:
        if batch.isEmpty():
            return
        stored = _stored(batch.sparkSession, path, schema)
        touched = stored.join(batch.select(day).distinct(), day, "left_semi")
        if newer_only:
            merged = first_per_key(touched.unionByName(batch), keys, version)
        else:
            merged = upsert(touched, batch, keys, version)
        _replace_days(merged, path, day, f"upsert-{batch_id}")

    return merge


def antecedent_sink(
    hours_path: str,
    grid_path: str,
    schema,
    keys: Sequence[str],
    time: str,
    widths: Sequence[int] = rolling.RAIN_WIDTHS,
    lag_hours: Sequence[int] = rolling.RAIN_LAGS,
) -> Callable:
    """A batch sink that keeps the hourly table and its antecedent rain grid.

    Arriving hours replace stored ones. The grid is then computed anew for the hours that a
    changed hour reaches, with the longest width plus lag before them as context; older hours
    are not read. Hours of a series follow each other without gaps. Both tables are
    partitioned by the column ``day``.
    """
    reach = F.make_dt_interval(hours=F.lit(max(widths) + max(lag_hours)))
    keep_hours = upsert_sink(hours_path, schema, keys=[*keys, time], version=[F.col(time)], day="day")

    def merge(batch: DataFrame, batch_id: int) -> None:
        if batch.isEmpty():
            return
        spark = batch.sparkSession
        keep_hours(batch, batch_id)
        span = batch.agg(F.min(time).alias("a"), F.max(time).alias("b")).select(
            "a", "b", F.to_date(F.date_trunc("day", "a") - reach).alias("from"), F.to_date(F.col("b") + reach).alias("to")
        ).first()
        hours = spark.read.schema(schema).parquet(hours_path)
        near = hours.filter(F.col("day").between(span["from"], span["to"])).drop("day")
        grid = rolling.antecedent(near, keys, time, widths=widths, lag_hours=lag_hours)
        grid = grid.withColumn("day", F.to_date(time)).filter(F.col("day") >= F.to_date(F.lit(span["a"])))
        before = _stored(spark, grid_path, grid.schema).join(grid.select("day").distinct(), "day", "left_semi")
        _replace_days(upsert(before, grid, [*keys, time], [F.col(time)]), grid_path, "day", f"grid-{batch_id}")

    return merge
