"""Wet/dry segmentation of an hourly rain series and time since events."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

# Smallest event depth kept (in), dry hours that end an event,
# and the depths (in) for the hours-since columns.
EVENT_MIN_DEPTH = 0.1
INTEREVENT_HOURS = 8
SINCE_DEPTHS = (0.10, 0.25, 0.50, 1.00)


def run_ids(df: DataFrame, keys: Sequence[str], order: Sequence, flag: Column, name: str) -> DataFrame:
    """Number the runs of equal ``flag`` values along the order."""
    w = Window.partitionBy(*keys).orderBy(*order)
    work = df.withColumn("_f", flag)
    turn = F.coalesce((F.col("_f") != F.lag("_f").over(w)).cast("int"), F.lit(1))
    return (
        work.withColumn("_turn", turn)
        .withColumn(name, F.sum("_turn").over(w.rowsBetween(Window.unboundedPreceding, 0)))
        .drop("_f", "_turn")
    )


def _switch_count(df: DataFrame, keys, order, wet: str, name: str) -> DataFrame:
    """Running count of wet/dry switches; a series that starts wet starts at 1, else at 0."""
    w = Window.partitionBy(*keys).orderBy(*order)
    step = F.abs(F.col(wet) - F.coalesce(F.lag(wet).over(w), F.lit(0)))
    return df.withColumn("_step", step).withColumn(
        name, F.sum("_step").over(w.rowsBetween(Window.unboundedPreceding, 0))
    ).drop("_step")


def rain_events(
    df: DataFrame,
    keys: Sequence[str],
    time: str,
    precip: str = "precip",
    min_depth: float = EVENT_MIN_DEPTH,
    gap_hours: int = INTEREVENT_HOURS,
) -> DataFrame:
    """Adds ``wet`` and ``event_id``.

    An hour is wet if rain fell or its dry run is shorter than the gap; wet spells whose
    depth does not exceed ``min_depth`` turn dry and the spells are renumbered. Each pass
    orders by (spell, time), which is the time order, so one shuffle serves all windows.
    """
    runs = run_ids(df, keys, [time], F.col(precip) > 0, "_run")
    run_length = F.count(F.lit(1)).over(Window.partitionBy(*keys, "_run"))
    spells = runs.withColumn(
        "_wet", ((F.col(precip) > 0) | (run_length < gap_hours)).cast("int")
    )
    spells = _switch_count(spells, keys, ["_run", time], "_wet", "_spell")
    depth = F.sum(precip).over(Window.partitionBy(*keys, "_spell"))
    kept = spells.withColumn("wet", (depth > min_depth).cast("int"))
    return _switch_count(kept, keys, ["_spell", time], "wet", "event_id").drop("_run", "_wet", "_spell")


def event_columns(df: DataFrame, keys: Sequence[str], time: str, precip: str = "precip") -> DataFrame:
    """Per-event duration, hour index, type, cumulative and total depth and peak."""
    whole = Window.partitionBy(*keys, "event_id")
    so_far = whole.orderBy(time).rowsBetween(Window.unboundedPreceding, 0)
    rain = F.col(precip) * F.col("wet")
    return df.withColumns(
        {
            "event_hour": F.row_number().over(whole.orderBy(time)),
            "event_precip_cumsum": F.sum(rain).over(so_far),
            "event_precip_cummax": F.max(rain).over(so_far),
        }
    ).withColumns(
        {
            "event_duration": F.count(F.lit(1)).over(whole),
            "event_type": F.when(F.col("wet") == 1, F.lit("Wet")).otherwise(F.lit("Dry")),
            "event_precip_sum": F.sum(rain).over(whole),
            "event_precip_max": F.max(rain).over(whole),
        }
    )


def since_name(depth: float) -> str:
    return f"hours_since_{round(depth * 100):03d}in_precip_event"


def hours_since(
    df: DataFrame, keys: Sequence[str], time: str, depths: Sequence[float] = SINCE_DEPTHS
) -> DataFrame:
    """Hours since the last event of each depth; before the first event, since the series start."""
    w = Window.partitionBy(*keys).orderBy("event_id", time)
    so_far = w.rowsBetween(Window.unboundedPreceding, 0)
    work = df.withColumn("_rn", F.row_number().over(w))
    out = {}
    for d in depths:
        hit = F.when(F.col("event_precip_sum") >= d, F.col("_rn"))
        out[since_name(d)] = F.col("_rn") - F.coalesce(F.last(hit, ignorenulls=True).over(so_far), F.lit(0))
    return work.withColumns(out).drop("_rn")


def longest_run(df: DataFrame, keys: Sequence[str], time: str, flag: str, name: str = "longest") -> DataFrame:
    """Length of the longest run of true ``flag`` per series (0 when there is none)."""
    runs = run_ids(df, keys, [time], F.col(flag), "_run")
    lengths = runs.groupBy(*keys, "_run").agg(F.sum(F.col(flag).cast("int")).alias("_n"))
    return lengths.groupBy(*keys).agg(F.max("_n").alias(name))
