"""As-of, interval, range-sum and dimension joins."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from hydrosignal.operators.ordered import PART, first_per_key, running_totals, time_part

HOUR = 3_600
DAY = 86_400


def chain_dimensions(df: DataFrame, *steps: tuple[DataFrame, Sequence[str]], how: str = "inner") -> DataFrame:
    """Chained equi joins with dimensions.

    No broadcast hint: Spark broadcasts a dimension when its measured size allows it, and
    otherwise splits skewed keys at run time.
    """
    for dim, on in steps:
        df = df.join(dim, list(on), how)
    return df


def replace_codes(df: DataFrame, code: str, lookup: DataFrame, lookup_code: str, lookup_name: str) -> DataFrame:
    """Codes become names; unknown codes become null (see ``unmatched_codes``)."""
    names = lookup.select(F.col(lookup_code).alias(code), F.col(lookup_name).alias("_name"))
    return df.join(names, code, "left").withColumn(code, F.col("_name")).drop("_name")


def unmatched_codes(df: DataFrame, code: str, lookup: DataFrame, lookup_code: str) -> DataFrame:
    used = df.filter(F.col(code).isNotNull()).groupBy(code).agg(F.count(F.lit(1)).alias("n"))
    return used.join(lookup.select(F.col(lookup_code).alias(code)), code, "left_anti")


def from_first(df: DataFrame, time: str, reference: DataFrame, reference_time: str) -> DataFrame:
    """Rows not earlier than the first row of a reference frame (one-row aggregate, broadcast)."""
    first = reference.agg(F.min(reference_time).alias("_first"))
    return df.crossJoin(F.broadcast(first)).filter(F.col(time) >= F.col("_first")).drop("_first")


def asof_join(
    left: DataFrame,
    right: DataFrame,
    keys: Sequence[str],
    left_time: str,
    right_time: str,
    cols: Sequence[str],
    tie: Sequence[str] = (),
    part_seconds: int = HOUR,
) -> DataFrame:
    """For every left row the last right row at or before it, per series.

    Only distinct instants are put in order: right rows are first reduced to one per
    (series, instant), ``tie`` deciding, and left rows to their distinct instants, so
    repeated instants of a busy series cost nothing. Instants are ordered inside (series,
    time part); one with no right row in its part takes the last one of the nearest
    earlier part. Left rows then look their instant up by an equi join.
    """
    ties = F.struct(*[F.col(c) for c in (tie or cols)])
    hit = F.struct(F.col(right_time), *[F.col(c) for c in cols])
    r = right.groupBy(*keys, F.col(right_time).alias("_t")).agg(F.max_by(hit, ties).alias("_r"))
    probes = left.select(*keys, F.col(left_time).alias("_t"), F.lit(1).alias("_side")).distinct()
    # readings come before probes of the same instant
    both = probes.unionByName(r.withColumn("_side", F.lit(0)), allowMissingColumns=True)
    both = both.withColumn(PART, time_part(F.col("_t"), part_seconds))
    inside = Window.partitionBy(*keys, PART).orderBy("_t", "_side").rowsBetween(Window.unboundedPreceding, 0)
    earlier = Window.partitionBy(*keys).orderBy(PART).rowsBetween(Window.unboundedPreceding, -1)
    carried = (
        both.groupBy(*keys, PART)
        .agg(F.max_by("_r", F.when(F.col("_side") == 0, F.col("_t"))).alias("_last"))
        .select(*keys, PART, F.last("_last", ignorenulls=True).over(earlier).alias("_carry"))
    )
    found = (
        both.withColumn("_in", F.last("_r", ignorenulls=True).over(inside))
        .filter("_side = 1")
        .join(carried, [*keys, PART], "left")
        .select(*keys, F.col("_t").alias(left_time), F.coalesce("_in", "_carry").alias("_hit"))
    )
    return left.join(found, [*keys, left_time], "left").select(*left.columns, "_hit.*")


def latest_at(df: DataFrame, keys: Sequence[str], time: str, at) -> DataFrame:
    """The latest row per series at or before one instant."""
    return first_per_key(df.filter(F.col(time) <= at), keys, [F.col(time).desc()])


def covering_intervals(
    points: DataFrame,
    intervals: DataFrame,
    keys: Sequence[str],
    time: str,
    start: str,
    end: str,
    bucket_seconds: int = DAY,
) -> DataFrame:
    """Pairs (point, interval) of the same key with ``start <= time <= end``.

    Intervals are cut to the time span of their key's points and spread over the buckets
    they touch, so the join is an equi join on (key, bucket) and an open-ended interval
    costs no more than the points it covers.
    """
    span = points.groupBy(*keys).agg(F.min(time).alias("_from"), F.max(time).alias("_to"))
    spread = (
        intervals.join(span, list(keys))
        .filter((F.col(start) <= F.col("_to")) & (F.col(end) >= F.col("_from")) & (F.col(start) <= F.col(end)))
        .withColumn(
            PART,
            F.explode(
                F.sequence(
                    time_part(F.greatest(start, "_from"), bucket_seconds),
                    time_part(F.least(end, "_to"), bucket_seconds),
                )
            ),
        )
        .drop("_from", "_to")
    )
    return (
        points.withColumn(PART, time_part(F.col(time), bucket_seconds))
        .join(spread, [*keys, PART])
        .filter(F.col(time).between(F.col(start), F.col(end)))
        .drop(PART)
    )


def range_sums(
    points: DataFrame,
    readings: DataFrame,
    keys: Sequence[str],
    point_time: str,
    reading_time: str,
    value: str,
    edges_hours: Sequence[int] = (0, 12, 24, 48, 72, 96, 120),
    prefix: str = "precip",
    part_seconds: int = HOUR,
    digits: int = 8,
) -> DataFrame:
    """Sum of readings in every bin ``[t - h1, t - h0)`` for every distinct point (key, t).

    A reading enters a bin once it is ``h0`` hours old and leaves it at ``h1``; a bin is the running
    total of what has entered and left before the point. The work is one sort of the points and of
    one row per reading and edge, whatever the bin widths and however many readings fall into them;
    points are neither repeated nor grouped again. Totals are decimals of two digits more than the
    result and hold only what is in the bin, so that a large early total costs later bins no
    digits. A bin with a reading that is not finite is NaN.
    """
    exact = f"decimal(38, {digits + 2})"
    edges = sorted(set(edges_hours))
    bins = {f"{prefix}_{a}_{b}": (a, b) for a, b in zip(edges, edges[1:])}
    probes = points.select(*keys, F.unix_micros(point_time).alias("_x")).distinct()
    sums = readings.groupBy(*keys, F.unix_micros(reading_time).alias("_x")).agg(F.sum(value).alias("_v"))
    finite = F.abs("_v") < F.lit(float("inf"))  # NaN is above infinity
    moved = sums.select(
        *keys,
        "_x",
        F.explode(F.array(*[F.lit(h) for h in edges])).alias("_edge"),
        F.coalesce(F.when(finite, F.col("_v")), F.lit(0.0)).cast(exact).alias("_v"),
        F.when(F.col("_v").isNull() | finite, 0).otherwise(1).alias("_odd"),
    ).withColumn("_x", F.col("_x") + F.col("_edge").cast("long") * 3_600_000_000)
    part = F.floor(F.col("_x") / F.lit(part_seconds * 1_000_000))
    # the join by part leaves them out anyway; said here, both branches of the totals share one shuffle
    both = probes.unionByName(moved, allowMissingColumns=True).filter(part.isNotNull())
    order = [F.col("_x"), F.col("_edge").asc_nulls_first()]  # a point comes before readings of its own instant

    def inside(a: int, b: int, c: str) -> Column:
        return F.when(F.col("_edge") == a, F.col(c)).when(F.col("_edge") == b, -F.col(c))

    totals = {f"{p}{n}": inside(*ab, c) for n, ab in bins.items() for p, c in (("_in_", "_v"), ("_odd_", "_odd"))}
    found = running_totals(both, keys, part, order, totals).filter("_edge IS NULL")
    return found.select(
        *keys,
        F.timestamp_micros("_x").alias(point_time),
        *[
            F.when(F.col(f"_odd_{n}") > 0, F.lit(float("nan"))).otherwise(F.round(F.col(f"_in_{n}").cast("double"), digits)).alias(n)
            for n in bins
        ],
    )
