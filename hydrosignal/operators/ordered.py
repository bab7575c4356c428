"""Ordered state without a task that owns a whole group.

A plain ``Window.partitionBy(keys)`` sends a group to one task. Where a group may hold
raw rows (samples, scores, observations) the operators here cut it into parts along its
order, work inside a part, and add what earlier parts contribute. Only one summary row
per (group, part) is ever gathered per group.

Part expressions must be deterministic functions of the row, because the rows and the
summaries are two branches of one plan.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from hydrosignal.session import materialize

PART = "_part"


def time_part(time: Column, seconds: int) -> Column:
    return F.floor(F.unix_seconds(time) / F.lit(seconds))


def hash_order(id_cols: Sequence[Column | str], seed: int) -> Column:
    """A seeded pseudo-random order key (hex digest), the same on every run."""
    cols = [F.col(c) if isinstance(c, str) else c for c in id_cols]
    return F.md5(F.concat_ws(":", *[c.cast("string") for c in cols], F.lit(str(seed))))


def hash_part(digest: Column) -> Column:
    """4096 equal slices of the digest order."""
    return F.conv(F.substring(digest, 1, 3), 16, 10).cast("int")


def value_part(df: DataFrame, column: str, cuts: int = 64) -> Column:
    """Slices of a numeric order with similar row counts, as one literal expression.

    The cut points are read once (a few dozen numbers come to the driver), so every use
    of the expression slices the same way. On a session with many shuffle partitions each
    slice is divided evenly again, so that there are several parts per partition.
    """
    found = sorted(set(df.approxQuantile(column, [i / cuts for i in range(cuts + 1)], 0.25 / cuts)))
    if len(found) < 2:
        return F.lit(0)
    inner, name = found[1:-1], "`" + column.replace("`", "``") + "`"

    def pick(lo: int, hi: int) -> str:
        if lo == hi:
            return str(lo)
        mid = (lo + hi) // 2
        return f"CASE WHEN {name} <= {inner[mid]!r}D THEN {pick(lo, mid)} ELSE {pick(mid + 1, hi)} END"

    slice_no = F.expr(pick(0, len(inner)))
    partitions = int(df.sparkSession.conf.get("spark.sql.shuffle.partitions"))
    finer = -(-4 * partitions // cuts)
    if finer <= 1:
        return slice_no
    low = F.array(*[F.lit(x) for x in found[:-1]])
    width = F.array(*[F.lit(y - x) for x, y in zip(found, found[1:])])
    share = (F.col(column) - F.get(low, slice_no)) / F.get(width, slice_no)
    inside = F.least(F.greatest(F.floor(share * finer), F.lit(0)), F.lit(finer - 1))
    return slice_no * finer + inside


def running_totals(
    df: DataFrame,
    keys: Sequence[str],
    part: Column,
    order: Sequence[Column],
    totals: dict[str, Column],
    descending_parts: bool = False,
) -> DataFrame:
    """Inclusive running sums of ``totals`` along (part, order) inside each key group.

    ``<name>_all`` holds the group's total. ``order`` must be unique inside a part for the
    result to be unique.
    """
    work = df.withColumn(PART, part)
    inside = (
        Window.partitionBy(*keys, PART).orderBy(*order).rowsBetween(Window.unboundedPreceding, 0)
    )
    part_order = F.col(PART).desc() if descending_parts else F.col(PART).asc()
    earlier = (
        Window.partitionBy(*keys).orderBy(part_order).rowsBetween(Window.unboundedPreceding, -1)
    )
    carried = (
        work.groupBy(*keys, PART)
        .agg(*[F.sum(c).alias(f"_t_{n}") for n, c in totals.items()])
        .select(
            *keys,
            PART,
            *[F.coalesce(F.sum(f"_t_{n}").over(earlier), F.lit(0)).alias(f"_c_{n}") for n in totals],
            *[F.sum(f"_t_{n}").over(Window.partitionBy(*keys)).alias(f"{n}_all") for n in totals],
        )
    )
    joined = work.withColumns({f"_i_{n}": F.sum(c).over(inside) for n, c in totals.items()}).join(
        carried, [*keys, PART]
    )
    return joined.withColumns(
        {n: F.coalesce(F.col(f"_i_{n}"), F.lit(0)) + F.col(f"_c_{n}") for n in totals}
    ).drop(PART, *[f"_i_{n}" for n in totals], *[f"_c_{n}" for n in totals])


def hash_rank(
    df: DataFrame, keys: Sequence[str], id_cols: Sequence[str], seed: int, name: str = "rank"
) -> DataFrame:
    """Exact 1-based rank of each row in the seeded random order of its group.

    ``<name>_all`` is the size of the group.
    """
    work = df.withColumn("_digest", hash_order(list(id_cols), seed))
    order = [F.col("_digest"), *[F.col(c) for c in id_cols]]
    ranked = running_totals(work, keys, hash_part(F.col("_digest")), order, {name: F.lit(1).cast("long")})
    return ranked.drop("_digest")


def first_per_key(df: DataFrame, keys: Sequence[str], order: Sequence[Column]) -> DataFrame:
    """One row per key, the first in ``order``.

    Spark limits each map task to one row per key before the shuffle, so a key with many
    rows sends one row per task.
    """
    w = Window.partitionBy(*keys).orderBy(*order)
    return df.withColumn("_rn", F.row_number().over(w)).filter("_rn = 1").drop("_rn")


def quantiles(
    df: DataFrame, keys: Sequence[str], value: str, probs: dict[str, float]
) -> DataFrame:
    """Exact interpolated quantiles per group, by name.

    Rows are reduced to counts per distinct value, the counts are cumulated in value
    order, and each quantile is read off between its two neighbouring ranks. No task
    holds the values of a group, unlike an exact percentile aggregate.
    """
    known = df.filter(F.col(value).isNotNull())
    # written once, so that the input is scanned a single time for cuts, totals and rows
    counts = materialize(known.groupBy(*keys, value).agg(F.count(F.lit(1)).alias("_k")), "value-counts")
    cum = running_totals(counts, keys, value_part(counts, value), [F.col(value)], {"_cum": F.col("_k")})
    def at(rank: Column) -> Column:
        return F.min(F.when(F.col("_cum") > rank, F.col(value)))

    place = {n: (F.col("_cum_all") - 1) * F.lit(float(p)) for n, p in probs.items()}
    ends = cum.groupBy(*keys, "_cum_all").agg(
        *[at(F.floor(x)).alias(f"_lo_{n}") for n, x in place.items()],
        *[at(F.ceil(x)).alias(f"_hi_{n}") for n, x in place.items()],
    )
    return ends.select(
        *keys,
        *[
            (F.col(f"_lo_{n}") + (F.col(f"_hi_{n}") - F.col(f"_lo_{n}")) * (x - F.floor(x))).alias(n)
            for n, x in place.items()
        ],
    )
