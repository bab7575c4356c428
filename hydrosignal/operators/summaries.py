"""Group summaries, cross-tabs, fits, weights and quality checks."""

from __future__ import annotations

from collections.abc import Sequence
from itertools import combinations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from hydrosignal.operators.attach import attach
from hydrosignal.operators.ordered import quantiles


def share_by(df: DataFrame, keys: Sequence[str], flag: Column, n="n_samples", share="frac_exceed") -> DataFrame:
    return df.groupBy(*keys).agg(F.count(F.lit(1)).alias(n), F.avg(flag.cast("double")).alias(share))


def cross_tab(df: DataFrame, row: str, col: str, values: Sequence) -> DataFrame:
    return df.groupBy(row).pivot(col, list(values)).count().na.fill(0)


def row_shares(df: DataFrame, row: str, col: str, values: Sequence) -> DataFrame:
    """Counts as shares of their row."""
    wide = cross_tab(df, row, col, values)
    total = sum((F.col(str(v)) for v in values), F.lit(0))
    return wide.select(row, *[(F.col(str(v)) / total).alias(str(v)) for v in values])


def cross_tab_totals(df: DataFrame, row: str, col: str, values: Sequence, label: str = "Total") -> DataFrame:
    """Cross-tab with a total column and a total row, from one grouping-sets pass."""
    cells = df.cube(row, col).agg(
        F.count(F.lit(1)).alias("n"), F.grouping(row).alias("_gr"), F.grouping(col).alias("_gc")
    )
    cells = cells.select(
        F.when(F.col("_gr") == 1, F.lit(label)).otherwise(F.col(row).cast("string")).alias(row),
        F.when(F.col("_gc") == 1, F.lit(label)).otherwise(F.col(col).cast("string")).alias("_col"),
        "n",
    )
    return cells.groupBy(row).pivot("_col", [*map(str, values), label]).agg(F.sum("n")).na.fill(0)


def _attach(df: DataFrame, other: DataFrame, keys: Sequence[str]) -> DataFrame:
    return df.join(other, list(keys)) if keys else df.crossJoin(F.broadcast(other))


def ranges(df: DataFrame, keys: Sequence[str], value: str = "value") -> DataFrame:
    """min / median / mean / max per group, the median exact."""
    plain = df.groupBy(*keys).agg(F.min(value).alias("min"), F.avg(value).alias("mean"), F.max(value).alias("max"))
    return _attach(plain, quantiles(df, keys, value, {"median": 0.5}), keys).select(*keys, "min", "median", "mean", "max")


def distribution(df: DataFrame, keys: Sequence[str], value: str) -> DataFrame:
    """Six-number summary of resampled metrics."""
    plain = df.groupBy(*keys).agg(F.min(value).alias("min"), F.avg(value).alias("mean"), F.max(value).alias("max"))
    q = quantiles(df, keys, value, {"q1": 0.25, "median": 0.5, "q3": 0.75})
    return _attach(plain, q, keys).select(*keys, "min", "q1", "median", "mean", "q3", "max")


def histogram(df: DataFrame, keys: Sequence[str], value: str, low: float, high: float, bins: int) -> DataFrame:
    bucket = F.width_bucket(F.col(value), F.lit(float(low)), F.lit(float(high)), F.lit(bins))
    return df.groupBy(*keys, bucket.alias("bucket")).agg(F.count(F.lit(1)).alias("n"))


def correlations(df: DataFrame, cols: Sequence[str], keys: Sequence[str] = ()) -> DataFrame:
    """All pairwise correlations in one pass, as rows (a, b, r)."""
    pairs = list(combinations(cols, 2))
    wide = df.groupBy(*keys).agg(*[F.corr(a, b).alias(f"_{i}") for i, (a, b) in enumerate(pairs)])
    rows = F.array(
        *[F.struct(F.lit(a).alias("a"), F.lit(b).alias("b"), F.col(f"_{i}").alias("r")) for i, (a, b) in enumerate(pairs)]
    )
    return wide.select(*keys, F.inline(rows))


def linear_fit(df: DataFrame, y: str, x: str, keys: Sequence[str] = ()) -> DataFrame:
    return df.groupBy(*keys).agg(
        F.regr_slope(y, x).alias("slope"),
        F.regr_intercept(y, x).alias("intercept"),
        F.regr_r2(y, x).alias("r2"),
    )


def group_stats_join(df: DataFrame, keys: Sequence[str], stats: dict[str, Column]) -> DataFrame:
    """Attach group aggregates to rows without sending a large group to one task.

    The aggregate is combined map-side, finished, and joined by the size-checked ``attach``.
    """
    return attach(df, df.groupBy(*keys).agg(*[c.alias(n) for n, c in stats.items()]), list(keys))


def z_scores(df: DataFrame, keys: Sequence[str], cols: Sequence[str]) -> DataFrame:
    stats = {f"_m_{c}": F.avg(c) for c in cols} | {f"_s_{c}": F.stddev_samp(c) for c in cols}
    work = group_stats_join(df, keys, stats)
    z = {c: (F.col(c) - F.col(f"_m_{c}")) / F.nullif(F.col(f"_s_{c}"), F.lit(0.0)) for c in cols}
    return work.withColumns(z).drop(*stats)


def class_weights(df: DataFrame, keys: Sequence[str], label: str, name: str = "weight") -> DataFrame:
    """Each class carries half of the total weight."""
    work = group_stats_join(df, [*keys, label], {"_n": F.count(F.lit(1))})
    return work.withColumn(name, F.lit(0.5) / F.col("_n")).drop("_n")


def null_violations(df: DataFrame, keys: Sequence[str], cols: Sequence[str]) -> DataFrame:
    """Series with nulls in columns that must be complete: one row per (series, column)."""
    wide = df.groupBy(*keys).agg(*[F.count_if(F.col(c).isNull()).alias(c) for c in cols])
    return wide.unpivot(list(keys), list(cols), "column", "n_null").filter("n_null > 0")


def not_single(df: DataFrame, keys: Sequence[str]) -> DataFrame:
    """Keys that do not have exactly one row."""
    return df.groupBy(*keys).agg(F.count(F.lit(1)).alias("n")).filter("n <> 1")


def checksum(source: DataFrame, parts: DataFrame, keys: Sequence[str], value: str, tolerance: float = 0.1) -> DataFrame:
    """Keys whose parts do not add up to the source (all keys, with a verdict)."""
    tagged = source.select(*keys, value, F.lit(1).alias("_sign")).unionByName(
        parts.select(*keys, value, F.lit(-1).alias("_sign"))
    )
    diff = F.sum(F.col(value) * F.col("_sign"))
    return tagged.groupBy(*keys).agg(diff.alias("difference")).withColumn(
        "ok", F.abs("difference") < tolerance
    )


def require(violations: DataFrame, message: str) -> DataFrame:
    """Fails the job when the violations frame has a row; gives an empty frame otherwise."""
    return violations.select(F.assert_true(F.lit(False), F.lit(message)).alias("ok"))
