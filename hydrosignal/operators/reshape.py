"""Unpivot, pivot, tagged unions, dummies and comparisons."""

from __future__ import annotations

from collections.abc import Sequence
from functools import reduce

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from hydrosignal.operators.attach import attach
from hydrosignal.operators.ordered import first_per_key, hash_part, running_totals
from hydrosignal.session import materialize


def stack(*frames: DataFrame) -> DataFrame:
    """Union by name; columns a frame lacks are null."""
    return reduce(lambda a, b: a.unionByName(b, allowMissingColumns=True), frames)


def stack_tagged(tag: str, **frames: DataFrame) -> DataFrame:
    return stack(*[df.withColumn(tag, F.lit(name)) for name, df in frames.items()])


def with_prefix(df: DataFrame, prefix: str) -> list[str]:
    return [c for c in df.columns if c.startswith(prefix)]


def transform_columns(df: DataFrame, cols: Sequence[str], f) -> DataFrame:
    return df.withColumns({c: f(F.col(c)) for c in cols})


def to_long(df: DataFrame, ids: Sequence[str], cols: Sequence[str], key: str = "key", value: str = "value") -> DataFrame:
    return df.unpivot(list(ids), list(cols), key, value)


def to_wide(df: DataFrame, ids: Sequence[str], key: str, values: Sequence[str], value: str = "value") -> DataFrame:
    return df.groupBy(*ids).pivot(key, list(values)).agg(F.first(value, ignorenulls=True))


def pivot_series(df: DataFrame, ids: Sequence[str], series: str, values: Sequence[str], cols: Sequence[str]) -> DataFrame:
    """One row per id with ``<series>_<column>`` columns, without going through long form."""
    aggs = [
        F.max(F.when(F.col(series) == v, F.col(c))).alias(f"{v}_{c}") for v in values for c in cols
    ]
    return df.groupBy(*ids).agg(*aggs)


def dummies(df: DataFrame, col: str, levels: Sequence[str]) -> DataFrame:
    """0/1 columns for all sorted levels but the first, and one for null."""
    new = {f"{col}_{v}": F.coalesce((F.col(col) == v).cast("int"), F.lit(0)) for v in sorted(levels)[1:]}
    new[f"{col}_nan"] = F.col(col).isNull().cast("int")
    return df.withColumns(new)


def levels_of(df: DataFrame, col: str) -> list[str]:
    """Distinct non-null levels, each of which becomes a column."""
    return sorted(r[0] for r in df.select(col).filter(F.col(col).isNotNull()).distinct().collect())


def level_index(df: DataFrame, col: str) -> DataFrame:
    """(col, index): a number from 0 for each non-null level, in the order of a hash of its text.

    The levels are numbered in slices of that order, so neither one task nor the driver holds them all.
    """
    levels = df.select(col).filter(F.col(col).isNotNull()).distinct().withColumn("_hash", F.md5(F.col(col).cast("string")))
    ranked = running_totals(materialize(levels, "levels"), [], hash_part(F.col("_hash")), [F.col("_hash")], {"index": F.lit(1).cast("long")})
    return ranked.select(col, (F.col("index") - 1).alias("index"))


def sparse_dummies(df: DataFrame, col: str, name: str | None = None) -> DataFrame:
    """Adds ``name`` (default ``<col>_level``): a sparse 0/1 vector as struct(size, indices, values).

    One place for each level of ``level_index`` and a last one for null; for any number of levels,
    where ``dummies`` makes a column of each. The index is attached by its size.
    """
    index = materialize(level_index(df, col), "level-index")
    size = index.count() + 1
    joined = attach(df, index.withColumnRenamed("index", "_index"), [col])
    place = F.coalesce("_index", F.lit(size - 1).cast("long"))
    vector = F.struct(F.lit(size).cast("long").alias("size"), F.array(place).alias("indices"), F.array(F.lit(1.0)).alias("values"))
    return joined.withColumn(name or f"{col}_level", vector).drop("_index")


def side_by_side(
    df: DataFrame,
    keys: Sequence[str],
    source: str,
    sources: tuple[str, str],
    value: str,
    order: Sequence[Column],
) -> DataFrame:
    """Values of two sources for the same key, where both have one; first row per (source, key)."""
    once = first_per_key(df.filter(F.col(source).isin(*sources)), [source, *keys], order)
    a, b = sources
    return pivot_series(once.withColumn(source, F.col(source)), keys, source, sources, [value]).select(
        *keys, F.col(f"{a}_{value}").alias(a), F.col(f"{b}_{value}").alias(b)
    ).filter(F.col(a).isNotNull() & F.col(b).isNotNull())


def nest(df: DataFrame, keys: Sequence[str], name: str = "data") -> DataFrame:
    """One row per group with its rows as an array; only for groups that fit in a row."""
    rest = [c for c in df.columns if c not in keys]
    return df.groupBy(*keys).agg(F.sort_array(F.collect_list(F.struct(*rest))).alias(name))


def unnest(df: DataFrame, keys: Sequence[str], name: str = "data") -> DataFrame:
    return df.select(*keys, F.inline(name))
