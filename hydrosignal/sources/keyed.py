"""Keyed writes over file tables: upsert, guarded append, change logs, backfill lists."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from hydrosignal.functions import times
from hydrosignal.operators.ordered import first_per_key


def upsert(existing: DataFrame, new: DataFrame, keys: Sequence[str], version: Sequence[Column]) -> DataFrame:
    """The table after the new rows replaced or joined the old ones.

    Among new rows of one key the first in ``version`` order wins; a new row always beats
    the stored one. Keys are unique in ``existing``, and a null key equals a null key. Only
    the news are reduced and sorted; stored rows pass an anti join, which Spark does without
    moving them as long as the keys of the news are small.
    """
    news = first_per_key(new, keys, version)
    named = news.select(*[F.col(k).alias(f"_k_{k}") for k in keys])
    return news.unionByName(existing.join(named, _same_key(keys), "left_anti"), allowMissingColumns=True)


def write_partitions(df: DataFrame, path: str, partition_by: Sequence[str]) -> None:
    """Replace only the partitions present in ``df``."""
    (
        df.write.mode("overwrite")
        .option("partitionOverwriteMode", "dynamic")
        .partitionBy(*partition_by)
        .parquet(path)
    )


def _same_key(keys: Sequence[str]) -> Column:
    """Whether a row's key equals that of a table whose key columns are named ``_k_...``; null equals null."""
    same = F.lit(True)
    for k in keys:
        same = same & F.col(k).eqNullSafe(F.col(f"_k_{k}"))
    return same


def new_rows(existing: DataFrame, new: DataFrame, keys: Sequence[str], version: Sequence[Column] | None = None) -> DataFrame:
    """New rows whose key is not stored yet, one per key (append under a unique key).

    Of new rows that repeat a key the first in ``version`` order is taken (default: all columns in
    order, smallest first); ``key_conflicts`` reports the others. A null key equals a null key.
    """
    once = first_per_key(new, keys, version or [F.col(c) for c in new.columns])
    stored = existing.select(*[F.col(k).alias(f"_k_{k}") for k in keys])
    return once.join(stored, _same_key(keys), "left_anti")


def key_conflicts(existing: DataFrame, new: DataFrame, keys: Sequence[str]) -> DataFrame:
    """Keys an append would duplicate: stored already, or repeated among the new rows."""
    counts = new.groupBy(*keys).agg(F.count(F.lit(1)).alias("n_new"))
    stored = existing.groupBy(*[F.col(k).alias(f"_k_{k}") for k in keys]).agg(F.count(F.lit(1)).alias("n_stored"))
    return (
        counts.join(stored, _same_key(keys), "left")
        .drop(*[f"_k_{k}" for k in keys])
        .withColumn("n_stored", F.coalesce("n_stored", F.lit(0)))
        .filter("n_new > 1 or n_stored > 0")
    )


def backfill_days(spark, landed: DataFrame, start: Column, end: Column, date: str = "date") -> DataFrame:
    """Days of a range that have not landed, newest first."""
    days = spark.range(1).select(F.explode(F.sequence(start, end, F.expr("INTERVAL 1 DAY"))).alias(date))
    return days.join(landed.select(date).distinct(), date, "left_anti").orderBy(F.col(date).desc())


def request_bounds(days: DataFrame, date: str = "date", tz: str = times.EASTERN) -> DataFrame:
    start, end = times.day_bounds(F.col(date), tz)
    return days.withColumns({"start_time": start, "end_time": end})


def apply_changes(base: DataFrame, changes: DataFrame, key: str, version: str, op: str = "op") -> DataFrame:
    """A table after a log of inserts, updates and deletes, in ``version`` order per key.

    A row exists if it was born (stored or inserted) after its last delete; its content is
    that of its last insert or update. An update replaces the whole row and does nothing
    for an unknown or deleted key. Birth, death and content come from one aggregate.
    """
    tagged = changes.withColumn("_log", F.lit(1)).unionByName(
        base.withColumn("_log", F.lit(0)), allowMissingColumns=True
    )
    when = F.struct("_log", version)
    content = [c for c in tagged.columns if c not in (key, "_log", op, version)]
    states = tagged.groupBy(key).agg(
        F.max(F.when((F.col("_log") == 0) | (F.col(op) == "insert"), when)).alias("_born"),
        F.max(F.when(F.col(op) == "delete", when)).alias("_died"),
        F.max_by(F.struct(*content), when).alias("_last"),
    )
    alive = F.col("_born").isNotNull() & (F.col("_died").isNull() | (F.col("_born") > F.col("_died")))
    return states.filter(alive).select(key, "_last.*")
