"""Exceedance labels, stratified splits, folds and class balancing."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from hydrosignal.operators.attach import attach
from hydrosignal.operators.ordered import hash_rank

#: Copies of one row that a task makes at a time.
COPIES_PER_CHUNK = 4096

# Bacteria standards (per 100 ml) by use and parameter.
STANDARDS = (
    ("Boating", "ECOLI", 1260.0),
    ("Boating", "ENT", 350.0),
    ("Swimming", "ECOLI", 235.0),
    ("Swimming", "ENT", 104.0),
)


def standards(spark: SparkSession, use: str = "Boating") -> DataFrame:
    """The fixed four-row table, one use at a time."""
    rows = F.array(*[F.struct(F.lit(p).alias("parameter"), F.lit(v).alias("standard_value")) for u, p, v in STANDARDS if u == use])
    return spark.range(1).select(F.inline(rows))


def label_exceedance(df: DataFrame, limits: DataFrame, parameter="parameter", value="concentration") -> DataFrame:
    """Adds the standard of the parameter and whether the value is strictly above it.

    ``limits`` has one row per parameter (use or override tables alike).
    """
    table = limits.select(F.col("parameter").alias(parameter), "standard_value")
    return df.join(table, parameter, "left").withColumn(
        "exceedance", F.col(value) > F.col("standard_value")
    )


def stratified_split(
    df: DataFrame, strata: Sequence[str], id_cols: Sequence[str], share: float = 0.75, seed: int = 1, name: str = "subset"
) -> DataFrame:
    """Exactly ``ceil(share * n)`` rows of every stratum are "train", the others "test".

    The choice is by seeded hash order, so it is the same on every run and machine;
    ``id_cols`` must identify a row.
    """
    ranked = hash_rank(df, strata, id_cols, seed, "_rank")
    train = F.col("_rank") <= F.ceil(F.round(F.col("_rank_all") * F.lit(share), 9))
    return ranked.withColumn(name, F.when(train, F.lit("train")).otherwise(F.lit("test"))).drop("_rank", "_rank_all")


def stratified_folds(
    df: DataFrame, strata: Sequence[str], id_cols: Sequence[str], folds: int = 10, seed: int = 1, name: str = "fold"
) -> DataFrame:
    """Fold number 0..folds-1, class sizes differing by at most one row between folds."""
    ranked = hash_rank(df, strata, id_cols, seed, "_rank")
    return ranked.withColumn(name, ((F.col("_rank") - 1) % folds).cast("int")).drop("_rank", "_rank_all")


def _class_sizes(df: DataFrame, keys: Sequence[str], label: str, pick, name: str) -> DataFrame:
    """One row per group: the size of its smallest or largest class."""
    return df.groupBy(*keys, label).count().groupBy(*keys).agg(pick("count").alias(name))


def down_sample(df: DataFrame, keys: Sequence[str], label: str, id_cols: Sequence[str], seed: int = 1) -> DataFrame:
    """Every class is cut to the size of the smallest class of its group."""
    ranked = hash_rank(df, [*keys, label], id_cols, seed, "_rank")
    joined = attach(ranked, _class_sizes(df, keys, label, F.min, "_n"), list(keys), salt_by=list(id_cols))
    return joined.filter(F.col("_rank") <= F.col("_n")).drop("_rank", "_rank_all", "_n")


def up_sample(
    df: DataFrame, keys: Sequence[str], label: str, id_cols: Sequence[str], seed: int = 1, chunk: int = COPIES_PER_CHUNK
) -> DataFrame:
    """Every class is replicated to the size of the largest class of its group.

    Each row is repeated ``size div n`` times and the first ``size mod n`` rows of the hash order
    once more. Copies are made in chunks that are dealt out first, so the row of a class that has
    only one spreads over as many tasks as its copies need.
    """
    ranked = hash_rank(df, [*keys, label], id_cols, seed, "_rank")
    joined = attach(ranked, _class_sizes(df, keys, label, F.max, "_top"), list(keys), salt_by=list(id_cols))
    n = F.col("_rank_all")
    copies = (F.floor(F.col("_top") / n) + (F.col("_rank") <= F.col("_top") % n).cast("long")).alias("_copies")
    one = F.lit(1).cast("long")
    chunks = joined.select(*df.columns, copies).withColumn("_chunk", F.explode(F.sequence(one, F.col("_copies"), F.lit(chunk).cast("long"))))
    # a fixed number of tasks: by the size of the chunks Spark would join them before they grow
    tasks = int(df.sparkSession.conf.get("spark.sql.shuffle.partitions"))
    dealt = chunks.repartition(tasks, F.xxhash64(*id_cols), "_chunk")
    last = F.least(F.col("_copies"), F.col("_chunk") + F.lit(chunk - 1))
    return dealt.withColumn("copy", F.explode(F.sequence(F.col("_chunk"), last))).drop("_copies", "_chunk")
