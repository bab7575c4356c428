"""Sharding by a hierarchical weighted hash tree.

A tree has regions, racks and shards. A row descends it: at each level every child draws
``-ln(u) / weight`` with ``u`` a uniform hash of (row key, child name), and the smallest draw
wins, so a child receives rows in proportion to its weight. A draw depends on nothing but the
key, the child and its own weight. If the weight of a subtree changes, only draws of the nodes
above it change: rows move into or out of that subtree and nowhere else.
"""

from __future__ import annotations

from dataclasses import dataclass

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from hydrosignal.operators.attach import attach

HASH_HEX = 12
#: Rows of a shard are numbered inside slices: 16 to the power of this many.
SLICE_HEX = 2


@dataclass(frozen=True)
class Leaf:
    region: str
    rack: str
    shard: int
    weight: float = 1.0


def tree(shards: int, regions: int = 2, racks: int = 2, base: int = 16) -> list[Leaf]:
    """The first ``base`` shards spread over regions and racks; each later one is a region of its own.

    A shard added as a subtree of its own changes no other weight, so it takes rows only into
    itself. (A shard put into an existing rack also draws rows of other regions into its rack's
    neighbours.)
    """
    per_region = -(-base // regions)
    per_rack = -(-per_region // racks)
    return [
        Leaf(f"r{i // per_region}", f"r{i // per_region}k{i % per_region // per_rack}", i)
        if i < base
        else Leaf(f"r+{i}", f"r+{i}k", i)
        for i in range(shards)
    ]


def _draw(key: Column, node: str, weight: float) -> Column:
    digest = F.substring(F.md5(F.concat_ws("|", key, F.lit(node)).cast("binary")), 1, HASH_HEX)
    u = (F.conv(digest, 16, 10).cast("double") + F.lit(1.0)) / F.lit(float(16**HASH_HEX + 1))
    return -F.log(u) / F.lit(float(weight))


def _winner(key: Column, children: list[tuple[str, float]], level: str) -> Column:
    if len(children) == 1:
        return F.lit(children[0][0])
    drawn = F.array(
        *[F.struct(_draw(key, f"{level}:{n}", w).alias("d"), F.lit(n).alias("n")) for n, w in children]
    )
    return F.array_min(drawn)["n"]


def _weights(leaves: list[Leaf], name) -> list[tuple[str, float]]:
    out: dict[str, float] = {}
    for leaf in leaves:
        out[name(leaf)] = out.get(name(leaf), 0.0) + leaf.weight
    return sorted((n, w) for n, w in out.items() if w > 0)


def _cases(on: Column, values: dict[str, Column]) -> Column:
    out = F.lit(None)
    for name, value in values.items():
        out = F.when(on == name, value).otherwise(out)
    return out


def place(df: DataFrame, key: str, leaves: list[Leaf], prefix: str = "") -> DataFrame:
    """Adds ``<prefix>region``, ``<prefix>rack`` and ``<prefix>shard``.

    A null key is a key like any other. Equal keys go to the same shard.
    """
    k = F.coalesce(F.col(key).cast("string"), F.lit("null"))
    region, rack, shard = (f"{prefix}{x}" for x in ("region", "rack", "shard"))
    df = df.withColumn(region, _winner(k, _weights(leaves, lambda x: x.region), "region"))
    racks = {
        r: _winner(k, _weights([x for x in leaves if x.region == r], lambda x: x.rack), "rack")
        for r in dict.fromkeys(x.region for x in leaves)
    }
    df = df.withColumn(rack, _cases(F.col(region), racks))
    last = {
        r: _winner(k, _weights([x for x in leaves if x.rack == r], lambda x: str(x.shard)), "shard")
        for r in dict.fromkeys(x.rack for x in leaves)
    }
    return df.withColumn(shard, _cases(F.col(rack), last).cast("int"))


def slots(df: DataFrame, shard: str, key: str, name: str = "slot") -> DataFrame:
    """Numbers the rows of each shard from 0 without gaps, in order of (slice, key).

    A shard is cut into hash slices of its rows, so no task sorts a whole shard; the start of a
    slice is the number of rows in earlier slices. Copies of one row stay in one slice and get
    consecutive numbers.
    """
    digest = F.md5(F.coalesce(F.col(key).cast("string"), F.lit("null")).cast("binary"))
    work = df.withColumn("_slice", F.substring(digest, 1, SLICE_HEX))
    sizes = work.groupBy(shard, "_slice").agg(F.count(F.lit(1)).alias("_n"))
    earlier = Window.partitionBy(shard).orderBy("_slice").rowsBetween(Window.unboundedPreceding, -1)
    starts = sizes.select(shard, "_slice", F.coalesce(F.sum("_n").over(earlier), F.lit(0)).alias("_start"))
    inside = Window.partitionBy(shard, "_slice").orderBy(key)
    return (
        attach(work.withColumn("_at", F.row_number().over(inside)), starts, [shard, "_slice"])
        .withColumn(name, (F.col("_start") + F.col("_at") - 1).cast("long"))
        .drop("_slice", "_start", "_at")
    )


def shard_documents(docs: DataFrame, shards: int = 16, key: str = "doc_id", text: str = "text") -> DataFrame:
    """Place of every document with ``shards`` shards and with one more.

    One row per input row: key, ``size`` (UTF-8 bytes of the text, none for null, plus 1),
    ``text_crc32``, ``region``, ``rack``, ``shard``, ``slot`` and ``grown_shard``. A null text
    has the checksum of the empty text. Repeated rows get slots of their own; other columns of
    ``docs`` are not read, whatever their names. Only these short rows are shuffled.
    """
    bare = docs.select(
        F.col(key),
        (F.coalesce(F.octet_length(F.col(text)), F.lit(0)) + 1).cast("long").alias("size"),
        F.crc32(F.coalesce(F.col(text), F.lit("")).cast("binary")).alias("text_crc32"),
    )
    now = place(bare, key, tree(shards))
    grown = place(now, key, tree(shards + 1), "grown_")
    return slots(grown.drop("grown_region", "grown_rack"), "shard", key).select(
        key, "size", "text_crc32", "region", "rack", "shard", "slot", "grown_shard"
    )
