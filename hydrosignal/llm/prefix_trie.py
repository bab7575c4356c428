"""Prefix trie of conversations from sorted matrices of turn ids.

A turn is known by a 128-bit hash of role and text. Every conversation is a row of turn ids, padded
to the width of its shard; a conversation of more than ``DEPTHS`` turns is cut into bands of so many
columns, and a later band carries the hash of all turns before it as a column of its own. The rows
are dealt to range shards in the order (band, hash before it, turns, conversation). Inside a shard
``numpy.lexsort`` orders the rows, a mask of the places where a column changes is OR-accumulated
from left to right and so marks where a node of each depth begins, and ``reduceat`` sums up members,
ends, children and subtrees of all depths.

Only nodes that hold the first or the last row of a shard can go on in another one. Their parts are
recombined by node; what belongs below them is added along the two border paths of each shard. Bands
behind the first give each conversation one sum, which is added to the nodes above it.

A node is named by its depth and the XOR of its turns' hashes, each salted by its place.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from hydrosignal.operators.attach import attach
from hydrosignal.operators.ordered import running_totals
from hydrosignal.session import materialize

#: Columns of a band.
DEPTHS = 16
#: Rows of a shard, on average.
SHARD_ROWS = 100_000
#: Bands that are summed up together along one conversation.
BANDS_PER_PART = 4096
#: Characters of a list of conversations that are passed on as one row.
PIECE = 16_384
#: The node a turnless conversation ends in.
ROOT = (0, 0, 0)
NODE = ["depth", "x", "y"]


@dataclass
class Trie:
    """``nodes``: one row per node. ``ends``: the node in which each conversation ends.

    ``nodes`` has (depth, x, y) as its name, conv_id, parent_conv_id, n_convs, n_children, n_leaves,
    saved (see ``build``), n_ends; ``ends`` has (depth, x, y, conv).
    """

    nodes: DataFrame
    ends: DataFrame


def numbered(
    turns: DataFrame, conv: str = "conv_id", turn: str = "turn", role: str = "role", text: str = "text"
) -> DataFrame:
    """(conv, pos, length, a, b, bytes): the place of every turn in its conversation, from 0.

    Turns are ordered by number, a null number first, equal numbers by a hash of role and text;
    repeated rows stay and follow each other. A null role or text counts as empty. Rows without a
    conversation are left out. (a, b) stands for role and text, ``bytes`` is the length of the text.
    Rows are numbered inside ranges of (conversation, turn), so a very long conversation is many
    tasks.
    """
    said = [F.coalesce(F.col(c).cast("string"), F.lit("")) for c in (role, text)]
    rows = turns.select(
        F.col(conv).alias("conv"),
        F.col(turn).alias("turn"),
        F.xxhash64(*said).alias("a"),
        F.xxhash64(F.lit("b"), *said).alias("b"),
        F.octet_length(said[1]).cast("long").alias("bytes"),
        F.monotonically_increasing_id().alias("seq"),
    ).filter("conv IS NOT NULL")
    # the order among equal rows must not change when a task is run again
    order = ["conv", "turn", "a", "b", "seq"]
    ranged = materialize(rows, "turns").repartitionByRange(*order).withColumn("shard", F.spark_partition_id())
    placed = running_totals(
        materialize(ranged, "turn-ranges"), ["conv"], F.col("shard"), [F.col(c) for c in order[1:]], {"pos": F.lit(1).cast("long")}
    )
    return placed.select("conv", (F.col("pos") - 1).alias("pos"), F.col("pos_all").alias("length"), "a", "b", "bytes")


def rebuilt(turns: DataFrame, group: int = 5, longest: int = 9) -> tuple[DataFrame, DataFrame]:
    """Conversations that begin with the first turns of another one: (steps, convs).

    Takes the table of ``numbered``. Conversation c has the first h turns of c - c % ``group`` (all,
    if there are fewer; none, if it is absent), then its own turns after its first h; h is the
    unsigned CRC-32 of its decimal number modulo ``longest``. ``steps``: (conv, i, last, a, b,
    bytes), i from 0, ``last`` at the end of a conversation; ``convs``: (conv, length) of all
    conversations, those without turns too.
    """
    turns = materialize(turns, "numbered")
    skip = F.crc32(F.col("conv").cast("string").cast("binary")) % F.lit(longest)
    whole = turns.filter("pos = 0").select("conv", "length", skip.alias("h"), (F.col("conv") - F.col("conv") % F.lit(group)).alias("base"))
    heads = (
        turns.filter(F.col("pos") < longest - 1)
        .groupBy("conv")
        .agg(F.sort_array(F.collect_list(F.struct("pos", "a", "b", "bytes"))).alias("head"))
    )
    # at most longest - 1 turns a conversation, asked for by the conversations of one group
    joined = whole.join(heads.withColumnRenamed("conv", "base"), "base", "left").withColumn(
        "head", F.expr("slice(coalesce(head, array()), 1, cast(h AS int))")
    )
    convs = materialize(
        joined.select(
            "conv", "h", "head", F.col("length").alias("own"), (F.size("head") + F.greatest(F.col("length") - F.col("h"), F.lit(0))).cast("long").alias("length")
        ),
        "conversations",
    )
    lent = convs.select("conv", "length", F.explode("head").alias("t")).select(
        "conv", F.col("t.pos").alias("i"), (F.col("t.pos") == F.col("length") - 1).alias("last"), "t.a", "t.b", "t.bytes"
    )
    moved = convs.filter((F.size("head") < F.col("h")) & (F.col("own") > F.col("h"))).select("conv", (F.col("h") - F.size("head")).cast("long").alias("less"))
    own = attach(turns.filter(F.col("pos") >= skip), moved, ["conv"], salt_by=["pos"]).select(
        "conv", (F.col("pos") - F.coalesce("less", F.lit(0))).alias("i"), (F.col("pos") == F.col("length") - 1).alias("last"), "a", "b", "bytes"
    )
    return lent.unionByName(own), convs.select("conv", "length")


def _running_xor(df: DataFrame, lanes: list[str]) -> DataFrame:
    """Adds p<lane>: the XOR over the earlier bands of a conversation. Parts of a conversation are worked on apart."""
    work = df.withColumn("_part", F.floor(F.col("band") / F.lit(BANDS_PER_PART)))
    before = Window.partitionBy("conv", "_part").orderBy("band").rowsBetween(Window.unboundedPreceding, -1)
    parts = work.groupBy("conv", "_part").agg(*[F.bit_xor(c).alias(f"_t{c}") for c in lanes])
    earlier = Window.partitionBy("conv").orderBy("_part").rowsBetween(Window.unboundedPreceding, -1)
    carried = parts.select("conv", "_part", *[F.coalesce(F.bit_xor(f"_t{c}").over(earlier), F.lit(0)).alias(f"_c{c}") for c in lanes])
    inside = work.withColumns({f"p{c}": F.coalesce(F.bit_xor(c).over(before), F.lit(0)) for c in lanes})
    joined = inside.join(carried, ["conv", "_part"])
    return joined.withColumns({f"p{c}": F.col(f"p{c}").bitwiseXOR(F.col(f"_c{c}")) for c in lanes}).drop("_part", *[f"_c{c}" for c in lanes])


def segments(steps: DataFrame, convs: DataFrame) -> DataFrame:
    """(conv, band, px, py, x, y, key, sizes, ends): the turns of a band as one row.

    ``key`` holds both hashes of each turn as sixteen bytes, (px, py) and (x, y) the XOR of what
    comes before the band and of the band itself.
    """
    lanes = steps.select("conv", "i", "last", "bytes", F.xxhash64("a", "i").alias("x"), F.xxhash64("b", "i").alias("y"))
    rows = (
        lanes.withColumn("band", F.floor(F.col("i") / F.lit(DEPTHS)))
        .groupBy("conv", "band")
        .agg(
            F.sort_array(F.collect_list(F.struct("i", "x", "y", "bytes"))).alias("turns"),
            F.bit_xor("x").alias("x"),
            F.bit_xor("y").alias("y"),
            F.max("last").alias("ends"),
        )
    )

    def octets(c: Column) -> Column:
        return F.lpad(F.hex(c), 16, "0")

    packed = _running_xor(rows, ["x", "y"]).select(
        "conv", "band", "px", "py", "x", "y",
        F.unhex(F.array_join(F.transform("turns", lambda t: F.concat(octets(t["x"]), octets(t["y"]))), "")).alias("key"),
        F.col("turns.bytes").alias("sizes"),
        "ends",
    )
    zero = F.lit(0).cast("long")
    turnless = convs.filter("length = 0").select(
        "conv", zero.alias("band"), *[zero.alias(c) for c in ("px", "py", "x", "y")],
        F.lit(b"").alias("key"), F.array().cast("array<long>").alias("sizes"), F.lit(True).alias("ends"),
    )
    return packed.unionByName(turnless)


@dataclass
class _Matrix:
    """Rows of one shard in order, with turn ids padded by -1."""

    band: np.ndarray
    prefix: np.ndarray
    ids: np.ndarray
    names: list[np.ndarray]
    sizes: np.ndarray
    length: np.ndarray
    conv: np.ndarray
    ends: np.ndarray


def _dense(*columns: np.ndarray) -> np.ndarray:
    """Ranks of rows by the given columns, equal rows alike; the first column counts most."""
    order = np.lexsort(columns[::-1])
    new = np.zeros(len(order), bool)
    for c in columns:
        new[1:] |= c[order][1:] != c[order][:-1]
    out = np.empty(len(order), np.int64)
    out[order] = np.cumsum(new)
    return out


def _matrix(rows: pa.Table) -> _Matrix:
    band, px, py, conv = (rows.column(c).to_numpy() for c in ("band", "px", "py", "conv"))
    keys = rows.column("key").combine_chunks().cast(pa.large_binary())
    length = (np.diff(np.frombuffer(keys.buffers()[1], np.int64, len(keys) + 1, keys.offset * 8)) // 16).astype(np.int64)
    flat = np.frombuffer(b"".join(keys.to_pylist()), ">u8").astype(np.uint64).reshape(-1, 2)
    width = int(length.max(initial=0))
    held = np.arange(width) < length[:, None]
    ids = np.full(held.shape, -1, np.int64)
    ids[held] = _dense(flat[:, 0], flat[:, 1])
    prefix = _dense(band, px, py)
    order = np.lexsort((conv, *ids.T[::-1], prefix))
    names = []
    for lane, before in zip(flat.T, (px, py), strict=True):
        padded = np.zeros(held.shape, np.uint64)
        padded[held] = lane
        start = before.astype(np.int64).view(np.uint64)[:, None]
        names.append(np.bitwise_xor.accumulate(np.hstack([start, padded]), axis=1).view(np.int64)[order])
    sizes = np.zeros(held.shape, np.int64)
    sizes[held] = rows.column("sizes").combine_chunks().flatten().to_numpy(zero_copy_only=False)
    ends = rows.column("ends").to_numpy(zero_copy_only=False).astype(bool)
    return _Matrix(band[order], prefix[order], ids[order], names, sizes[order], length[order], conv[order], ends[order])


PARTS = (
    "shard long, side int, depth long, x long, y long, px long, py long, conv_id long, n_convs long, n_ends long, "
    "bytes long, n_leaves long, saved long, n_children long, parent_conv_id long, late boolean, outside boolean"
)


def _nodes(m: _Matrix, shard: int) -> dict[str, np.ndarray]:
    """All nodes of a shard; those on its first (side 1) or last row (side 2) in part."""
    n, width = m.ids.shape
    changes = np.ones((n, width + 1), bool)
    changes[1:, 0] = m.prefix[1:] != m.prefix[:-1]
    changes[1:, 1:] = m.ids[1:] != m.ids[:-1]
    begins = np.logical_or.accumulate(changes, axis=1)
    leaves, saved = np.zeros(n, np.int64), np.zeros(n, np.int64)
    found: list[dict[str, np.ndarray]] = []
    for d in range(width, -1, -1):
        at = np.flatnonzero(begins[:, d])
        stop = np.append(at[1:], n)
        here = (m.length[at] >= d) if d else (m.band[at] == 0)
        members = stop - at
        ends = np.add.reduceat((m.ends & (m.length == d)).astype(np.int64), at)
        side = np.where(at == 0, 1, 0) + np.where(stop == n, 2, 0)
        size = m.sizes[at, d - 1] if d else np.zeros(len(at), np.int64)
        inner = here & (side == 0)
        np.add.at(leaves, at[inner], (members == ends)[inner].astype(np.int64))
        np.add.at(saved, at[inner], ((members - 1) * size)[inner])
        if d < width:
            children = np.add.reduceat((begins[:, d + 1] & (m.length > d)).astype(np.int64), at)
        else:
            children = np.zeros(len(at), np.int64)
        node = {
            "side": side,
            "depth": m.band[at] * DEPTHS + d,
            "x": m.names[0][at, d],
            "y": m.names[1][at, d],
            "px": m.names[0][at, max(d - 1, 0)],
            "py": m.names[1][at, max(d - 1, 0)],
            "conv_id": np.minimum.reduceat(m.conv, at),
            "n_convs": members,
            "n_ends": ends,
            "bytes": size,
            "n_leaves": np.add.reduceat(leaves, at),
            "saved": np.add.reduceat(saved, at),
            "n_children": children,
            "late": (side > 0) | (d == DEPTHS),
            "at": at,
        }
        found.append({k: v[here] for k, v in node.items()})
        if len(found) > 1 and d:
            _under(found[-2], found[-1])
        elif len(found) > 1:
            _under(found[-2], node)
    top = found[-1]
    top["parent_conv_id"], top["outside"] = np.full(len(top["at"]), -1), np.ones(len(top["at"]), bool)
    out = {k: np.concatenate([f[k] for f in found]) for k in top}
    return {"shard": np.full(len(out["at"]), shard), **out}


def _under(child: dict[str, np.ndarray], parent: dict[str, np.ndarray]) -> None:
    """The smallest conversation of each child's parent; ``outside`` if the parent is not whole here."""
    above = np.searchsorted(parent["at"], child["at"], "right") - 1
    # the column before the first of a later band belongs to the band before
    whole = (parent["side"][above] == 0) & (child["depth"] % DEPTHS != 1)
    child["parent_conv_id"] = np.where(whole, parent["conv_id"][above], -1)
    child["outside"] = ~whole


def _shard(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    held = list(batches)
    if not sum(len(b) for b in held):
        return
    nodes = _nodes(_matrix(pa.Table.from_batches(held)), TaskContext.get().partitionId())
    names = [c.split()[0] for c in PARTS.split(", ")]
    kinds = {"int": pa.int32(), "long": pa.int64(), "boolean": pa.bool_()}
    columns = [pa.array(nodes[c.split()[0]]).cast(kinds[c.split()[1]]) for c in PARTS.split(", ")]
    yield from pa.Table.from_arrays(columns, names=names).to_batches(10_000)


def _bordering(parts: DataFrame) -> DataFrame:
    """Nodes on the border paths of shards, recombined, with what lies below them."""
    some = parts.filter("side > 0").withColumn("path", F.expr("explode(filter(array(side & 1, side & 2), p -> p > 0))"))
    once = parts.filter("side > 0")
    whole = materialize(
        once.groupBy(*NODE).agg(
            *[F.min(c).alias(c) for c in ("px", "py", "conv_id", "bytes")],
            *[F.sum(c).alias(c) for c in ("n_convs", "n_ends", "n_leaves", "saved")],
            F.min(F.struct("shard", F.expr("CASE WHEN side & 1 > 0 THEN 1 ELSE 2 END").alias("path"))).alias("home"),
        ),
        "border",
    )
    # every node counts on one path; a node above it is on that path too
    values = whole.select(
        *NODE, "home", (F.col("n_convs") == F.col("n_ends")).cast("long").alias("leaf"), ((F.col("n_convs") - 1) * F.col("bytes")).alias("own")
    )
    deeper = Window.partitionBy("shard", "path").orderBy(F.col("depth").desc()).rowsBetween(Window.unboundedPreceding, 0)
    at_home = F.struct("shard", "path") == F.struct("home.shard", "home.path")
    along = some.select(*NODE, "shard", "path").join(values, NODE)
    below = (
        along.select(*NODE, *[F.sum(F.when(at_home, F.col(c)).otherwise(0)).over(deeper).alias(c) for c in ("leaf", "own")])
        .groupBy(*NODE)
        .agg(F.sum("leaf").alias("leaf"), F.sum("own").alias("own"))
    )
    return whole.join(below, NODE).select(
        *NODE, "px", "py", "conv_id", "n_convs", "n_ends", "bytes",
        (F.col("n_leaves") + F.col("leaf")).alias("n_leaves"), (F.col("saved") + F.col("own")).alias("saved"),
        F.lit(0).cast("long").alias("n_children"), F.lit(-1).cast("long").alias("parent_conv_id"),
        F.lit(True).alias("late"), F.lit(True).alias("outside"),
    )


def _spread(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """What later bands of a conversation add to each node that it passes in a band."""
    for batch in batches:
        if not len(batch):
            continue
        m = _matrix(pa.Table.from_batches([batch]))
        # the matrix is in the order of its rows; sums are found again by (conversation, band)
        rows = {(c, b): (le, s) for c, b, le, s in zip(*(batch.column(k).to_pylist() for k in ("conv", "band", "more_leaves", "more_saved")), strict=True)}
        more = np.array([rows[c, b] for c, b in zip(m.conv.tolist(), m.band.tolist(), strict=True)], np.int64)
        n, width = m.ids.shape
        d = np.broadcast_to(np.arange(width + 1), (n, width + 1))
        passed = (d <= m.length[:, None]) & ((d > 0) | (m.band == 0)[:, None])
        row = np.nonzero(passed)[0]
        columns = [(m.band[row] * DEPTHS + d[passed]), m.names[0][passed], m.names[1][passed], more[row, 0], more[row, 1]]
        yield pa.RecordBatch.from_arrays([pa.array(c, pa.int64()) for c in columns], names=["depth", "x", "y", "more_leaves", "more_saved"])


def _later_bands(nodes: DataFrame, rows: DataFrame) -> DataFrame:
    """(depth, x, y, more_leaves, more_saved) of nodes above a later band."""
    own = (
        nodes.filter(F.col("depth") > DEPTHS)
        .withColumn("band", F.floor((F.col("depth") - 1) / F.lit(DEPTHS)))
        .groupBy(F.col("conv_id").alias("conv"), "band")
        .agg(
            F.sum((F.col("n_convs") == F.col("n_ends")).cast("long")).alias("leaves"),
            F.sum((F.col("n_convs") - 1) * F.col("bytes")).alias("saves"),
        )
        .filter("leaves > 0 OR saves > 0")
    )
    own = materialize(own, "later-bands")
    known = rows.join(own.select("conv").distinct(), "conv", "left_semi").join(own, ["conv", "band"], "left")
    summed = running_totals(
        known.fillna(0, ["leaves", "saves"]),
        ["conv"],
        F.floor(F.col("band") / F.lit(BANDS_PER_PART)),
        [F.col("band").desc()],
        {"more_leaves": F.col("leaves"), "more_saved": F.col("saves")},
        descending_parts=True,
    )
    rest = summed.withColumns(
        {"more_leaves": F.col("more_leaves") - F.col("leaves"), "more_saved": F.col("more_saved") - F.col("saves")}
    ).filter("more_leaves > 0 OR more_saved > 0")
    spread = rest.select("conv", "band", "px", "py", "key", "sizes", "ends", "more_leaves", "more_saved").mapInArrow(
        _spread, "depth long, x long, y long, more_leaves long, more_saved long"
    )
    return spread.groupBy(*NODE).agg(F.sum("more_leaves").alias("more_leaves"), F.sum("more_saved").alias("more_saved"))


def build(steps: DataFrame, convs: DataFrame) -> Trie:
    """The trie of all conversations.

    ``steps``: (conv long, i from 0 without gaps, last, a, b, bytes); ``convs``: (conv, length) of every
    conversation once. A node's conv_id is its smallest member; n_leaves counts the childless nodes
    of its subtree (itself included), saved sums (n_convs - 1) * bytes over its subtree. Without
    conversations there is no node, with turnless ones only there is the root. One conversation may
    hold most of all turns, and one first turn may be that of most conversations: neither is worked
    on by a single task.
    """
    rows = materialize(segments(steps, convs), "segments")
    shards = max(int(rows.sparkSession.conf.get("spark.sql.shuffle.partitions")), -(-rows.count() // SHARD_ROWS))
    ranged = rows.select("band", "px", "py", "key", "conv", "sizes", "ends").repartitionByRange(shards, "band", "px", "py", "key", "conv")
    parts = materialize(ranged.mapInArrow(_shard, PARTS), "trie-parts")
    nodes = materialize(parts.filter("side = 0").drop("shard", "side").unionByName(_bordering(parts)), "trie-nodes")
    above = [(F.col("depth") - 1).alias("depth"), F.col("px").alias("x"), F.col("py").alias("y")]
    outside = nodes.filter("outside AND depth > 0")
    kids = outside.select(*above).groupBy(*NODE).agg(F.count(F.lit(1)).alias("kids"))
    parents = nodes.filter("late").select("conv_id", *[F.col(c).alias(f"p_{c}") for c in NODE])
    asked = outside.withColumn("p_depth", F.col("depth") - 1).withColumn("p_x", F.col("px")).withColumn("p_y", F.col("py"))
    found = attach(
        asked.drop("parent_conv_id"), parents.withColumnRenamed("conv_id", "parent_conv_id"), ["p_depth", "p_x", "p_y"], salt_by=["x", "y"]
    ).drop("p_depth", "p_x", "p_y")
    joined = nodes.filter("NOT outside OR depth = 0").unionByName(found).join(kids, NODE, "left")
    joined = joined.join(_later_bands(nodes, rows), NODE, "left")
    done = joined.select(
        *NODE,
        "conv_id",
        F.when(F.col("depth") > 0, F.col("parent_conv_id")).alias("parent_conv_id"),
        "n_convs",
        F.when(F.col("late"), F.coalesce("kids", F.lit(0))).otherwise(F.col("n_children")).alias("n_children"),
        (F.col("n_leaves") + F.coalesce("more_leaves", F.lit(0))).alias("n_leaves"),
        (F.col("saved") + F.coalesce("more_saved", F.lit(0))).alias("saved"),
        "n_ends",
    )
    ends = rows.filter("ends").select(
        (F.col("band") * DEPTHS + F.size("sizes")).alias("depth"),
        F.col("px").bitwiseXOR(F.col("x")).alias("x"),
        F.col("py").bitwiseXOR(F.col("y")).alias("y"),
        "conv",
    )
    return Trie(done, ends)


def last_turns(nodes: DataFrame, steps: DataFrame, turns: DataFrame, role: str = "role", text: str = "text") -> DataFrame:
    """``nodes`` with the role and text of their last turn; null at the root.

    ``steps`` are those that the trie was built from, ``turns`` the table with the texts.
    """
    said = [F.coalesce(F.col(c).cast("string"), F.lit("")) for c in (role, text)]
    known = (
        turns.select(*[c.alias(n) for c, n in zip(said, ("_role", "_text"), strict=True)])
        .groupBy(F.xxhash64("_role", "_text").alias("a"), F.xxhash64(F.lit("b"), "_role", "_text").alias("b"))
        .agg(F.min("_role").alias(role), F.min("_text").alias(text))
    )
    at = steps.select(F.col("conv").alias("conv_id"), (F.col("i") + 1).alias("depth"), "a", "b")
    return attach(nodes.join(at, ["conv_id", "depth"], "left"), known, ["a", "b"], salt_by=["x", "y"]).drop("a", "b")


def _joined_ends(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Digests of nodes whose ends all lie within a range; pieces of the others' lists.

    The first and the last node of a range may go on elsewhere, long lists are passed on in pieces.
    """
    shard = TaskContext.get().partitionId()
    out: list[tuple] = []
    now, held, size, piece, whole = None, [], 0, 0, False

    def flush() -> None:
        nonlocal held, size, piece
        if held:
            out.append((*now, shard, piece, ",".join(held), None))
            held, size, piece = [], 0, piece + 1

    def batch() -> pa.RecordBatch:
        nonlocal out
        columns = list(zip(*out, strict=True))
        out = []
        kinds = [pa.int64()] * 5 + [pa.string(), pa.string()]
        return pa.RecordBatch.from_arrays(
            [pa.array(c, k) for c, k in zip(columns, kinds, strict=True)], names=["x", "y", "depth", "shard", "piece", "part", "digest"]
        )

    for rows in batches:
        for *node, conv in zip(*(rows.column(c).to_pylist() for c in ("x", "y", "depth", "conv")), strict=True):
            if node != now:
                if whole and not piece:
                    out.append((*now, None, None, None, hashlib.sha256(",".join(held).encode()).hexdigest()))
                else:
                    flush()
                whole = now is not None
                now, held, size, piece = node, [], 0, 0
            held.append(str(conv))
            size += len(held[-1]) + 1
            if size >= PIECE:
                flush()
        if out:
            yield batch()
    flush()
    if out:
        yield batch()


def _digested(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    now, state = None, None
    out: list[tuple] = []
    for rows in batches:
        for *node, part in zip(*(rows.column(c).to_pylist() for c in ("x", "y", "depth", "part")), strict=True):
            if node != now:
                if now is not None:
                    out.append((*now, state.hexdigest()))
                now, state = node, hashlib.sha256(part.encode())
            else:
                state.update(b"," + part.encode())
    if now is not None:
        out.append((*now, state.hexdigest()))
    if out:
        columns = zip(*out, strict=True)
        kinds = [pa.int64()] * 3 + [pa.string()]
        yield pa.RecordBatch.from_arrays([pa.array(c, k) for c, k in zip(columns, kinds, strict=True)], names=["x", "y", "depth", "digest"])


def end_digests(ends: DataFrame) -> DataFrame:
    """(depth, x, y, digest): SHA-256 of the comma-joined numbers of the conversations that end in a node.

    The numbers are joined in rising order inside ranges of (node, conversation); of a node that
    spans ranges the pieces follow each other through one hash, a batch at a time.
    """
    order = ["x", "y", "depth", "conv"]
    pieces = materialize(
        ends.repartitionByRange(*order).sortWithinPartitions(*order).mapInArrow(
            _joined_ends, "x long, y long, depth long, shard long, piece long, part string, digest string"
        ),
        "ends",
    )
    open_ones = pieces.filter("digest IS NULL").repartition("x", "y", "depth").sortWithinPartitions("x", "y", "depth", "shard", "piece")
    spanning = open_ones.mapInArrow(_digested, "x long, y long, depth long, digest string")
    return pieces.filter("digest IS NOT NULL").select(*NODE, "digest").unionByName(spanning.select(*NODE, "digest"))
