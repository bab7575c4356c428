"""Hard negatives by inner product with length buckets and coordinate pruning.

Vectors are scaled to whole numbers and cut into buckets of falling length; each bucket keeps, for
every coordinate, its rows sorted by value. To find the rows of a bucket whose product with an
anchor is at least t, nothing is needed if t exceeds the product of both lengths. Otherwise such
rows lie in a cap of the bucket's ball, and the cap bounds each of their coordinates. The largest
coordinates of the anchor are its focus: their feasible ranges are slices of the sorted lists, the
candidate sets are intersected, and what remains is verified by exact products. t is the limit of
the query, or the last of the best products found so far if that is higher.

The anchors are a stated part of the rows and are compared in blocks with blocks of buckets; every
pair of blocks hands on its best rows only.
"""

from __future__ import annotations

import math
from collections.abc import Callable, Iterator
from dataclasses import dataclass, field

import numpy as np
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from hydrosignal.session import materialize

#: Bytes of one bucket (values and sorted lists), and its rows at most.
BUCKET_BYTES = 1_000_000
BUCKET_ROWS = 2048
#: Buckets that are searched one after another for a block of anchors.
GROUP = 8
#: Bytes of the anchors of one block, on average.
ANCHOR_BYTES = 4_000_000
#: Coordinates of an anchor whose feasible ranges are used.
FOCUS = 3
#: Whole numbers up to which products of doubles are exact.
EXACT = 2.0**53
LONG = 2**63 - 1


def _codes(label: str, df: DataFrame) -> Column:
    """Labels as longs: integers as they are, others by hash."""
    if df.schema[label].dataType.simpleString() in ("tinyint", "smallint", "int", "bigint"):
        return F.col(label).cast("long")
    return F.xxhash64(label)


def _scaled(scale: int) -> Callable:
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            seq, ids, code, anchor, v = (batch.column(c) for c in ("seq", "id", "code", "anchor", "v"))
            flat = np.floor(scale * v.flatten().to_numpy(zero_copy_only=False).astype(np.float64))
            width = pa.compute.list_value_length(v).to_numpy(zero_copy_only=False).astype(np.int64)
            ends = np.cumsum(width)
            out, wide, norm = [], [], []
            for a, b in zip(ends - width, ends, strict=True):
                x = flat[a:b]
                far = bool((np.abs(x) >= 2**31 - 1).any())
                wide.append(far)
                out.append(x.tobytes() if far else x.astype(np.int32).tobytes())
                most = float(np.abs(x).max(initial=0))
                norm.append(most * float(np.sqrt(((x / most) ** 2).sum())) if most else 0.0)
            columns = [seq, ids, code, anchor, pa.array(width.astype(np.int32)), pa.array(wide), pa.array(norm, pa.float64()), pa.array(out, pa.binary())]
            yield pa.RecordBatch.from_arrays(columns, names=["seq", "id", "code", "anchor", "width", "wide", "norm", "q"])

    return run


def whole_vectors(vectors: DataFrame, key: str, vector: str, label: str, anchors: Column, scale: int) -> DataFrame:
    """(seq, id, code, anchor, width, wide, norm, q): floor(scale * x) of every usable row, written once.

    Left out: rows with a null label or vector, or with null or non-finite components.
    """
    finite = F.forall(vector, lambda x: x.isNotNull() & ~F.isnan(x) & (F.abs(x) < F.lit(math.inf)))
    rows = vectors.filter(F.col(label).isNotNull() & F.coalesce(finite, F.lit(False))).select(
        F.monotonically_increasing_id().alias("seq"),
        F.col(key).alias("id"),
        _codes(label, vectors).alias("code"),
        F.coalesce(anchors, F.lit(False)).alias("anchor"),
        F.col(vector).cast("array<double>").alias("v"),
    )
    kind = vectors.schema[key].dataType.simpleString()
    return materialize(
        rows.mapInArrow(_scaled(scale), f"seq long, id {kind}, code long, anchor boolean, width int, wide boolean, norm double, q binary"), "whole-vectors"
    )


BUCKET = (
    "gid long, place long, width int, wide boolean, least double, most double, rows int, seq binary, ids binary, known binary, "
    "code binary, q binary, sorted binary"
)


def _runs(batches: Iterator[pa.RecordBatch], limit: Callable[[int], int]) -> Iterator[dict[str, list]]:
    """Consecutive rows of one width and kind, at most ``limit(width)`` at a time."""
    names = ("seq", "id", "code", "norm", "q")
    held: dict[str, list] = {n: [] for n in names}
    kind = None
    for batch in batches:
        columns = {n: batch.column(n).to_pylist() for n in names}
        kinds = list(zip(batch.column("width").to_pylist(), batch.column("wide").to_pylist(), strict=True))
        for i, k in enumerate(kinds):
            if held["seq"] and (k != kind or len(held["seq"]) >= limit(k[0])):
                yield {**held, "width": kind[0], "wide": kind[1]}
                held = {n: [] for n in names}
            kind = k
            for n in names:
                held[n].append(columns[n][i])
    if held["seq"]:
        yield {**held, "width": kind[0], "wide": kind[1]}


def _values(q: bytes, rows: int, width: int, wide: bool) -> np.ndarray:
    return np.frombuffer(q, np.float64 if wide else np.int32).reshape(rows, width)


def _ids(ids: list) -> tuple[bytes, bytes]:
    known = np.array([i is not None for i in ids])
    return np.array([LONG if i is None else i for i in ids], np.int64).tobytes(), known.tobytes()


def _bucketed(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    shard = TaskContext.get().partitionId()
    names = [c.split()[0] for c in BUCKET.split(", ")]
    schema = pa.schema(list(zip(names, [pa.int64(), pa.int64(), pa.int32(), pa.bool_(), pa.float64(), pa.float64(), pa.int32(), *[pa.binary()] * 6], strict=True)))
    limit = lambda width: min(BUCKET_ROWS, max(16, BUCKET_BYTES // (6 * max(width, 1))))
    for place, run in enumerate(_runs(batches, limit)):
        n = len(run["seq"])
        q = b"".join(run["q"])
        x = _values(q, n, run["width"], run["wide"])
        order = np.argsort(x.T, axis=1, kind="stable").astype(np.uint16)
        ids, known = _ids(run["id"])
        row = [
            shard << 32 | place // GROUP, place, run["width"], run["wide"], min(run["norm"]), max(run["norm"]), n,
            np.array(run["seq"], np.int64).tobytes(), ids, known, np.array(run["code"], np.int64).tobytes(), q, order.tobytes(),
        ]
        yield pa.RecordBatch.from_arrays([pa.array([v], t) for v, t in zip(row, schema.types, strict=True)], schema=schema)


def buckets(rows: DataFrame) -> DataFrame:
    """Rows in buckets of falling length with their sorted coordinate lists, in groups of ``GROUP``.

    Rows of one length are told apart by their place in the table, so equal vectors spread.
    """
    order = ["width", "wide", F.col("norm").desc(), "seq"]
    ranged = rows.repartitionByRange(*order).sortWithinPartitions(*order)
    return materialize(ranged.mapInArrow(_bucketed, BUCKET), "buckets")


@dataclass
class _Bucket:
    """A bucket as it is searched."""

    width: int
    wide: bool
    most: float
    seq: np.ndarray
    ids: np.ndarray
    known: np.ndarray
    code: np.ndarray
    x: np.ndarray
    order: np.ndarray
    lists: np.ndarray = field(init=False)
    exact: np.ndarray | None = None

    def __post_init__(self) -> None:
        self.lists = np.take_along_axis(self.x.T, self.order.astype(np.int64), axis=1)
        self.x = self.x.astype(np.float64)

    def candidates(self, q: np.ndarray, length: float, least: float) -> np.ndarray | None:
        """Rows that may reach the product ``least``; None for all."""
        if least == -math.inf or not length or self.wide:
            return None
        most = self.most * (1 + 1e-12)
        at = least / length
        if at > most * (1 + 1e-9):
            return np.zeros(0, np.int64)
        if at <= -most:
            return None
        radius = math.sqrt(max(most * most - at * at, 0.0))
        slack = 1e-6 * (most + 1)
        ranges = []
        for f in np.argsort(-np.abs(q), kind="stable")[:FOCUS].tolist():
            along = q[f] / length
            across = math.sqrt(max(1 - along * along, 0.0))
            high = most if most * along >= at else at * along + radius * across
            low = -most if -most * along >= at else at * along - radius * across
            a = int(np.searchsorted(self.lists[f], low - slack, "left"))
            b = int(np.searchsorted(self.lists[f], high + slack, "right"))
            ranges.append((b - a, f, a, b, low - slack, high + slack))
        ranges.sort()
        size, f, a, b, _, _ = ranges[0]
        if size >= len(self.seq):
            return None
        found = self.order[f, a:b].astype(np.int64)
        for size, f, _, _, low, high in ranges[1:]:
            if size < len(self.seq):
                values = self.x[found, f]
                found = found[(values >= low) & (values <= high)]
        return found

    def products(self, rows: np.ndarray, q: np.ndarray, length: float, wide: bool) -> np.ndarray:
        """Exact products as longs; in the rare case that doubles cannot hold them by whole numbers of any size."""
        if not wide and not self.wide and length * self.most < EXACT:
            return (self.x[rows] @ q).astype(np.int64)
        if self.exact is None:
            self.exact = np.array([[int(v) for v in row] for row in self.x], object).reshape(self.x.shape)
        other = [int(v) for v in q]
        found = [sum(a * b for a, b in zip(row, other, strict=True)) for row in self.exact[rows]]
        return np.array([min(max(s, -LONG), LONG) for s in found], np.int64)


def _read_buckets(table: pa.Table) -> list[_Bucket]:
    rows = sorted(table.to_pylist(), key=lambda r: r["place"])
    return [
        _Bucket(
            r["width"], r["wide"], r["most"],
            *[np.frombuffer(r[c], k) for c, k in (("seq", np.int64), ("ids", np.int64), ("known", bool), ("code", np.int64))],
            _values(r["q"], r["rows"], r["width"], r["wide"]),
            np.frombuffer(r["sorted"], np.uint16).reshape(r["width"], r["rows"]),
        )
        for r in rows
    ]


@dataclass
class _Best:
    """The best rows found so far: falling score, then rising id, unknown ids last."""

    size: int
    score: np.ndarray = field(default_factory=lambda: np.zeros(0, np.int64))
    ids: np.ndarray = field(default_factory=lambda: np.zeros(0, np.int64))
    known: np.ndarray = field(default_factory=lambda: np.zeros(0, bool))
    seq: np.ndarray = field(default_factory=lambda: np.zeros(0, np.int64))

    def least(self, otherwise: float) -> float:
        return float(self.score[-1]) if len(self.score) == self.size else otherwise

    def add(self, bucket: _Bucket, rows: np.ndarray, score: np.ndarray) -> None:
        if not len(rows):
            return
        if len(rows) > 4 * self.size:  # all rows tied with the last one that can stay are kept
            keep = score >= np.partition(score, -self.size)[-self.size]
            rows, score = rows[keep], score[keep]
        score = np.concatenate([self.score, score])
        ids = np.concatenate([self.ids, bucket.ids[rows]])
        known = np.concatenate([self.known, bucket.known[rows]])
        seq = np.concatenate([self.seq, bucket.seq[rows]])
        order = np.lexsort((seq, ids, ~known, -score))[: self.size]
        self.score, self.ids, self.known, self.seq = score[order], ids[order], known[order], seq[order]


FOUND = "anchor long, pair int, score long, id long, seq long"


def _found(best: list[tuple[int, int, _Best]]) -> pa.Table:
    kinds = [("anchor", pa.int64()), ("pair", pa.int32()), ("score", pa.int64()), ("id", pa.int64()), ("seq", pa.int64())]
    held = [(s, p, b) for s, p, b in best if len(b.seq)]
    counts = [len(b.seq) for _, _, b in held]
    join = lambda parts, kind: np.concatenate([np.zeros(0, kind), *parts]).astype(kind)
    known = join([b.known for _, _, b in held], bool)
    columns = [
        pa.array(np.repeat(np.array([s for s, _, _ in held], np.int64), counts)),
        pa.array(np.repeat(np.array([p for _, p, _ in held], np.int32), counts)),
        pa.array(join([b.score for _, _, b in held], np.int64)),
        pa.array(join([b.ids for _, _, b in held], np.int64), mask=~known),
        pa.array(join([b.seq for _, _, b in held], np.int64)),
    ]
    return pa.Table.from_arrays([c.cast(k) for c, (_, k) in zip(columns, kinds, strict=True)], names=[n for n, _ in kinds])


def _anchors(table: pa.Table) -> Iterator[tuple[int, int, np.ndarray, bool, dict]]:
    for row in table.to_pylist():
        q = _values(row["q"], 1, row["width"], row["wide"])[0].astype(np.float64)
        yield row["seq"], row["code"], q, row["wide"], row


def _positives(size: int) -> Callable:
    def run(left: pa.Table, right: pa.Table) -> pa.Table:
        parts, best = _read_buckets(left), []
        for seq, code, q, wide, row in _anchors(right):
            held, length = _Best(size), row["norm"]
            for bucket in parts:
                if bucket.width != len(q):
                    continue
                rows = bucket.candidates(q, 0.0 if wide else length, held.least(-math.inf))
                same = bucket.code == code if rows is None else bucket.code[rows] == code
                rows = np.flatnonzero(same) if rows is None else rows[same]
                rows = rows[bucket.seq[rows] != seq]
                if len(rows):
                    score = bucket.products(rows, q, length, wide)
                    good = score >= held.least(-math.inf)
                    held.add(bucket, rows[good], score[good])
            best.append((seq, 0, held))
        return _found(best)

    return run


def _negatives(size: int) -> Callable:
    def run(left: pa.Table, right: pa.Table) -> pa.Table:
        parts, best = _read_buckets(left), []
        for seq, code, q, wide, row in _anchors(right):
            bands, length = sorted({(lo, hi) for lo, hi in zip(row["low"], row["high"], strict=True) if lo <= hi}), row["norm"]
            held = [_Best(size) for _ in bands]
            for bucket in parts if bands else []:
                if bucket.width != len(q):
                    continue
                least = [b.least(lo) for b, (lo, _) in zip(held, bands, strict=True)]
                rows = bucket.candidates(q, 0.0 if wide else length, min(least))
                other = bucket.code != code if rows is None else bucket.code[rows] != code
                rows = np.flatnonzero(other) if rows is None else rows[other]
                if not len(rows):
                    continue
                score = bucket.products(rows, q, length, wide)
                for b, (_, hi), lo in zip(held, bands, least, strict=True):
                    good = (score >= lo) & (score <= hi)
                    b.add(bucket, rows[good], score[good])
            at = {band: b for band, b in zip(bands, held, strict=True)}
            best += [(seq, p, at[lo, hi]) for p, lo, hi in zip(row["pair"], row["low"], row["high"], strict=True) if lo <= hi]
        return _found(best)

    return run


def _searched(parts: DataFrame, anchors: DataFrame, run: Callable) -> DataFrame:
    """All blocks of anchors against all groups of buckets."""
    wide = anchors.agg(F.sum(F.octet_length("q")).alias("n")).first()["n"] or 0
    chunks = max(1, -(-int(wide) // ANCHOR_BYTES))
    blocks = anchors.withColumn("chunk", F.pmod(F.xxhash64("seq"), F.lit(chunks)))
    # block numbers only: the stated anchors meet all rows in blocks
    met = parts.select("gid").distinct().withColumn("chunk", F.explode(F.sequence(F.lit(0).cast("long"), F.lit(chunks - 1).cast("long"))))
    met = materialize(met, "blocks")
    asked = parts.join(met, "gid")
    asking = blocks.join(met.toDF("met", "chunk"), "chunk")
    return asked.groupBy("gid", "chunk").cogroup(asking.groupBy("met", "chunk")).applyInArrow(run, FOUND)


def mine(
    vectors: DataFrame, anchors: Column, key: str = "vec_id", vector: str = "embedding", label: str = "label", scale: int = 256,
    positives: int = 5, negatives: int = 10, low: int = 30, high: int = 90,
) -> DataFrame:
    """(anchor_id, positive_id, rank, negative_id, positive_score, negative_score).

    A row's score is the product of its vector floor(``scale`` * x) with the anchor's. Positives of
    an anchor are the first ``positives`` other rows of its label, by falling score, then rising key;
    negatives of both are the first ``negatives`` rows of other labels with low * positive_score <=
    100 * score <= high * positive_score. An anchor or positive without any gives no row.

    ``anchors`` is a condition on ``vectors``. Rows with a null label or vector, or with null or
    non-finite components, take no part. Vectors of different lengths are not compared, empty ones
    score 0. Repeated rows are rows of their own; a null key comes last among equal scores. Scores
    beyond a long count as the largest long. Other columns are not read.
    """
    rows = whole_vectors(vectors, key, vector, label, anchors, scale)
    parts = buckets(rows)
    asking = rows.filter("anchor").select("seq", "id", "code", "width", "wide", "norm", "q")
    order = [F.col("score").desc(), F.col("id").asc_nulls_last(), F.col("seq")]
    near = _searched(parts, asking.drop("id"), _positives(positives))
    liked = materialize(_first(near, ["anchor"], order, positives).select("anchor", "rank", "id", "score"), "positives")
    score = F.col("score").cast("decimal(38,0)")
    bands = liked.groupBy(F.col("anchor").alias("seq")).agg(
        F.sort_array(
            F.collect_list(
                F.struct(
                    F.col("rank").alias("pair"),
                    F.least(F.ceil(score * low / 100), F.lit(LONG).cast("decimal(38,0)")).cast("long").alias("low"),
                    F.floor(score * high / 100).cast("long").alias("high"),
                )
            )
        ).alias("b")
    )
    banded = asking.drop("id").join(bands, "seq").select("*", "b.pair", "b.low", "b.high").drop("b")
    far = _searched(parts, banded, _negatives(negatives))
    hard = _first(far, ["anchor", "pair"], order, negatives)
    named = liked.select("anchor", F.col("rank").alias("pair"), F.col("id").alias("positive_id"), F.col("score").alias("positive_score"))
    return (
        hard.select("anchor", "pair", "rank", F.col("id").alias("negative_id"), F.col("score").alias("negative_score"))
        .join(named, ["anchor", "pair"])
        .join(asking.select(F.col("seq").alias("anchor"), F.col("id").alias("anchor_id")), "anchor")
        .select("anchor_id", "positive_id", "rank", "negative_id", "positive_score", "negative_score")
    )


def _first(found: DataFrame, keys: list[str], order: list[Column], size: int) -> DataFrame:
    """The first rows of each key, with their ``rank``; every task sends at most ``size`` of a key."""
    w = Window.partitionBy(*keys).orderBy(*order)
    return found.withColumn("rank", F.row_number().over(w)).filter(F.col("rank") <= size)
