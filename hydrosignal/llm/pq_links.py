"""Near-duplicate vectors by product quantisation and exact rerank.

Unit vectors are assigned to the nearest of a set of coarse centroids (inverted lists); what
remains is cut into subspaces and coded by the nearest of a few sub-centroids. The centroids are
fitted on a bounded sample, but every vector is indexed. Let d be the distance that belongs to
the cosine threshold.

* A list is probed if the vector lies within d / 2 of the border between its own cell and that
  list's. Of two vectors at most d apart in two cells, at least one lies so near to the border
  between them, and a pair is compared if either of the two probes the other's list. So no pair is
  lost, whatever the lists are like.
* A coded vector is a candidate unless its table-lookup distance exceeds d by more than the coding
  error kept with it; by the triangle inequality this loses nothing.

Candidates are verified by their cosine in double precision.
"""

from __future__ import annotations

import math
import pickle
from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from hydrosignal.llm.links import components
from hydrosignal.operators.attach import attach
from hydrosignal.session import discard, materialize, materialize_at, scratch_dir

LEAST_COSINE = 0.93
#: Vectors on which the centroids are fitted, the first in a seeded order.
FIT_ROWS = 40_000
#: Vectors of the fit sample per coarse list.
ROWS_PER_LIST = 256
SUBSPACE = 8
CODES = 32
#: Vectors that are packed and compared together: at least so many where a label has them, at most twice as many on average.
BLOCK = 384
#: Labels up to which their tables of lists are broadcast.
LABELS = 2_000
#: Slack for single rounding steps of the pruning distances.
EPSILON = 1e-6


@dataclass
class Book:
    """Coarse centroids, and per subspace the code centroids of the residuals."""

    coarse: np.ndarray
    codes: list[np.ndarray]


def _squared(x: np.ndarray, y: np.ndarray) -> np.ndarray:
    return np.maximum((x * x).sum(1)[:, None] - 2 * x @ y.T + (y * y).sum(1), 0)


def _kmeans(x: np.ndarray, k: int, rounds: int = 8) -> np.ndarray:
    rng = np.random.default_rng(7)
    x = np.unique(x, axis=0)
    centres = x[rng.choice(len(x), min(k, len(x)), replace=False)]
    for _ in range(rounds):
        near = _squared(x, centres).argmin(1)
        sums = np.zeros_like(centres)
        np.add.at(sums, near, x)
        counts = np.bincount(near, minlength=len(centres))
        filled = counts > 0
        centres[filled] = sums[filled] / counts[filled, None]
    return centres


def _parts(width: int) -> list[slice]:
    return [slice(a, min(a + SUBSPACE, width)) for a in range(0, width, SUBSPACE)]


def fit_book(sample: np.ndarray) -> Book:
    coarse = _kmeans(sample, max(1, len(sample) // ROWS_PER_LIST))
    rest = sample - coarse[_squared(sample, coarse).argmin(1)]
    return Book(coarse, [_kmeans(rest[:, p].copy(), CODES) for p in _parts(sample.shape[1])])


def probes(book: Book, x: np.ndarray, distance: float) -> tuple[np.ndarray, np.ndarray]:
    """Own list of each unit vector, and a mask of the lists it probes."""
    to = _squared(x, book.coarse)
    own = to.argmin(1)
    apart = np.sqrt(_squared(book.coarse[own], book.coarse))
    border = to - to[np.arange(len(x)), own][:, None]
    return own, border <= 2 * apart * (distance / 2 + EPSILON) + EPSILON


def encode(book: Book, x: np.ndarray, own: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Residual codes of vectors and the distance from each to what its code stands for."""
    rest = x - book.coarse[own]
    codes = np.empty((len(x), len(book.codes)), np.uint8)
    error = np.zeros(len(x))
    for i, (p, centres) in enumerate(zip(_parts(x.shape[1]), book.codes, strict=True)):
        to = _squared(rest[:, p], centres)
        codes[:, i] = to.argmin(1)
        error += to[np.arange(len(x)), codes[:, i]]
    return codes, np.sqrt(error)


def lookup(book: Book, x: np.ndarray, cells: np.ndarray, codes: np.ndarray) -> np.ndarray:
    """Asymmetric distances from exact vectors to coded ones, each of the list in ``cells``.

    Products with the code centroids are tables per subspace, products with the lists one table.
    """
    stands = book.coarse[cells]
    product = (x @ book.coarse.T)[:, cells]
    for i, (p, centres) in enumerate(zip(_parts(x.shape[1]), book.codes, strict=True)):
        product += (x[:, p] @ centres.T)[:, codes[:, i]]
        stands[:, p] += centres[codes[:, i]]
    squared = (x * x).sum(1)[:, None] + (stands * stands).sum(1) - 2 * product
    return np.sqrt(np.maximum(squared, 0))


def unit_rows(column: pa.Array, width: int) -> np.ndarray:
    """Unit vectors in double precision of a list column whose rows all have ``width`` finite numbers."""
    x = column.flatten().to_numpy(zero_copy_only=False).astype(np.float64).reshape(-1, width)
    x = x / np.abs(x).max(1, keepdims=True)
    return x / np.sqrt((x * x).sum(1, keepdims=True))


def _linkable(label: str, vector: str):
    finite = F.forall(vector, lambda x: x.isNotNull() & ~F.isnan(x) & (F.abs(x) < F.lit(math.inf)))
    return (
        F.col(label).isNotNull()
        & F.coalesce(finite, F.lit(False))
        & F.coalesce(F.exists(vector, lambda x: x != 0), F.lit(False))
    )


def _indexed(distinct: DataFrame, books: dict[int, Book], distance: float) -> DataFrame:
    """Adds the list of each vector, its code, coding error and the lists it probes."""
    shared = distinct.sparkSession.sparkContext.broadcast(pickle.dumps(books))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        books = pickle.loads(shared.value)
        for batch in batches:
            widths = batch.column("width").to_numpy()
            for width in np.unique(widths):
                rows = batch.take(pa.array(np.flatnonzero(widths == width)))
                x = unit_rows(rows.column("v"), int(width))
                book = books.get(int(width)) or Book(np.zeros((1, int(width))), [np.zeros((1, p.stop - p.start)) for p in _parts(int(width))])
                own, mask = probes(book, x, distance)
                codes, error = encode(book, x, own)
                lists = [np.flatnonzero(m).astype(np.int32) for m in mask]
                yield pa.RecordBatch.from_arrays(
                    [
                        rows.column("grp"),
                        rows.column("id"),
                        rows.column("copies"),
                        rows.column("width"),
                        rows.column("v"),
                        pa.array(own.astype(np.int32)),
                        pa.array([c.tobytes() for c in codes], pa.binary()),
                        pa.array(error),
                        pa.array(lists, pa.list_(pa.int32())),
                    ],
                    names=["grp", "id", "copies", "width", "v", "cell", "code", "error", "probed"],
                )

    v = distinct.schema["v"].dataType.simpleString()
    schema = f"grp long, id long, copies long, width int, v {v}, cell int, code binary, error double, probed array<int>"
    return distinct.mapInArrow(run, schema)


def _packed(key, rows: pd.DataFrame) -> pd.DataFrame:
    """One row for the vectors of a block, with all bundles of lists that any of them probes."""
    rows = rows.sort_values("id")
    mask = np.zeros((len(rows), max(int(c.max()) for c in rows.probed) + 1), bool)
    for i, lists in enumerate(rows.probed):
        mask[i, lists] = True
    return pd.DataFrame(
        {
            "grp": [key[0]],
            "bundle": [key[1]],
            "block": [key[2]],
            "width": np.array([rows.width.iloc[0]], np.int32),
            "ids": [rows.id.to_numpy(np.int64).tobytes()],
            "copies": [rows.copies.to_numpy(np.int64).tobytes()],
            "v": [np.stack(rows.v.to_numpy()).tobytes()],
            "cells": [rows.cell.to_numpy(np.int32).tobytes()],
            "codes": [b"".join(rows.code)],
            "error": [rows.error.to_numpy(np.float64).tobytes()],
            "masks": [np.packbits(mask, axis=1).tobytes()],
            "asks": [np.unique(np.concatenate(rows.bundles.to_list()))],
        }
    )


def _spanning(a: np.ndarray, b: np.ndarray) -> list[tuple[int, int]]:
    """A forest with the same components as the links (a, b)."""
    up: dict[int, int] = {}

    def root(x: int) -> int:
        while up.get(x, x) != x:
            up[x] = up.get(up[x], up[x])
            x = up[x]
        return x

    out = []
    for x, y in zip(a.tolist(), b.tolist(), strict=True):
        p, q = root(x), root(y)
        if p != q:
            up[max(p, q)] = min(p, q)
            out.append((x, y))
    return out


def _compared(pairs: DataFrame, books: dict[int, Book], kind: str, least: float, distance: float) -> DataFrame:
    """Rows (a, b, links): with b, a link of a spanning forest; without, links that a takes part in."""
    shared = pairs.sparkSession.sparkContext.broadcast(pickle.dumps(books))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        books = pickle.loads(shared.value)
        for batch in batches:
            for row in batch.to_pylist():
                width = row["width"]
                ids, copies, x = _block(row, "", width, kind)
                other_ids, other_copies, y = _block(row, "o_", width, kind)
                same = row["bundle"] == row["o_bundle"] and row["block"] == row["o_block"]
                cells, other_cells = np.frombuffer(row["cells"], np.int32), np.frombuffer(row["o_cells"], np.int32)
                asks = _asks(row["masks"], len(x), other_cells) | _asks(row["o_masks"], len(y), cells).T
                asking = np.flatnonzero(asks.any(1))
                if not len(asking):
                    continue
                near = asks[asking]
                book = books.get(width)
                if book is not None:
                    codes = np.frombuffer(row["o_codes"], np.uint8).reshape(len(y), -1)
                    error = np.frombuffer(row["o_error"], np.float64)
                    near &= lookup(book, x[asking], other_cells, codes) <= distance + error + EPSILON
                i, j = np.nonzero(near)
                i = asking[i]
                if same:
                    i, j = i[i < j], j[i < j]
                keep = [np.zeros(0, bool)]
                for s in range(0, len(i), 100_000):
                    keep.append(np.einsum("ij,ij->i", x[i[s : s + 100_000]], y[j[s : s + 100_000]]) >= least)
                keep = np.concatenate(keep)
                i, j = i[keep], j[keep]
                if not len(i):
                    continue
                mine = np.bincount(i, other_copies[j], len(x)).astype(np.int64)
                theirs = np.bincount(j, copies[i], len(y)).astype(np.int64)
                forest = _spanning(ids[i], other_ids[j])
                out = [(int(n), None, int(k)) for n, k in zip(ids, mine, strict=True) if k]
                out += [(int(n), None, int(k)) for n, k in zip(other_ids, theirs, strict=True) if k]
                out += [(a, b, 0) for a, b in forest]
                a, b, k = zip(*out, strict=True)
                yield pa.RecordBatch.from_arrays(
                    [pa.array(a, pa.int64()), pa.array(b, pa.int64()), pa.array(k, pa.int64())], names=["a", "b", "links"]
                )

    return pairs.mapInArrow(run, "a long, b long, links long")


def _asks(masks: bytes, rows: int, cells: np.ndarray) -> np.ndarray:
    """Which rows of a block probe the lists ``cells`` of another; lists behind the last probed one are not in the masks."""
    mask = np.unpackbits(np.frombuffer(masks, np.uint8).reshape(rows, -1), axis=1).astype(bool)
    out = np.zeros((rows, len(cells)), bool)
    held = np.flatnonzero(cells < mask.shape[1])
    out[:, held] = mask[:, cells[held]]
    return out


def _block(row: dict, side: str, width: int, kind: str) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    v = np.frombuffer(row[f"{side}v"], kind)
    x = unit_rows(pa.ListArray.from_arrays(pa.array(np.arange(0, len(v) + 1, width, dtype=np.int32)), pa.array(v)), width)
    return np.frombuffer(row[f"{side}ids"], np.int64), np.frombuffer(row[f"{side}copies"], np.int64), x


def link_vectors(
    vectors: DataFrame, key: str = "vec_id", vector: str = "embedding", label: str = "label",
    least: float = LEAST_COSINE, fit_rows: int = FIT_ROWS,
) -> DataFrame:
    """(key, n_links, component_id, kept) of every row of ``vectors``; all links are found.

    Vectors link if their labels are equal and not null, they are equally long, and their cosine
    is ``least`` or more. Null, empty and zero vectors and those with null or non-finite numbers
    link with nothing. Equal vectors are compared once and counted as often as they occur
    (repeated rows too). ``component_id``: smallest key reachable by links; a row with a null key
    has a null component. Other columns are not read.

    Small lists of a label are bundled and large ones cut by hash, so that blocks are of one
    size and a hot list or label is many of them; pairs of blocks are compared inside tasks and
    give counts and a spanning forest, not pairs.
    """
    spark = vectors.sparkSession
    kind = "f4" if vectors.schema[vector].dataType.elementType.simpleString() == "float" else "f8"
    number = "float" if kind == "f4" else "double"
    distance = math.sqrt(2 - 2 * least)
    rows = vectors.select(
        F.col(key).alias("key"), F.col(label).cast("string").alias("label"), F.col(vector).cast(f"array<{number}>").alias("v")
    )
    good = rows.filter(_linkable("label", "v")).withColumn("width", F.size("v"))
    good = good.withColumn("id", F.xxhash64("label", "v"))
    at = scratch_dir(spark, "vectors")
    distinct = materialize_at(
        good.groupBy("label", "width", "v", "id").agg(F.count(F.lit(1)).alias("copies")).withColumn("grp", F.xxhash64("label", "width")),
        at,
    )
    sample = distinct.orderBy(F.xxhash64("id", "grp"), "id").limit(fit_rows).select("width", "v").toArrow()
    widths = sample.column("width").to_numpy()
    books = {
        int(w): fit_book(unit_rows(sample.column("v").combine_chunks().take(pa.array(np.flatnonzero(widths == w))), int(w)))
        for w in np.unique(widths)
    }
    indexed = materialize(_indexed(distinct.select("grp", "id", "copies", "width", "v"), books, distance), "indexed")
    sizes = indexed.groupBy("grp", "cell").agg(F.count(F.lit(1)).alias("_n"))
    before = Window.partitionBy("grp").orderBy("cell").rowsBetween(Window.unboundedPreceding, -1)
    bundled = sizes.withColumn("bundle", F.floor(F.coalesce(F.sum("_n").over(before), F.lit(0)) / F.lit(BLOCK)))
    held = bundled.withColumn("_m", F.sum("_n").over(Window.partitionBy("grp", "bundle")))
    # a label has at most as many rows here as there are lists
    tables = held.groupBy("grp").agg(
        F.map_from_entries(F.collect_list(F.struct("cell", F.struct("bundle", F.ceil(F.col("_m") / F.lit(2 * BLOCK)).alias("cuts"))))).alias("_to")
    )
    cut = attach(indexed, tables, ["grp"], limit=LABELS, salt_by=["id"])
    cut = (
        cut.withColumn("bundle", F.col("_to")[F.col("cell")]["bundle"])
        .withColumn("block", F.pmod("id", F.col("_to")[F.col("cell")]["cuts"]))
        .withColumn("bundles", F.array_distinct(F.transform(F.filter("probed", lambda c: F.map_contains_key("_to", c)), lambda c: F.col("_to")[c]["bundle"])))
        .drop("_to")
    )
    schema = (
        "grp long, bundle long, block long, width int, ids binary, copies binary, v binary, cells binary, codes binary, "
        "error binary, masks binary, asks array<long>"
    )
    blocks = materialize(cut.groupBy("grp", "bundle", "block").applyInPandas(_packed, schema), "blocks")
    asking = blocks.select("grp", F.struct("bundle", "block").alias("p"), F.explode("asks").alias("bundle"))
    asked = blocks.select("grp", "bundle", F.struct("bundle", "block").alias("q"))
    met = asking.join(asked, ["grp", "bundle"]).select("grp", F.least("p", "q").alias("p"), F.greatest("p", "q").alias("q")).distinct()
    held = ("width", "ids", "copies", "v", "cells", "codes", "error", "masks")
    one = blocks.select("grp", F.struct("bundle", "block").alias("p"), "bundle", "block", *[c for c in held if c not in ("codes", "error")])
    other = blocks.select(
        "grp", F.struct("bundle", "block").alias("q"), F.col("bundle").alias("o_bundle"), F.col("block").alias("o_block"),
        *[F.col(c).alias(f"o_{c}") for c in held if c != "width"],
    )
    pairs = materialize(met, "met-blocks").join(one, ["grp", "p"]).join(other, ["grp", "q"]).drop("p", "q")
    found = materialize(_compared(pairs, books, kind, least, distance), "compared")
    labels = components(found.filter("b IS NOT NULL").select("a", "b"))
    counts = found.filter("b IS NULL").groupBy("a").agg(F.sum("links").alias("others"))
    classes = distinct.select("id", F.col("copies") - 1).toDF("id", "own")
    facts = (
        classes.join(counts.withColumnRenamed("a", "id"), "id", "left")
        .join(labels.withColumnRenamed("node", "id"), "id", "left")
        .select("id", (F.col("own") + F.coalesce("others", F.lit(0))).alias("n_links"), F.coalesce("component", "id").alias("_c"))
        .filter("n_links > 0")
    )
    all_rows = rows.withColumn("id", F.when(_linkable("label", "v"), F.xxhash64("label", "v"))).select("key", "id")
    placed = attach(all_rows, facts, ["id"], salt_by=["key"])
    least_key = placed.filter("_c IS NOT NULL").groupBy("_c").agg(F.min("key").alias("_least"))
    out = attach(placed, least_key, ["_c"], salt_by=["key"])
    component = F.when(F.col("key").isNotNull(), F.coalesce("_least", "key"))
    result = out.select(
        F.col("key").alias(key),
        F.coalesce("n_links", F.lit(0)).cast("long").alias("n_links"),
        component.alias("component_id"),
        F.coalesce(component == F.col("key"), F.lit(False)).alias("kept"),
    )
    result = materialize(result, "vector-links")
    discard(spark, at)
    return result
