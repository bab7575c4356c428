"""Text quality by hierarchical empirical Bayes.

A logistic classifier over byte-class shares judges each document by itself. Its evidence is
pooled per host and per path below it; a host's share of good documents is shrunk towards the
global share and a path's towards its host's, the more the fewer documents it has. The strength
of each shrinkage is estimated from the spread between groups. A document's posterior joins its
own evidence with the odds of its path, of which its own part has been taken out.
"""

from __future__ import annotations

import math
from collections.abc import Iterator, Sequence
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.types import DoubleType, StructType

from hydrosignal.llm.texts import text_chunks, tidy, words
from hydrosignal.operators.attach import attach
from hydrosignal.operators.ordered import first_per_key
from hydrosignal.session import materialize

#: Labelled rows on which the classifier is fitted, the first in a seeded order.
FIT_ROWS = 20_000
KEEP_FROM = 0.5
LEVELS = ("source", "lang")
_CLASSES = 17


def _byte_classes() -> np.ndarray:
    kind = np.full(256, 11, np.uint8)  # other signs
    kind[97:123], kind[65:91], kind[48:58], kind[128:] = 0, 1, 2, 3
    for number, signs in ((4, b" \t"), (5, b"\n\r\x0b\x0c"), (6, b"."), (7, b",;:"), (8, b"!?"), (9, b"|"), (10, b"'\"-()")):
        kind[list(signs)] = number
    return kind


_KIND = _byte_classes()


def features(column: pa.Array) -> np.ndarray:
    """A row per text: shares of byte classes, word and line lengths, log length, repeated words."""
    out = np.zeros((len(column), _CLASSES))
    for a, b, data, offsets in text_chunks(column):
        size = np.diff(offsets)
        row = np.repeat(np.arange(b - a, dtype=np.int64), size)
        counts = np.bincount(row * 12 + _KIND[data], minlength=(b - a) * 12).reshape(b - a, 12)
        whole = np.maximum(size, 1)[:, None]
        gaps = counts[:, 4] + counts[:, 5] + 1
        letters = counts[:, 0] + counts[:, 1] + counts[:, 3]
        out[a:b, :12] = np.sqrt(counts / whole)
        out[a:b, 12] = np.log1p(size)
        out[a:b, 13] = np.log1p(letters / gaps)
        out[a:b, 14] = counts[:, 1] / np.maximum(letters, 1)
        out[a:b, 15] = np.log1p(size / (counts[:, 5] + 1))
        hashes, _, _, n = words(data, offsets)
        same = np.zeros(len(hashes) + 1)
        same[1:-1] = hashes[1:] == hashes[:-1]
        first = np.cumsum(n) - n
        same[first[n > 0]] = 0  # the first word of a text follows none
        sums = np.concatenate([[0], np.cumsum(same)])
        out[a:b, 16] = np.sqrt((sums[first + n] - sums[first]) / np.maximum(n, 1))
    return out


@dataclass(frozen=True)
class Model:
    """Standardised logistic regression; ``base`` is the share of good rows it was fitted on."""

    mean: np.ndarray
    scale: np.ndarray
    weights: np.ndarray
    base: float

    def log_odds(self, x: np.ndarray) -> np.ndarray:
        z = np.clip((x - self.mean) / self.scale, -8, 8)
        return np.clip(z @ self.weights[1:] + self.weights[0], -30, 30)


def fit(docs: DataFrame, labels: DataFrame, key: str, text: str, label: str, rows: int = FIT_ROWS) -> Model:
    """Fits on at most ``rows`` labelled documents.

    Null labels and labels of unknown documents are left out; of repeated keys the first row
    counts. With fewer than two classes every document gets the only class's smoothed share.
    """
    known = labels.filter(F.col(label).isNotNull() & F.col(key).isNotNull())
    picked = first_per_key(known.select(key, label), [key], [F.col(label)])
    picked = picked.orderBy(F.xxhash64(key), key).limit(rows)
    # at most FIT_ROWS pairs of numbers
    sample = docs.select(key, text).join(F.broadcast(picked), key)

    def measure(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            x = features(batch.column(text))
            yield pa.RecordBatch.from_arrays(
                [batch.column(label).cast(pa.float64()), pa.array(list(x), pa.list_(pa.float64()))], names=["y", "x"]
            )

    # repeated keys give more rows than were picked
    table = sample.mapInArrow(tidy(measure), "y double, x array<double>").orderBy(F.xxhash64("x"), "x", "y").limit(rows).toArrow()
    y = table.column("y").to_numpy()
    x = np.array(table.column("x").to_pylist(), float).reshape(len(y), _CLASSES)
    base = float((y.sum() + 1) / (len(y) + 2))
    mean = x.mean(0) if len(y) else np.zeros(_CLASSES)
    scale = np.maximum(x.std(0), 1e-3) if len(y) else np.ones(_CLASSES)
    weights = np.zeros(_CLASSES + 1)
    weights[0] = math.log(base / (1 - base))
    if 0 < y.sum() < len(y):
        design = np.column_stack([np.ones(len(y)), np.clip((x - mean) / scale, -8, 8)])
        ridge = np.full(_CLASSES + 1, 1.0)
        ridge[0] = 1e-9
        for _ in range(200):
            p = 1 / (1 + np.exp(-np.clip(design @ weights, -30, 30)))
            hessian = (design * (p * (1 - p))[:, None]).T @ design + np.diag(ridge)
            step = np.linalg.solve(hessian, design.T @ (y - p) - ridge * weights)
            weights = weights + step * min(1.0, 5 / np.abs(step).max())
            if np.abs(step).max() < 1e-9:
                break
    return Model(mean, scale, weights, base)


def judged(docs: DataFrame, model: Model, text: str, name: str) -> DataFrame:
    """Adds the classifier's log odds; null where the text holds nothing but white space."""
    schema = StructType([f for f in docs.schema.fields if f.name != name]).add(name, DoubleType())

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            x = features(batch.column(text))
            blank = x[:, 4] ** 2 + x[:, 5] ** 2 >= (x[:, :12] ** 2).sum(1) - 1e-12
            odds = pa.array(model.log_odds(x), pa.float64(), mask=blank)
            rest = [batch.column(f.name) for f in schema.fields[:-1]]
            yield pa.RecordBatch.from_arrays([*rest, odds], names=schema.names)

    return docs.mapInArrow(tidy(run), schema)


def _share(odds: Column) -> Column:
    return F.lit(1.0) / (F.lit(1.0) + F.exp(-odds))


def _strength(groups: DataFrame) -> float:
    """Prior rows that fit the spread of group shares (method of moments), from columns n, good, sq."""
    row = groups.agg(
        F.sum("n").alias("n"),
        F.sum("good").alias("good"),
        F.sum(F.col("good") * F.col("good") / F.col("n")).alias("between"),
        F.sum(F.col("n") * F.col("n")).alias("n2"),
        F.sum("sq").alias("sq"),
        F.count(F.lit(1)).alias("k"),
    ).first()
    if not row["n"] or row["k"] < 2 or row["n"] <= row["k"]:
        return 1e6
    mean = row["good"] / row["n"]
    within = (row["sq"] - row["between"]) / (row["n"] - row["k"])
    spread = row["between"] - row["n"] * mean * mean - (row["k"] - 1) * within
    tau = spread / (row["n"] - row["n2"] / row["n"])
    return float(min(max(within / tau, 1.0), 1e6)) if tau > 1e-12 else 1e6


#: Columns that ``posteriors`` adds.
SCORES = ("quality_odds", "host_share", "path_share", "quality", "kept")


def posteriors(
    docs: DataFrame, labels: DataFrame, key: str = "doc_id", text: str = "text", label: str = "quality",
    levels: Sequence[str] = LEVELS, keep_from: float = KEEP_FROM, fit_rows: int = FIT_ROWS,
) -> DataFrame:
    """All columns of ``docs`` with ``quality_odds``, ``host_share``, ``path_share``, ``quality`` and ``kept``.

    ``levels``: the host column, then the columns below it. Sums per path are combined map-side,
    so a hot host sends one row per task; the finished table of paths is attached by the
    size-checked ``attach``. Texts are read three times (fit, sums, result) and never shuffled
    while the table of paths can be broadcast. A null level is a group of its own. A null, empty
    or blank text has no evidence, quality 0, and is not kept. Repeated rows are judged alike and
    all count. Columns of these names in ``docs`` are replaced.
    """
    model = fit(docs, labels, key, text, label, fit_rows)
    base = math.log(model.base / (1 - model.base))
    evidence = judged(docs.select(text, *levels), model, text, "_o").filter("_o IS NOT NULL").withColumn("_p", _share(F.col("_o")))
    sums = [F.sum("n").alias("n"), F.sum("good").alias("good"), F.sum("sq").alias("sq")]
    paths = materialize(
        evidence.groupBy(*levels).agg(
            F.count(F.lit(1)).alias("n"), F.sum("_p").alias("good"), F.sum(F.col("_p") * F.col("_p")).alias("sq")
        ),
        "paths",
    )
    host = levels[0]
    hosts = materialize(paths.groupBy(host).agg(*sums), "hosts")
    total = hosts.agg(*sums).first()
    share = (total["good"] + 1.0) / (total["n"] + 2.0) if total["n"] else model.base
    for_host, for_path = _strength(hosts), _strength(paths)
    shrunk = hosts.select(
        host, F.col("n").alias("_hn"), F.col("good").alias("_hg")
    )
    table = attach(paths, shrunk, [host]).select(*levels, F.col("n").alias("_pn"), F.col("good").alias("_pg"), "_hn", "_hg")
    rows = judged(docs.drop(*SCORES), model, text, "_o")
    rows = attach(rows, table, list(levels))
    own, one = F.coalesce(_share(F.col("_o")), F.lit(0.0)), F.when(F.col("_o").isNotNull(), 1).otherwise(0)

    def left(n: str, good: str, prior: Column, strength: float) -> Column:
        rest_n = F.coalesce(F.col(n), F.lit(0)) - one
        rest_good = F.greatest(F.coalesce(F.col(good), F.lit(0.0)) - own, F.lit(0.0))
        return (rest_good + prior * F.lit(strength)) / (rest_n + F.lit(strength))

    rows = rows.withColumn("host_share", left("_hn", "_hg", F.lit(share), for_host))
    rows = rows.withColumn("path_share", left("_pn", "_pg", F.col("host_share"), for_path))
    # kept off 0 and 1, where the odds have no value
    prior = F.greatest(F.least(F.col("path_share"), F.lit(1 - 1e-9)), F.lit(1e-9))
    quality = _share(F.col("_o") - F.lit(base) + F.log(prior / (F.lit(1.0) - prior)))
    return (
        rows.withColumn("quality", F.coalesce(quality, F.lit(0.0)))
        .withColumnRenamed("_o", "quality_odds")
        .withColumn("kept", F.col("quality") >= keep_from)
        .drop("_pn", "_pg", "_hn", "_hg")
    )
