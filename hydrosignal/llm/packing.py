"""Packing of documents into windows of tokens by lexical retrieval.

Whole windows of a document are sequences of their own; what remains of it, shorter than a window,
is packed with what remains of documents alike. The remainders are dealt out by the weightiest
tokens of their documents and cut into shards. Each shard has an inverted index over the tokens of
its whole documents, scored by BM25 with document frequencies of the whole table. A seed document
opens a window; the unused neighbours that the index returns fill it greedily, best first, then any
unused document of the shard. The last one is cut where the window ends, and its rest is the next
seed. What a shard leaves over goes to the next one; the end of a range of shards is cut into
sequences whose lengths are powers of two, so nothing is padded.
"""

from __future__ import annotations

import json
import zlib
from collections.abc import Iterator
from functools import lru_cache

import numpy as np
import pyarrow as pa
import tiktoken
from pyspark import TaskContext
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from tokenizers import Tokenizer

from hydrosignal.llm.bpe import byte_letters
from hydrosignal.session import materialize

WINDOW = 1024
#: Id behind every document.
END = 0
#: Documents of a shard.
SHARD_DOCS = 768
#: Tokens that place a document near others.
PLACED_BY = 2
#: Saturation of term frequencies and weight of the length in BM25.
K1, B = 1.2, 0.75
#: Bytes of text that are encoded together, and ids that are passed on together.
RUN_BYTES = 2_000_000
RUN_IDS = 1_000_000


class Encoder:
    """Ids of one byte-level BPE tokenizer file, equal to those of the ``tokenizers`` library.

    The vocabulary is read as ranks and run by ``tiktoken``; texts whose runs of white space are too
    long for its pattern are encoded by ``tokenizers`` itself.
    """

    def __init__(self, data: bytes):
        spec = json.loads(data)
        plain = {c: b for b, c in enumerate(byte_letters())}
        special = {t["content"]: t["id"] for t in spec["added_tokens"]}
        ranks = {bytes(plain[c] for c in t): i for t, i in spec["model"]["vocab"].items() if t not in special}
        self.size = max([*ranks.values(), *special.values()]) + 1
        self.library = Tokenizer.from_str(data.decode())
        self.library.no_truncation()
        self.library.no_padding()
        # Fixed value: the pattern of byte-level pre-tokenization.
        pattern = r"'s|'t|'re|'ve|'m|'ll|'d| ?\p{L}+| ?\p{N}+| ?[^\s\p{L}\p{N}]+|\s+(?!\S)|\s+"
        self.fast = tiktoken.Encoding("packing", pat_str=pattern, mergeable_ranks=ranks, special_tokens=special)

    def encode(self, text: str) -> np.ndarray:
        try:
            ids = self.fast.encode_to_numpy(text, allowed_special="all")
        except ValueError:
            ids = self.library.encode(text, add_special_tokens=False).ids
        return np.append(np.asarray(ids, np.uint32), np.uint32(END))


@lru_cache(maxsize=1)
def _encoder(data: bytes) -> Encoder:
    return Encoder(data)


TOKENS = (
    "key long, {doc}, place int, start long, ids binary, doc_tokens long, terms binary, counts binary"
)


def encoded(docs: DataFrame, path: str, doc: str = "doc_id", text: str = "text", window: int = WINDOW) -> DataFrame:
    """(key, doc, place, start, ids, doc_tokens, terms, counts): windows and remainder of each document, written once.

    ``place`` numbers the pieces of a document; whole windows come first. The last piece, shorter
    than a window, has the distinct tokens of the whole document and their counts. A document is its
    ids and ``END``; a null text is empty. A document without a remainder has its tokens in a piece
    of no ids. Texts are encoded whole, one at a time.
    """
    with open(path, "rb") as file:
        data = file.read()
    shared = docs.sparkSession.sparkContext.broadcast(data)
    kind = docs.schema[doc].dataType.simpleString()
    schema = TOKENS.format(doc=f"doc {kind}")
    names = [c.split()[0] for c in schema.split(", ")]

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        encoder, part, number, size, out = _encoder(shared.value), TaskContext.get().partitionId(), 0, 0, []

        def batch(kinds: pa.DataType) -> pa.RecordBatch:
            types = [pa.int64(), kinds, pa.int32(), pa.int64(), pa.binary(), pa.int64(), pa.binary(), pa.binary()]
            columns = zip(zip(*out, strict=True), types, strict=True)
            return pa.RecordBatch.from_arrays([pa.array(c, t) for c, t in columns], names=names)

        for rows in batches:
            kinds = rows.column("doc").type
            for name, value in zip(rows.column("doc"), rows.column("text"), strict=True):
                ids = encoder.encode(value.as_py() or "")
                n, key = len(ids), part << 33 | number
                number += 1
                full = n // window
                for i in range(full):
                    out.append((key, name.as_py(), i, i * window, ids[i * window : (i + 1) * window].tobytes(), n, None, None))
                    size += window
                    if size >= RUN_IDS:
                        yield batch(kinds)
                        out, size = [], 0
                terms, counts = np.unique(ids, return_counts=True)
                rest = ids[full * window :]
                out.append((key, name.as_py(), full, full * window, rest.tobytes(), n, terms.tobytes(), counts.astype(np.uint32).tobytes()))
                size += len(rest) + 2 * len(terms)
                if size >= RUN_IDS:
                    yield batch(kinds)
                    out, size = [], 0
        if out:
            yield batch(kinds)

    return materialize(docs.select(F.col(doc).alias("doc"), F.col(text).cast("string").alias("text")).mapInArrow(run, schema), "tokens")


def _frequencies(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Documents of each token; under token -1 all documents and all tokens."""
    held, docs, tokens = np.zeros(0, np.int64), 0, 0
    for rows in batches:
        terms = np.frombuffer(b"".join(rows.column("terms").to_pylist()), np.uint32)
        found = np.bincount(terms)
        if len(found) > len(held):
            held = np.append(held, np.zeros(len(found) - len(held), np.int64))
        held[: len(found)] += found
        docs += len(rows)
        tokens += sum(rows.column("doc_tokens").to_pylist())
    at = np.flatnonzero(held)
    columns = [np.append(at, -1), np.append(held[at], docs), np.append(np.zeros(len(at), np.int64), tokens)]
    yield pa.RecordBatch.from_arrays([pa.array(c, pa.int64()) for c in columns], names=["token", "docs", "tokens"])


def statistics(tokens: DataFrame) -> tuple[np.ndarray, float]:
    """BM25 weight of every token of the vocabulary, and the mean length of documents, over all of them.

    One row per token of the vocabulary comes to the driver. A token in half of the documents or
    more has no weight.
    """
    last = tokens.filter("terms IS NOT NULL").select("terms", "doc_tokens").mapInArrow(_frequencies, "token long, docs long, tokens long")
    rows = last.groupBy("token").agg(F.sum("docs").alias("docs"), F.sum("tokens").alias("tokens")).toArrow().to_pydict()
    found = dict(zip(rows["token"], zip(rows["docs"], rows["tokens"], strict=True), strict=True))
    docs, total = found.pop(-1, (0, 0))
    weight = np.zeros(max(found, default=0) + 1)
    if found:
        held = np.array([n for n, _ in found.values()], float)
        weight[list(found)] = np.maximum(np.log((docs - held + 0.5) / (held + 0.5)), 0)
    return weight, total / docs if docs else 1.0


def _placed(batches: Iterator[pa.RecordBatch], weight: np.ndarray) -> Iterator[pa.RecordBatch]:
    for rows in batches:
        near = np.full((len(rows), PLACED_BY), -1, np.int64)
        lists = rows.column("terms").to_pylist()
        terms = np.frombuffer(b"".join(lists), np.uint32)
        much = weight[terms] * np.log1p(np.frombuffer(b"".join(rows.column("counts").to_pylist()), np.uint32))
        sizes = np.array([len(x) // 4 for x in lists])  # every document has END at least
        first, row = np.cumsum(sizes) - sizes, np.repeat(np.arange(len(lists)), sizes)
        for i in range(PLACED_BY if len(lists) else 0):
            most = np.maximum.reduceat(much, first)
            at = np.flatnonzero(much == most[row])
            at = at[np.append(True, row[at][1:] != row[at][:-1])]  # the smallest of equal ones
            near[:, i] = np.where(most >= 0, terms[at], -1)
            much[at] = -1
        columns = [rows.column(c) for c in ("key", "doc", "place", "start", "ids", "doc_tokens", "terms", "counts")]
        yield pa.RecordBatch.from_arrays(
            columns + [pa.array(x) for x in near.T], names=["key", "doc", "place", "start", "ids", "doc_tokens", "terms", "counts", *[f"near{i}" for i in range(PLACED_BY)]]
        )


class Shard:
    """An inverted index over some documents, and which of them still have ids to pack."""

    def __init__(self, terms: list[np.ndarray], counts: list[np.ndarray], lengths: np.ndarray, weight: np.ndarray, mean: float):
        sizes = np.array([len(t) for t in terms])
        doc = np.repeat(np.arange(len(terms)), sizes)
        term, count = np.concatenate(terms), np.concatenate(counts).astype(float)
        heavy = weight[term] > 0
        doc, term, count = doc[heavy], term[heavy], count[heavy]
        order = np.argsort(term, kind="stable")
        self.doc, count = doc[order], count[order]
        self.vocabulary, self.first = np.unique(term[order], return_index=True)
        self.last = np.append(self.first[1:], len(order))
        norm = K1 * (1 - B + B * lengths / mean)
        self.score = weight[term[order]] * count * (K1 + 1) / (count + norm[self.doc])
        self.terms = [t[weight[t] > 0] for t in terms]
        self.held = len(terms)

    def thin(self, left: np.ndarray) -> None:
        """Takes documents without ids left out of the lists once they are a quarter of them."""
        unused = np.count_nonzero(left)
        if unused < 0.75 * self.held:
            keep = left[self.doc] > 0
            before = np.append(0, np.cumsum(keep))
            self.first, self.last = before[self.first], before[self.last]
            self.doc, self.score, self.held = self.doc[keep], self.score[keep], unused

    def scores(self, seed: int, left: np.ndarray) -> np.ndarray:
        """BM25 of every unused document of the shard for the tokens of one of them."""
        self.thin(left)
        at = np.searchsorted(self.vocabulary, self.terms[seed])
        first, size = self.first[at], (self.last - self.first)[at]
        ends = np.cumsum(size)
        entries = np.arange(ends[-1] if len(ends) else 0) + np.repeat(first - (ends - size), size)
        return np.bincount(self.doc[entries], self.score[entries], len(self.terms))


def fill(left: np.ndarray, scores, window: int, flush: bool) -> Iterator[list[tuple[int, int]]]:
    """Windows as lists of (document, length), each taking what a document has left from its front.

    ``left``: ids of each document that are not packed, changed in place. ``scores(seed, left)``
    ranks the neighbours of a seed. A document that is cut is the next seed; otherwise the next unused one is.
    What cannot fill a window stays in ``left``, unless ``flush``: then it is given out in sequences
    whose lengths are powers of two.
    """
    total, seed, at = int(left.sum()), -1, 0
    while total >= window or (flush and total):
        size = window if total >= window else 1 << (total.bit_length() - 1)
        if seed < 0 or not left[seed]:
            while not left[at]:
                at += 1
            seed = at
        room, taken = size, []
        first = min(room, int(left[seed]))
        taken.append((seed, first))
        left[seed] -= first
        room -= first
        if room:
            rank = scores(seed, left)
            unused = np.flatnonzero(left)
            unused = unused[np.argsort(-rank[unused], kind="stable")]
            # behind the last of these the window is full
            for d in unused[: int(np.searchsorted(np.cumsum(left[unused]), room)) + 1].tolist():
                some = min(room, int(left[d]))
                taken.append((d, some))
                left[d] -= some
                room -= some
                seed = d
        total -= size
        yield taken


PIECES = "{doc}, start long, length long, ids binary, doc_tokens long, sequence_id long, offset long"


def _packed(batches: Iterator[pa.RecordBatch], weight: np.ndarray, mean: float, window: int) -> Iterator[pa.RecordBatch]:
    """Pieces of the remainders of one range, shard after shard."""
    part, sequence, rest, held = TaskContext.get().partitionId(), 0, [], []

    def pieces(rows: list[dict], flush: bool) -> Iterator[pa.RecordBatch]:
        nonlocal sequence, rest
        terms = [np.frombuffer(r["terms"], np.uint32) for r in rows]
        counts = [np.frombuffer(r["counts"], np.uint32) for r in rows]
        shard = Shard(terms, counts, np.array([r["doc_tokens"] for r in rows], float), weight, mean)
        ids = [np.frombuffer(r["ids"], np.uint32)[r.get("used", 0) :] for r in rows]
        left = np.array([len(x) for x in ids])
        used, out = [0] * len(rows), []
        for taken in fill(left, shard.scores, window, flush):
            offset = 0
            for d, size in taken:
                r, a = rows[d], used[d]
                out.append((r["doc"], r["start"] + r.get("used", 0) + a, size, ids[d][a : a + size].tobytes(), r["doc_tokens"], (part << 32 | sequence) * 2 + 1, offset))
                used[d] += size
                offset += size
            sequence += 1
        rest = [{**r, "used": r.get("used", 0) + u} for r, u, n in zip(rows, used, left.tolist(), strict=True) if n]
        if out:
            kinds = [kind, pa.int64(), pa.int64(), pa.binary(), pa.int64(), pa.int64(), pa.int64()]
            columns = zip(zip(*out, strict=True), kinds, strict=True)
            names = ["doc", "start", "length", "ids", "doc_tokens", "sequence_id", "offset"]
            yield pa.RecordBatch.from_arrays([pa.array(c, t) for c, t in columns], names=names)

    kind = pa.null()
    for batch in batches:
        kind = batch.column("doc").type
        for first in range(0, len(batch), SHARD_DOCS):
            for row in batch.slice(first, SHARD_DOCS).to_pylist():
                held.append(row)
                if len(held) + len(rest) >= SHARD_DOCS:
                    yield from pieces(rest + held, False)
                    held = []
    if held or rest:
        yield from pieces(rest + held, True)


def pack(docs: DataFrame, path: str, doc: str = "doc_id", text: str = "text", window: int = WINDOW) -> DataFrame:
    """(doc, start, length, ids, doc_tokens, sequence_id, offset): every piece of every document.

    ``path`` names a byte-level BPE file of the ``tokenizers`` library. Each id of each document
    (``END`` behind its text) lies in one piece; ``ids`` holds them as little-endian unsigned 32-bit
    numbers, ``start`` counts the document's ids before the piece. Sequences have ``window`` ids, or
    a power of two below it at the end of a range of documents.

    A null text is empty and gives the piece with ``END`` alone; rows with a null or repeated key are
    documents of their own. An empty table gives no pieces. Other columns are not read.
    """
    if window < 1 or window & (window - 1):
        raise ValueError("the window must be a power of two")
    tokens = encoded(docs, path, doc, text, window)
    weight, mean = statistics(tokens)
    shared = docs.sparkSession.sparkContext.broadcast((weight, mean))
    kind = docs.schema[doc].dataType.simpleString()
    whole = tokens.filter(F.col("terms").isNull()).select(
        "doc",
        "start",
        F.lit(window).cast("long").alias("length"),
        "ids",
        "doc_tokens",
        # of the documents before, at most 2^33 a task, and of windows, at most 2^20 a document
        F.monotonically_increasing_id().alias("sequence_id"),
        F.lit(0).cast("long").alias("offset"),
    )
    whole = whole.withColumn("sequence_id", F.col("sequence_id") * 2)
    near = [f"near{i}" for i in range(PLACED_BY)]
    rest = (
        tokens.filter("terms IS NOT NULL AND octet_length(ids) > 0")
        .mapInArrow(lambda b: _placed(b, shared.value[0]), TOKENS.format(doc=f"doc {kind}") + "".join(f", {n} long" for n in near))
        .repartitionByRange(*near, "key")
        .sortWithinPartitions(*near, "key")
    )
    filled = rest.mapInArrow(lambda b: _packed(b, *shared.value, window), PIECES.format(doc=f"doc {kind}"))
    return whole.unionByName(filled).withColumnRenamed("doc", doc)


def crc32(pieces: DataFrame, ids: str = "ids") -> DataFrame:
    """``ids_crc32``, the unsigned CRC-32 of the ids of each piece, in place of the ids."""
    return pieces.withColumn(ids, F.crc32(F.col(ids))).withColumnRenamed(ids, "ids_crc32")


def checksum(ids: np.ndarray) -> int:
    """What ``crc32`` gives for an array of ids."""
    return zlib.crc32(np.asarray(ids, "<u4").tobytes())
