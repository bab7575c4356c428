"""Benchmark decontamination: rare seeds, then Smith-Waterman alignment.

A matching word counts by its information (rare words more), gaps and differing words cost a share
of the item's mean; the score is the share of the item's full score, so edited and paraphrased
copies still score high, chance matches of a few words score low, and neither the size of the
corpus nor the number of copies in it decides what is found.

The seeds of a test item are its rarest words, as many as hold ``SEED_SHARE`` of its weight. A
passage that reaches the least score matches that share of the weight, so all but ``1 - SEED_SHARE``
of it is matched by seeds; its length is bounded, because every gap costs. So only where seeds of
enough weight lie within so many words a passage is aligned, and none is missed, however it was edited.
"""

from __future__ import annotations

import pickle
from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql.types import DoubleType, LongType, StringType, StructType

from hydrosignal.llm.texts import FOLDED, SIGNS, grams, text_chunks, tidy, words

#: Share of an item's weight that its seeds hold.
SEED_SHARE = 0.85
#: Words that are summed up together when seeds are looked for.
STRIDE = 32
LEAST_SCORE = 0.5
#: Items of fewer words are found only where two neighbouring words of theirs (or their only one) stand together.
SHORT = 6
#: Costs of a differing word and of a gap, in mean weights of an item's words.
DIFFERENT = GAP = 0.5
#: Bytes of test items handled at once; a larger benchmark is worked on in blocks.
BLOCK_BYTES = 16_000_000


@dataclass
class Block:
    """Test items with the weight of each word, and their seeds.

    ``words``: sorted hashes of all seeds; ``first``: where the list of each begins in ``owner`` (items)
    and ``weight``. ``needed``: weight of seeds that an item found in a text has at least; ``reach``:
    words of its passage at most.
    """

    ids: list
    items: list[np.ndarray]
    weights: list[np.ndarray]
    words: np.ndarray
    first: np.ndarray
    owner: np.ndarray
    weight: np.ndarray
    needed: np.ndarray
    reach: np.ndarray


def align(item: np.ndarray, weights: np.ndarray, passage: np.ndarray, unit: float = 1.0) -> tuple[float, int]:
    """Best local alignment score and the end of it in ``passage``; costs count ``unit`` times."""
    different, gap = DIFFERENT * unit, GAP * unit
    slope = np.arange(len(passage)) * gap
    above = np.zeros(len(passage))
    best, end = 0.0, 0
    for word, weight in zip(item, weights, strict=True):
        here = np.where(passage == word, weight, -different)
        here[1:] += above[:-1]
        here = np.maximum(np.maximum(here, above - gap), 0.0)
        above = np.maximum.accumulate(here + slope) - slope
        at = int(above.argmax())
        if above[at] > best:
            best, end = float(above[at]), at + 1
    return best, end


def aligned_span(item: np.ndarray, weights: np.ndarray, passage: np.ndarray) -> tuple[float, int, int]:
    """(score as a share of the item's own, start, end) of the best local alignment."""
    unit = float(weights.mean())
    score, end = align(item, weights, passage, unit)
    if not end:
        return 0.0, 0, 0
    _, back = align(item[::-1], weights[::-1], passage[:end][::-1], unit)
    return score / float(weights.sum()), end - back, end


def _item_words(texts: list[str | None]) -> list[np.ndarray]:
    out = []
    for _, _, data, offsets in text_chunks(pa.array(texts, pa.string())):
        hashes, _, _, counts = words(data, offsets, SIGNS, FOLDED)
        out += np.split(hashes, np.cumsum(counts)[:-1])
    return out


def word_counts(docs: DataFrame, vocabulary: np.ndarray, text: str = "text") -> tuple[np.ndarray, int]:
    """Occurrences of each word of a sorted vocabulary in all documents, and of all words."""
    shared = docs.sparkSession.sparkContext.broadcast(vocabulary.tobytes())

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        known = np.frombuffer(shared.value, np.uint64)
        counts, total = np.zeros(len(known), np.int64), 0
        for batch in batches:
            for _, _, data, offsets in text_chunks(batch.column(0)):
                found, _, _, _ = words(data, offsets, SIGNS, FOLDED)
                total += len(found)
                place = np.minimum(np.searchsorted(known, found), len(known) - 1)
                counts += np.bincount(place[known[place] == found], minlength=len(known))
        seen = np.flatnonzero(counts)
        yield pa.RecordBatch.from_arrays(
            [pa.array(np.append(seen, -1)), pa.array(np.append(counts[seen], total))], names=["word", "n"]
        )

    sums = docs.select(text).mapInArrow(tidy(run), "word long, n long").groupBy("word").agg(F.sum("n").alias("n")).toArrow()
    place, n = sums.column("word").to_numpy(), sums.column("n").to_numpy()
    counts = np.zeros(len(vocabulary), np.int64)
    counts[place[place >= 0]] = n[place >= 0]
    return counts, int(n[place < 0].sum())


def _block(docs: DataFrame, rows: list, text: str, least: float) -> Block | None:
    filled = [(r[0], x) for r, x in zip(rows, _item_words([r[1] for r in rows]), strict=True) if len(x)]
    if not filled:
        return None
    ids, items = (list(x) for x in zip(*filled, strict=True))
    vocabulary = np.unique(np.concatenate(items))
    counts, total = word_counts(docs, vocabulary, text)
    rate = np.log((counts + 1.0) / (total + len(vocabulary)))
    weights, needed, parts = [], np.zeros(len(items)), []
    for number, item in enumerate(items):
        at = np.searchsorted(vocabulary, item)
        weights.append(np.minimum(np.maximum(-rate[at] / -np.log(1e-4), 0.05), 1.0))
        # the rarest words first, all places of a word together
        order = np.lexsort((item, rate[at]))
        held = np.cumsum(weights[-1][order])
        share = max(SEED_SHARE, 1.0 - least / 2)
        last = order[min(int(np.searchsorted(held, share * held[-1])), len(order) - 1)]
        seeds = (rate[at] < rate[at[last]]) | ((rate[at] == rate[at[last]]) & (item <= item[last]))
        needed[number] = weights[-1][seeds].sum() - (1 - least) * held[-1] - 1e-9
        own, where = np.unique(item[seeds], return_index=True)
        parts.append((own, np.full(len(own), number), weights[-1][seeds][where]))
    seeds, owner, weight = (np.concatenate(x) for x in zip(*parts, strict=True))
    order = np.lexsort((owner, seeds))
    known, first = np.unique(seeds[order], return_index=True)
    # matches and differing words are at most the item's own, gaps as many as the score can bear
    reach = np.array([len(x) + int(len(x) * (1 - least) / GAP) + 1 for x in items])
    return Block(ids, items, weights, known, np.append(first, len(order)), owner[order], weight[order], needed, reach)


def blocks(docs: DataFrame, benchmark: DataFrame, item: str, text: str, least: float) -> Iterator[Block]:
    """Blocks of test items of bounded size, one after another, whatever the size of the benchmark."""
    sized = benchmark.select(item, "text")
    total = sized.agg(F.sum(F.octet_length("text"))).first()[0] or 0
    parts = total // BLOCK_BYTES + 1
    for i in range(parts):
        here = sized.filter(F.pmod(F.xxhash64(item, "text"), F.lit(parts)) == i) if parts > 1 else sized
        block = _block(docs, sorted(here.collect(), key=lambda r: (r[0] is None, r[0] or 0, r[1] or "")), text, least)
        if block:
            yield block


def _windows(block: Block, hashes: np.ndarray) -> Iterator[tuple[int, int, int]]:
    """(item number, start, end) of the runs of words in which seeds of enough weight lie close together.

    Weights are summed by strides of words; an item's passage lies within a few strides in a row.
    """
    at = np.minimum(np.searchsorted(block.words, hashes), len(block.words) - 1)
    met = np.flatnonzero(block.words[at] == hashes)
    first, size = block.first[at[met]], np.diff(block.first)[at[met]]
    entries = np.arange(size.sum()) + np.repeat(first - (np.cumsum(size) - size), size)
    strides = len(hashes) // STRIDE + 1
    keys, place = np.unique(block.owner[entries] * strides + np.repeat(met // STRIDE, size), return_inverse=True)
    if not len(keys):
        return
    before = np.append(0, np.cumsum(np.bincount(place, block.weight[entries])))
    number = keys // strides
    span = (block.reach[number] - 2) // STRIDE + 2
    stop = np.minimum(np.searchsorted(keys, keys + span), np.searchsorted(keys, (number + 1) * strides))
    found = np.flatnonzero(before[stop] - before[:-1] >= block.needed[number])
    number, start = number[found], (keys[found] % strides) * STRIDE
    end = np.minimum(start + span[found] * STRIDE, len(hashes))
    start = np.maximum(start - block.reach[number], 0)  # words before the first seed
    for i, a, z in zip(number.tolist(), start.tolist(), end.tolist(), strict=True):
        yield i, a, z


def _hits(block: Block, hashes: np.ndarray, first: np.ndarray, least: float) -> dict[int, list[tuple[int, float, int, int]]]:
    """By text: (item number, score, start, end) of the best alignment with each item found in it.

    ``hashes`` are the words of several texts, ``first`` where each begins. Windows of one item that
    touch are aligned as one.
    """
    joined: dict[int, list[list[int]]] = {}
    for number, a, z in _windows(block, hashes):
        runs = joined.setdefault(number, [])
        if runs and a <= runs[-1][1]:
            runs[-1][1] = z
        else:
            runs.append([a, z])
    out: dict[int, dict[int, tuple[float, int, int]]] = {}
    for number, runs in joined.items():
        item, weights = block.items[number], block.weights[number]
        words_, where = np.unique(item, return_index=True)
        by_word, needed = weights[where], least * float(weights.sum()) - 1e-9
        for a, z in runs:
            # a run may lie over the border of texts
            for i in range(int(np.searchsorted(first, a, "right")) - 1, len(first) - 1):
                if first[i] >= z:
                    break
                start, end = max(a, int(first[i])), min(z, int(first[i + 1]))
                passage = hashes[start:end]
                at = np.minimum(np.searchsorted(words_, passage), len(words_) - 1)
                if len(passage) and by_word[at[words_[at] == passage]].sum() >= needed and weights[np.isin(item, passage)].sum() >= needed:
                    if len(item) < SHORT and not np.isin(grams(passage, min(len(item), 2)), grams(item, min(len(item), 2))).any():
                        continue
                    score, p, q = aligned_span(item, weights, passage)
                    best = out.setdefault(i, {}).get(number, (least - 1e-12, 0, 0))
                    if score > best[0]:
                        offset = start - int(first[i])
                        out[i][number] = score, offset + p, offset + q
    return {i: [(number, *hit) for number, hit in sorted(found.items())] for i, found in sorted(out.items()) if found}


def _texts_with_hits(block: Block, column: pa.Array, least: float):
    for a, _, data, offsets in text_chunks(column):
        hashes, starts, ends, counts = words(data, offsets, SIGNS, FOLDED)
        first = np.concatenate([[0], np.cumsum(counts)])
        for i, found in _hits(block, hashes, first, least).items():
            span = slice(first[i], first[i + 1])
            yield a + i, found, data, starts[span], ends[span]


def contaminated(
    docs: DataFrame, benchmark: DataFrame, key: str = "doc_id", text: str = "text", item: str = "item_id",
    least: float = LEAST_SCORE,
) -> DataFrame:
    """(key, item, score, start_word, end_word, passage) for each document row and item that align.

    Per pair the best place counts. Words are runs of signs other than ASCII white space and
    punctuation, compared without regard to the case of Latin letters. Null and empty texts hold nothing; an item is
    found wherever its alignment reaches the least score, however common its words are and however
    they were edited (one of fewer than ``SHORT`` words only where two of them stand together). Items without words are found nowhere. A new column whose name the key or the
    item has already gets an underscore in front, the item's column if it is named like the key. Repeated rows and repeated items give repeated
    results. An empty benchmark or an empty table gives no rows. Other columns are not read.
    No document is shuffled: blocks of items of bounded size go to the tasks.
    """
    spark = docs.sparkSession
    rows = docs.select(key, text)
    schema = StructType([docs.schema[key]])
    for name, kind in (
        (item, benchmark.schema[item].dataType), ("score", DoubleType()), ("start_word", LongType()), ("end_word", LongType()), ("passage", StringType())
    ):
        while name in schema.names:
            name = f"_{name}"
        schema = schema.add(name, kind)
    out = spark.createDataFrame([], schema)
    for block in blocks(docs, benchmark, item, text, least):
        shared = spark.sparkContext.broadcast(pickle.dumps(block))

        def run(batches: Iterator[pa.RecordBatch], shared=shared) -> Iterator[pa.RecordBatch]:
            block = pickle.loads(shared.value)
            for batch in batches:
                keys, ids, score, start, end, passage = [], [], [], [], [], []
                for i, found, data, starts, ends in _texts_with_hits(block, batch.column(1), least):
                    for number, value, a, b in found:
                        keys.append(i)
                        ids.append(block.ids[number])
                        score.append(value)
                        start.append(a)
                        end.append(b)
                        passage.append(data[starts[a] : ends[b - 1]].tobytes().decode("utf-8", "replace"))
                if keys:
                    yield pa.RecordBatch.from_arrays(
                        [batch.column(0).take(pa.array(keys)), pa.array(ids), pa.array(score), pa.array(start),
                         pa.array(end), pa.array(passage, pa.string())],
                        names=schema.names,
                    )

        out = out.unionByName(rows.mapInArrow(tidy(run), schema))
    return out


def without_contaminated(
    docs: DataFrame, benchmark: DataFrame, text: str = "text", item: str = "item_id",
    least: float = LEAST_SCORE,
) -> DataFrame:
    """The rows of ``docs``, all columns, in which no item is found by ``contaminated``."""
    out = docs
    for block in blocks(docs, benchmark, item, text, least):
        shared = docs.sparkSession.sparkContext.broadcast(pickle.dumps(block))

        def run(batches: Iterator[pa.RecordBatch], shared=shared) -> Iterator[pa.RecordBatch]:
            block = pickle.loads(shared.value)
            for batch in batches:
                keep = np.ones(batch.num_rows, bool)
                for i, *_ in _texts_with_hits(block, batch.column(text), least):
                    keep[i] = False
                yield batch.filter(pa.array(keep))

        out = out.mapInArrow(tidy(run), docs.schema)
    return out
