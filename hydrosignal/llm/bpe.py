"""Byte-pair encoding by longest matches and pair compatibility, decoding by an offset table.

A word is covered by tokens from the left. At each place the longest vocabulary token (from one
Aho-Corasick pass over the word) is tried first, then its shorter prefixes. A token may follow
another only if merging the two alone would leave the border between them in place; by that
local test the finished cover is the one that merging by rank gives. Places from which no cover
goes on are remembered, so every (place, token) is tried once.
"""

from __future__ import annotations

import json
import os
import unicodedata
from collections.abc import Iterator
from functools import lru_cache

import ahocorasick
import numpy as np
import pyarrow as pa
import regex
from pyspark.sql import DataFrame
from pyspark.sql.types import ArrayType, IntegerType, StringType, StructType

from hydrosignal.llm.texts import tidy

#: Words, blank-free pieces and pairs of tokens kept during a task; a full table is emptied and filled anew.
WORD_CACHE = 100_000
PIECE_CACHE = 150_000
PAIR_CACHE = 400_000
CHUNK_CHARS = 1_000_000
_PRIVATE = 0xE000


def byte_letters() -> list[str]:
    """The printable letter that stands for each byte in byte-level vocabularies."""
    plain = [*range(33, 127), *range(161, 173), *range(174, 256)]
    shifted = iter(range(256, 512))
    return [chr(b) if b in plain else chr(next(shifted)) for b in range(256)]


class Vocabulary:
    """Tables of one tokenizer file of the kind "BPE with word ends over bytes"."""

    def __init__(self, data: bytes):
        spec = json.loads(data)
        model = spec["model"]
        self.suffix = model["end_of_word_suffix"] or ""
        self.special = {t["content"]: t["id"] for t in spec["added_tokens"]}
        self.special_split = regex.compile(
            "(" + "|".join(map(regex.escape, sorted(self.special, key=len, reverse=True))) + ")"
        )
        pattern = spec["pre_tokenizer"]["pretokenizers"][0]["pattern"]["Regex"]
        self.words = regex.compile(pattern, regex.V0)
        letters = byte_letters()
        self.letters = letters
        self.last = {c: chr(_PRIVATE + b) for b, c in enumerate(letters)}
        vocab: dict[str, int] = model["vocab"]
        by_letters = {self._symbols(t): i for t, i in vocab.items()}
        size = max([*vocab.values(), *self.special.values()]) + 1
        self.halves: list[tuple[int, int] | None] = [None] * size
        self.rank = list(range(-size, 0))  # single symbols come before all merges
        self.merged: dict[tuple[int, int], int] = {}
        for order, (a, b) in enumerate(model["merges"]):
            left, right, both = vocab[a], vocab[b], vocab[a + b]
            if self.halves[both] is None:
                self.halves[both] = (left, right)
                self.rank[both] = order
            self.merged[left, right] = both
        self.length = [0] * size
        self.pairs: dict[tuple[int, int], bool] = {}
        self.automaton = ahocorasick.Automaton()
        for symbols, i in by_letters.items():
            self.length[i] = len(symbols)
            if self.halves[i] is None or self._holds_together(i):
                self.automaton.add_word(symbols, i)
        self.automaton.make_automaton()
        self.shorter = [-1] * size
        for symbols, i in by_letters.items():
            for end in range(len(symbols) - 1, 0, -1):
                j = self.automaton.get(symbols[:end], -1)
                if j >= 0:
                    self.shorter[i] = j
                    break
        texts = [""] * size
        for t, i in [*vocab.items(), *self.special.items()]:
            texts[i] = t
        raw = [(t + " ").encode() for t in texts]
        self.blob = np.frombuffer(b"".join(raw), np.uint8)
        self.sizes = np.array([len(x) for x in raw], np.int64)
        self.starts = np.cumsum(self.sizes) - self.sizes
        self.known: dict[str, tuple[int, ...]] = {}
        self.pieces: dict[str, tuple[int, ...]] = {}

    def _symbols(self, token: str) -> str:
        if self.suffix and token.endswith(self.suffix) and len(token) > len(self.suffix):
            body = token[: -len(self.suffix)]
            return body[:-1] + self.last[body[-1]]
        return token

    def _border(self, left: int, right: int, limit: int) -> bool:
        """Whether no merge of a rank below ``limit`` joins ``left`` and ``right``.

        Both sides are taken apart in the reverse order of their merges; at each moment the two
        pieces that touch must not have been mergeable before the next merge of either side.
        """
        rank, halves, merged = self.rank, self.halves, self.merged
        while True:
            both = merged.get((left, right))
            if both is not None and rank[both] < limit:
                return False
            a = rank[left] if halves[left] else -1
            b = rank[right] if halves[right] else -1
            if a < 0 and b < 0:
                return True
            # the later of the two merges is undone: until then the older border stood.
            # Of equal ranks the left one was made first.
            if b >= a:
                limit = min(limit, b + 1)
                right = halves[right][0]
            else:
                limit = min(limit, a)
                left = halves[left][1]

    def compatible(self, left: int, right: int) -> bool:
        got = self.pairs.get((left, right))
        if got is None:
            if len(self.pairs) >= PAIR_CACHE:
                self.pairs.clear()
            got = self.pairs[left, right] = self._border(left, right, 1 << 60)
        return got

    def _holds_together(self, token: int) -> bool:
        left, right = self.halves[token]
        return self._border(left, right, self.rank[token])

    def encode_word(self, word: str) -> tuple[int, ...]:
        """Ids of one word given as byte letters."""
        symbols = word[:-1] + self.last[word[-1]] if self.suffix else word
        n = len(symbols)
        longest = [-1] * n
        length = self.length
        for end, token in self.automaton.iter(symbols):
            start = end - length[token] + 1
            if longest[start] < 0 or length[token] > length[longest[start]]:
                longest[start] = token
        open_at = [True] * (n + 1)
        out: list[int] = []
        at, token = 0, longest[0]
        while at < n:
            while token >= 0:
                end = at + length[token]
                if open_at[end] and (not out or self.compatible(out[-1], token)):
                    break
                token = self.shorter[token]
            if token >= 0:
                out.append(token)
                at += length[token]
                token = longest[at] if at < n else -1
            else:
                open_at[at] = False
                token = out.pop()
                at -= length[token]
        return tuple(out)

    def encode(self, text: str) -> list[int]:
        """Ids of a text; strings of special tokens become those tokens."""
        out: list[int] = []
        for i, part in enumerate(self.special_split.split(text)):
            if i % 2:
                out.append(self.special[part])
            elif part:
                self._encode_part(part, out)
        return out

    def _encode_part(self, part: str, out: list[int]) -> None:
        # letters are lower-cased one by one, so a final sigma is an ordinary one
        text = unicodedata.normalize("NFC", part).replace("\u03a3", "\u03c3").lower()
        # no word holds white space, so a text may be cut at any blank
        pieces = self.pieces
        for piece in text.replace("\n", " ").split(" "):
            ids = pieces.get(piece)
            if ids is None:
                if len(pieces) >= PIECE_CACHE:
                    pieces.clear()
                ids = pieces[piece] = self._encode_piece(piece)
            out += ids

    def _encode_piece(self, piece: str) -> tuple[int, ...]:
        known, out = self.known, ()
        for word in self.words.findall(piece):
            ids = known.get(word)
            if ids is None:
                if len(known) >= WORD_CACHE:
                    known.clear()
                letters = self.letters
                ids = known[word] = self.encode_word("".join([letters[b] for b in word.encode()]))
            out = out + ids if out else ids
        return out

    def forget(self) -> None:
        """Empties the tables that grow with the texts."""
        self.known.clear()
        self.pieces.clear()
        self.pairs.clear()

    def decode_all(self, ids: np.ndarray, offsets: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """Bytes and offsets of the token strings of each list, joined by one blank."""
        sizes = self.sizes[ids]
        ends = np.cumsum(sizes)
        total = int(ends[-1]) if len(ends) else 0
        source = np.arange(total) + np.repeat(self.starts[ids] - (ends - sizes), sizes)
        data = self.blob[source]
        bounds = np.concatenate([[0], ends])[offsets]
        full = np.diff(offsets) > 0
        drop = bounds[1:][full] - 1  # the blank behind the last token of a list
        keep = np.ones(total, bool)
        keep[drop] = False
        new = bounds - np.concatenate([[0], np.cumsum(full)])
        return data[keep], new


@lru_cache(maxsize=1)
def _tables(data: bytes) -> Vocabulary:
    return Vocabulary(data)


def _batches(rows: int, sizes: np.ndarray) -> Iterator[tuple[int, int]]:
    """Runs of rows of bounded size; one long text is a run of its own."""
    first, size = 0, 0
    for i in range(rows):
        size += int(sizes[i])
        if size >= CHUNK_CHARS:
            yield first, i + 1
            first, size = i + 1, 0
    if first < rows:
        yield first, rows


def _apply(df: DataFrame, path: str, drop: str | None, new: list[tuple[str, object]], run) -> DataFrame:
    with open(path, "rb") as file:
        data = file.read()
    if os.path.getsize(path) > 64_000_000:
        raise ValueError("a tokenizer file of this size is not broadcast")
    shared = df.sparkSession.sparkContext.broadcast(data)
    names = [n for n, _ in new]
    kept = [f for f in df.schema.fields if f.name not in names and f.name != drop]
    schema = StructType(list(kept))
    for name, kind in new:
        schema = schema.add(name, kind)

    def tasks(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        vocabulary = _tables(shared.value)
        try:
            for batch in batches:
                for rows, columns in run(vocabulary, batch):
                    others = [rows.column(f.name) for f in kept]
                    yield pa.RecordBatch.from_arrays(others + columns, names=[*(f.name for f in kept), *names])
        finally:
            vocabulary.forget()

    return df.mapInArrow(tidy(tasks), schema)


def _encoded(vocabulary: Vocabulary, batch: pa.RecordBatch, text: str):
    column = batch.column(text)
    sizes = np.nan_to_num(column.is_null().to_numpy(zero_copy_only=False) * 0.0)
    lengths = pa.compute.binary_length(column).fill_null(0).to_numpy(zero_copy_only=False)
    for a, b in _batches(len(column), lengths + sizes):
        flat, counts = [], []
        for value in column.slice(a, b - a).to_pylist():
            ids = vocabulary.encode(value) if value else []
            flat += ids
            counts.append(len(ids))
        offsets = np.concatenate([[0], np.cumsum(counts)]).astype(np.int32)
        yield batch.slice(a, b - a), np.array(flat, np.int32), offsets


def _lists(flat: np.ndarray, offsets: np.ndarray) -> pa.Array:
    return pa.ListArray.from_arrays(pa.array(offsets, pa.int32()), pa.array(flat, pa.int32()))


def _strings(data: np.ndarray, bounds: np.ndarray) -> pa.Array:
    return pa.StringArray.from_buffers(
        len(bounds) - 1, pa.py_buffer(bounds.astype(np.int32).tobytes()), pa.py_buffer(data.tobytes())
    )


def encode(df: DataFrame, path: str, text: str = "text", ids: str = "ids") -> DataFrame:
    """Adds the token ids of a text column. Null and empty texts have an empty list.

    Rows are encoded one by one, whole, in runs of bounded size. A column named like ``ids`` is
    replaced, all others are kept.
    """

    def run(vocabulary, batch):
        for rows, flat, offsets in _encoded(vocabulary, batch, text):
            yield rows, [_lists(flat, offsets)]

    return _apply(df, path, None, [(ids, ArrayType(IntegerType()))], run)


def decode(df: DataFrame, path: str, ids: str = "ids", decoded: str = "decoded") -> DataFrame:
    """Adds the text of a list of ids: token strings joined by one blank; empty for null or no ids."""

    def run(vocabulary, batch):
        column = batch.column(ids)
        lengths = pa.compute.list_value_length(column).fill_null(0).to_numpy(zero_copy_only=False)
        for a, b in _batches(len(column), lengths * 4):
            flat = column.slice(a, b - a).flatten().to_numpy(zero_copy_only=False)
            offsets = np.concatenate([[0], np.cumsum(lengths[a:b])]).astype(np.int64)
            yield batch.slice(a, b - a), [_strings(*vocabulary.decode_all(flat, offsets))]

    return _apply(df, path, None, [(decoded, StringType())], run)


def round_trip(df: DataFrame, path: str, text: str = "text", ids: str = "ids", decoded: str = "decoded") -> DataFrame:
    """``encode`` and ``decode`` in one pass; the text column itself is dropped."""

    def run(vocabulary, batch):
        for rows, flat, offsets in _encoded(vocabulary, batch, text):
            yield rows, [_lists(flat, offsets), _strings(*vocabulary.decode_all(flat, offsets.astype(np.int64)))]

    return _apply(df, path, text, [(ids, ArrayType(IntegerType())), (decoded, StringType())], run)
