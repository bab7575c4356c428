"""Exact Jaccard self-join of word-shingle sets by universe partitioning.

Sets are put into bands of size. The universe of shingles is hashed into segments whose number
depends on the band, so a set falls into one subset per segment. Two sets of sizes r >= s with a
Jaccard similarity of at least 3/4 differ in at most H = (r + s) / 7 elements, of which at most
B = (4 s - 3 r) / 7 are missing from the larger one. Every difference spoils one segment, hence
of any H + 1 segments of the larger set one is equal in both (pigeonhole); and of
B + (H - B) / 2 + 1 segments one is equal or becomes equal if one element of the larger set's
subset is deleted. The smaller set is indexed under its segment subsets; the larger one probes
those of its own band and of the band below, and may choose which: an allocation that takes the
segments, or the one-deletion neighbourhoods, that the fewest indexed sets share. What no one
shares costs nothing, so most sets are done without a candidate. Candidates are verified exactly.

Shingles and sets are compared by 64-bit hashes.
"""

from __future__ import annotations

import struct
from collections.abc import Iterator

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql.types import StructType

from hydrosignal.llm.links import components
from hydrosignal.llm.texts import grams, mix, text_chunks, tidy, tidy_group, words
from hydrosignal.operators.attach import attach
from hydrosignal.session import discard, materialize, materialize_at, scratch_dir

WORDS = 5
#: Sets below this size have a segment for each shingle; up to the second bound, one-deletion
#: neighbourhoods are probed too; above it segments alone.
SINGLE_BELOW, DELETE_BELOW = 128, 512
#: Segments per element of the band's upper bound: enough that a set fills H + 1 of them with some
#: to choose from (short by chance with a probability below 1e-12; the job then fails and says so).
SEGMENTS = 0.4
#: Bytes of text worked on at a time: arrays that stay in a core's cache.
CHUNK_BYTES = 250_000
#: Bytes of text per bucket of signatures: about a million signatures.
BUCKET_BYTES = 6_000_000
LEAST_BUCKETS = 64
FLUSH_SIGNATURES, FLUSH_SETS = 800_000, 16_000
#: Sets of a block; pairs of blocks with at least so many candidate pairs are verified as blocks.
BLOCK_SETS, DENSE = 256, 256
#: Pairs of sets of one signature from which only their blocks are paired; blocks of a side of a tile.
MANY_PAIRS, TILE = 1024, 512
#: Columns of the element matrices with which two blocks are compared at a time.
SLICE = 8192

_LOW = np.uint64(0xFFFFFFFF)
_SEGMENT_KEY, _VALUE_KEY = np.uint64(0x5851F42D4C957F2D), np.uint64(0x14057B7EF767814F)
INDEXED, PROBE_BELOW, DELETED, DELETED_BELOW = range(4)


def _bounds() -> np.ndarray:
    """Band starts. Each is over 4/3 of the last, so a set probes its band and the one below."""
    out = [1]
    while out[-1] < 1 << 40:
        out.append(out[-1] * 4 // 3 + 1)
    return np.array(out, np.int64)


BOUNDS = _bounds()


def band_of(n: np.ndarray) -> np.ndarray:
    return np.searchsorted(BOUNDS, n, "right") - 1


def segments_of(band: np.ndarray) -> np.ndarray:
    """Segments of a band; 0 where every element is its own."""
    top = BOUNDS[band + 1]
    return np.where(top <= SINGLE_BELOW, 0, np.ceil(top * SEGMENTS)).astype(np.int64)


def limits(n: int, band: int) -> tuple[int, int]:
    """(H, B) of a set of ``n`` elements against sets of a band that are no larger."""
    s = min(n, int(BOUNDS[band + 1]) - 1)
    return (n + s) // 7, max(0, 4 * s - 3 * n) // 7


def shingle_sets(hashes: np.ndarray, counts: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """(sorted distinct shingle hashes of each text, one text after the other; their number per text).

    Fewer words make one shingle.
    """
    start = np.cumsum(counts) - counts
    runs = np.where(counts >= WORDS, counts - WORDS + 1, np.minimum(counts, 1))
    ends = np.cumsum(runs)
    begins = ends - runs
    flat = np.empty(int(runs.sum()), np.uint64)
    whole = np.repeat(counts >= WORDS, runs)
    flat[whole] = grams(hashes, WORDS)[(np.repeat(start - begins, runs) + np.arange(len(flat)))[whole]]
    for n in range(1, WORDS):
        short = np.flatnonzero(counts == n)
        if len(short):
            rows = hashes[start[short][:, None] + np.arange(n)]
            flat[begins[short]] = [grams(w, n)[0] ^ np.uint64(n) for w in rows]
    for a, z in zip(begins.tolist(), ends.tolist(), strict=True):
        flat[a:z].sort()
    new = np.ones(len(flat), bool)
    new[1:] = flat[1:] != flat[:-1]
    new[begins[runs > 0]] = True
    if new.all():
        return flat, runs
    before = np.concatenate([[0], np.cumsum(new)])
    return flat[new], before[ends] - before[begins]


def set_hashes(values: np.ndarray, sizes: np.ndarray) -> np.ndarray:
    """Hash of each set from the values (``mix`` of element and key) of its elements."""
    before = np.concatenate([np.zeros(1, np.uint64), np.cumsum(values, dtype=np.uint64)])
    ends = np.cumsum(sizes)
    return mix(before[ends] - before[ends - sizes])


def _sets(column: pa.Array) -> Iterator[tuple[int, int, np.ndarray, np.ndarray, np.ndarray, np.ndarray]]:
    """(first row, end row, elements, their values, sizes, hashes) of the sets of runs of texts."""
    for a, b, data, offsets in text_chunks(column, CHUNK_BYTES):
        hashes, _, _, counts = words(data, offsets)
        flat, sizes = shingle_sets(hashes, counts)
        values = mix(flat ^ _VALUE_KEY)
        yield a, b, flat, values, sizes, set_hashes(values, sizes)


def _hash_column(column: pa.Array) -> tuple[np.ndarray, pa.Array]:
    """(sizes, hashes) of the sets of a column of texts; the hash is null for an empty set."""
    sizes, ids = [np.zeros(0, np.int64)], [np.zeros(0, np.uint64)]
    for _, _, _, _, n, hashes in _sets(column):
        sizes.append(n)
        ids.append(hashes)
    n = np.concatenate(sizes)
    return n, pa.array(np.concatenate(ids).view(np.int64), mask=n == 0)


def profiles(docs: DataFrame, key: str, text: str) -> DataFrame:
    """(key, n_shingles, set_hash) of every row; the hash is null for an empty set."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            n, ids = _hash_column(batch.column(1))
            yield pa.RecordBatch.from_arrays([batch.column(0), pa.array(n), ids], names=[key, "n_shingles", "set_hash"])

    kind = docs.schema[key].dataType.simpleString()
    return docs.select(key, text).mapInArrow(tidy(run), f"`{key}` {kind}, n_shingles long, set_hash long")


def signatures(flat: np.ndarray, values: np.ndarray, spread: np.ndarray, sizes: np.ndarray, bands: np.ndarray, below: bool):
    """(signature, set number, kind, segment + 1, non-empty segments, those of two or more) in given bands.

    ``flat``, ``values``, ``spread``: elements of the sets, their values, and where in the universe
    they lie. A band of -1 leaves a set out. The segment is 0 where no deletion is possible.
    """
    m = segments_of(np.maximum(bands, 0))
    filled, plural = np.zeros(len(sizes), np.int64), np.zeros(len(sizes), np.int64)
    parts = [(np.zeros(0, np.uint64), np.zeros(0, np.int32), np.zeros(0, np.uint8), np.zeros(0, np.uint16))]
    for single in (True, False):
        chosen = (bands >= 0) & ((m == 0) == single)
        own = np.flatnonzero(chosen).astype(np.int32)
        if not len(own):
            continue
        mine = slice(None) if chosen.all() else np.repeat(chosen, sizes)
        at = np.repeat(np.arange(len(own), dtype=np.int32), sizes[own])
        salt = mix(bands[own].astype(np.uint64) * np.uint64(0x9E3779B97F4A7C15))
        kind = PROBE_BELOW if below else INDEXED
        if single:
            filled[own] = sizes[own]
            parts.append((mix(flat[mine] + salt[at]), own[at], np.full(len(at), kind, np.uint8), np.zeros(len(at), np.uint16)))
            continue
        base = np.cumsum(m[own]) - m[own]
        segment = ((spread[mine] * m[own].astype(np.uint64)[at]) >> np.uint64(32)).astype(np.int64)
        place, value = base[at] + segment, values[mine]
        total = int(m[own].sum())
        sums = np.zeros(total, np.uint64)
        np.add.at(sums, place, value)
        counts = np.bincount(place, minlength=total)
        owner = np.repeat(np.arange(len(own), dtype=np.int32), m[own])
        number = np.arange(total) - base[owner]
        deletable = (BOUNDS[bands[own] + 1] <= DELETE_BELOW)[owner] & (counts > 1)
        full = np.flatnonzero(counts)
        filled[own] = np.bincount(owner[full], minlength=len(own))
        plural[own] = np.bincount(owner[deletable], minlength=len(own))
        tag = mix(number.astype(np.uint64) + salt[owner])
        names = np.where(deletable, number + 1, 0).astype(np.uint16)
        parts.append((mix(sums[full] + tag[full]), own[owner[full]], np.full(len(full), kind, np.uint8), names[full]))
        loose = np.flatnonzero(deletable[place])
        there = place[loose]
        parts.append(
            (
                mix(sums[there] - value[loose] + tag[there]),
                own[at[loose]],
                np.full(len(loose), DELETED_BELOW if below else DELETED, np.uint8),
                names[there],
            )
        )
    return *(np.concatenate(x) for x in zip(*parts, strict=True)), filled, plural


def _planes(x: np.ndarray) -> bytes:
    """Bytes of a sorted array, most significant first and byte by byte: they compress well."""
    return x.astype(f">u{x.dtype.itemsize}").view(np.uint8).reshape(len(x), -1).T.tobytes()


def _unplanes(raw: bytes, size: int) -> np.ndarray:
    return np.ascontiguousarray(np.frombuffer(raw, np.uint8).reshape(size, -1).T).view(f">u{size}").ravel()


def _pack(*arrays: np.ndarray) -> bytes:
    """First array sorted, in planes; all follow their lengths."""
    raw = [_planes(arrays[0]), *(np.ascontiguousarray(x).tobytes() for x in arrays[1:])]
    return struct.pack(f"<{len(raw)}q", *map(len, raw)) + b"".join(raw)


def _unpack(raw: bytes, *kinds) -> list[np.ndarray]:
    sizes = struct.unpack_from(f"<{len(kinds)}q", raw)
    at, out = 8 * len(kinds), []
    for i, (size, kind) in enumerate(zip(sizes, kinds, strict=True)):
        part = raw[at : at + size]
        out.append(_unplanes(part, np.dtype(kind).itemsize).astype(kind) if i == 0 else np.frombuffer(part, kind))
        at += size
    return out


ENTRY = ("u4", "u2", "u2", "u8")
INFO = ("u8", "u4", "u4", "u4", "u4", "u4")
SHARED = ("u8", "u8", "u8", "u4", "u2", "u1")
MEMBER = ("u8", "u8", "u4", "u8", "u8", "u1")


def _signature_blobs(docs: DataFrame, text: str, buckets: int) -> DataFrame:
    """Rows (bucket, kind, blob): signatures by bucket, and a line of facts for each set."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held: list = []
        sets_held = entries_held = 0

        def flush():
            ids = np.concatenate([h[0] for h in held])
            _, first = np.unique(ids, return_index=True)
            own = np.zeros(len(ids), bool)
            own[first] = True  # a set that occurs again in this run is sent once
            base = np.cumsum([0, *(len(h[0]) for h in held[:-1])])
            sigs = np.concatenate([h[1] for h in held])
            owner = np.concatenate([h[2] + np.int32(b) for h, b in zip(held, base, strict=True)])
            kind = np.concatenate([h[3] for h in held])
            segment = np.concatenate([h[4] for h in held])
            info = np.concatenate([h[5] for h in held])
            if not own.all():
                use = own[owner]
                sigs, owner, kind, segment = sigs[use], owner[use], kind[use], segment[use]
            # (bucket, low half) in one number: one fast sort
            place = (sigs >> np.uint64(32)) * np.uint64(buckets) & ~_LOW | sigs & _LOW
            order = np.argsort(place)
            place, owner, kind, segment = place[order], owner[order], kind[order], segment[order]
            cuts = np.searchsorted(place, np.arange(buckets + 1, dtype=np.uint64) << np.uint64(32))
            low = (place & _LOW).astype("u4")
            numbers, kinds, blobs = [], [], []
            number, there = np.zeros(len(ids), np.uint16), np.zeros(len(ids), bool)
            for b in np.flatnonzero(np.diff(cuts)):
                rows = slice(cuts[b], cuts[b + 1])
                there[owner[rows]] = True
                here = np.flatnonzero(there)
                there[here] = False
                number[here] = np.arange(len(here), dtype=np.uint16) * 4
                numbers.append(int(b))
                kinds.append(0)
                blobs.append(_pack(low[rows], number[owner[rows]] + kind[rows], segment[rows], ids[here]))
            facts = info[first]
            home = (facts[:, 0] % np.uint64(buckets)).astype(np.int64)
            for b in np.unique(home):
                here = facts[home == b]
                here = here[np.argsort(here[:, 0])]
                numbers.append(int(b))
                kinds.append(1)
                blobs.append(_pack(here[:, 0].copy(), *(here[:, i].astype("u4") for i in range(1, 6))))
            held.clear()
            return pa.RecordBatch.from_arrays(
                [pa.array(numbers, pa.int32()), pa.array(kinds, pa.int32()), pa.array(blobs, pa.binary())],
                names=["bucket", "kind", "blob"],
            )

        for batch in batches:
            for _, _, flat, values, n, ids in _sets(batch.column(0)):
                real = np.flatnonzero(n)
                if not len(real):
                    continue
                _, once = np.unique(ids[real], return_index=True)
                real = real[np.sort(once)]
                for a in range(0, len(real), FLUSH_SETS):
                    part = real[a : a + FLUSH_SETS]
                    size, mine = n[part], slice(None)
                    if len(part) < len(n):
                        chosen = np.zeros(len(n), bool)
                        chosen[part] = True
                        mine = np.repeat(chosen, n)
                    elements = flat[mine]
                    spread = mix(elements ^ _SEGMENT_KEY) >> np.uint64(32)
                    band = band_of(size)
                    under = np.where((band > 0) & (4 * (BOUNDS[band] - 1) >= 3 * size), band - 1, -1)
                    up = signatures(elements, values[mine], spread, size, band, False)
                    down = signatures(elements, values[mine], spread, size, under, True)
                    info = np.column_stack([ids[part], size, up[4], up[5], down[4], down[5]]).astype(np.uint64)
                    info[:, 0] = ids[part]
                    if held and (sets_held + len(part) > FLUSH_SETS or entries_held > FLUSH_SIGNATURES):
                        yield flush()
                        sets_held = entries_held = 0
                    merged = (np.concatenate(x) for x in zip(up[:4], down[:4], strict=True))
                    held.append((ids[part], *merged, info))
                    sets_held += len(part)
                    entries_held += len(up[0]) + len(down[0])
        if held:
            yield flush()

    return docs.select(text).mapInArrow(tidy(run), "bucket int, kind int, blob binary")


def _frame(buckets: list[int], kinds: list[int], blobs: list[bytes]) -> pd.DataFrame:
    return pd.DataFrame({"bucket": np.array(buckets, np.int32), "kind": np.array(kinds, np.int32), "blob": blobs})


def _repeated(low: np.ndarray) -> np.ndarray:
    """Rows whose value occurs more than once, ordered by value and row."""
    rows = np.sort(low.astype(np.uint64) << np.uint64(32) | np.arange(len(low), dtype=np.uint64))
    same = rows[1:] >> np.uint64(32) == rows[:-1] >> np.uint64(32)
    met = np.zeros(len(rows), bool)
    met[1:] = same
    met[:-1] |= same
    return (rows[met] & _LOW).astype(np.int64)


def _ordered(low: np.ndarray, owner: np.ndarray, kind: np.ndarray, segment: np.ndarray) -> np.ndarray:
    """Order of ascending ``low`` by (low, owner, kind, segment): one number per row where it has the room."""
    group = np.cumsum(np.concatenate([[False], low[1:] != low[:-1]]))
    bits = [int(x.max()).bit_length() for x in (group, owner, kind, segment)]
    if sum(bits) > 64:
        return np.lexsort((segment, kind, owner, low))
    place = group.astype(np.uint64)
    for x, n in zip((owner, kind, segment), bits[1:], strict=True):
        place = place << np.uint64(n) | x.astype(np.uint64)
    return np.argsort(place)


def _find_shared(key, rows: pd.DataFrame, buckets: int) -> pd.DataFrame:
    """One bucket of signatures: keeps those that two sets meet in, dealt by the sets' own buckets.

    For each entry: how many indexed sets it would meet, and one of them.
    """
    numbers, kinds, blobs = [], [], []
    for blob in rows.blob[rows.kind == 1]:
        numbers.append(int(key[0]))
        kinds.append(1)
        blobs.append(blob)
    entries, base = [], 0
    for blob in rows.blob[rows.kind == 0]:
        a, b, c, d = _unpack(blob, *ENTRY)
        entries.append((a, b.astype(np.int64) + 4 * base, c, d))
        base += len(d)
    if not entries:
        return _frame(numbers, kinds, blobs)
    low, local, segment, ids = (np.concatenate(x) for x in zip(*entries, strict=True))
    del entries
    # most signatures stand alone and go before anything else is done
    rows_met = _repeated(low)
    if not len(rows_met):
        return _frame(numbers, kinds, blobs)
    low, local, segment = low[rows_met], local[rows_met], segment[rows_met]
    names, owner = np.unique(ids[local >> 2], return_inverse=True)
    kind = local & 3
    order = _ordered(low, owner, kind, segment)
    low, owner, kind, segment = low[order], owner[order], kind[order], segment[order]
    same = (low[1:] == low[:-1]) & (owner[1:] == owner[:-1])
    new = np.concatenate([[True], ~(same & (kind[1:] == kind[:-1]) & (segment[1:] == segment[:-1]))])
    low, owner, kind, segment = low[new], owner[new], kind[new], segment[new]
    start = np.flatnonzero(np.concatenate([[True], low[1:] != low[:-1]]))
    group = np.cumsum(np.concatenate([[True], low[1:] != low[:-1]])) - 1
    other = np.concatenate([[True], (owner[1:] != owner[:-1]) | (low[1:] != low[:-1])])
    members = np.add.reduceat(other.astype(np.int64), start)
    indexed = kind == INDEXED
    count = np.add.reduceat(indexed.astype(np.int64), start)
    keep = ((members > 1) & (count > 0))[group]
    # the first two indexed sets of a group, to name one that is not the entry's own set
    place = np.flatnonzero(indexed)
    first = np.full(len(start), -1)
    second = np.full(len(start), -1)
    at = group[place]
    head = np.concatenate([[True], at[1:] != at[:-1]]) if len(at) else np.zeros(0, bool)
    first[at[head]] = owner[place[head]]
    follow = np.flatnonzero(head) + 1
    follow = follow[follow < len(at)]
    follow = follow[~head[follow]]
    second[at[follow]] = owner[place[follow]]
    is_member = indexed[np.flatnonzero(other)][np.cumsum(other) - 1]  # the indexed entry of a set comes first
    cost = count[group] - is_member
    mate = np.where(first[group] == owner, second[group], first[group])
    rows_kept = np.flatnonzero(keep & ((cost > 0) | indexed))
    owner, kind, segment, cost, mate = (x[rows_kept] for x in (owner, kind, segment, cost, mate))
    full = (np.uint64(key[0]) << np.uint64(32)) | low[rows_kept].astype(np.uint64)
    mates = np.where(mate >= 0, names[np.maximum(mate, 0)], np.uint64(0))
    homes = (names % np.uint64(buckets)).astype(np.int64)
    rank = np.empty(len(names), np.int64)
    rank[np.argsort(homes, kind="stable")] = np.arange(len(names))
    order = np.argsort(rank[owner], kind="stable")
    home, owner, cost, kind = homes[owner[order]], names[owner[order]], cost[order].astype("u4"), kind[order].astype("u1")
    full, mates, segment = full[order], mates[order], segment[order].astype("u2")
    cuts = np.searchsorted(home, np.arange(buckets + 1))
    for b in np.flatnonzero(np.diff(cuts)):
        r = slice(cuts[b], cuts[b + 1])
        numbers.append(int(b))
        kinds.append(0)
        blobs.append(_pack(owner[r], full[r], mates[r], cost[r], segment[r], kind[r]))
    return _frame(numbers, kinds, blobs)


def allocate(n: int, band: int, filled: int, plural: int, cost: np.ndarray, kind: np.ndarray, segment: np.ndarray):
    """Which shared entries a set probes in a band; none if its unshared segments already rule out a partner.

    ``cost``, ``kind``, ``segment``: the entries shared with indexed sets. Compares the cheapest
    H + 1 whole segments with the cheapest one-deletion neighbourhoods that suffice.
    """
    h, b = limits(n, band)
    whole = np.flatnonzero(kind == 0)
    need = h + 1 - (filled - len(whole))
    if need <= 0:
        return whole[:0]
    exact = whole[np.argsort(cost[whole], kind="stable")[:need]] if need <= len(whole) else None
    if plural:
        by_segment = np.flatnonzero(segment > 0)
        sums = np.bincount(segment[by_segment], cost[by_segment])
        touched = np.unique(segment[by_segment])
        need = b + (h - b) // 2 + 1 - (plural - len(touched))
        if need <= 0:
            return whole[:0]
        if need <= len(touched):
            cheap = touched[np.argsort(sums[touched], kind="stable")[:need]]
            if exact is None or sums[cheap].sum() < cost[exact].sum():
                return np.flatnonzero((segment > 0) & np.isin(segment, cheap))
    if exact is None:
        raise ValueError(f"a set of {n} shingles fills only {filled} segments of band {band}; use another segment key")
    return exact


def _plans(shared: pd.DataFrame):
    """For each set of a bucket: (id, size, probed rows, indexed rows) and the columns they are rows of."""
    facts = [_unpack(x, *INFO) for x in shared.blob[shared.kind == 1]]
    parts = [_unpack(x, *SHARED) for x in shared.blob[shared.kind == 0]]
    if not parts or not facts:
        return [], None
    ids, n, filled, plural, filled_below, plural_below = (np.concatenate(x) for x in zip(*facts, strict=True))
    columns = [np.concatenate(x) for x in zip(*parts, strict=True)]
    order = np.argsort(columns[0], kind="stable")
    columns = owner, _, _, cost, segment, kind = [x[order] for x in columns]
    sets, start = np.unique(owner, return_index=True)
    end = np.append(start[1:], len(owner))
    by_id = np.argsort(ids, kind="stable")
    at = by_id[np.searchsorted(ids[by_id], sets)]
    out = []
    for i, (name, a, z) in enumerate(zip(sets, start, end, strict=True)):
        f = at[i]
        size = int(n[f])
        band = int(band_of(np.array([size]))[0])
        rows = np.arange(a, z)
        mine, met = kind[a:z], cost[a:z] > 0
        probed = []
        for whole, deleted, where, full, many in (
            (INDEXED, DELETED, band, filled[f], plural[f]),
            (PROBE_BELOW, DELETED_BELOW, band - 1, filled_below[f], plural_below[f]),
        ):
            use = rows[((mine == whole) | (mine == deleted)) & met]
            if full and len(use):
                picked = allocate(size, where, int(full), int(many), cost[use].astype(np.int64), (kind[use] != whole).astype(int), segment[use].astype(np.int64))
                probed.append(use[picked])
        probed = np.concatenate(probed) if probed else rows[:0]
        indexed = rows[mine == INDEXED]
        if int(filled[f]) - len(indexed) > size // 3:
            indexed = rows[:0]  # as the smaller set it would need more equal segments than others share
        if len(probed) or len(indexed):
            out.append((name, size, probed, indexed))
    return out, columns


def _first_pairs(shared: pd.DataFrame) -> pd.DataFrame:
    """Each set that may have a partner, with the set it meets most often (null if it only waits to be met)."""
    plans, columns = _plans(shared)
    names, mates = [], []
    for name, _, probed, _ in plans:
        names.append(name)
        if len(probed):
            met, count = np.unique(columns[2][probed], return_counts=True)
            mates.append(int(met[count.argmax()].astype(np.int64)))
        else:
            mates.append(None)
    return pd.DataFrame(
        {"a": np.array(names, np.uint64).astype(np.int64), "b": pd.array(mates, dtype="Int64")}
    )


def _members(shared: pd.DataFrame, labels: pd.DataFrame, buckets: int) -> pd.DataFrame:
    """Probing and indexed sets with their components, dealt by bucket of signature."""
    plans, columns = _plans(shared)
    known = dict(zip(labels.node.to_numpy(), zip(labels.component.to_numpy(), labels.block.to_numpy(), strict=True), strict=True))
    parts = []
    for name, size, probed, indexed in plans:
        component, block = known[int(name.astype(np.int64))]
        for rows, role in ((probed, 1), (indexed, 0)):
            if len(rows):
                k = len(rows)
                parts.append((columns[1][rows], np.full(k, name), np.full(k, size), np.full(k, component), np.full(k, block), np.full(k, role)))
    if not parts:
        return _frame([], [], [])
    sig, name, size, component, block, role = (np.concatenate(x) for x in zip(*parts, strict=True))
    bucket = (sig >> np.uint64(32)).astype(np.int64)
    order = np.lexsort((sig, bucket))
    cuts = np.searchsorted(bucket[order], np.arange(buckets + 1))
    numbers, blobs = [], []
    for b in np.flatnonzero(np.diff(cuts)):
        r = order[cuts[b] : cuts[b + 1]]
        numbers.append(int(b))
        blobs.append(
            _pack(
                sig[r], name[r].astype("u8"), size[r].astype("u4"), component[r].view(np.uint64),
                block[r].view(np.uint64), role[r].astype("u1"),
            )
        )
    return _frame(numbers, [0] * len(numbers), blobs)


def _sides(block: np.ndarray, size: np.ndarray, component: np.ndarray) -> np.ndarray:
    """(block, least and largest size, least and largest component) of some sets, a column per block."""
    order = np.argsort(block, kind="stable")
    block, size, component = block[order], size[order], component[order]
    start = np.flatnonzero(np.concatenate([[True], block[1:] != block[:-1]]))
    low, high = np.minimum.reduceat, np.maximum.reduceat
    return np.stack([block[start], low(size, start), high(size, start), low(component, start), high(component, start)])


def _opposed(probing: np.ndarray, indexed: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Pairs (p, q) of a probing and an indexed block that may link sets of different components."""
    x, y = probing[:, :, None], indexed[:, None, :]
    one = (x[3] == x[4]) & (y[3] == y[4]) & (x[3] == y[3])
    i, j = np.nonzero(~one & (y[1] <= x[2]) & (4 * y[2] >= 3 * x[1]))
    a, b = probing[0][i], indexed[0][j]
    return np.minimum(a, b), np.maximum(a, b)


def _cross_pairs(rows: pd.DataFrame) -> pd.DataFrame:
    """What meets in a signature: a probing and an indexed set of different components, or their blocks.

    Few pairs between two blocks are rows (a, b). Many, and all those of a signature with many
    members, are tiles (p, q) of blocks, of which ``_block_pairs`` lists the pairs elsewhere.
    """
    sig, name, size, component, block, role = (
        np.concatenate(x) for x in zip(*(_unpack(b, *MEMBER) for b in rows.blob), strict=True)
    )
    names, number = np.unique(name, return_inverse=True)
    block, component = block.view(np.int64), component.view(np.int64)
    block_of = np.zeros(len(names), np.int64)
    block_of[number] = block
    order = np.lexsort((role, sig))
    sig, number, size, component, role, block = (x[order] for x in (sig, number, size.astype(np.int64), component, role, block))
    start = np.flatnonzero(np.concatenate([[True], sig[1:] != sig[:-1]]))
    end = np.append(start[1:], len(sig))
    low = np.minimum.reduceat(component, start)
    high = np.maximum.reduceat(component, start)
    met, tiles, seen = [np.zeros(0, np.int64)], [], set()
    for a, z in zip(start[low < high], end[low < high], strict=True):
        probes = a + np.flatnonzero(role[a:z] == 1)
        index = a + np.flatnonzero(role[a:z] == 0)
        if len(probes) * len(index) > MANY_PAIRS:
            left, right = (_sides(block[i], size[i], component[i]) for i in (probes, index))
            for i in range(0, left.shape[1], TILE):
                for j in range(0, right.shape[1], TILE):
                    tile = left[:, i : i + TILE].tobytes(), right[:, j : j + TILE].tobytes()
                    if tile not in seen:
                        seen.add(tile)
                        tiles.append(tile)
            continue
        for x in probes:
            fits = index[
                (component[index] != component[x]) & (size[index] <= size[x]) & (4 * size[index] >= 3 * size[x])
            ]
            if len(fits):
                met.append(np.minimum(number[fits], number[x]) * len(names) + np.maximum(number[fits], number[x]))
    met = np.unique(np.concatenate(met))
    a, b = met // len(names), met % len(names)
    p, q = np.minimum(block_of[a], block_of[b]), np.maximum(block_of[a], block_of[b])
    order = np.lexsort((q, p))
    a, b, p, q = a[order], b[order], p[order], q[order]
    cuts = np.flatnonzero(np.concatenate([[True], (p[1:] != p[:-1]) | (q[1:] != q[:-1])])) if len(a) else []
    few = [np.zeros(0, np.int64)]
    for i, z in zip(cuts, np.append(cuts[1:], len(a)), strict=True) if len(a) else ():
        if z - i < DENSE:
            few.append(np.arange(i, z))
        else:
            # wide bounds: these two blocks are to be compared
            wide = np.array([0, 1 << 40, 0, 1])
            tiles.append(tuple(np.append(int(c), wide).astype(np.int64).tobytes() for c in (p[i], q[i])))
    few = np.concatenate(few)
    blank = [None] * len(tiles)
    columns = {
        "a": [*names[a[few]].view(np.int64).tolist(), *blank],
        "b": [*names[b[few]].view(np.int64).tolist(), *blank],
    }
    for i, c in enumerate("pq"):
        columns[c] = [*[None] * len(few), *(tile[i] for tile in tiles)]
    # nullable integers: a float column would round the hashes
    return pd.DataFrame({c: pd.array(v, dtype="Int64") if c in "ab" else v for c, v in columns.items()})


def _block_pairs(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
    """The pairs of blocks (p, q) of each tile."""
    for batch in batches:
        for x, y in zip(batch.p, batch.q, strict=True):
            p, q = _opposed(*(np.frombuffer(side, np.int64).reshape(5, -1) for side in (x, y)))
            yield pd.DataFrame({"p": p, "q": q}).drop_duplicates()


def _packed(key, rows: pd.DataFrame) -> pd.DataFrame:
    """The sets of a block in one row."""
    sizes = rows.elements.str.len().to_numpy(np.int64) // 8
    return pd.DataFrame(
        {
            "block": [key[0]],
            "ids": [rows.set_hash.to_numpy(np.int64).tobytes()],
            "sizes": [sizes.tobytes()],
            "elements": [b"".join(rows.elements)],
        }
    )


def _common(x: np.ndarray, x_sizes: np.ndarray, y: np.ndarray, y_sizes: np.ndarray) -> np.ndarray:
    """Intersection sizes of all sets of one block with all of another, in slices of the elements they share."""
    shared = np.intersect1d(x, y)
    out = np.zeros((len(x_sizes), len(y_sizes)), np.float64)
    for s in range(0, len(shared), SLICE):
        part = shared[s : s + SLICE]
        tables = []
        for flat, sizes in ((x, x_sizes), (y, y_sizes)):
            at = np.minimum(np.searchsorted(part, flat), len(part) - 1)
            hit = part[at] == flat
            table = np.zeros((len(sizes), len(part)), np.float32)
            table[np.repeat(np.arange(len(sizes)), sizes)[hit], at[hit]] = 1
            tables.append(table)
        out += tables[0] @ tables[1].T
    return np.rint(out).astype(np.int64)


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


def _verified_blocks(dense: DataFrame, blocks: DataFrame) -> DataFrame:
    """Links (a spanning forest per pair of blocks) among all sets of the listed pairs of blocks."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for row in batch.to_pylist():
                ids, sizes, flat = zip(
                    *((np.frombuffer(row[f"{s}ids"], np.int64), np.frombuffer(row[f"{s}sizes"], np.int64), np.frombuffer(row[f"{s}elements"], np.uint64)) for s in "pq"),
                    strict=True,
                )
                common = _common(flat[0], sizes[0], flat[1], sizes[1])
                linked = 100 * common >= 75 * (sizes[0][:, None] + sizes[1][None] - common)
                i, j = np.nonzero(linked)
                forest = _spanning(ids[0][i], ids[1][j])
                a, b = zip(*forest, strict=True) if forest else ((), ())
                yield pa.RecordBatch.from_arrays([pa.array(a, pa.int64()), pa.array(b, pa.int64())], names=["a", "b"])

    sides = [blocks.select(F.col("block").alias(s), *[F.col(c).alias(f"{s}{c}") for c in ("ids", "sizes", "elements")]) for s in "pq"]
    return dense.join(sides[0], "p").join(sides[1], "q").mapInArrow(tidy(run), "a long, b long")


def _set_table(docs: DataFrame, key: str, text: str, wanted: DataFrame) -> DataFrame:
    """(set_hash, elements) of each wanted (set_hash, key): one row per set. Only texts of wanted keys are read again."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for a, b, flat, _, sizes, ids in _sets(batch.column(1)):
                raw, ends = flat.tobytes(), np.cumsum(sizes) * 8
                sets = [raw[i:z] for i, z in zip(ends - sizes * 8, ends, strict=True)]
                yield pa.RecordBatch.from_arrays(
                    [batch.column(0).slice(a, b - a), pa.array(ids.view(np.int64)), pa.array(sets, pa.binary())],
                    names=[key, "set_hash", "elements"],
                )

    kind = docs.schema[key].dataType.simpleString()
    again = attach(docs.select(key, text), wanted.select(key).distinct().withColumn("_w", F.lit(1)), [key], "inner", salt_by=[text])
    sets = again.select(key, text).mapInArrow(tidy(run), f"`{key}` {kind}, set_hash long, elements binary")
    found = attach(sets, wanted.withColumn("_w", F.lit(1)), ["set_hash", key], "inner", salt_by=[key])
    return found.select("set_hash", "elements").dropDuplicates(["set_hash"])


def _verified(pairs: DataFrame, sets: DataFrame) -> DataFrame:
    """The pairs (a, b) with 100 * intersection >= 75 * union."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            keep = np.zeros(batch.num_rows, bool)
            for i, (x, y) in enumerate(zip(batch.column(2), batch.column(3), strict=True)):
                x, y = np.frombuffer(x.as_py(), np.uint64), np.frombuffer(y.as_py(), np.uint64)
                if len(x) > len(y):
                    x, y = y, x
                common = int((y[np.minimum(np.searchsorted(y, x), len(y) - 1)] == x).sum())
                keep[i] = 100 * common >= 75 * (len(x) + len(y) - common)
            yield batch.select(["a", "b"]).filter(pa.array(keep))

    one = sets.select(F.col("set_hash").alias("a"), F.col("elements").alias("x"))
    two = sets.select(F.col("set_hash").alias("b"), F.col("elements").alias("y"))
    return pairs.join(one, "a").join(two, "b").select("a", "b", "x", "y").mapInArrow(tidy(run), "a long, b long")


def _labelled(first: DataFrame, labels: DataFrame) -> DataFrame:
    """(node, component, block) of every set that may have a partner.

    Sets that the first candidate pairs connect are likely to meet, so they share blocks; a large
    group of them is cut into blocks by hash.
    """
    nodes = first.select(F.col("a").alias("node"))
    groups = components(first).withColumnRenamed("component", "cluster")
    known = attach(attach(nodes, labels, ["node"]), groups, ["node"])
    known = known.select("node", F.coalesce("component", "node").alias("component"), F.coalesce("cluster", "node").alias("cluster"))
    counts = known.groupBy("cluster").count().filter(F.col("count") > BLOCK_SETS)
    parts = F.ceil(F.coalesce("count", F.lit(1)) / F.lit(BLOCK_SETS))
    block = F.xxhash64("cluster", F.pmod(F.xxhash64("node"), parts))
    return materialize(attach(known, counts, ["cluster"]).select("node", "component", block.alias("block")), "labelled")


def with_set_hash(docs: DataFrame, text: str = "text", name: str = "set_hash") -> DataFrame:
    """``docs`` with the hash of each text's set, null for an empty set."""
    names = [*docs.columns, name]

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            yield pa.RecordBatch.from_arrays([*batch.columns, _hash_column(batch.column(text))[1]], names=names)

    return docs.mapInArrow(tidy(run), StructType([*docs.schema.fields]).add(name, "long"))


def link_documents(docs: DataFrame, key: str = "doc_id", text: str = "text") -> DataFrame:
    """(key, n_shingles, component_id) of every row.

    Words are runs of anything but ASCII white space, A-Z lower-cased; a set holds the distinct
    shingles of five words, or the whole text as one if it has fewer. Sets link at a Jaccard
    similarity of 3/4 or more; ``component_id`` is the smallest key reachable by links. Null,
    empty and blank texts have size 0 and are linked with nothing. Rows with equal sets, repeated
    rows among them, are one set and always linked. A row with a null key has a null component
    and does not name one, though its text still links others. Other columns are not read.
    """
    placed = linked_sets(docs, key, text)
    least = placed.filter("cluster IS NOT NULL").groupBy("cluster").agg(F.min(key).alias("_least"), F.count(F.lit(1)).alias("_n"))
    named = attach(placed, least.filter("_n > 1").select("cluster", "_least"), ["cluster"], salt_by=[key])
    component = F.when(F.col(key).isNotNull(), F.coalesce("_least", key))
    return named.select(key, "n_shingles", component.alias("component_id"))


def linked_sets(docs: DataFrame, key: str = "doc_id", text: str = "text") -> DataFrame:
    """(key, n_shingles, set_hash, cluster) of every row: rows of linked sets have one cluster, empty sets none.

    Groups of signatures and of sets are dealt by hash in buckets of bounded text size. A set is
    first verified against the set that it meets most often; then every pair that still lies in
    different components and meets in a probed signature is verified, so no link between
    components is lost. Where many such pairs lie between two blocks of sets, or many sets meet in
    one signature, only pairs of blocks are listed; two blocks are compared whole inside one task
    and give a spanning forest. Only scattered pairs of sets are rows.
    """
    spark = docs.sparkSession
    documents = materialize(profiles(docs, key, text), "profiles")
    size = docs.agg(F.sum(F.octet_length(text))).first()[0] or 0
    buckets = max(LEAST_BUCKETS, size // BUCKET_BYTES + 1)
    entries = _signature_blobs(docs, text, buckets)
    shared_at = scratch_dir(spark, "shared")
    shared = materialize_at(
        entries.groupBy("bucket").applyInPandas(tidy_group(lambda k, x: _find_shared(k, x, buckets)), "bucket int, kind int, blob binary"),
        shared_at,
    )
    first = materialize(shared.groupBy("bucket").applyInPandas(tidy_group(_first_pairs), "a long, b long"), "first-pairs")
    named = documents.filter(F.col("set_hash").isNotNull()).groupBy("set_hash").agg(F.min(key).alias(key))
    wanted = materialize(first.select(F.col("a").alias("set_hash")).join(named, "set_hash"), "wanted")
    sets_at = scratch_dir(spark, "sets")
    sets = materialize_at(_set_table(docs, key, text, wanted), sets_at)
    edges = materialize(_verified(first.filter("b IS NOT NULL"), sets), "edges")
    labels = _labelled(first, components(edges))
    unsigned = F.col("node").cast("decimal(21,0)")
    unsigned = F.when(F.col("node") < 0, unsigned + F.lit(str(2**64)).cast("decimal(21,0)")).otherwise(unsigned)
    dealt = labels.withColumn("bucket", (unsigned % F.lit(buckets)).cast("int"))
    members = shared.groupBy("bucket").cogroup(dealt.groupBy("bucket")).applyInPandas(
        tidy_group(lambda x, y: _members(x, y, buckets)), "bucket int, kind int, blob binary"
    )
    met = materialize(
        members.groupBy("bucket").applyInPandas(tidy_group(_cross_pairs), "a long, b long, p binary, q binary"), "met"
    )
    few = met.filter("a IS NOT NULL").select("a", "b").distinct()
    tiles = met.filter("a IS NULL").select("p", "q").distinct().repartition(buckets)
    dense = materialize(tiles.mapInPandas(_block_pairs, "p long, q long").distinct(), "dense")
    needed = dense.select(F.explode(F.array("p", "q")).alias("block")).distinct()
    placed = labels.select(F.col("node").alias("set_hash"), "block").join(needed, "block")
    packs = materialize(
        sets.join(placed, "set_hash").groupBy("block").applyInPandas(_packed, "block long, ids binary, sizes binary, elements binary"),
        "packs",
    )
    more = _verified(few, sets).unionByName(_verified_blocks(dense, packs))
    edges = materialize(edges.unionByName(more), "edges")
    labels = components(edges)
    discard(spark, shared_at)
    discard(spark, sets_at)
    placed = attach(documents, labels.withColumnRenamed("node", "set_hash"), ["set_hash"], salt_by=[key])
    return placed.select(key, "n_shingles", "set_hash", F.coalesce("component", "set_hash").alias("cluster"))
