"""Brute-force and edge tests of the prefix trie, hard negatives and packing."""

import hashlib
import math
import random
import zlib
from collections import defaultdict

import numpy as np
import pytest

pytest.importorskip("hydrosignal.llm.catalog")

import public_tokenizers  # noqa: E402
from pyspark.sql import functions as F  # noqa: E402
from tokenizers import Tokenizer  # noqa: E402

from hydrosignal.llm import catalog, hard_negatives, packing, prefix_trie  # noqa: E402


def table(rows):
    return sorted((tuple(r) for r in rows), key=repr)


# -- op11


def plain_trie(rows, group=5, longest=9):
    own = defaultdict(list)
    for c, t, r, x in rows:
        if c is not None:
            own[c].append((t is not None, t or 0, r or "", x or ""))
    own = {c: [(r, x) for _, _, r, x in sorted(v, key=lambda q: q[:2])] for c, v in own.items()}
    seq = {}
    for c, v in own.items():
        h = zlib.crc32(str(c).encode()) % longest
        seq[c] = own.get(c - int(math.fmod(c, group)), [])[:h] + v[h:]
    members, kids = defaultdict(list), defaultdict(int)
    for c, s in seq.items():
        for d in range(len(s) + 1):
            members[tuple(s[:d])].append(c)
    for k in members:
        if k:
            kids[k[:-1]] += 1
    leaves, saved = defaultdict(int), defaultdict(int)
    for k, m in members.items():
        for d in range(len(k) + 1):
            leaves[k[:d]] += not kids[k]
            saved[k[:d]] += (len(m) - 1) * len(k[-1][1].encode()) if k else 0
    out = []
    for k, m in members.items():
        ends = ",".join(str(c) for c in sorted(m) if len(seq[c]) == len(k))
        above = min(members[k[:-1]]) if k else None
        out.append((min(m), len(k), above, len(m), kids[k], leaves[k], saved[k], hashlib.sha256(ends.encode()).hexdigest()))
    return table(out)


def trie_of(spark, tmp_path, rows):
    folder = str(tmp_path / f"t{len(list(tmp_path.iterdir()))}")
    df = spark.createDataFrame(rows, "conv_id long, turn long, role string, text string")
    df.withColumns({c: F.lit("x") for c in ("depth", "conv", "x", "shard")}).write.parquet(f"{folder}/conversations.parquet")
    return table(catalog.op11_prefix_trie(spark, folder).collect())


def test_trie_of_odd_conversations(spark, tmp_path, monkeypatch):
    """Long and hot conversations, copies, nulls, negative ids, shards of few rows and short lists of ends."""
    monkeypatch.setattr(prefix_trie, "SHARD_ROWS", 37)
    monkeypatch.setattr(prefix_trie, "BANDS_PER_PART", 3)
    monkeypatch.setattr(prefix_trie, "PIECE", 40)
    rnd = random.Random(3)
    rows = [(c, t, rnd.choice("ua"), rnd.choice("xy")) for c in range(150) for t in range(rnd.choice([1, 2, 5, 12]))]
    rows += [(7, t, "u", f"long{t // 50}") for t in range(100, 300)] + [(c, t, "u", "same") for c in range(1000, 1040) for t in range(35)]
    rows += [(None, 1, "u", "lost"), (2000, None, None, None), (2000, 3, None, "é"), (-7, 1, "u", "neg"), (-5, 1, "u", "neg"), (2003, None, None, None)]
    rows += [(3000, 1, "u", "twice"), (3000, 1, "u", "twice")]
    assert trie_of(spark, tmp_path, rows) == plain_trie(rows)


def test_trie_of_nothing_and_of_one(spark, tmp_path):
    assert trie_of(spark, tmp_path, []) == []
    one = [(4, 0, "user", "hello")]
    assert trie_of(spark, tmp_path, one) == plain_trie(one)


def test_nodes_know_their_last_turn(spark):
    rows = [(1, 0, "user", "a"), (1, 1, "assistant", "b"), (2, 0, "user", "a"), (2, 1, None, "c")]
    turns = spark.createDataFrame(rows, "conv_id long, turn long, role string, text string")
    numbered = prefix_trie.numbered(turns)
    steps = numbered.withColumn("last", F.col("pos") == F.col("length") - 1).withColumnRenamed("pos", "i")
    trie = prefix_trie.build(steps, numbered.filter("pos = 0").select("conv", "length"))
    got = prefix_trie.last_turns(trie.nodes, steps, turns)
    assert table(got.select("depth", "role", "text", "n_convs").collect()) == table([(0, None, None, 2), (1, "user", "a", 2), (2, "", "c", 1), (2, "assistant", "b", 1)])


# -- op12


def plain_negatives(rows):
    good = []
    for i, v, k in rows:
        if k is not None and v is not None and all(x is not None and math.isfinite(x) for x in v):
            good.append((i, [math.floor(256 * float(x)) for x in v], (k + 1) % 10 if i is not None and i % 7 == 0 else k))
    out = []
    for n, (i, q, k) in enumerate(good):
        if i is None or i % 100:
            continue
        scored = [(-sum(a * b for a, b in zip(q, v)), j is None, j or 0, m) for m, (j, v, _) in enumerate(good) if len(v) == len(q) and m != n]
        other = sorted(s for s in scored if good[s[3]][2] != k)
        for p in sorted(s for s in scored if good[s[3]][2] == k)[:5]:
            found = [s for s in other if 30 * -p[0] <= 100 * -s[0] <= 90 * -p[0]][:10]
            out += [(i, good[p[3]][0], r + 1, good[s[3]][0], -p[0], -s[0]) for r, s in enumerate(found)]
    return table(out)


def test_negatives_equal_brute_force(spark, tmp_path, monkeypatch):
    """Ties, repeated keys and vectors, nulls, several widths, a vector that many rows share."""
    monkeypatch.setattr(hard_negatives, "BUCKET_ROWS", 64)
    monkeypatch.setattr(hard_negatives, "ANCHOR_BYTES", 300)
    rnd = random.Random(5)
    rows = [(rnd.choice([k, k % 30 * 100]), [rnd.choice([rnd.gauss(0, 1), 0.5]) for _ in range(6)], rnd.choice([0, 1, 2, None])) for k in range(700)]
    rows += [(None, [1.0] * 6, 1), (5, None, 1), (6, [1.0, None] * 3, 1), (8, [float("nan")] * 6, 2), (9, [math.inf] * 6, 2)]
    rows += [(100, [], 1), (102, [], 2), (103, [], 1), (200, [1.0, 2.0], 1), (201, [1.0, 1.5], 1), (202, [0.5, 0.5], 2)]
    rows += [(300, [0.0] * 6, 1), (301, [0.0] * 6, 2), *[(k, [1.0, 2.0, 0.5, 0.1, 0.0, 1.0], 1 + k % 2) for k in range(5000, 5400)]]
    df = spark.createDataFrame(rows, "vec_id long, embedding array<double>, label int")
    df.withColumns({c: F.lit("x") for c in ("seq", "gid", "norm")}).write.parquet(f"{tmp_path}/embeddings.parquet")
    want = plain_negatives(rows)
    assert want and table(catalog.op12_hard_negatives(spark, str(tmp_path)).collect()) == want


def test_negatives_of_very_large_components(spark):
    rows = [(100, [3e9, 1.0], 1), (1, [1.0, 1.0], 1), (2, [0.5, 0.0], 2), (3, [1e30, 0.0], 1), (4, [0.5, 0.5], 3)]
    df = spark.createDataFrame(rows, "vec_id long, embedding array<double>, label int")
    got = table(hard_negatives.mine(df, F.col("vec_id") % 100 == 0).collect())
    assert [r[:4] for r in got] == [(100, 1, 1, 4), (100, 1, 2, 2)] and all(r[4] > 2**40 for r in got)
    assert hard_negatives.mine(df.limit(0), F.col("vec_id") % 100 == 0).count() == 0


def test_pruning_keeps_every_row_that_reaches_the_limit():
    rng = np.random.default_rng(2)
    x = np.floor(256 * rng.normal(size=(300, 12))).astype(np.int32)
    norm = np.sqrt((x.astype(float) ** 2).sum(1))
    zero = np.zeros(300, np.int64)
    bucket = hard_negatives._Bucket(12, False, float(norm.max()), zero, zero, zero == 0, zero, x, np.argsort(x.T, axis=1).astype(np.uint16))
    pruned = 0
    for q in np.floor(256 * rng.normal(size=(40, 12))):
        length, product = float(np.sqrt((q * q).sum())), x @ q
        for least in np.quantile(product, [0.0, 0.5, 0.95, 1.0]).tolist() + [float(product.max()) + 1, 1e12, -1e12]:
            found = bucket.candidates(q, length, least)
            if found is not None:
                pruned += 300 - len(found)
                assert set(np.flatnonzero(product >= least)) <= set(found.tolist())
    assert pruned > 1000


# -- op13

PATH = public_tokenizers.path(catalog.PACKED_BY)


def check_pieces(got, texts, window=1024):
    """Every id of every document once, sequences without gaps, and no padding; by row order of ``texts``."""
    library = Tokenizer.from_file(PATH)
    want = defaultdict(list)
    for k, t in texts:
        want[k].append(library.encode(t or "", add_special_tokens=False).ids + [0])
    sequences, by = defaultdict(list), defaultdict(list)
    for r in got:
        sequences[r.sequence_id].append((r.offset, r.length))
        by[r.doc_id].append(r)
    for k, docs in want.items():
        pieces = sorted((r.start, np.frombuffer(r.ids, np.uint32).tolist(), r.doc_tokens) for r in by.pop(k))
        for ids in sorted(docs, key=len):
            at = 0
            while at < len(ids):
                i = next(i for i, (s, x, n) in enumerate(pieces) if s == at and n == len(ids) and x == ids[at : at + len(x)])
                at += len(pieces.pop(i)[1])
        assert not pieces
    assert not by
    for pieces in sequences.values():
        at = 0
        for offset, length in sorted(pieces):
            assert offset == at and length > 0
            at += length
        assert at <= window and at & (at - 1) == 0


def test_packing_of_odd_texts(spark):
    rnd = random.Random(1)
    words = [f"w{i}" for i in range(300)]
    texts = [(i, " ".join(rnd.choices(words, k=rnd.choice([0, 1, 5, 60, 400])))) for i in range(120)]
    texts += [(500, None), (501, ""), (None, "a text without an id"), (None, "another"), (7, "a second text under one id"), (502, " " * 300_000), (503, "x " * 40_000)]
    texts += [(504, "<|endoftext|> in a text\n\t é中\U0001f600"), *[(600 + i, "the same text again and again") for i in range(200)]]
    docs = spark.createDataFrame(texts, "doc_id long, text string").withColumns({c: F.lit("x") for c in ("ids", "doc", "key")})
    got = packing.pack(docs, PATH).collect()
    check_pieces(got, texts)
    assert packing.pack(docs.limit(0), PATH).count() == 0


def test_neighbours_share_windows(spark):
    """Documents of one subject meet in windows far more often than by chance."""
    rnd = random.Random(4)
    subjects = [["".join(rnd.choices(letters, k=6)) for _ in range(40)] for letters in ("bao", "dei", "gui", "kay", "mie", "zuo")]
    texts = [(i, " ".join(rnd.choices(subjects[i % 6], k=40))) for i in range(300)]
    got = packing.pack(spark.createDataFrame(texts, "doc_id long, text string").coalesce(1), PATH).collect()
    windows = defaultdict(list)
    for r in got:
        windows[r.sequence_id].append(r.doc_id % 6)
    full = [w for w in windows.values() if len(w) > 3]
    share = np.mean([max(w.count(s) for s in set(w)) / len(w) for w in full])
    assert share > 0.7


def test_lists_give_textbook_bm25():
    rng = np.random.default_rng(3)
    docs = [np.unique(rng.integers(0, 40, 12), return_counts=True) for _ in range(30)]
    weight, lengths = np.maximum(rng.normal(1, 1, 40), 0), np.array([12.0] * 30)
    shard = packing.Shard([t.astype(np.uint32) for t, _ in docs], [c for _, c in docs], lengths, weight, 10.0)
    left = np.ones(30, np.int64)
    for seed in (0, 7, 29):
        left[seed] = 0
        got = shard.scores(seed, left)
        norm = packing.K1 * (1 - packing.B + packing.B * 12 / 10)
        for d in np.flatnonzero(left):
            held = dict(zip(*docs[d]))
            want = sum(weight[t] * held[t] * (packing.K1 + 1) / (held[t] + norm) for t in docs[seed][0] if t in held)
            assert got[d] == pytest.approx(want)
        left[: seed // 2] = 0
