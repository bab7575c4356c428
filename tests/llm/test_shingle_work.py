"""What the shingle join does no more than once: sets of a chunk at a time, lone signatures, texts read again."""

import numpy as np
import pandas as pd
import pytest

pytest.importorskip("hydrosignal.llm.catalog")

import pyarrow as pa  # noqa: E402

from hydrosignal.llm import shingle_join, texts  # noqa: E402


def _chunk(values):
    [(_, _, data, offsets)] = texts.text_chunks(pa.array(values))
    hashes, _, _, counts = texts.words(data, offsets)
    return hashes, counts


def test_sets_of_a_chunk_are_those_of_each_text():
    values = ["", "a", None, "b a", "a b c d", "a b c d e", "a b c d e f", "a b c d e " * 5, " ", "a a a a a a a", "d c b a"]
    flat, sizes = shingle_join.shingle_sets(*_chunk(values))
    ids = shingle_join.set_hashes(texts.mix(flat ^ shingle_join._VALUE_KEY), sizes)
    assert sizes.tolist() == [0, 1, 0, 1, 1, 1, 2, 5, 0, 1, 1]
    for i, own in enumerate(texts.by_text(flat, sizes)):
        w = _chunk([values[i]])[0]
        n = min(len(w), shingle_join.WORDS)
        expected = np.unique(texts.grams(w, n)) ^ np.uint64(n % shingle_join.WORDS) if n else w
        assert own.tolist() == expected.tolist()
        one = texts.mix(expected ^ shingle_join._VALUE_KEY).sum(dtype=np.uint64, keepdims=True)
        assert ids[i] == texts.mix(one)[0]
    flat, sizes = shingle_join.shingle_sets(*_chunk([None, " "]))
    assert not len(flat) and sizes.tolist() == [0, 0]


def test_word_hashes_do_not_depend_on_the_length_of_the_chunk():
    few = ["alpha", "beta", "gamma"]
    long, _ = _chunk([" ".join(few * (texts.KEPT_POWERS // 10))])
    short, _ = _chunk([" ".join(few)])
    assert np.array_equal(long.reshape(-1, 3), np.broadcast_to(short, (len(long) // 3, 3)))


def test_signatures_that_stand_alone_are_not_ordered(monkeypatch):
    n = 20_000  # sets of one signature each; the last ten have the signature of the first ten
    low = np.append(np.arange(n - 10), np.arange(10)).astype("u4")
    ids = np.arange(1, n + 1, dtype=np.uint64) * np.uint64(0x9E3779B97F4A7C15)
    blobs = [
        shingle_join._pack(low[a : a + 10_000], np.arange(10_000, dtype="u2") * 4, np.zeros(10_000, "u2"), ids[a : a + 10_000])
        for a in (0, 10_000)
    ]
    ordered = []
    for name in ("lexsort", "argsort"):
        real = getattr(np, name)
        monkeypatch.setattr(np, name, lambda x, *a, _real=real, **k: ordered.append(np.shape(x)[-1]) or _real(x, *a, **k))
    frame = pd.DataFrame({"bucket": 0, "kind": 0, "blob": blobs})
    got = shingle_join._find_shared((0,), frame, 1)
    owner, _, mate, cost, _, _ = shingle_join._unpack(got.blob[0], *shingle_join.SHARED)
    pairs = {*zip(ids[:10].tolist(), ids[-10:].tolist(), strict=True)}
    assert {*zip(owner.tolist(), mate.tolist(), strict=True)} == pairs | {(b, a) for a, b in pairs}
    assert (cost == 1).all() and max(ordered) <= 20


@pytest.mark.parametrize("most", [1 << 20, 1 << 61])
def test_one_number_orders_like_four_columns(most):
    rng = np.random.default_rng(3)
    low, owner = np.sort(rng.integers(0, 40, 500)).astype("u4"), rng.integers(0, 5, 500) * (most // 4)
    columns = low, owner, rng.integers(0, 4, 500), rng.integers(0, 3, 500).astype("u2")
    order = shingle_join._ordered(*columns)
    rows = np.column_stack([c.astype(np.int64) for c in columns])
    assert np.array_equal(rows[order], rows[np.lexsort(rows.T[::-1])])


def test_only_texts_of_wanted_keys_are_read_again(spark):
    data = [(1, "a b c d e f"), (1, "x"), (2, "k l m n o p"), (None, "q r s t u"), (4, None)]
    docs = spark.createDataFrame(data, "doc_id long, text string")
    known = {(r.doc_id, r.n_shingles): r.set_hash for r in shingle_join.profiles(docs, "doc_id", "text").collect()}
    chosen = [(known[1, 2], 1), (known[1, 1], 1), (known[None, 1], None)]
    got = shingle_join._set_table(docs, "doc_id", "text", spark.createDataFrame(chosen, "set_hash long, doc_id long"))
    assert {r.set_hash: len(r.elements) for r in got.collect()} == {chosen[0][0]: 16, chosen[1][0]: 8, chosen[2][0]: 8}
    plan = got._jdf.queryExecution().optimizedPlan().toString()
    assert "Join" in plan[plan.index("MapInArrow") :]
