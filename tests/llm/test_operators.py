"""Brute-force, round-trip and edge tests of the training-text operators."""

import hashlib
import math
import re

import numpy as np
import pandas as pd
import pyarrow as pa
import pytest

pytest.importorskip("hydrosignal.llm.catalog")

import public_tokenizers  # noqa: E402
from pyspark.sql import functions as F  # noqa: E402
from tokenizers import Tokenizer  # noqa: E402

from hydrosignal.llm import (  # noqa: E402
    bpe,
    catalog,
    contamination,
    licences,
    links,
    pq_links,
    shard_tree,
    shingle_join,
    site_quality,
    texts,
    transcripts,
    url_trie,
    warc,
)

DATA = "/root/testdata/sf0.001"
PATH = public_tokenizers.path(catalog.TOKENIZER)
LONG = " ".join(f"word{i}" for i in range(30_000))
ROWS = [
    (1, "The quick brown fox jumps over the lazy dog again and again.", "s", "en"),
    (2, "The quick brown fox jumps over the lazy dog again and again.", "s", "en"),
    (2, "The quick brown fox jumps over the lazy dog again and again.", "s", "en"),
    (3, None, None, None),
    (4, "", "s", "de"),
    (5, " \n\t ", "s", "de"),
    (6, "two words", None, "en"),
    (7, LONG, "s", "en"),
    (None, "The quick brown fox jumps over the lazy dog again and again.", "s", "en"),
    (8, "Licensed under the MIT License. All rights reserved.", "s", "en"),
]
CLASHING = ["ids", "n", "key", "id", "bucket", "kind", "_o", "v", "label", "block"]


@pytest.fixture(scope="module")
def docs(spark):
    df = spark.createDataFrame(ROWS, "doc_id long, text string, source string, lang string")
    return df.withColumns({c: F.lit("x") for c in CLASHING})


@pytest.fixture(scope="module")
def none(docs):
    return docs.limit(0)


def rows(df):
    return sorted((tuple(r) for r in df.collect()), key=repr)


def test_components_of_stars_chains_and_nulls(spark):
    pairs = [(i, i + 1) for i in range(40)] + [(100, i) for i in range(101, 400)] + [(None, 3), (7, 7), (1, 0), (500, 500)]
    got = dict(rows(links.components(spark.createDataFrame(pairs, "a long, b long"))))
    assert got == {**dict.fromkeys(range(41), 0), **dict.fromkeys(range(100, 400), 100)}
    assert links.components(spark.createDataFrame([], "a long, b long")).count() == 0


def test_word_hashes_equal_python_split():
    values = ["Ab  cD\x0b e\x1cf", "", None, " a ", "Ünï Code\u00a0x\n"]
    for _, _, data, offsets in texts.text_chunks(pa.array(values)):
        hashes, starts, ends, counts = texts.words(data, offsets)
    want = [w for v in values for w in (v or "").encode().lower().split()]
    assert [data[a:b].tobytes().lower() for a, b in zip(starts, ends)] == want
    assert counts.tolist() == [len((v or "").encode().split()) for v in values]
    assert len(set(hashes.tolist())) == len(set(want))


# -- op1


def _cosines(rows):
    keys = [r[0] for r in rows]
    good = [
        r[2] is not None and r[1] is not None and len(r[1]) > 0
        and all(x is not None and math.isfinite(x) for x in r[1]) and any(r[1]) for r in rows
    ]
    link = {i: set() for i in range(len(rows))}
    for i in range(len(rows)):
        for j in range(i):
            if good[i] and good[j] and rows[i][2] == rows[j][2] and len(rows[i][1]) == len(rows[j][1]):
                x, y = np.array(rows[i][1], float), np.array(rows[j][1], float)
                if x @ y / math.sqrt((x @ x) * (y @ y)) >= 0.93:
                    link[i].add(j)
                    link[j].add(i)
    out = []
    for i in range(len(rows)):
        seen, stack = {i}, [i]
        while stack:
            for j in link[stack.pop()] - seen:
                seen.add(j)
                stack.append(j)
        least = min(keys[j] for j in seen)
        out.append((keys[i], len(link[i]), least, least == keys[i]))
    return sorted(out)


def test_vectors_link_as_by_brute_force(spark):
    rng = np.random.default_rng(3)
    data, base = [], rng.normal(size=(12, 16))
    for i in range(600):
        centre = base[rng.integers(12)]
        data.append((i, (centre + rng.normal(size=16) * rng.choice([0.05, 0.2, 0.35])).astype("f4").tolist(), int(rng.integers(3))))
    data += [(600 + i, data[5][1], data[5][2]) for i in range(5)]
    data += [(700, None, 1), (701, [0.0] * 16, 1), (702, [1.0] * 15 + [None], 1), (703, [float("nan")] * 16, 1),
             (704, data[5][1], None), (705, [], 1), (706, [1.0, 2.0], 1), (707, [2.0, 4.0], 1)]
    df = spark.createDataFrame(data, "vec_id long, embedding array<float>, label int").withColumn("id", F.lit("x"))
    want = _cosines(data)
    got = rows(pq_links.link_vectors(df))
    assert sum(r[1] for r in got) >= 0.99 * sum(r[1] for r in want) and sum(r[1] for r in want) > 1000
    assert sorted(got) == want
    assert pq_links.link_vectors(df.limit(0)).count() == 0


# -- op2


def test_growth_moves_rows_only_into_the_new_shard(spark):
    keys = spark.range(20_000).select(F.col("id").alias("doc_id"), F.lit("é").alias("text"))
    got = shard_tree.shard_documents(keys).toPandas()
    moved = got[got.shard != got.grown_shard]
    assert set(moved.grown_shard) == {16} and 800 < len(moved) < 1600
    assert got.groupby("shard").size().between(1000, 1500).all() and (got["size"] == 3).all()
    for _, part in got.groupby("shard"):
        assert sorted(part.slot) == list(range(len(part)))


def test_weight_change_moves_rows_only_from_or_to_its_subtree(spark):
    leaves = shard_tree.tree(16)
    heavy = [shard_tree.Leaf(x.region, x.rack, x.shard, 3.0 if x.shard == 5 else 1.0) for x in leaves]
    keys = spark.range(4000).select(F.col("id").alias("k"))
    both = shard_tree.place(shard_tree.place(keys, "k", leaves), "k", heavy, "new_").toPandas()
    moved = both[both.shard != both.new_shard]
    outside = moved[(moved.region == moved.new_region) & (moved.new_region != "r0")]
    assert len(moved) > 100 and outside.empty


def test_shards_of_odd_rows(docs, none):
    got = shard_tree.shard_documents(docs).toPandas()
    assert len(got) == len(ROWS) and set(got[got.doc_id.isin([3, 4])]["size"]) == {1}
    assert got[got.doc_id == 2].shard.nunique() == 1 and got[got.doc_id == 2].slot.nunique() == 2
    assert shard_tree.shard_documents(none).count() == 0


# -- op3


def test_tokens_equal_the_library(spark, docs, none):
    library = Tokenizer.from_file(PATH)
    library.no_padding(), library.no_truncation()
    odd = ["Don't STOP", "ΣΑΣ İx", "a\u0301é\u2003b\x85c\x1cd", "<|endoftext|>x<|startoftext|>", "1234 漢字😀", "aaaaaaaaaaaaaaaaaaaaab" * 20]
    df = docs.select("doc_id", "text", "ids", "n").unionByName(spark.createDataFrame([(100 + i, t, "x", "x") for i, t in enumerate(odd)], "doc_id long, text string, ids string, n string"))
    coded = bpe.decode(bpe.encode(df, PATH), PATH).collect()
    assert len(coded) == len(ROWS) + len(odd)
    for r in coded:
        want = library.encode(r.text or "", add_special_tokens=False).ids
        assert r.ids == want and r.decoded == library.decode(want, skip_special_tokens=False) and r.n == "x"
    assert rows(bpe.round_trip(df, PATH).select("doc_id", "ids", "decoded")) == sorted(((r.doc_id, r.ids, r.decoded) for r in coded), key=repr)
    assert bpe.encode(none, PATH).count() == 0


def test_random_words_equal_the_library():
    library, tables = Tokenizer.from_file(PATH), bpe.Vocabulary(open(PATH, "rb").read())
    rng = np.random.default_rng(1)
    for _ in range(3000):
        word = "".join(rng.choice(list("aeinrstolhé'-1"), rng.integers(1, 60)))
        assert tables.encode(word) == library.encode(word, add_special_tokens=False).ids


def test_digests_of_the_query(spark):
    library = Tokenizer.from_file(PATH)
    got = {r.doc_id: r for r in catalog.op3_bpe_round_trip(spark, DATA).collect()}
    for r in spark.read.parquet(f"{DATA}/documents.parquet").collect():
        ids = library.encode(r.text or "", add_special_tokens=False).ids
        assert got[r.doc_id].n_tokens == len(ids)
        assert got[r.doc_id].ids_sha256 == hashlib.sha256(" ".join(map(str, ids)).encode()).hexdigest()
        assert got[r.doc_id].decoded_sha256 == hashlib.sha256(library.decode(ids, skip_special_tokens=False).encode()).hexdigest()


# -- op4


def test_licence_rules_in_order(spark, docs, none):
    wrapped = "Intro text.\n\n" + re.sub(" ", "\n", licences.SENTENCES[1], count=9) + "\n\n" + licences.SENTENCES[2] + " " + licences.SENTENCES[3]
    cases = [
        (wrapped, ["MIT"]),
        (licences.SENTENCES[21] + "\n\n1. " + licences.SENTENCES[22] + "\n2. " + licences.SENTENCES[23], ["BSD-2-Clause"]),
        ("no end\nReleased under the MIT License\nmore", ["MIT"]),
        (licences.SENTENCES[16] + " " + licences.SENTENCES[6], ["Apache-2.0", "CC-BY-NC-4.0"]),
        ("We discussed the licence of the house.", []),
    ]
    df = spark.createDataFrame([(i, t) for i, (t, _) in enumerate(cases)], "doc_id long, text string")
    got = {r.doc_id: r.licences for r in licences.scan_licences(df).collect()}
    assert [got[i] for i in range(len(cases))] == [want for _, want in cases]
    odd = {r.doc_id: r for r in licences.scan_licences(docs).collect()}
    assert odd[3].licences == [] and odd[4].licence is None and odd[8].licences == ["MIT", "LicenseRef-all-rights-reserved"]
    assert licences.scan_licences(none).count() == 0


# -- op5


def test_pieces_give_the_best_path_of_the_whole(spark, monkeypatch):
    turns = spark.read.parquet(f"{DATA}/conversations.parquet").withColumn("best", F.lit("x"))
    model = transcripts.train(turns)
    plain = transcripts.plain_transcripts(turns)
    monkeypatch.setattr(transcripts, "TURNS_PER_PIECE", 2)
    monkeypatch.setattr(transcripts, "FAN_IN", 2)
    got = transcripts.parse_transcripts(plain, model).toPandas().sort_values(["conv_id", "piece"]).groupby("conv_id").rendered.agg("\n".join)
    for conv, part in plain.toPandas().sort_values(["conv_id", "turn", "text"]).groupby("conv_id"):
        lines = "\n".join(part.text).split("\n")
        emit = transcripts.scores(model, lines)
        best, back = model.start + emit[0], []
        for row in emit[1:]:
            enter = best[:, None] + model.step
            back.append(enter.argmax(0))
            best = enter.max(0) + row
        states = [int(best.argmax())]
        for came in reversed(back):
            states.append(int(came[states[-1]]))
        assert got[conv] == transcripts.render(lines, states[::-1])


def test_roles_are_recovered(spark):
    turns = spark.read.parquet("/root/testdata/sf0.01/conversations.parquet")
    fit, held = turns.filter("conv_id % 2 = 0"), turns.filter("conv_id % 2 = 1")
    got = transcripts.parse_transcripts(transcripts.plain_transcripts(held), transcripts.train(fit)).toPandas().set_index("conv_id").roles
    truth = held.toPandas().sort_values(["conv_id", "turn"]).groupby("conv_id").role.agg(" ".join)
    assert (got.reindex(truth.index) == truth).mean() > 0.75


def test_odd_transcripts(spark):
    schema = "conv_id long, turn long, role string, text string, best string"
    data = [(1, 0, "user", "Hi?", "x"), (1, 0, "user", "Hi?", "x"), (1, None, None, None, "x"), (None, 1, "tool", "a\nb", "x"), (2, -1, "User", "", "x"), (3, 500, "assistant", LONG, "x")]
    df = spark.createDataFrame(data, schema)
    got = transcripts.parse_transcripts(transcripts.plain_transcripts(df), transcripts.train(df)).toPandas()
    assert len(got) == 4 and got.n_lines.sum() >= 6
    empty = df.limit(0)
    assert transcripts.parse_transcripts(transcripts.plain_transcripts(empty), transcripts.train(empty)).count() == 0


def test_repeated_turns_and_one_long_conversation(spark, monkeypatch):
    monkeypatch.setattr(transcripts, "TURNS_PER_PIECE", 3)
    data = [(1, 0, "user: hello"), (1, 0, "user: hello"), (1, 1, "assistant: yes"), (2, None, "a"), (2, None, None), (2, None, "a"), (None, 5, "b"), (None, 5, "b")]
    data += [(3, i // 40, f"user: line {i}") for i in range(200)]
    df = spark.createDataFrame(data, "conv_id long, turn long, text string")
    model = transcripts.train(spark.read.parquet(f"{DATA}/conversations.parquet"))
    got = transcripts.parse_transcripts(df, model).toPandas().sort_values(["conv_id", "piece"])
    count = got.groupby("conv_id", dropna=False).n_lines.sum()
    assert count[1] == 3 and count[2] == 3 and count[3] == 200 and got[got.conv_id.isna()].n_lines.sum() == 2
    assert got.n_lines.max() == 3 and "\n".join(got[got.conv_id == 1].rendered).count("hello") == 2


# -- op6


def test_quality_on_held_out_labels(spark):
    documents = spark.read.parquet("/root/testdata/sf0.01/documents.parquet")
    labels = spark.read.parquet("/root/testdata/sf0.01/labels.parquet")
    got = site_quality.posteriors(documents, labels.filter("doc_id % 2 = 0")).join(
        labels.filter("doc_id % 2 = 1").select("doc_id", F.col("quality").alias("y")), "doc_id"
    ).select("y", "kept").toPandas()
    assert (got.kept == (got.y == 1)).mean() > 0.95 and got[got.y == 1].kept.mean() > 0.97


def test_posteriors_by_hand(spark):
    documents = spark.read.parquet(f"{DATA}/documents.parquet").select("doc_id", "text", "source", "lang")
    labels = spark.read.parquet(f"{DATA}/labels.parquet")
    got = site_quality.posteriors(documents, labels).toPandas()
    model = site_quality.fit(documents, labels, "doc_id", "text", "quality")
    odds = model.log_odds(site_quality.features(pa.array(got.text)))
    np.testing.assert_allclose(odds, got.quality_odds, atol=1e-9)
    p = 1 / (1 + np.exp(-odds))

    def strength(groups):
        n, good, sq = groups.size().to_numpy(float), groups.p.sum().to_numpy(), groups.p2.sum().to_numpy()
        mean, between = good.sum() / n.sum(), (good**2 / n).sum()
        within = (sq.sum() - between) / (n.sum() - len(n))
        tau = (between - n.sum() * mean**2 - (len(n) - 1) * within) / (n.sum() - (n**2).sum() / n.sum())
        return min(max(within / tau, 1.0), 1e6) if tau > 1e-12 else 1e6

    frame = got.assign(p=p, p2=p * p)
    host, path = frame.groupby("source"), frame.groupby(["source", "lang"])
    share = (p.sum() + 1) / (len(p) + 2)
    kh, kp = strength(host), strength(path)
    hs = (host.p.transform("sum") - p + share * kh) / (host.p.transform("size") - 1 + kh)
    ps = (path.p.transform("sum") - p + hs * kp) / (path.p.transform("size") - 1 + kp)
    z = odds - math.log(model.base / (1 - model.base)) + np.log(ps / (1 - ps))
    np.testing.assert_allclose(got.quality, 1 / (1 + np.exp(-z)), atol=1e-6)


def test_quality_of_odd_rows(spark, docs, none):
    labels = spark.createDataFrame([(1, 1), (4, 0), (8, 0), (None, 1), (9, 1), (2, None)], "doc_id long, quality int")
    got = site_quality.posteriors(docs, labels).toPandas()
    assert len(got) == len(ROWS) and not got[got.doc_id.isin([3, 4, 5])].kept.any() and got.quality.between(0, 1).all()
    assert site_quality.posteriors(none, labels).count() == 0
    assert site_quality.posteriors(docs, labels.limit(0)).count() == len(ROWS)


# -- op7


def test_verdicts_against_plain_rules(spark):
    hosts = ["example.org", "a.example.org", "org", "notorg", "x.com", "com", "EXAMPLE.org:80", "example.org."]
    paths = ["", "/", "/es", "/es/", "/en/1", "/en/12?x", "/en#/1", "/fr/a", "/de/", "/de//x?/fr/", "?/es/"]
    urls = [f"http://{h}{p}" for h in hosts for p in paths] + [None, "", "example.org/es/", "a://b://c/d", "x://\n/fr/"]
    df = spark.createDataFrame([(i, u) for i, u in enumerate(urls)], "page_id long, url string")
    for r in url_trie.filter_urls(df, catalog.URL_RULES, ["page_id", "url"]).collect():
        rest = r.url.partition("://")[2] if r.url and "://" in r.url else ""
        host = re.split("[/?#]", rest, maxsplit=1)[0]
        path = re.split("[?#]", rest[len(host):], maxsplit=1)[0]
        host = re.sub("[A-Z]", lambda m: m[0].lower(), host)
        fits = [(len(h.split(".")), len(p), h + p, v) for v, h, p in catalog.URL_RULES if (host == h or host.endswith("." + h)) and path.startswith(p)]
        _, _, rule, verdict = max(fits, default=(0, 0, None, "allow"))
        assert (r.host, r.path, r.rule, r.verdict) == (host, path, rule, verdict)
    assert url_trie.filter_urls(df.limit(0), catalog.URL_RULES, ["page_id"]).count() == 0
    assert url_trie.judge(url_trie.build([("allow", "a", "/x"), ("block", "a", "/x")]), "a", "/x") == ("a/x", "block")


# -- op8


def test_leaks_and_edited_copies_are_found(spark):
    rng = np.random.default_rng(5)
    word = lambda: "".join(rng.choice(list("abcdefghij"), 6))
    items = [" ".join(word() for _ in range(30)) for _ in range(8)]
    noise = lambda n: " ".join(word() for _ in range(n))
    edited = items[1].split()
    edited[7], edited[15] = "changed", "other words"
    del edited[22]
    data = [(0, noise(400)), (1, noise(50) + " " + items[0].upper() + "!! " + noise(50)), (2, " ".join(edited)),
            (3, noise(20) + " " + " ".join(items[2].split()[:8])), (4, None), (5, ""), (1, items[0])]
    docs = spark.createDataFrame(data, "doc_id long, text string").withColumn("item_id", F.lit("x"))
    bench = spark.createDataFrame(list(enumerate(items)) + [(90, None), (91, "of the"), (92, "")], "item_id long, text string")
    got = contamination.contaminated(docs, bench).collect()
    assert sorted((r.doc_id, r.item_id) for r in got) == [(1, 0), (1, 0), (2, 1)]
    long = next(r for r in got if r.doc_id == 1 and r.start_word == 50)
    assert long.score == pytest.approx(1.0) and long.passage == items[0].upper()
    assert sorted(r.doc_id for r in contamination.without_contaminated(docs, bench).collect()) == [0, 3, 4, 5]
    assert contamination.contaminated(docs, bench.limit(0)).count() == 0
    assert contamination.contaminated(docs.limit(0), bench).count() == 0


def test_hot_and_short_items_are_found(spark):
    item = " ".join(f"hot{i}" for i in range(30))
    edited = item.replace("hot7 ", "other ").replace("hot20 ", "")
    rows = [(i, item) for i in range(10)] + [(10, edited)] + [(11, "of hot0"), (12, "hot1 hot2")]
    few, bench = (spark.createDataFrame(x, f"{k} long, text string").coalesce(1) for x, k in ((rows, "doc_id"), ([(0, item)], "item_id")))
    assert {r.doc_id for r in contamination.contaminated(few, bench).collect()} == set(range(11))
    assert sorted(r.doc_id for r in contamination.without_contaminated(few, bench).collect()) == [11, 12]
    rng = np.random.default_rng(7)
    other = [" ".join(f"w{k}" for k in rng.zipf(1.3, 30) % 5000) for _ in range(300)]
    rows = [(i, f"{x} {item} {x}" if i % 3 == 0 else f"{x} {x}") for i, x in enumerate(other)] + [(300, "alone here"), (301, "Single!"), (302, "alone, not here")]
    rows += [(303, "to be or not be at all"), (304, "of the and in to is was that it for")]
    short = [(0, item), (1, "alone here"), (2, "single"), (3, "to be or not to be"), (4, "of the and in to is was that it for"), (5, "...")]
    many, bench = (spark.createDataFrame(x, f"{k} long, text string") for x, k in ((rows, "doc_id"), (short, "item_id")))
    got = {(r.doc_id, r.item_id) for r in contamination.contaminated(many, bench).collect()}
    assert got == {(i, 0) for i in range(0, 300, 3)} | {(300, 1), (301, 2), (303, 3), (304, 4)}


def test_a_run_of_very_many_items_still_leaves_them_seeds(spark):
    items = [(i, "please answer the following question " + " ".join(f"q{i}x{j}" for j in range(12))) for i in range(100)]
    bench = spark.createDataFrame(items, "item_id long, text string")
    docs = bench.select(F.col("item_id").alias("doc_id"), "text")
    assert sorted((r.doc_id, r.item_id) for r in contamination.contaminated(docs, bench).collect()) == [(i, i) for i in range(100)]


def test_copies_without_any_whole_run_are_found(spark):
    rng = np.random.default_rng(3)
    items = [[f"w{i}x{k}" for k in range(30)] for i in range(20)]
    third = lambda x: [f"new{k}" if k % 3 == 2 else w for k, w in enumerate(x)]
    spread = lambda x: [w for k, w in enumerate(x) for w in ([w, "filler"] if k % 2 else [w])]
    noise = lambda n: [f"n{k}" for k in rng.integers(0, 400, n)]
    docs = [(i, " ".join(noise(300) + (third if i % 2 else spread)(x) + noise(200))) for i, x in enumerate(items)]
    docs += [(100, " ".join(noise(800))), (101, " ".join(w for x in items for w in x[:6]))]
    given, bench = (spark.createDataFrame(x, f"{k} long, text string") for x, k in ((docs, "doc_id"), ([(i, " ".join(x)) for i, x in enumerate(items)], "item_id")))
    assert {(r.doc_id, r.item_id) for r in contamination.contaminated(given, bench).collect()} == {(i, i) for i in range(20)}


def test_windows_lose_no_alignment():
    """Every text and item whose alignment over the whole text reaches the least score."""
    rng = np.random.default_rng(11)
    vocabulary = rng.integers(1, 2**60, 60).astype(np.uint64)
    texts_ = [vocabulary[rng.zipf(1.4, n) % 60] for n in rng.integers(5, 200, 60)]
    items = [vocabulary[rng.zipf(1.4, n) % 60] for n in rng.integers(6, 25, 25)]
    names, counts = np.unique(np.concatenate(texts_), return_counts=True)
    word = lambda a: "".join(chr(97 + int(d)) for d in str(int(a)))
    docs = [" ".join(word(w) for w in t) for t in texts_]
    block_rows = [(i, " ".join(word(w) for w in t)) for i, t in enumerate(items)]
    hashed = contamination._item_words(docs)
    every = np.concatenate(hashed)

    def counted(_, known, __):
        return np.array([(every == k).sum() for k in known]), len(every)

    real, contamination.word_counts = contamination.word_counts, counted
    try:
        block = contamination._block(None, block_rows, "text", 0.5)
    finally:
        contamination.word_counts = real
    first = np.concatenate([[0], np.cumsum([len(h) for h in hashed])])
    got = {(i, n) for i, found in contamination._hits(block, every, first, 0.5).items() for n, *_ in found}
    want = {(i, n) for i, h in enumerate(hashed) for n, (x, w) in enumerate(zip(block.items, block.weights)) if contamination.aligned_span(x, w, h)[0] >= 0.5}
    assert want and got == want


def test_clashing_names_of_key_and_item(spark):
    docs = spark.createDataFrame([(1, "some words that are leaked here today")], "score long, text string")
    bench = spark.createDataFrame([(7, "some words that are leaked here today")], "score long, text string")
    got = contamination.contaminated(docs, bench, key="score", item="score")
    assert got.columns[:3] == ["score", "_score", "__score"] and [tuple(r)[:2] for r in got.collect()] == [(1, 7)]


def test_alignment_equals_the_textbook_recurrence():
    rng = np.random.default_rng(2)
    for _ in range(40):
        item, passage = rng.integers(0, 6, 9).astype(np.uint64), rng.integers(0, 6, 14).astype(np.uint64)
        weights = rng.random(9)
        table = np.zeros((10, 15))
        for i in range(1, 10):
            for j in range(1, 15):
                hit = weights[i - 1] if item[i - 1] == passage[j - 1] else -contamination.DIFFERENT
                table[i, j] = max(0, table[i - 1, j - 1] + hit, table[i - 1, j] - contamination.GAP, table[i, j - 1] - contamination.GAP)
        assert contamination.align(item, weights, passage)[0] == pytest.approx(table.max())


def test_leaks_in_the_given_tables_against_plain_search(spark):
    docs, bench = (spark.read.parquet(f"{DATA}/{t}.parquet") for t in ("documents", "benchmark"))
    got = {(r.doc_id, r.item_id) for r in contamination.contaminated(docs, bench).collect()}
    fold = lambda t: " ".join(re.findall(r"[^\s!-/:-@\[-`{-~]+", (t or "").lower()))
    want = {(d.doc_id, b.item_id) for d in docs.collect() for b in bench.collect() if f" {fold(b.text)} " in f" {fold(d.text)} "}
    assert want and got == want


# -- op1, many lists


@pytest.mark.parametrize("rank", [2, 3, 64])
def test_no_link_is_lost_between_lists(spark, monkeypatch, rank):
    monkeypatch.setattr(pq_links, "ROWS_PER_LIST", 8)
    monkeypatch.setattr(pq_links, "BLOCK", 32)
    rng = np.random.default_rng(rank)
    x = rng.normal(size=(900, rank)) @ rng.normal(size=(rank, 64))
    if rank == 64:
        x[500:] = x[:400] + 2.2 * rng.normal(size=(400, 64))
    df = spark.createDataFrame([(i, [float(a) for a in v], 1) for i, v in enumerate(x)], "vec_id long, embedding array<double>, label int")
    unit = x / np.linalg.norm(x, axis=1, keepdims=True)
    near = unit @ unit.T >= 0.93
    np.fill_diagonal(near, False)
    assert near.any() and {r.vec_id: r.n_links for r in pq_links.link_vectors(df).collect()} == dict(enumerate(near.sum(1).tolist()))


# -- op9


def test_archives_round_trip(spark, tmp_path):
    big = "x" * 3_000_000
    data = [(3, "http://a/", "same"), (1, "http://b/", "same"), (2, None, None), (4, "u\r\nv", ""), (5, "http://c/", "é\r\n\r\nWARC/1.0"), (6, "http://d/", big), (None, "n", "same"), (3, "http://a/", "same")]
    pages = spark.createDataFrame(data, "page_id long, url string, html string").withColumn("value", F.lit("x"))
    path = str(tmp_path / "warc")
    warc.write_archives(pages, path)
    got = warc.read_archives(spark, path).collect()
    assert len(got) == len(data) and all(r.digest_ok for r in got)
    for r in got:
        body = next((h or "").encode() for p, _, h in data if p == r.page_id)
        assert r.payload_bytes == len(body) and r.payload_digest == warc.sha1_base32(body)
        first = {"same": 1, "": 2}.get(body.decode(), r.page_id)
        assert (r.record_type, r.refers_to) == (("response", None) if first == r.page_id else ("revisit", first))
        assert r.payload == (body if r.record_type == "response" else None)
    import gzip
    import pathlib

    whole = b"".join(gzip.decompress(p.read_bytes()) for p in pathlib.Path(path).glob("part-*") if p.stat().st_size)
    assert whole.count(b"WARC-Type: ") == len(data)
    warc.write_archives(pages.limit(0), str(tmp_path / "none"))
    assert warc.read_archives(spark, str(tmp_path / "none")).count() == 0


def test_broken_archives_are_noticed():
    good = warc.member(warc.record(1, "u", b"body", None))
    assert [warc.parse(x)["payload"] for x in warc.members(good + warc.EMPTY_MEMBER + good)] == [b"body", b"body"]
    with pytest.raises(ValueError):
        list(warc.members(good[:-5]))
    raw = next(warc.members(good))
    assert not warc.parse(raw.replace(b"body", b"bodx"))["digest_ok"]
    with pytest.raises(ValueError):
        warc.parse(raw[:-6])


# -- op10


def _shingles(text):
    w = re.findall(r"[^\x20\x09-\x0D]+", re.sub("[A-Z]", lambda m: m[0].lower(), text or ""))
    return frozenset(tuple(w[i : i + 5]) for i in range(len(w) - 4)) if len(w) >= 5 else frozenset([tuple(w)] if w else [])


def _joined(data):
    sets = [_shingles(t) for _, t in data]
    up = list(range(len(data)))

    def root(i):
        while up[i] != i:
            i = up[i]
        return i

    for i in range(len(data)):
        for j in range(i):
            both = len(sets[i] & sets[j])
            if both and 100 * both >= 75 * (len(sets[i]) + len(sets[j]) - both):
                up[root(i)] = root(j)
    names = {}
    for i, (k, _) in enumerate(data):
        if k is not None:
            names[root(i)] = min(k, names.get(root(i), k))
    return sorted(((k, len(sets[i]), None if k is None else names[root(i)]) for i, (k, _) in enumerate(data)), key=repr)


def test_shingle_join_equals_brute_force(spark, monkeypatch):
    rng = np.random.default_rng(11)
    word = lambda: "".join(rng.choice(list("abcdef"), 4))
    passage = [word() for _ in range(60)]
    data = []
    for n in (3, 5, 7, 9, 14, 40, 90, 150, 220, 400, 700, 1500):
        base = [word() for _ in range(n)]
        for _ in range(9):
            copy = list(base)
            for _ in range(rng.integers(0, max(2, n // 18))):
                copy[rng.integers(n)] = word()
            extra = [word() for _ in range(rng.integers(0, max(1, n // 4)))]
            data.append((len(data), " ".join(copy + extra)))
    base = [word() for _ in range(150)]
    for _ in range(120):  # one large group of near copies, many of them just too far from each other
        copy = list(base)
        for _ in range(rng.integers(1, 9)):
            copy[rng.integers(150)] = word()
        data.append((len(data), " ".join(copy)))
    data += [(len(data) + i, " ".join(passage + [word() for _ in range(40)])) for i in range(60)]
    monkeypatch.setattr(shingle_join, "DENSE", 20)
    monkeypatch.setattr(shingle_join, "BLOCK_SETS", 16)
    got = rows(shingle_join.link_documents(spark.createDataFrame(data, "doc_id long, text string").repartition(5)))
    assert got == _joined(data)


def test_shingle_join_of_odd_rows(docs, none):
    assert rows(shingle_join.link_documents(docs)) == _joined([r[:2] for r in ROWS])
    assert shingle_join.link_documents(none).count() == 0


def test_limits_hold_for_all_sizes():
    for r in range(1, 400):
        for s in range(-(-3 * r // 4), r + 1):
            h, b = shingle_join.limits(r, int(shingle_join.band_of(np.array([s]))[0]))
            least = next(k for k in range(s + 1) if 100 * k >= 75 * (r + s - k))
            assert r + s - 2 * least <= h and s - least <= b


def test_a_hot_signature_lists_blocks_and_not_pairs():
    n = 4000
    ids, role = np.tile(np.arange(1, n + 1, dtype=np.uint64), 2), np.repeat([0, 1], n)
    blob = shingle_join._pack(
        np.full(2 * n, 9, np.uint64), ids, np.full(2 * n, 100, "u4"), ids, ids // np.uint64(250), role.astype("u1")
    )
    got = shingle_join._cross_pairs(pd.DataFrame({"blob": [blob]}))
    assert sum(len(v) for c in got for v in got[c] if isinstance(v, bytes)) < 100_000 and got.a.isna().all()
    pairs = pd.concat(shingle_join._block_pairs([got]))
    assert set(zip(pairs.p, pairs.q, strict=True)) == {(p, q) for p in range(17) for q in range(p, 17)} - {(16, 16)}


def test_a_large_group_just_below_the_limit(spark):
    body = " ".join(f"b{i}" for i in range(84))  # 80 shingles of 80 + 17: two texts have 80 / 114 = 0.70
    rows = [(i, body + " " + " ".join(f"t{i}x{j}" for j in range(17))) for i in range(600)]
    rows += [(1000 + i, rows[i][1] + " end") for i in range(0, 600, 7)]
    got = dict(shingle_join.link_documents(spark.createDataFrame(rows, "doc_id long, text string")).select("doc_id", "component_id").collect())
    assert got == {i: i % 1000 for i, _ in rows}
