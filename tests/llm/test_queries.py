"""Every query with SQL against DuckDB, and the pipeline against its parts."""

import pytest

pytest.importorskip("hydrosignal.llm.catalog")

import corpus_pipeline  # noqa: E402
import duckdb  # noqa: E402
import public_tokenizers  # noqa: E402
from tokenizers import Tokenizer  # noqa: E402

from hydrosignal.llm import catalog, oracle  # noqa: E402
from llm import test_operators as plain  # noqa: E402

DATA = "/root/testdata/sf0.001"


@pytest.fixture(scope="module")
def duck():
    con = duckdb.connect()
    for t in ("documents", "embeddings", "pages", "benchmark", "labels", "conversations"):
        con.execute(f"CREATE VIEW {t} AS SELECT * FROM '{DATA}/{t}.parquet'")
    return con


@pytest.mark.parametrize("name", sorted(oracle.SQL))
def test_query_equals_sql(spark, duck, name):
    got = catalog.QUERIES[name](spark, DATA)
    columns = sorted(got.columns)
    want = duck.execute(oracle.SQL[name])
    names = [d[0] for d in want.description]
    assert sorted(names) == columns
    place = [names.index(c) for c in columns]
    expected = sorted((tuple(r[i] for i in place) for r in want.fetchall()), key=repr)
    assert sorted((tuple(r) for r in got.select(*columns).collect()), key=repr) == expected


@pytest.mark.parametrize("name", sorted(set(catalog.QUERIES) - set(oracle.SQL)))
def test_query_gives_rows(spark, name):
    assert catalog.QUERIES[name](spark, DATA).count() > 0


def test_pipeline_stages_against_plain_versions(spark):
    docs = spark.read.parquet(f"{DATA}/documents.parquet")
    assert [n for n, _ in corpus_pipeline.STAGES] == ["quality", "near_duplicates", "decontaminate", "tokenize"]
    good = corpus_pipeline.quality(spark, docs, DATA)
    labels = {r.doc_id: r.quality for r in spark.read.parquet(f"{DATA}/labels.parquet").collect()}
    kept = {r.doc_id for r in good.collect()}
    right = [(d in kept) == bool(y) for d, y in labels.items()]
    assert good.columns == docs.columns and sum(right) > 0.9 * len(right)
    again = docs.unionByName(docs.filter("doc_id < 3"))
    single = corpus_pipeline.near_duplicates(spark, again, DATA)
    data = [(r.doc_id, r.text) for r in docs.collect()]
    least = {k for k, _, c in plain._joined(data) if k == c}
    assert single.columns == docs.columns and sorted(r.doc_id for r in single.collect()) == sorted(least)
    clean = corpus_pipeline.decontaminate(spark, docs, DATA)
    leaks = {r.doc_id for r in catalog.op8_contaminated_documents(spark, DATA).collect()}
    assert {r.doc_id for r in clean.collect()} == {k for k, _ in data} - leaks


def test_near_duplicates_under_repeated_and_null_ids(spark):
    a, b, c = ("one two three four five six seven", "red green blue white black brown pink", "north south east west up down left")
    rows = [(1, a), (2, a), (2, b), (3, c), (3, b + " more"), (None, c), (None, "own text of a row without an id"), (None, "own text of a row without an id"), (4, ""), (4, ""), (5, None)]
    docs = spark.createDataFrame([(k, t, "x") for k, t in rows], "doc_id long, text string, _set string")
    docs = docs.withColumnRenamed("_set", "kept")
    got = sorted(((r.doc_id, r.text) for r in corpus_pipeline.near_duplicates(spark, docs, DATA).collect()), key=repr)
    want = [(1, a), (2, b), (3, c), (None, "own text of a row without an id"), (4, ""), (4, ""), (5, None)]
    assert got == sorted(want, key=repr) or got == sorted([*want, (3, b + " more")], key=repr)
    assert corpus_pipeline.near_duplicates(spark, docs.limit(0), DATA).count() == 0


def test_pipeline_result(spark):
    library = Tokenizer.from_file(public_tokenizers.path(catalog.TOKENIZER))
    texts = {r.doc_id: r.text for r in spark.read.parquet(f"{DATA}/documents.parquet").collect()}
    got = corpus_pipeline.run(spark, DATA).collect()
    assert 0 < len(got) < len(texts)
    for r in got:
        assert r.ids == library.encode(texts[r.doc_id], add_special_tokens=False).ids
