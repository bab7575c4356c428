"""Registered queries of the training-text operators, with SQL where it can express them."""

from __future__ import annotations

from collections.abc import Callable

import public_tokenizers
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from hydrosignal.llm import (
    bpe,
    contamination,
    hard_negatives,
    licences,
    packing,
    pq_links,
    prefix_trie,
    shard_tree,
    shingle_join,
    site_quality,
    transcripts,
    url_trie,
    warc,
)
from hydrosignal.session import scratch_dir

Query = Callable[[SparkSession, str], DataFrame]
TOKENIZER = "word_bpe_49k.json"
PACKED_BY = "byte_bpe_50k.json"
SHARDS = 16
# The rules of the url query.
URL_RULES = [
    ("allow", "org", "/"),
    ("block", "example.org", "/es/"),
    ("block", "example.org", "/en/1"),
    ("allow", "com", "/fr/"),
    ("block", "com", "/de/"),
]


def _table(spark: SparkSession, folder: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{folder}/{name}.parquet")


def op1_embedding_links(spark: SparkSession, folder: str) -> DataFrame:
    return pq_links.link_vectors(_table(spark, folder, "embeddings"))


def op2_shard_documents(spark: SparkSession, folder: str) -> DataFrame:
    placed = shard_tree.shard_documents(_table(spark, folder, "documents"), SHARDS)
    return placed.select(
        "doc_id", "size", "text_crc32", F.lit("key").alias("law"), "shard", "slot", "grown_shard", "region", "rack"
    )


def op3_bpe_round_trip(spark: SparkSession, folder: str) -> DataFrame:
    docs = _table(spark, folder, "documents").select("doc_id", "text")
    coded = bpe.round_trip(docs, public_tokenizers.path(TOKENIZER))
    return coded.select(
        "doc_id",
        F.size("ids").cast("long").alias("n_tokens"),
        F.sha2(F.array_join(F.col("ids").cast("array<string>"), " ").cast("binary"), 256).alias("ids_sha256"),
        F.sha2(F.col("decoded").cast("binary"), 256).alias("decoded_sha256"),
    )


def op4_licence_scan(spark: SparkSession, folder: str) -> DataFrame:
    found = licences.scan_licences(_table(spark, folder, "documents"))
    return found.select(
        "doc_id",
        F.array_join(F.col("sentence_ids").cast("array<string>"), " ").alias("sentence_ids"),
        F.array_join("licences", " ").alias("licences"),
        "licence",
    )


def op5_chat_transcripts(spark: SparkSession, folder: str) -> DataFrame:
    turns = _table(spark, folder, "conversations")
    return transcripts.parse_transcripts(transcripts.plain_transcripts(turns), transcripts.train(turns))


def op6_site_quality(spark: SparkSession, folder: str) -> DataFrame:
    docs = _table(spark, folder, "documents").select("doc_id", "text", "source", "lang")
    scored = site_quality.posteriors(docs, _table(spark, folder, "labels"))
    return scored.select("doc_id", "source", "lang", "quality_odds", "host_share", "path_share", "quality", "kept")


def op7_url_verdicts(spark: SparkSession, folder: str) -> DataFrame:
    return url_trie.filter_urls(_table(spark, folder, "pages"), URL_RULES, ["page_id"])


def op8_contaminated_documents(spark: SparkSession, folder: str) -> DataFrame:
    return contamination.contaminated(_table(spark, folder, "documents"), _table(spark, folder, "benchmark"))


def op9_warc_round_trip(spark: SparkSession, folder: str) -> DataFrame:
    path = scratch_dir(spark, "warc")
    warc.write_archives(_table(spark, folder, "pages"), path)
    records = warc.read_archives(spark, path)
    return records.select("page_id", "payload_bytes", "payload_digest", "record_type", "refers_to", "digest_ok")


def op10_shingle_components(spark: SparkSession, folder: str) -> DataFrame:
    return shingle_join.link_documents(_table(spark, folder, "documents"))


def op11_prefix_trie(spark: SparkSession, folder: str) -> DataFrame:
    steps, convs = prefix_trie.rebuilt(prefix_trie.numbered(_table(spark, folder, "conversations")))
    trie = prefix_trie.build(steps, convs)
    digests = prefix_trie.end_digests(trie.ends)
    return trie.nodes.join(digests, prefix_trie.NODE, "left").select(
        "conv_id",
        "depth",
        "parent_conv_id",
        "n_convs",
        "n_children",
        "n_leaves",
        F.col("saved").alias("saved_tokens"),
        F.coalesce("digest", F.sha2(F.lit(b""), 256)).alias("ends_sha256"),
    )


def op12_hard_negatives(spark: SparkSession, folder: str) -> DataFrame:
    moved = F.when(F.col("vec_id") % 7 == 0, (F.col("label") + 1) % 10).otherwise(F.col("label"))
    vectors = _table(spark, folder, "embeddings").withColumn("label", moved)
    return hard_negatives.mine(vectors, F.col("vec_id") % 100 == 0)


def op13_packed_windows(spark: SparkSession, folder: str) -> DataFrame:
    pieces = packing.pack(_table(spark, folder, "documents"), public_tokenizers.path(PACKED_BY))
    return packing.crc32(pieces).select("doc_id", "start", "length", "ids_crc32", "doc_tokens", "sequence_id", "offset")


QUERIES: dict[str, Query] = {
    f.__name__: f
    for f in (
        op1_embedding_links,
        op2_shard_documents,
        op3_bpe_round_trip,
        op4_licence_scan,
        op5_chat_transcripts,
        op6_site_quality,
        op7_url_verdicts,
        op8_contaminated_documents,
        op9_warc_round_trip,
        op10_shingle_components,
        op11_prefix_trie,
        op12_hard_negatives,
        op13_packed_windows,
    )
}
