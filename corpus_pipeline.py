"""Cleaning of a corpus in four stages: quality, near duplicates, benchmark passages, token ids."""

from __future__ import annotations

import public_tokenizers
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from hydrosignal.llm import bpe, contamination, shingle_join, site_quality
from hydrosignal.llm.catalog import TOKENIZER
from hydrosignal.operators.attach import BROADCAST_ROWS, attach
from hydrosignal.session import materialize


def quality(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Keeps the documents whose posterior quality is at least one half, with all their columns.

    Columns named like the scores are kept under other names meanwhile.
    """
    labels = spark.read.parquet(f"{sf_dir}/labels.parquet")
    names = {c: f"_given_{c}" for c in site_quality.SCORES if c in docs.columns}
    scored = site_quality.posteriors(docs.withColumnsRenamed(names), labels).filter("kept").drop(*site_quality.SCORES)
    return scored.withColumnsRenamed({v: k for k, v in names.items()}).select(*docs.columns)


def near_duplicates(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Keeps one document of each group of linked documents: the smallest id, of equal ones the smallest set.

    A null id comes last. Of several rows with that id and set one stays; rows without words are
    linked with nothing and all stay. Ids that stand for one set are decided by id alone; texts
    under repeated or null ids are told apart by their sets. Lists of ids are broadcast up to a
    counted size and joined beyond it; texts move only in that case.
    """
    linked = shingle_join.linked_sets(docs).select("doc_id", "set_hash", "cluster")
    linked = materialize(linked.withColumn("place", F.struct(F.col("doc_id").isNull(), "doc_id", "set_hash")), "linked")
    first = linked.filter("cluster IS NOT NULL").groupBy("cluster").agg(F.min("place").alias("first"))
    decided = attach(linked, first, ["cluster"], salt_by=["doc_id"]).select(
        "doc_id", "set_hash", (F.col("cluster").isNull() | F.col("place").eqNullSafe(F.col("first"))).alias("stays")
    )
    decided = materialize(decided, "decided")

    def sized(ids: DataFrame) -> DataFrame:
        return F.broadcast(ids) if ids.limit(BROADCAST_ROWS + 1).count() <= BROADCAST_ROWS else ids

    known = decided.filter("doc_id IS NOT NULL")
    again = materialize(known.groupBy("doc_id").count().filter("count > 1").select("doc_id"), "again")
    goes = known.filter("NOT stays").select("doc_id").unionByName(again).distinct()
    alone = docs.filter("doc_id IS NOT NULL").join(sized(goes), "doc_id", "left_anti")
    repeated = docs.filter("doc_id IS NOT NULL").join(sized(again), "doc_id", "left_semi").unionByName(docs.filter("doc_id IS NULL"))
    told = shingle_join.with_set_hash(repeated, name="_set")
    choice = decided.filter("stays AND set_hash IS NOT NULL").select("doc_id", F.col("set_hash").alias("_set")).distinct()
    chosen = attach(told.filter("_set IS NOT NULL"), choice.withColumn("_stays", F.lit(True)), ["doc_id", "_set"], "inner", salt_by=["text"])
    once = chosen.dropDuplicates(["doc_id", "_set"])
    return alone.select(*docs.columns).unionByName(once.select(*docs.columns)).unionByName(told.filter("_set IS NULL").select(*docs.columns))


def decontaminate(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Keeps the documents in which no benchmark item is found."""
    return contamination.without_contaminated(docs, spark.read.parquet(f"{sf_dir}/benchmark.parquet"))


def tokenize(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Token ids of every document, and a digest of the text decoded from them."""
    coded = bpe.round_trip(docs.select("doc_id", "lang", "source", "text"), public_tokenizers.path(TOKENIZER))
    return coded.select(
        "doc_id",
        "lang",
        "source",
        F.size("ids").cast("long").alias("n_tokens"),
        "ids",
        F.sha2(F.col("decoded").cast("binary"), 256).alias("decoded_sha256"),
    )


STAGES = [
    ("quality", quality),
    ("near_duplicates", near_duplicates),
    ("decontaminate", decontaminate),
    ("tokenize", tokenize),
]
#: A trained classifier and the tokenizer are beyond SQL; tests/llm holds the brute-force version.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The stages one after another, each written and read again."""
    docs = spark.read.parquet(f"{sf_dir}/documents.parquet")
    for name, stage in STAGES[:-1]:
        docs = materialize(stage(spark, docs, sf_dir), name)
    return STAGES[-1][1](spark, docs, sf_dir)
