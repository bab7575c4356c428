"""Running a stream to the end of its available input."""

from __future__ import annotations

from collections.abc import Callable, Sequence

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from hydrosignal.session import materialize, scratch_dir
from hydrosignal.streaming.hourly import upsert_sink


def read_table_stream(spark: SparkSession, path: str, columns: list[str] | None = None, files: int = 64) -> DataFrame:
    """A parquet table as a stream; the schema comes from the table itself.

    The file source takes a plain path for a folder; written as a glob, the path may also
    be a single file.
    """
    schema = spark.read.parquet(path).schema
    source = f"{path[:-1]}[{path[-1]}]" if path.endswith(".parquet") else path
    df = spark.readStream.schema(schema).option("maxFilesPerTrigger", files).parquet(source)
    return df.select(*columns) if columns else df


def run_append(df: DataFrame, name: str) -> DataFrame:
    """Process everything available into a parquet folder and return that table."""
    base = scratch_dir(df.sparkSession, name)
    writer = (
        df.writeStream.format("parquet")
        .outputMode("append")
        .option("path", f"{base}/data")
        .option("checkpointLocation", f"{base}/checkpoint")
        .trigger(availableNow=True)
    )
    writer.start().awaitTermination()
    return df.sparkSession.read.schema(df.schema).parquet(f"{base}/data")


def run_batches(df: DataFrame, name: str, sink: Callable[[DataFrame, int], None], mode: str = "update") -> None:
    """Process everything available, one call of ``sink`` per micro-batch."""
    base = scratch_dir(df.sparkSession, name)
    writer = (
        df.writeStream.outputMode(mode)
        .option("checkpointLocation", f"{base}/checkpoint")
        .trigger(availableNow=True)
        .foreachBatch(sink)
    )
    writer.start().awaitTermination()


def run_updates(df: DataFrame, name: str, keys: Sequence[str], time: str) -> DataFrame:
    """Process everything available in update mode and return the table of latest results.

    Results that the watermark has not closed yet are in the table too, and later input
    replaces them.
    """
    path = scratch_dir(df.sparkSession, f"{name}-table")
    dated = df.withColumn("_day", F.to_date(time))
    run_batches(dated, name, upsert_sink(path, dated.schema, [*keys, time], [F.col(time)], "_day"), "update")
    return df.sparkSession.read.schema(dated.schema).parquet(path).drop("_day")


def run_newest(df: DataFrame, name: str, keys: Sequence[str], time: str, version: str) -> DataFrame:
    """Process everything available in update mode and return the greatest version of each key.

    A micro-batch is written once before it is merged, so that its state is not run through again.
    """
    path = scratch_dir(df.sparkSession, f"{name}-table")
    dated = df.withColumn("_day", F.to_date(time))
    sink = upsert_sink(path, dated.schema, keys, [F.col(version).desc()], "_day", newer_only=True)
    run_batches(dated, name, lambda batch, i: sink(materialize(batch, f"{name}-batch"), i), "update")
    return df.sparkSession.read.schema(dated.schema).parquet(path).drop("_day")
