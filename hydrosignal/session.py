"""Session helpers shared by the library, the query catalog, tests and bench."""

from __future__ import annotations

import uuid

from pyspark.sql import DataFrame, SparkSession


def build_session(master: str | None = None, app: str = "hydrosignal", **conf) -> SparkSession:
    """A session with the settings the operators assume (UTC, ANSI, AQE with skew handling)."""
    builder = (
        SparkSession.builder.appName(app)
        .config("spark.sql.session.timeZone", "UTC")
        .config("spark.sql.ansi.enabled", "true")
        .config("spark.sql.adaptive.enabled", "true")
        .config("spark.sql.adaptive.coalescePartitions.enabled", "true")
        .config("spark.sql.adaptive.skewJoin.enabled", "true")
        # wide projections above the JIT's method limit run faster split than fused
        .config("spark.sql.codegen.hugeMethodLimit", "8000")
    )
    if master:
        builder = builder.master(master)
    for key, value in conf.items():
        builder = builder.config(key.replace("__", "."), value)
    return builder.getOrCreate()


#: Scratch folders made by this process, by session.
_made: dict[str, list[str]] = {}


def scratch_dir(spark: SparkSession, name: str) -> str:
    """A fresh folder for intermediate tables below ``spark.checkpoint.dir``.

    That must be a folder which all executors reach, so on a cluster it has to be set. A local
    session without it uses a folder below its warehouse.
    """
    base = spark.conf.get("spark.checkpoint.dir", None) or spark.sparkContext.getCheckpointDir()
    if not base:
        if not spark.sparkContext.master.startswith("local"):
            raise ValueError("set spark.checkpoint.dir to a folder that all executors can reach")
        base = f"{spark.conf.get('spark.sql.warehouse.dir').rstrip('/')}/_scratch"
    path = f"{base.rstrip('/')}/hydrosignal/{name}-{uuid.uuid4().hex}"
    _made.setdefault(spark.sparkContext.applicationId, []).append(path)
    return path


def clear_scratch(spark: SparkSession) -> None:
    """Remove the scratch folders that this process has made; results that were not saved elsewhere are lost."""
    for path in _made.pop(spark.sparkContext.applicationId, []):
        discard(spark, path)


def materialize(df: DataFrame, name: str) -> DataFrame:
    """Cut lineage by writing ``df`` to the shared scratch folder and reading it back."""
    return materialize_at(df, scratch_dir(df.sparkSession, name))


def materialize_at(df: DataFrame, path: str) -> DataFrame:
    df.write.parquet(path)
    return df.sparkSession.read.schema(df.schema).parquet(path)


def discard(spark: SparkSession, path: str) -> None:
    """Remove a scratch folder that no later read needs, in whatever store it lies."""
    folder = spark._jvm.org.apache.hadoop.fs.Path(path)
    folder.getFileSystem(spark._jsc.hadoopConfiguration()).delete(folder, True)


def stored_bytes(spark: SparkSession, path: str) -> int:
    """Size of the files of a folder."""
    folder = spark._jvm.org.apache.hadoop.fs.Path(path)
    return folder.getFileSystem(spark._jsc.hadoopConfiguration()).getContentSummary(folder).getLength()
