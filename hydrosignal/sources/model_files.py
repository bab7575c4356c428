"""Saving and loading fitted pipelines with their metrics."""

from __future__ import annotations

from pyspark.ml import PipelineModel
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F


def save_model(model: PipelineModel, path: str, info: DataFrame) -> None:
    """``info`` is the model's row of the final table."""
    model.save(f"{path}/pipeline")
    info.write.parquet(f"{path}/info")


def load_model(spark: SparkSession, path: str) -> tuple[PipelineModel, DataFrame]:
    return PipelineModel.load(f"{path}/pipeline"), spark.read.parquet(f"{path}/info")


def version_id(*parts) -> F.col:
    """A stable model version from what defines the model."""
    return F.md5(F.concat_ws("|", *[F.col(p) if isinstance(p, str) else p for p in parts]))
