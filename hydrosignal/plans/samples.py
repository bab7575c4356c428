"""Labelled samples, model tables and feature matrices."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from hydrosignal.functions import clean, times
from hydrosignal.operators import joins, labels, models, reshape, summaries


def labelled_samples(
    frames: Sequence[DataFrame],
    location_model: DataFrame,
    model_characteristic: DataFrame,
    limits: DataFrame,
    parameters: Sequence[str] = ("ENT", "ECOLI"),
    tz: str = times.EASTERN,
) -> DataFrame:
    """Samples of all sources with model, standard and exceedance."""
    rows = reshape.stack(*frames).filter(F.col("CharacteristicID").isin(*parameters))
    placed = joins.chain_dimensions(
        rows, (location_model, ["LocationID"]), (model_characteristic, ["ModelLocation", "CharacteristicID"])
    )
    named = placed.select(
        F.concat_ws("_", "ModelLocation", "CharacteristicID").alias("model_id"),
        F.col("ModelLocation").alias("model_location"),
        F.col("LocationID").alias("location_id"),
        F.col("ProjectID").alias("project_id"),
        F.col("CharacteristicID").alias("parameter"),
        times.instant_of(F.col("Datetime"), tz).alias("timestamp"),
        F.col("ResultValue").alias("concentration"),
    )
    return labels.label_exceedance(named, limits).select(
        "model_id", "model_location", "location_id", "project_id", "parameter",
        "standard_value", "timestamp", "concentration", "exceedance",
    )


def model_table(
    samples: DataFrame,
    predictors: DataFrame,
    keys: Sequence[str] = (),
    predictor_time: str = "hour",
    time: str = "timestamp",
    season: dict | None = None,
    digits: int = 5,
    day_tz: str = "UTC",
) -> DataFrame:
    """Samples with the predictors of their hour, in season, with class label; flat by model_id."""
    at_hour = samples.withColumn("_hour", times.floor_hour(F.col(time)))
    p = predictors.withColumnRenamed(predictor_time, "_hour")
    if "date" in p.columns:
        p = p.drop("date")
    rows = at_hour.join(p, [*keys, "_hour"], "left")
    rows = joins.from_first(rows, "_hour", predictors, predictor_time)
    rows = rows.withColumn("date", times.local_date(F.col("_hour"), day_tz)).filter(
        clean.in_season(F.col("date"), **(season or {}))
    )
    rain = reshape.with_prefix(rows, "precip_")
    rows = reshape.transform_columns(rows, rain, lambda c: F.round(c, digits)) if rain else rows
    return rows.withColumnsRenamed({"_hour": f"{time}_hour"}).withColumn(
        "exceedance_class", clean.class_label(F.col("exceedance"))
    )


def model_summary(table: DataFrame) -> DataFrame:
    return summaries.share_by(table, ["model_id"], F.col("exceedance"))


def prepare(
    frames: dict[str, DataFrame],
    flows: DataFrame,
    location_types: DataFrame,
    categories: dict[str, Sequence[str]],
    flow_keys: Sequence[str],
    flow_time: str,
) -> tuple[dict[str, DataFrame], DataFrame, list[str]]:
    """Code names and dummies on every sample frame, flow change on the flow frame."""
    out, names = {}, set()
    for name, df in frames.items():
        df = joins.replace_codes(df, "LocationTypeID", location_types, "ID", "LocationTypeName")
        for col, levels in categories.items():
            before = set(df.columns)
            df = reshape.dummies(df, col, levels)
            names |= set(df.columns) - before
        out[name] = df
    w = Window.partitionBy(*flow_keys).orderBy(flow_time)
    flows = flows.withColumn("flow_deriv", F.col("flow") - F.lag("flow", 1).over(w))
    return out, flows, sorted(names)


def feature_matrix(
    results: DataFrame,
    pairs: Sequence[tuple[str, str]],
    flows_wide: DataFrame,
    rain: DataFrame,
    dummy_names: Sequence[str],
    time: str = "DateHour",
    rain_time: str = "datetime",
    rain_value: str = "prcp_in",
    edges: Sequence[int] = (0, 12, 24, 48, 72, 96, 120),
) -> tuple[DataFrame, list[str]]:
    """Unflagged rows of the wanted (characteristic, unit) pairs with flow and rain-bin features.

    Returns the frame and the feature names, result qualifiers left out.
    """
    rows = results.filter(
        clean.any_pair(F.col("CharacteristicID"), F.col("Units"), pairs) & F.col("FlagID").isNull()
    )
    flow_cols = [c for c in flows_wide.columns if c != time]
    rows = rows.join(flows_wide, time, "left")
    bins = joins.range_sums(rows, rain, [], time, rain_time, rain_value, edges)
    bin_cols = [c for c in bins.columns if c != time]
    features = [c for c in [*flow_cols, *dummy_names, *bin_cols] if not c.startswith("Qualifier")]
    return rows.join(bins, time, "left"), features


def train_test(
    rows: DataFrame,
    limits: dict[str, float],
    features: Sequence[str],
    id_cols: Sequence[str],
    value: str = "ResultValue",
    test_share: float = 0.2,
    seed: int = 101,
) -> DataFrame:
    """Label by the standards, impute feature means, split by label."""
    y = F.lit(False)
    for parameter, limit in limits.items():
        y = y | ((F.col("CharacteristicID") == parameter) & (F.col(value) > limit))
    labelled = rows.withColumn("label", F.coalesce(y, F.lit(False)).cast("int"))
    imputed = models.impute_mean(
        reshape.transform_columns(labelled, features, lambda c: c.cast("double")), features
    )
    return labels.stratified_split(imputed, ["label"], id_cols, 1 - test_share, seed)
