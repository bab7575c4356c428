"""The scoring job: predictors of a period from their sources, models applied, guarded append."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from hydrosignal.operators import joins, models
from hydrosignal.operators.attach import attach
from hydrosignal.plans import flow as flow_plan
from hydrosignal.plans import predictors as predictor_plan
from hydrosignal.plans import weather
from hydrosignal.session import materialize
from hydrosignal.sources import keyed, model_files, payloads


def predictors_of_period(
    docs: DataFrame, flow: DataFrame, keys: Sequence[str], site: str, sites: Sequence[str], start: Column, end: Column, day_tz: str = "UTC"
) -> DataFrame:
    """Weather reports and daily flow of a period to one predictor row per series and hour."""
    daily = flow_plan.flow_series(flow, [site], start, end)
    wide = flow_plan.flow_predictors(daily, site, sites)
    hours = weather.metar_series(docs, keys, start, end)
    return predictor_plan.all_predictors(hours, keys, wide, day_tz=day_tz)


def model_versions(coefficients: DataFrame) -> DataFrame:
    """One version per model from its terms and cutoff (a list as long as the model)."""
    term = F.concat_ws(",", *[F.col(c).cast("string") for c in ("key", "mean", "sd", "coef", "cutoff")])
    terms = coefficients.groupBy("model_id").agg(F.array_join(F.sort_array(F.collect_list(term)), ";").alias("_terms"))
    return terms.select(F.col("model_id").alias("name"), model_files.version_id("model_id", "_terms").alias("version"))


def rows_to_score(
    predictors: DataFrame, keys: Sequence[str], time: str, listed: DataFrame | None = None, at: Column | None = None
) -> DataFrame:
    """Predictor rows at listed hours, or each series' latest row at or before one instant.

    Fails when there are none, so that a run without predictors does not look like a run whose
    results were all stored before.
    """
    if (listed is None) == (at is None):
        raise ValueError("give either listed hours or one instant")
    if listed is not None:
        rows = predictor_plan.target_rows(predictors, keys, time, listed)
    else:
        rows = joins.latest_at(predictors, keys, time, at)
    if rows.isEmpty():
        raise ValueError("no predictors available")
    return rows


def predictions(rows: DataFrame, coefficients: DataFrame, keys: Sequence[str], time: str) -> DataFrame:
    """Every row scored by every model: version, predictors as JSON, probability, exceedance.

    Probability and exceedance are null where a predictor is null; the row stays.
    """
    scored = models.score_many(rows, coefficients, [*keys, time])
    return attach(scored, model_versions(coefficients), ["name"], salt_by=[*keys, time]).select(
        *keys,
        "name",
        F.col(time).alias("timestamp"),
        "version",
        payloads.predictors_to_json(F.col("predictors")).alias("predictors"),
        "prob",
        "exceedance",
    )


def append_predictions(stored: DataFrame, new: DataFrame, path: str, keys: Sequence[str]) -> DataFrame:
    """Appends to ``path`` what is not in ``stored`` under (keys, name, timestamp).

    Returns the keys that were left out because they are stored already.
    """
    unique = [*keys, "name", "timestamp"]
    rows = materialize(new, "predictions")
    conflicts = materialize(keyed.key_conflicts(stored, rows, unique), "conflicts")
    keyed.new_rows(stored, rows, unique).write.mode("append").parquet(path)
    return conflicts
