"""Tabular classifiers on MLlib: fits, tuning, leaderboards, scoring, effects.

Fits read distributed frames; only coefficients and metrics (a few numbers per model) come
back to the driver.
"""

from __future__ import annotations

import json
import math
from collections.abc import Sequence
from dataclasses import dataclass, field

import numpy as np
from pyspark.ml import Pipeline, PipelineModel
from pyspark.ml.classification import GBTClassifier, LogisticRegression, RandomForestClassifier
from pyspark.ml.feature import Imputer, StandardScaler, VectorAssembler
from pyspark.ml.functions import vector_to_array
from pyspark.ml.regression import GeneralizedLinearRegression
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from hydrosignal.functions.clean import sigmoid
from hydrosignal.operators import labels, metrics, newton
from hydrosignal.operators.attach import attach
from hydrosignal.operators.ordered import first_per_key
from hydrosignal.session import materialize

# The elastic-net grid, default cutoff and acceptance limits.
ALPHAS = (0.0, 0.2, 0.4, 0.6, 0.8, 1.0)
LAMBDAS = (0.0001, 0.001, 0.01, 0.1)
CUTOFF = 0.2
ACCEPT = {"accuracy": 0.80, "sensitivity": 0.5, "specificity": 0.85}
MAX_COEFFICIENTS = 100_000
NUMERIC = ("tinyint", "smallint", "int", "bigint", "float", "double")


@dataclass
class Glm:
    """A fitted binomial model with its summary figures."""

    model: PipelineModel
    predictors: list[str]
    figures: dict[str, float]
    coefficients: list[tuple[str, float, float]] = field(default_factory=list)

    def score(self, df: DataFrame, name: str = "prob") -> DataFrame:
        return score_with(self.model, df, name)


def _scaled(predictors: Sequence[str]) -> list:
    return [
        VectorAssembler(inputCols=list(predictors), outputCol="_raw", handleInvalid="skip"),
        StandardScaler(inputCol="_raw", outputCol="_features", withMean=True, withStd=True),
    ]


def impute_mean(df: DataFrame, cols: Sequence[str]) -> DataFrame:
    """Nulls become the column mean."""
    return Imputer(strategy="mean", inputCols=list(cols), outputCols=list(cols)).fit(df).transform(df)


def standardize(train: DataFrame, df: DataFrame, cols: Sequence[str], suffix: str = "_z") -> DataFrame:
    """Centre and scale by mean and sample standard deviation of the complete training rows.

    Every row of ``df`` stays; a null stays null. A constant column becomes 0.
    """
    whole = train.dropna(subset=list(cols))
    row = whole.agg(
        *[F.avg(c).alias(f"m{i}") for i, c in enumerate(cols)], *[F.stddev_samp(c).alias(f"s{i}") for i, c in enumerate(cols)]
    ).first()
    new = {}
    for i, c in enumerate(cols):
        mean, sd = row[f"m{i}"], row[f"s{i}"]
        x = F.col(c).cast("double") - F.lit(mean).cast("double")
        new[f"{c}{suffix}"] = x / F.lit(float(sd)) if sd else F.when(x.isNotNull(), F.lit(0.0))
    return df.withColumns(new)


def fit_glm(
    df: DataFrame, predictors: Sequence[str], label: str = "label", weight: str | None = None
) -> Glm:
    """Binomial fit on centred and scaled predictors, with AIC, deviances and pseudo-R2."""
    glr = GeneralizedLinearRegression(
        family="binomial", link="logit", featuresCol="_features", labelCol=label, predictionCol="_p", tol=1e-12, maxIter=100
    )
    if weight:
        glr = glr.setWeightCol(weight)
    model = Pipeline(stages=[*_scaled(predictors), glr]).fit(df)
    fitted = model.stages[-1]
    s = fitted.summary
    figures = {
        "aic": s.aic,
        "deviance": s.deviance,
        "null_deviance": s.nullDeviance,
        "r2": 1 - s.deviance / s.nullDeviance,
        "n_predictors": float(len(predictors)),
    }
    values = [*fitted.coefficients, fitted.intercept]
    errors = list(s.coefficientStandardErrors)
    names = [*predictors, "(Intercept)"]
    return Glm(model, list(predictors), figures, [(n, float(v), float(e)) for n, v, e in zip(names, values, errors)])


def coefficient_table(spark: SparkSession, model_id: str, glm: Glm) -> DataFrame:
    rows = [(model_id, n, v, e, v / e if e else None) for n, v, e in glm.coefficients]
    return spark.createDataFrame(rows, "model_id string, term string, estimate double, std_error double, z_value double")


def importance(spark: SparkSession, model_id: str, glm: Glm) -> DataFrame:
    """Absolute z value per predictor."""
    table = coefficient_table(spark, model_id, glm).filter("term <> '(Intercept)'")
    return table.select("model_id", "term", F.abs("z_value").alias("importance"))


def score_with(model: PipelineModel, df: DataFrame, name: str = "prob") -> DataFrame:
    """Probability of the positive class from any fitted pipeline.

    MLlib drops rows with a null predictor; they come back with a null probability.
    """
    keep = model.stages[0].copy()
    keep.setHandleInvalid("keep")
    inputs = keep.getInputCols()
    stages = PipelineModel([keep, *model.stages[1:]])
    out = stages.transform(df)
    if "probability" in out.columns:
        p = vector_to_array("probability")[1]
    else:
        p = F.col("_p")
    complete = F.lit(True)
    for c in inputs:
        complete = complete & F.col(c).isNotNull()
    return out.select(*df.columns, F.when(complete, F.nanvl(p, F.lit(None).cast("double"))).alias(name))


@dataclass
class Tuned:
    """A tuned elastic net: mean AUC of every tried setting and the best one fitted on all rows."""

    settings: list[tuple[float, float, float | None]]
    best: tuple[float, float]
    bestModel: PipelineModel


def _fold_rows(df: DataFrame, fold: str, folds: int) -> tuple[DataFrame, list[str]]:
    """Adds a true/false column per fold: the rows a model that leaves the fold out is fitted on."""
    names = [f"_not_{fold}_{k}" for k in range(folds)]
    return df.withColumns({n: F.col(fold) != k for k, n in enumerate(names)}), names


def elastic_net(
    df: DataFrame,
    predictors: Sequence[str],
    label: str = "label",
    fold: str = "fold",
    folds: int = 10,
    alphas: Sequence[float] = ALPHAS,
    lambdas: Sequence[float] = LAMBDAS,
    weight: str | None = None,
) -> Tuned:
    """Elastic net tuned by the mean AUC of the held-out folds over the (alpha, lambda) grid.

    All settings of all folds are fitted together, one pass over the rows per step. Of equal AUCs
    the stronger penalty wins, then the larger alpha. A setting without a fit has a null AUC.
    """
    work, rows = _fold_rows(df, fold, folds)
    grid = [(float(a), float(x)) for a in alphas for x in lambdas]
    specs = [newton.Spec((i, k), tuple(predictors), r, x, a) for i, (a, x) in enumerate(grid) for k, r in enumerate(rows)]
    fits = newton.fit_many(work, specs, label, weight)
    by = {f.spec.name: f for f in fits if f.converged}

    # coefficients on the given predictors by fold, setting after setting; no number where there is no fit
    width, table = len(predictors) + 1, []
    for k in range(folds):
        line = []
        for i in range(len(grid)):
            f = by.get((i, k))
            raw = f.beta[:-1] / f.scales if f else np.full(width - 1, np.nan)
            line += [*raw.tolist(), float(f.beta[-1] - (raw * f.means).sum()) if f else math.nan]
        table.append(line)
    own = F.get(F.from_json(F.lit(json.dumps(table)), "array<array<double>>"), F.col(fold))

    def prob(i: Column) -> Column:
        odds = F.get(own, i * width + width - 1)
        for j, c in enumerate(predictors):
            odds = odds + F.get(own, i * width + j) * F.col(c).cast("double")
        return F.nanvl(sigmoid(odds), F.lit(None).cast("double"))

    probs = F.transform(F.sequence(F.lit(0), F.lit(len(grid) - 1)), prob).alias("_p")
    rows_ = df.select(F.col(fold).alias("_f"), F.col(label).alias("_y"), probs)
    scored = rows_.select(F.col("_f").alias("fold"), F.col("_y").alias("label"), F.posexplode("_p").alias("setting", "prob"))
    means = metrics.auc(scored, ["setting", "fold"]).groupBy("setting").agg(F.avg("auc").alias("auc")).collect()
    found = {r["setting"]: r["auc"] for r in means}
    settings = [(a, x, found.get(i)) for i, (a, x) in enumerate(grid)]
    tried = [t for t in settings if t[2] is not None]
    if not tried:
        raise ValueError("no setting could be fitted")
    alpha, strength, _ = max(tried, key=lambda t: (round(t[2], 12), t[1], t[0]))
    lr = LogisticRegression(
        featuresCol="_features", labelCol=label, standardization=False, elasticNetParam=alpha, regParam=strength, tol=1e-9, maxIter=500
    )
    if weight:
        lr = lr.setWeightCol(weight)
    return Tuned(settings, (alpha, strength), Pipeline(stages=[*_scaled(predictors), lr]).fit(df))


def ridge_path(df, predictors, label="label", fold="fold", folds=7, n_values=10, weight=None) -> Tuned:
    """Ten penalties spaced evenly on a log scale from strong to weak, chosen by cross-validation."""
    n = df.count()
    strengths = [10 ** (-4 + 8 * i / (n_values - 1)) for i in range(n_values)]
    return elastic_net(df, predictors, label, fold, folds, (0.0,), [1.0 / (c * n) for c in strengths], weight)


def tuning_table(spark: SparkSession, tuned: Tuned) -> DataFrame:
    """One row per tried setting with its mean AUC."""
    return spark.createDataFrame(tuned.settings, "alpha double, lambda double, auc double")


def random_forest(df, predictors, label="label", trees=100, depth=8, seed=1) -> PipelineModel:
    rf = RandomForestClassifier(featuresCol="_features", labelCol=label, numTrees=trees, maxDepth=depth, seed=seed)
    return Pipeline(stages=[*_scaled(predictors), rf]).fit(df)


def boosted_trees(df, predictors, label="label", rounds=50, depth=3, seed=1) -> PipelineModel:
    gbt = GBTClassifier(featuresCol="_features", labelCol=label, maxIter=rounds, maxDepth=depth, seed=seed)
    return Pipeline(stages=[*_scaled(predictors), gbt]).fit(df)


def tree_importance(spark: SparkSession, model_id: str, model: PipelineModel) -> DataFrame:
    names = model.stages[0].getInputCols()
    values = model.stages[-1].featureImportances.toArray()
    return spark.createDataFrame(
        [(model_id, n, float(v)) for n, v in zip(names, values)], "model_id string, term string, importance double"
    )


def forward_selection(df: DataFrame, candidates: Sequence[str], label: str = "label") -> tuple[Glm | None, list[tuple]]:
    """Adds the predictor that lowers AIC most until none does; returns the model and the path.

    All candidates of a round are fitted together. A candidate without a finite fit is passed over;
    of equal AICs the one named first is taken.
    """
    base = df.filter(F.col(label).isNotNull()).agg(F.count(F.lit(1)).alias("n"), F.sum(F.col(label)).alias("k")).first()
    n, k = float(base["n"]), float(base["k"] or 0)
    null_dev = -2 * sum(c * _ln(c / n) for c in (k, n - k)) if n else 0.0
    best_aic, chosen, path = null_dev + 2, [], [(0, "(none)", null_dev + 2)]
    left = list(candidates)
    while left:
        fits = newton.fit_many(df, [newton.Spec((c,), (*chosen, c)) for c in left], label)
        done = [f for f in fits if f.converged]
        fit = min(done, key=lambda f: round(f.aic, 9), default=None)
        if fit is None or fit.aic >= best_aic:
            break
        name, best_aic = fit.spec.name[0], fit.aic
        chosen.append(name)
        left.remove(name)
        path.append((len(chosen), name, best_aic))
    return fit_glm(df, chosen, label) if chosen else None, path


def _ln(x: float) -> float:
    return math.log(x) if x > 0 else 0.0


def repeated_folds(df: DataFrame, strata: Sequence[str], id_cols: Sequence[str], folds=10, repeats=3, seed=1) -> DataFrame:
    """Adds one stratified fold column per repeat: ``fold_1`` .. ``fold_<repeats>``."""
    for r in range(1, repeats + 1):
        df = labels.stratified_folds(df, strata, id_cols, folds, seed + r, f"fold_{r}")
    return df


def held_out_scores(
    df: DataFrame, predictors: Sequence[str], fold_columns: Sequence[str], folds: int, label: str = "label", name: str = "resample"
) -> DataFrame:
    """Every row scored, for each fold column, by the model that did not see its fold.

    One row per row and fold column, ``name`` tells the resample (Fold01.Rep1, ...). The models of
    all folds and repeats are fitted together. Rows that cannot be scored have a null ``prob``.
    """
    work, specs = df, []
    for r, column in enumerate(fold_columns):
        work, rows = _fold_rows(work, column, folds)
        specs += [newton.Spec((r, k), tuple(predictors), row) for k, row in enumerate(rows)]
    by = {f.spec.name: f for f in newton.fit_many(work, specs, label) if f.converged}
    entries = []
    for r, column in enumerate(fold_columns):
        odds = F.lit(None).cast("double")
        for k in range(folds):
            if (r, k) in by:
                odds = F.when(F.col(column) == k, by[r, k].log_odds()).otherwise(odds)
        entries.append(F.struct(F.format_string(f"Fold%02d.Rep{r + 1}", F.col(column) + 1).alias(name), sigmoid(odds).alias("prob")))
    return df.select("*", F.inline(F.array(*entries)))


def resample_metrics(scored: DataFrame, fold: str, label: str = "label", cutoff: float = CUTOFF) -> DataFrame:
    """ROC, sensitivity and specificity of every resample."""
    four = metrics.cells(scored, [fold], F.lit(cutoff), label=label)
    r = metrics.rates(*[F.col(c) for c in ("tp", "fp", "fn", "tn")])
    rows = four.select(fold, r["sensitivity"].alias("sens"), r["specificity"].alias("spec"))
    return metrics.auc(scored, [fold], label=label, name="roc").select(fold, "roc").join(rows, fold)


def leaderboard(scored: DataFrame, keys: Sequence[str], subset: str = "subset", cutoff: float = CUTOFF) -> DataFrame:
    """Train/test AUC, mean and half-difference, and the rates at the cutoff, per model.

    ``scored`` holds all candidates' rows with their keys (predictor set, learner).
    """
    all_keys = [*keys, subset]
    area = metrics.auc(scored, all_keys)
    wide = area.groupBy(*keys).agg(
        F.max(F.when(F.col(subset) == "train", F.col("auc"))).alias("auc_train"),
        F.max(F.when(F.col(subset) == "test", F.col("auc"))).alias("auc_test"),
    )
    wide = wide.withColumns(
        {"auc_diff": (F.col("auc_test") - F.col("auc_train")) / 2, "auc_mean": (F.col("auc_test") + F.col("auc_train")) / 2}
    )
    cf = metrics.confusion(scored, all_keys, F.lit(cutoff))
    names = ("accuracy", "kappa", "sensitivity", "specificity", "ppv", "npv", "accuracy_null", "accuracy_pvalue")
    wide_cf = cf.groupBy(*keys).agg(
        *[
            F.max(F.when(F.col(subset) == s, F.col(n))).alias(f"{n}_{s}")
            for n in names
            for s in ("train", "test")
        ]
    )
    return wide.join(wide_cf, list(keys))


def accepted(table: DataFrame, suffix: str = "", limits: dict[str, float] | None = None) -> DataFrame:
    """Adds the acceptance verdict."""
    ok = F.lit(True)
    for name, least in (limits or ACCEPT).items():
        ok = ok & F.coalesce(F.col(name + suffix) > least, F.lit(False))
    return table.withColumn("accepted", ok)


def final_table(
    samples: DataFrame, scored: DataFrame, figures: DataFrame, keys: Sequence[str] = ("model_id",), cutoff: float = CUTOFF
) -> DataFrame:
    """Final model table: sample count, exceedance share, fit figures, train/test metrics, verdict.

    Every model of ``samples`` has a row; what is missing in ``figures`` or ``scored`` is null and
    not accepted.
    """
    base = samples.groupBy(*keys).agg(
        F.count(F.lit(1)).alias("n_sample"), F.avg(F.col("label").cast("double")).alias("freq_exceedance")
    )
    board = leaderboard(scored, keys, cutoff=cutoff)
    joined = base.join(figures, list(keys), "left").join(board, list(keys), "left")
    return accepted(joined.withColumn("cutoff", F.lit(cutoff)), "_test")


def collect_coefficients(coefficients: DataFrame) -> dict | None:
    """Coefficient rows (model_id, key, mean, sd, coef, cutoff) as plain numbers, None above the size for literals."""
    rows = coefficients.limit(MAX_COEFFICIENTS + 1).collect()
    if len(rows) > MAX_COEFFICIENTS:
        return None
    models: dict = {}
    for r in rows:
        entry = models.setdefault(r["model_id"], {"cutoff": r["cutoff"], "terms": []})
        entry["terms"].append((r["key"], r["mean"], r["sd"], r["coef"]))
    for m in models.values():
        m["terms"].sort(key=lambda t: t[0])
    return models


def score_many(df: DataFrame, coefficients: DataFrame, keep: Sequence[str]) -> DataFrame:
    """Every row scored by every model without a shuffle.

    Coefficients become literals of one expression per model. A null predictor gives a
    null probability and a null exceedance. The used predictors travel along as a map.
    Beyond ``MAX_COEFFICIENTS`` the same rows come from ``score_long``; there ``keep`` has to
    identify a row.
    """
    found = collect_coefficients(coefficients)
    if found is None:
        numbers = [c for c, t in df.dtypes if c not in keep and (t in NUMERIC or t.startswith("decimal"))]
        pairs = [x for c in numbers for x in (F.lit(c), F.col(c).cast("double"))]
        long = df.select(*keep, F.explode(F.create_map(*pairs)).alias("key", "value"))
        return score_long(long, coefficients, keep)
    entries = []
    for model_id, m in sorted(found.items()):
        odds = F.lit(0.0)
        used = []
        for key, mean, sd, coef in m["terms"]:
            if key == "(Intercept)":
                odds = odds + F.lit(float(coef))
            else:
                x = F.col(key).cast("double")
                odds = odds + F.lit(float(coef)) * ((x - F.lit(float(mean))) / F.lit(float(sd)))
                used += [F.lit(key), x]
        prob = sigmoid(odds)
        entries.append(
            F.struct(
                F.lit(model_id).alias("name"),
                prob.alias("prob"),
                (prob > F.lit(float(m["cutoff"]))).alias("exceedance"),
                (F.create_map(*used) if used else F.create_map().cast("map<string,double>")).alias("predictors"),
            )
        )
    return df.select(*keep, F.inline(F.array(*entries)))


def score_long(df: DataFrame, coefficients: DataFrame, ids: Sequence[str]) -> DataFrame:
    """Scoring as a join, for coefficient tables too large for literals.

    ``df`` is long (ids, key, value). Any missing or null predictor gives a null score; a
    model is scored for rows that have at least one of its predictors. The terms of all
    models on one predictor are one row, attached by size, so that values are not shuffled
    by the name of their predictor.
    """
    terms = coefficients.filter("key <> '(Intercept)'")
    totals = coefficients.groupBy("model_id").agg(
        F.count_if(F.col("key") != "(Intercept)").alias("_n"),
        F.sum(F.when(F.col("key") == "(Intercept)", F.col("coef")).otherwise(0.0)).alias("_b0"),
        F.max("cutoff").alias("cutoff"),
    )
    by_key = terms.groupBy("key").agg(F.collect_list(F.struct("model_id", "mean", "sd", "coef")).alias("_terms"))
    each = attach(df.select(*ids, "key", "value"), by_key, ["key"], "inner").select(*ids, "key", "value", F.inline("_terms"))
    part = F.col("coef") * ((F.col("value") - F.col("mean")) / F.col("sd"))
    sums = each.groupBy(*ids, "model_id").agg(
        F.sum(part).alias("_sum"),
        F.count("value").alias("_got"),
        F.map_from_entries(F.collect_list(F.struct("key", "value"))).alias("predictors"),
    )
    odds = F.when(F.col("_got") == F.col("_n"), F.col("_sum") + F.col("_b0"))
    return attach(sums, totals, ["model_id"], salt_by=list(ids)).withColumn("prob", sigmoid(odds)).select(
        *ids, F.col("model_id").alias("name"), "prob", (F.col("prob") > F.col("cutoff")).alias("exceedance"), "predictors"
    )


def range_audit(values: DataFrame, ranges: DataFrame, keys: Sequence[str] = ("model_id", "key")) -> DataFrame:
    """Long predictor values with the training range and whether they leave it; null without a range."""
    return attach(values, ranges, list(keys)).withColumns(
        {"below": F.col("value") < F.col("min"), "above": F.col("value") > F.col("max")}
    )


def effect_curve(
    coefficients: DataFrame, term: str, low: float, high: float, steps: int = 100
) -> DataFrame:
    """Probability and log-odds over a grid of one predictor, all others at their mean."""
    grid = F.transform(
        F.sequence(F.lit(0), F.lit(steps)), lambda i: F.lit(float(low)) + i * F.lit((high - low) / steps)
    )
    one = coefficients.groupBy("model_id").agg(
        F.sum(F.when(F.col("key") == "(Intercept)", F.col("coef")).otherwise(0.0)).alias("_b0"),
        *[F.max(F.when(F.col("key") == term, F.col(c))).alias(f"_{c}") for c in ("mean", "sd", "coef")],
    ).filter("_coef is not null")
    each = one.select("*", F.explode(grid).alias("x"))
    odds = F.col("_b0") + F.col("_coef") * ((F.col("x") - F.col("_mean")) / F.col("_sd"))
    return each.select("model_id", "x", odds.alias("log_odds"), sigmoid(odds).alias("prob"))


def univariate_screen(
    long: DataFrame, keys: Sequence[str], value: str = "x", label: str = "label", steps: int = 25
) -> DataFrame:
    """Single-predictor logistic fits for every group at once: AIC, AUC, slope and intercept.

    Rows are reduced to counts per distinct value; Newton steps are then plain aggregates over that
    table, with two coefficients per group attached each time. Groups that have converged drop out,
    and no group's rows are gathered in one task. Every group of ``long`` gives a row: a group with
    one class, one value or no complete row, or whose classes the value tells apart, has no finite
    fit: its figures are null and ``converged`` is false.
    """
    y = F.col(label).cast("double")
    base = materialize(
        long.filter(F.col(value).isNotNull() & F.col(label).isNotNull())
        .groupBy(*keys, F.col(value).cast("double").alias("_x"))
        .agg(F.count(F.lit(1)).cast("double").alias("_n"), F.sum(y).alias("_k")),
        "screen-counts",
    )
    means = base.groupBy(*keys).agg(
        F.sum("_n").alias("n_sample"), F.sum("_k").alias("_pos"), (F.sum(F.col("_n") * F.col("_x")) / F.sum("_n")).alias("_mx")
    )
    # centred and scaled for a well-conditioned 2 x 2 system
    apart = F.col("_x") - F.col("_mx")
    hit, miss = F.when(F.col("_k") > 0, F.col("_x")), F.when(F.col("_k") < F.col("_n"), F.col("_x"))
    spread = attach(base, means, keys, "inner").groupBy(*keys, "n_sample", "_pos", "_mx").agg(
        F.sqrt(F.sum(F.col("_n") * apart * apart) / F.first("n_sample")).alias("_sx"),
        ((F.min(hit) < F.max(miss)) & (F.min(miss) < F.max(hit))).alias("_mixed"),
    )
    can = (F.col("_sx") > F.lit(1e-12) * F.abs("_mx")) & F.coalesce("_mixed", F.lit(False))
    groups = materialize(spread.withColumn("_can", can), "screen-groups")
    # start at the intercept-only fit
    live = groups.filter("_can").select(
        *keys, "_mx", "_sx", F.log(F.col("_pos") / (F.col("n_sample") - F.col("_pos"))).alias("_b0"), F.lit(0.0).alias("_b1")
    )
    live, done = materialize(live, "screen-step"), []
    z, eta = (F.col("_x") - F.col("_mx")) / F.col("_sx"), F.col("_b0") + F.col("_b1") * F.col("_z")
    p = sigmoid(eta)
    w, g = F.col("_n") * p * (1 - p), F.col("_k") - F.col("_n") * p
    h00, h01, h11, g0, g1 = (F.col(c) for c in ("_h00", "_h01", "_h11", "_g0", "_g1"))
    for _ in range(steps):
        if live.isEmpty():
            break
        sums = (
            attach(base, live, keys, "inner")
            .withColumn("_z", z)
            .groupBy(*keys, "_mx", "_sx", "_b0", "_b1")
            .agg(
                F.sum(w).alias("_h00"),
                F.sum(w * F.col("_z")).alias("_h01"),
                F.sum(w * F.col("_z") * F.col("_z")).alias("_h11"),
                F.sum(g).alias("_g0"),
                F.sum(g * F.col("_z")).alias("_g1"),
                F.sum(F.col("_k") * eta - F.col("_n") * F.log1p(F.exp(eta))).alias("_loglik"),
            )
        )
        det = F.nullif(h00 * h11 - h01 * h01, F.lit(0.0))
        moved = sums.withColumns({"_d0": (h11 * g0 - h01 * g1) / det, "_d1": (h00 * g1 - h01 * g0) / det})
        size = F.greatest(F.abs("_d0"), F.abs("_d1"))
        # a step of no size or beyond all bounds ends the group without a fit
        moved = materialize(
            moved.filter(size.isNotNull() & (F.abs("_b0") + F.abs("_b1") < 1e6)).withColumn("_done", size < F.lit(1e-9)), "screen-sums"
        )
        done.append(moved.filter("_done").select(*keys, "_b0", "_b1", "_loglik"))
        new = [(F.col("_b0") + F.col("_d0")).alias("_b0"), (F.col("_b1") + F.col("_d1")).alias("_b1")]
        live = materialize(moved.filter("NOT _done").select(*keys, "_mx", "_sx", *new), "screen-step")
    fits = done[0] if done else live.select(*keys, "_b0", "_b1", F.lit(None).cast("double").alias("_loglik")).limit(0)
    for d in done[1:]:
        fits = fits.unionByName(d)
    # A logistic fit is monotone in x, so its AUC is that of x, mirrored for a falling fit.
    area = metrics.auc(long, keys, value, label, "_auc").select(*keys, "_auc")
    every = long.select(*keys).distinct()
    same = lambda a, b: [a[k].eqNullSafe(b[f"_k_{k}"]) for k in keys]

    def joined(a: DataFrame, b: DataFrame) -> DataFrame:
        renamed = b.withColumnsRenamed({k: f"_k_{k}" for k in keys})
        return a.join(renamed, same(a, renamed), "left").drop(*[f"_k_{k}" for k in keys])

    out = joined(joined(joined(every, groups), fits), area)
    slope = F.col("_b1") / F.col("_sx")
    return out.select(
        *keys,
        F.coalesce(F.col("n_sample").cast("long"), F.lit(0)).alias("n_sample"),
        (F.col("_pos") / F.col("n_sample")).alias("frac_exceed"),
        (4 - 2 * F.col("_loglik")).alias("aic"),
        slope.alias("slope"),
        (F.col("_b0") - slope * F.col("_mx")).alias("intercept"),
        F.when(slope < 0, 1 - F.col("_auc")).when(slope.isNotNull(), F.col("_auc")).alias("auc"),
        F.col("_loglik").isNotNull().alias("converged"),
    )


def best_by(df: DataFrame, keys: Sequence[str], metric: Column, tie: Sequence[Column]) -> DataFrame:
    return first_per_key(df, keys, [metric.desc(), *tie])


def train_learners(
    df: DataFrame, predictors: Sequence[str], fold: str, folds: int, label: str = "label", seed: int = 1, **sizes
) -> dict[str, PipelineModel]:
    """The five learners of the comparison on one predictor set."""
    step, _ = forward_selection(df, predictors, label)
    net = elastic_net(
        df, predictors, label, fold, folds, sizes.get("alphas", ALPHAS), sizes.get("lambdas", LAMBDAS)
    ).bestModel
    learners = {
        "net": net,
        "rf": random_forest(df, predictors, label, sizes.get("trees", 100), seed=seed),
        "gbm": boosted_trees(df, predictors, label, sizes.get("rounds", 50), seed=seed),
        "glm": fit_glm(df, predictors, label).model,
    }
    if step is not None:
        learners["step"] = step.model
    return learners


def score_learners(
    df: DataFrame, models: dict[tuple[str, str], PipelineModel], keep: Sequence[str]
) -> DataFrame:
    """All candidates' scores stacked, tagged by predictor set and learner."""
    out = None
    for (predictor_set, name), model in models.items():
        rows = score_with(model, df).select(
            *keep, "prob", F.lit(predictor_set).alias("predictor_set"), F.lit(name).alias("model_name")
        )
        out = rows if out is None else out.unionByName(rows)
    return out
