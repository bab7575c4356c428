"""Exact classifier metrics from scored rows (keys, prob, label 0/1).

Every metric starts from a count table over distinct scores (or cutoff slots), so the rows
are reduced before any shuffle and ties are handled once. A higher score always means the
positive class.
"""

from __future__ import annotations

import math
from collections.abc import Sequence

import pandas as pd
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F
from pyspark.sql.types import DoubleType

from hydrosignal.operators.attach import attach
from hydrosignal.operators.ordered import running_totals, value_part
from hydrosignal.session import materialize

# The two cutoff sweeps.
CUTOFFS_5 = tuple(round(i * 0.05, 2) for i in range(1, 20))
CUTOFFS_1 = tuple(round(i * 0.01, 2) for i in range(1, 100))


def ratio(a: Column, b: Column) -> Column:
    return a / F.nullif(b.cast("double"), F.lit(0.0))


def score_counts(df: DataFrame, keys: Sequence[str], prob="prob", label="label") -> DataFrame:
    """Positives and negatives per distinct score; unscored rows are left out."""
    y = F.col(label).cast("long")
    return (
        df.filter(F.col(prob).isNotNull() & F.col(label).isNotNull())
        .groupBy(*keys, prob)
        .agg(F.sum(y).alias("pos"), F.sum(1 - y).alias("neg"))
    )


def _cumulated(df: DataFrame, keys, prob, label) -> DataFrame:
    """Counts per distinct score with their running totals from the highest score down.

    The counts are written once: the cut points, the part totals and the rows all read
    the small count table, and the scored rows are scanned a single time.
    """
    counts = materialize(score_counts(df, keys, prob, label), "score-counts")
    totals = {"tp": F.col("pos"), "fp": F.col("neg")}
    return running_totals(counts, keys, value_part(counts, prob), [F.col(prob).desc()], totals, descending_parts=True)


def _with_totals(df, totals, keys):
    return df.join(totals, list(keys)) if keys else df.crossJoin(F.broadcast(totals))


def roc_points(df: DataFrame, keys: Sequence[str], prob="prob", label="label") -> DataFrame:
    """One point per distinct score: predicting positive for scores at or above the threshold."""
    return _cumulated(df, keys, prob, label).select(
        *keys,
        F.col(prob).alias("threshold"),
        "tp",
        "fp",
        ratio(F.col("tp"), F.col("tp_all")).alias("tpr"),
        ratio(F.col("fp"), F.col("fp_all")).alias("fpr"),
    )


def auc(df: DataFrame, keys: Sequence[str], prob="prob", label="label", name="auc") -> DataFrame:
    """Area under the ROC curve: share of (positive, negative) pairs in the right order, ties half."""
    cum = _cumulated(df, keys, prob, label)
    # negatives scored at or above a positive count against it, those level with it half
    lost = F.sum(F.col("pos") * (F.col("fp") - F.col("neg") / 2.0))
    pairs = F.sum("pos") * F.sum("neg").cast("double")
    return cum.groupBy(*keys).agg(
        ratio(pairs - lost, pairs).alias(name), F.sum("pos").alias("n_pos"), F.sum("neg").alias("n_neg")
    )


def rates(tp: Column, fp: Column, fn: Column, tn: Column) -> dict[str, Column]:
    """Accuracy, kappa and the two-class rates from the four cells."""
    n = (tp + fp + fn + tn).cast("double")
    acc = ratio(tp + tn, n)
    chance = ratio((tp + fp) * (tp + fn) * F.lit(1.0) + (fn + tn) * (fp + tn) * F.lit(1.0), n * n)
    return {
        "accuracy": acc,
        "kappa": ratio(acc - chance, 1 - chance),
        "sensitivity": ratio(tp, tp + fn),
        "specificity": ratio(tn, fp + tn),
        "ppv": ratio(tp, tp + fp),
        "npv": ratio(tn, fn + tn),
        "precision": ratio(tp, tp + fp),
        "recall": ratio(tp, tp + fn),
        "accuracy_null": ratio(F.greatest(tp + fn, fp + tn), n),
    }


#: Trials from which the tail is taken from its uniform expansion; its error falls as their power -1.5.
MANY_TRIALS = 1e7


def _upper_tail(x: float, n: float, p: float) -> float:
    """P(X >= x) for X ~ Binomial(n, p): the beta integral of p up to ``MANY_TRIALS``, its expansion beyond."""
    if x <= 0 or p >= 1.0:
        return 1.0
    if x > n or p <= 0.0:
        return 0.0
    a, b = x, n - x + 1.0
    if n > MANY_TRIALS and min(a, b) > 1e4:
        return _beta_expansion(a, b, p)
    if p > (a + 1) / (a + b + 2):
        return 1.0 - _beta_ratio(b, a, 1.0 - p)
    return _beta_ratio(a, b, p)


def _beta_expansion(a: float, b: float, x: float) -> float:
    """Ratio of the beta integral for large ``a`` and ``b``, uniform in ``x``.

    The integrand is put in the shape of a normal density around its peak; what is left is one
    term of order 1 / sqrt(a + b).
    """
    n, peak = a + b, a / (a + b)
    # n/2 eta^2 = a ln(peak / x) + b ln((1 - peak) / (1 - x)), by log1p near the peak
    d = x - peak
    half = -peak * math.log1p(d / peak) - (1 - peak) * math.log1p(-d / (1 - peak))
    if abs(d) < 1e-3 * min(peak, 1 - peak):
        # the two logarithms cancel up to the second power of d: sum what is left as a series
        half = sum(((-1) ** k * peak * (d / peak) ** k + (1 - peak) * (d / (1 - peak)) ** k) / k for k in range(2, 12))
    eta = math.copysign(math.sqrt(max(2 * half, 0.0)), d)
    spread = math.sqrt(peak * (1 - peak))
    if abs(eta) < 1e-5:
        term = (1 - 2 * peak) / (3 * spread) - eta * (1 + peak * (peak - 1)) / (12 * peak * (1 - peak))
    else:
        term = 1 / eta - spread / d
    return 0.5 * math.erfc(-eta * math.sqrt(n / 2)) + math.exp(-n * half) / math.sqrt(2 * math.pi * n) * term


def _beta_ratio(a: float, b: float, x: float) -> float:
    """Ratio of the beta integral by its continued fraction, which needs some sqrt(a + b) terms."""
    front = math.exp(
        math.lgamma(a + b) - math.lgamma(a) - math.lgamma(b) + a * math.log(x) + b * math.log1p(-x)
    )
    # Lentz evaluation of the fraction 1/(1+ d1/(1+ d2/(1+ ...)))
    tiny = 1e-300
    f, c, d, i = 1.0, 1.0, 0.0, 0
    while True:
        m = i // 2
        if i == 0:
            num = 1.0
        elif i % 2 == 0:
            num = m * (b - m) * x / ((a + 2 * m - 1) * (a + 2 * m))
        else:
            num = -(a + m) * (a + b + m) * x / ((a + 2 * m) * (a + 2 * m + 1))
        d = 1.0 + num * d
        d = 1.0 / (d if abs(d) > tiny else tiny)
        c = 1.0 + num / (c if abs(c) > tiny else tiny)
        step = c * d
        f *= step
        if i > 0 and abs(step - 1.0) < 1e-14:
            return front * (f - 1.0) / a
        i += 1


@F.pandas_udf(DoubleType())
def binomial_upper_tail(x: pd.Series, n: pd.Series, p: pd.Series) -> pd.Series:
    """One value per model row: chance of at least ``x`` hits in ``n`` at rate ``p``."""
    return pd.Series(
        [None if pd.isna(a) or pd.isna(c) else _upper_tail(float(a), float(b), float(c)) for a, b, c in zip(x, n, p)],
        dtype="float64",
    )


def cells(df: DataFrame, keys: Sequence[str], cutoff: Column, prob="prob", label="label") -> DataFrame:
    """tp, fp, fn, tn per group for one cutoff (a literal or a column of the group)."""
    hit = F.col(prob) > cutoff
    y = F.col(label) == 1
    scored = df.filter(F.col(prob).isNotNull() & F.col(label).isNotNull())
    return scored.groupBy(*keys).agg(
        F.count_if(hit & y).alias("tp"),
        F.count_if(hit & ~y).alias("fp"),
        F.count_if(~hit & y).alias("fn"),
        F.count_if(~hit & ~y).alias("tn"),
    )


def confusion(df: DataFrame, keys: Sequence[str], cutoff: Column, prob="prob", label="label") -> DataFrame:
    """Confusion cells, all rates, no-information rate and its one-sided p-value."""
    base = cells(df, keys, cutoff, prob, label)
    c = [F.col(x) for x in ("tp", "fp", "fn", "tn")]
    table = base.withColumns(rates(*c))
    n = (c[0] + c[1] + c[2] + c[3]).cast("double")
    p = binomial_upper_tail((c[0] + c[3]).cast("double"), n, F.col("accuracy_null"))
    return table.withColumn("accuracy_pvalue", p)


def cutoff_sweep(
    df: DataFrame, keys: Sequence[str], cutoffs: Sequence[float] = CUTOFFS_5, prob="prob", label="label"
) -> DataFrame:
    """Rates and distance to the perfect corner for every cutoff.

    A row is positive for all cutoffs below its score, so rows are counted once by the
    number of cutoffs they pass and the sweep works on at most ``len(cutoffs) + 1`` rows
    per group.
    """
    passed = sum((F.col(prob) > F.lit(c)).cast("int") for c in cutoffs)
    y = F.col(label).cast("long")
    slots = (
        df.filter(F.col(prob).isNotNull() & F.col(label).isNotNull())
        .groupBy(*keys, passed.alias("_slot"))
        .agg(F.sum(y).alias("_pos"), F.sum(1 - y).alias("_neg"))
    )
    table = F.array(*[F.struct(F.lit(i).alias("_i"), F.lit(c).alias("cutoff")) for i, c in enumerate(cutoffs)])
    each = slots.select(*keys, "_slot", "_pos", "_neg", F.inline(table))
    hit = F.col("_slot") > F.col("_i")
    four = each.groupBy(*keys, "cutoff").agg(
        F.sum(F.when(hit, F.col("_pos")).otherwise(0)).alias("tp"),
        F.sum(F.when(hit, F.col("_neg")).otherwise(0)).alias("fp"),
        F.sum(F.when(hit, 0).otherwise(F.col("_pos"))).alias("fn"),
        F.sum(F.when(hit, 0).otherwise(F.col("_neg"))).alias("tn"),
    )
    r = rates(F.col("tp"), F.col("fp"), F.col("fn"), F.col("tn"))
    sens, spec = r["sensitivity"], r["specificity"]
    return four.select(
        *keys,
        "cutoff",
        sens.alias("sens"),
        spec.alias("spec"),
        F.sqrt((1 - spec) * (1 - spec) + (1 - sens) * (1 - sens)).alias("dist"),
        r["precision"].alias("prec"),
        r["recall"].alias("recall"),
        r["accuracy"].alias("acc"),
    )


def best_cutoff(sweep: DataFrame, keys: Sequence[str], digits: int = 12) -> DataFrame:
    """Mean of the cutoffs with the least distance; distances equal up to rounding tie."""
    d = F.round("dist", digits)
    least = sweep.groupBy(*keys).agg(F.min(d).alias("_least"))
    joined = _with_totals(sweep, least, keys).filter(d == F.col("_least"))
    return joined.groupBy(*keys).agg(F.avg("cutoff").alias("best_cutoff"), F.first("_least").alias("dist"))


def sweep_with_auc(df: DataFrame, keys: Sequence[str], cutoffs=CUTOFFS_5, prob="prob", label="label") -> DataFrame:
    area = auc(df, keys, prob, label, "roc").select(*keys, "roc")
    return _with_totals(cutoff_sweep(df, keys, cutoffs, prob, label), area, keys)


def on_fpr_grid(points: DataFrame, keys: Sequence[str], grid_size: int = 10_000, pin_start: bool = True) -> DataFrame:
    """ROC points on a common false-positive grid, linear between neighbours.

    Every pair of neighbouring points yields the grid positions between them, so no grid x
    point join is needed. A vertical step is entered at its lowest and left at its highest
    tpr; the curve starts at (0, 0).
    """
    per_fpr = points.groupBy(*keys, "fpr").agg(
        F.max("tpr").alias("tpr"),
        F.min("threshold").alias("threshold"),
        F.min("tpr").alias("tpr_in"),
        F.max("threshold").alias("threshold_in"),
    )
    # at most one point per distinct fpr; cut by fpr so that no task holds a whole curve
    work = per_fpr.withColumn("_slot", F.floor(F.col("fpr") * 256))
    w = Window.partitionBy(*keys, "_slot").orderBy("fpr")
    later = Window.partitionBy(*keys).orderBy(F.col("_slot").desc()).rowsBetween(Window.unboundedPreceding, -1)
    leave = F.struct("fpr", "tpr", "threshold")
    arrive = F.struct("fpr", F.col("tpr_in").alias("tpr"), F.col("threshold_in").alias("threshold"))
    firsts = (
        work.groupBy(*keys, "_slot")
        .agg(F.min(arrive).alias("_first"))
        .select(*keys, "_slot", F.last("_first").over(later).alias("_next_slot"))
    )
    segments = (
        work.withColumn("_next", F.lead(arrive).over(w))
        .join(firsts, [*keys, "_slot"])
        .select(*keys, leave.alias("a"), F.coalesce("_next", "_next_slot").alias("b"))
    )
    # leading segment from the origin to the first point
    head = (
        per_fpr.groupBy(*keys)
        .agg(F.min(arrive).alias("b"))
        .select(
            *keys,
            F.struct(F.lit(0.0).alias("fpr"), F.lit(0.0).alias("tpr"), F.col("b.threshold").alias("threshold")).alias("a"),
            "b",
        )
        .filter("b.fpr > 0")
    )
    segments = segments.unionByName(head)
    step = F.lit(grid_size - 1)
    lo = F.ceil(F.round(F.col("a.fpr") * step, 9))
    hi = F.when(F.col("b").isNull(), F.floor(F.round(F.col("a.fpr") * step, 9))).otherwise(
        F.ceil(F.round(F.col("b.fpr") * step, 9)) - 1
    )
    on_grid = segments.withColumns({"_lo": lo, "_hi": hi}).filter("_lo <= _hi").select(
        *keys, "a", "b", F.explode(F.sequence("_lo", "_hi")).alias("grid")
    )
    x = F.col("grid") / step
    share = (x - F.col("a.fpr")) / (F.col("b.fpr") - F.col("a.fpr"))
    line = lambda f: F.when(F.col("b").isNull() | (x <= F.col("a.fpr")), F.col(f"a.{f}")).otherwise(
        F.col(f"a.{f}") + (F.col(f"b.{f}") - F.col(f"a.{f}")) * share
    )
    tpr = F.when(F.col("grid") == 0, F.lit(0.0)).otherwise(line("tpr")) if pin_start else line("tpr")
    return on_grid.select(*keys, "grid", x.alias("fpr"), tpr.alias("tpr"), line("threshold").alias("threshold"))


def mean_roc(points: DataFrame, keys: Sequence[str], fold: str, grid_size: int = 10_000) -> DataFrame:
    """Mean curve over folds on the common grid with the spread of the tpr."""
    grid = on_fpr_grid(points, [*keys, fold], grid_size)
    mean = grid.groupBy(*keys, "grid", "fpr").agg(
        F.avg("tpr").alias("tpr"), F.stddev_pop("tpr").alias("tpr_sd"), F.avg("threshold").alias("threshold")
    )
    end = F.col("grid") == grid_size - 1
    return mean.withColumn("tpr", F.when(end, F.lit(1.0)).otherwise(F.col("tpr")))


def curve_area(grid: DataFrame, keys: Sequence[str], grid_size: int, name: str = "mean_auc") -> DataFrame:
    """Trapezoid area of a curve on the full equal-step grid: interior points count once, ends half."""
    weight = F.when((F.col("grid") == 0) | (F.col("grid") == grid_size - 1), F.lit(0.5)).otherwise(F.lit(1.0))
    return grid.groupBy(*keys).agg((F.sum(F.col("tpr") * weight) / (grid_size - 1)).alias(name))


def threshold_for(curve: DataFrame, keys: Sequence[str], target: Column) -> DataFrame:
    """Threshold of the curve point whose tpr is nearest to the target; on ties the first along the curve.

    ``target`` may be a column of the curve (one per target row).
    """
    rank = F.struct(F.round(F.abs(F.col("tpr") - target), 12), F.col("fpr"), F.col("tpr"))
    return curve.groupBy(*keys).agg(
        F.min_by("threshold", rank).alias("threshold"), F.min_by("tpr", rank).alias("curve_tpr")
    )


def sensitivity_response(
    scored: DataFrame, curve: DataFrame, keys: Sequence[str], targets: Sequence[float], prob="prob", label="label"
) -> DataFrame:
    """Target sensitivity -> threshold -> sensitivity, specificity and accuracy on the scored rows.

    Rows are first counted per distinct score. The list of (target, threshold), as long as
    the given targets, is attached to them once per key and never shuffles them.
    """
    wanted = F.array(*[F.lit(float(t)) for t in targets])
    each = curve.select(*keys, "fpr", "tpr", "threshold", F.explode(wanted).alias("target"))
    picked = threshold_for(each, [*keys, "target"], F.col("target"))
    lists = picked.groupBy(*keys).agg(F.collect_list(F.struct("target", "threshold")).alias("_picked"))
    counts = attach(score_counts(scored, keys, prob, label), lists, keys, "inner")
    joined = counts.select(*keys, prob, "pos", "neg", F.inline("_picked"))
    positive = F.col(prob) > F.col("threshold")
    tp = F.sum(F.when(positive, F.col("pos")).otherwise(0))
    tn = F.sum(F.when(positive, 0).otherwise(F.col("neg")))
    return joined.groupBy(*keys, "target", "threshold").agg(
        ratio(tp, F.sum("pos")).alias("tpr"),
        ratio(tn, F.sum("neg")).alias("tnr"),
        ratio(tp + tn, F.sum(F.col("pos") + F.col("neg"))).alias("accuracy"),
    )


def sensitivity_targets(n: int = 100) -> list[float]:
    """Targets from nearly one down to nearly zero, their distance from one evenly spaced in logs."""
    return [1 - 10 ** (-3 + (3 - 0.0001) * i / (n - 1)) for i in range(n)]


def auc_spread(scored: DataFrame, keys: Sequence[str], fold: str, prob="prob", label="label") -> DataFrame:
    """Spread of the folds' AUCs per key."""
    return auc(scored, [*keys, fold], prob, label).groupBy(*keys).agg(F.stddev_pop("auc").alias("auc_sd"))
