"""Many logistic models fitted together: every step is one pass over the rows.

A model is a set of predictors, a condition that chooses its rows, and a penalty. A pass sums the
gradient and the Hessian of all models that have not converged yet; a task hands on one row of sums
per model, which are added up before they reach the driver. There the small systems are solved:
without penalty by a Newton step, with one by coordinate descent on the weighted Gram matrix that
starts from the last coefficients. Predictors are centred and scaled by each model's own rows.
"""

from __future__ import annotations

import math
from collections.abc import Iterator, Sequence
from dataclasses import dataclass, field

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

STEPS = 25
#: Greatest change of a coefficient, in units of scaled predictors, at which a model has converged.
TOLERANCE = 1e-10


@dataclass(frozen=True)
class Spec:
    """One model: rows where ``rows`` names a true column (all if None), penalty ``strength`` with share ``mix`` of it absolute."""

    name: tuple
    predictors: tuple[str, ...]
    rows: str | None = None
    strength: float = 0.0
    mix: float = 0.0


@dataclass
class Fit:
    """A fitted model. Coefficients belong to centred and scaled predictors, the intercept comes last.

    Where no finite fit exists (one class only, a predictor without spread, fewer rows than
    coefficients, classes that a predictor tells apart) ``converged`` is false.
    """

    spec: Spec
    n: float = 0.0
    positives: float = 0.0
    means: np.ndarray = field(default_factory=lambda: np.zeros(0))
    scales: np.ndarray = field(default_factory=lambda: np.zeros(0))
    beta: np.ndarray = field(default_factory=lambda: np.zeros(0))
    errors: np.ndarray = field(default_factory=lambda: np.zeros(0))
    loglik: float = math.nan
    steps: int = 0
    converged: bool = False

    @property
    def deviance(self) -> float:
        return -2 * float(self.loglik)

    @property
    def null_deviance(self) -> float:
        k, n = float(self.positives), float(self.n)
        return -2 * sum(c * math.log(c / n) for c in (k, n - k) if c > 0)

    @property
    def aic(self) -> float:
        return self.deviance + 2 * (len(self.spec.predictors) + 1)

    def log_odds(self) -> Column:
        """Linear predictor as an expression; null where a predictor is null."""
        out = F.lit(float(self.beta[-1]))
        for c, m, sd, b in zip(self.spec.predictors, self.means, self.scales, self.beta, strict=False):
            out = out + F.lit(float(b)) * ((F.col(c).cast("double") - F.lit(float(m))) / F.lit(float(sd)))
        return out


def _rows(batch: pa.RecordBatch, names: Sequence[str]) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    columns = [batch.column(c).to_numpy(zero_copy_only=False).astype(float) for c in names]
    x = np.column_stack(columns) if columns else np.zeros((len(batch), 0))
    return x, batch.column("_y").to_numpy(zero_copy_only=False).astype(float), batch.column("_w").to_numpy(zero_copy_only=False).astype(float)


class _Pass:
    """Sums over the rows of every model, by one function of (rows of the model, label, weight, model)."""

    def __init__(self, table: DataFrame, names: list[str], conditions: list[str]):
        self.table, self.names, self.conditions = table, names, conditions

    def sums(self, fits: list[Fit], what, width: int) -> dict[int, np.ndarray]:
        names, conditions = self.names, self.conditions
        at = {c: i for i, c in enumerate(names)}
        work = [(i, [at[c] for c in f.spec.predictors], f.spec.rows, f) for i, f in fits]
        shared = self.table.sparkSession.sparkContext.broadcast(work)

        def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
            total = {i: np.zeros(width) for i, *_ in shared.value}
            for batch in batches:
                x, y, w = _rows(batch, names)
                flags = {c: batch.column(c).to_numpy(zero_copy_only=False).astype(bool) for c in conditions}
                for i, columns, rows, fit in shared.value:
                    z = x[:, columns]
                    keep = ~np.isnan(z).any(axis=1) & ~np.isnan(y) & (w > 0)
                    if rows is not None:
                        keep &= flags[rows]
                    got = what(z[keep], y[keep], w[keep], fit)
                    total[i][: len(got)] += got
            values = np.stack([total[i] for i, *_ in shared.value])
            yield pa.RecordBatch.from_arrays(
                [pa.array([i for i, *_ in shared.value], pa.int32()), *[pa.array(v) for v in values.T]], names=["m", *[f"v{k}" for k in range(width)]]
            )

        each = self.table.mapInArrow(run, "m int, " + ", ".join(f"v{k} double" for k in range(width)))
        added = each.groupBy("m").agg(*[F.sum(f"v{k}").alias(f"v{k}") for k in range(width)])
        return {r["m"]: np.array(r[1:], float) for r in added.collect()}


def _moments(x, y, w, fit):
    return np.concatenate([[w.sum(), (w * y).sum(), len(y)], x.sum(axis=0)])


def _squares(x, y, w, fit):
    return ((x - fit.means) ** 2).sum(axis=0)


def _newton(x, y, w, fit):
    """Log-likelihood, gradient and lower half of the Hessian."""
    z = np.column_stack([(x - fit.means) / fit.scales, np.ones(len(y))])
    eta = z @ fit.beta
    p = 1 / (1 + np.exp(-np.clip(eta, -700, 700)))
    h = (z * (w * p * (1 - p))[:, None]).T @ z
    loglik = (w * (y * eta - np.logaddexp(0, eta))).sum()
    return np.concatenate([[loglik], z.T @ (w * (y - p)), h[np.tril_indices(len(fit.beta))]])


def _square(half: np.ndarray, size: int) -> np.ndarray:
    h = np.zeros((size, size))
    h[np.tril_indices(size)] = half
    return h + np.tril(h, -1).T


def _descended(h: np.ndarray, g: np.ndarray, beta: np.ndarray, fit: Fit) -> np.ndarray:
    """Least of the penalised quadratic model around ``beta``, coordinate by coordinate from there."""
    h, g = h / fit.n, g / fit.n
    absolute, square = fit.spec.strength * fit.spec.mix, fit.spec.strength * (1 - fit.spec.mix)
    new = beta.copy()
    for _ in range(10_000):
        most = 0.0
        for j in range(len(beta)):
            slope = g[j] - h[j] @ (new - beta) + h[j, j] * new[j]
            if j == len(beta) - 1:  # the intercept is free
                value = slope / h[j, j]
            else:
                value = math.copysign(max(abs(slope) - absolute, 0.0), slope) / (h[j, j] + square)
            most = max(most, abs(value - new[j]))
            new[j] = value
        if most < TOLERANCE / 10:
            break
    return new


def _penalised(fit: Fit, loglik: float, beta: np.ndarray) -> float:
    b = beta[:-1]
    return loglik / fit.n - fit.spec.strength * (fit.spec.mix * np.abs(b).sum() + (1 - fit.spec.mix) / 2 * (b * b).sum())


def fit_many(df: DataFrame, specs: Sequence[Spec], label: str = "label", weight: str | None = None, steps: int = STEPS) -> list[Fit]:
    """All models, in the order of ``specs``.

    Rows with a null label or weight, or with a null in a model's own predictors, are left out of it.
    The table is read once per step, two times more for means and scales; models that have converged
    drop out. A step that would lower the (penalised) likelihood is halved. The driver holds one
    matrix of the size of its predictors per model.
    """
    names = list(dict.fromkeys(c for s in specs for c in s.predictors))
    conditions = list(dict.fromkeys(s.rows for s in specs if s.rows is not None))
    table = df.select(
        *[F.col(c).cast("double").alias(c) for c in names],
        *[F.coalesce(F.col(c), F.lit(False)).alias(c) for c in conditions],
        F.col(label).cast("double").alias("_y"),
        F.coalesce(F.col(weight).cast("double") if weight else F.lit(1.0), F.lit(0.0)).alias("_w"),
    )
    if len(set(names) & set(conditions)):
        raise ValueError("a condition must not be a predictor")
    run, fits = _Pass(table, names, conditions), [Fit(s) for s in specs]
    width = max((len(s.predictors) for s in specs), default=0)
    every = list(enumerate(fits))
    rows = {}
    for i, v in run.sums(every, _moments, 3 + width).items():
        p = len(fits[i].spec.predictors)
        fits[i].n, fits[i].positives, rows[i] = v[0], v[1], v[2]
        fits[i].means = v[3 : 3 + p] / v[2] if v[2] else np.zeros(p)
    for i, v in run.sums(every, _squares, max(width, 1)).items():
        p = len(fits[i].spec.predictors)
        fits[i].scales = np.sqrt(v[:p] / max(rows[i] - 1, 1))
        fits[i].beta = np.zeros(p + 1)
    live = []
    for i, f in every:
        # a predictor without spread up to rounding errors
        spread = bool((f.scales > 1e-12 * np.maximum(np.abs(f.means), 1e-300)).all())
        if rows.get(i, 0) > len(f.beta) - 1 and 0 < f.positives < f.n and spread:
            f.beta[-1] = math.log(f.positives / (f.n - f.positives))
            live.append((i, f))
        else:
            f.beta = np.full(len(f.spec.predictors) + 1, math.nan)
    size = lambda p: 1 + (p + 1) + (p + 1) * (p + 2) // 2
    before: dict[int, tuple[float, np.ndarray]] = {}
    for step in range(steps):
        if not live:
            break
        found, still = run.sums(live, _newton, size(max(len(f.spec.predictors) for _, f in live))), []
        for i, f in live:
            k = len(f.beta)
            v, f.steps = found[i], step + 1
            f.loglik, g, h = float(v[0]), v[1 : 1 + k], _square(v[1 + k : 1 + k + k * (k + 1) // 2], k)
            value = _penalised(f, f.loglik, f.beta) if f.spec.strength else f.loglik / f.n
            if i in before and value < before[i][0] - 1e-12 * (1 + abs(before[i][0])):
                f.beta = (f.beta + before[i][1]) / 2
                still.append((i, f))
                continue
            try:
                new = _descended(h, g, f.beta, f) if f.spec.strength else f.beta + np.linalg.solve(h, g)
                f.errors = np.sqrt(np.maximum(np.diag(np.linalg.inv(h)), 0))
            except np.linalg.LinAlgError:
                continue
            if not np.isfinite(new).all() or np.abs(new).max() > 1e6:
                continue
            moved = float(np.abs(new - f.beta).max())
            before[i] = value, f.beta
            if moved < TOLERANCE * max(1.0, float(np.abs(new).max())):
                f.converged = True
            else:
                f.beta = new
                still.append((i, f))
        live = still
    return fits
