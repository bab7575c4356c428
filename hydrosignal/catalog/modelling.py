"""Splits, metrics, fits and scoring on the given tables."""

from __future__ import annotations

from pyspark.sql import functions as F

from hydrosignal.catalog import standins as s
from hydrosignal.catalog.registry import query
from hydrosignal.catalog.windows import shown
from hydrosignal.functions.clean import sigmoid
from hydrosignal.operators import labels, metrics, models, newton, reshape, summaries
from hydrosignal.plans import weather
from hydrosignal.session import materialize, scratch_dir
from hydrosignal.sources import model_files

_ORDERS = """o AS (SELECT o_orderkey, o_orderpriority AS model_id, (o_totalprice > 400000)::INTEGER AS label FROM orders)"""


def _orders(spark, folder):
    o = s.read(spark, folder, "orders")
    return o.select("o_orderkey", F.col("o_orderpriority").alias("model_id"), (F.col("o_totalprice") > 400000).cast("int").alias("label"))


def _ranked(seed, keys="model_id, label"):
    return f"{_ORDERS}, r AS (SELECT *, row_number() OVER (PARTITION BY {keys} ORDER BY md5(o_orderkey::VARCHAR || ':{seed}'), o_orderkey) AS rn, count(*) OVER (PARTITION BY {keys}) AS n FROM o)"


@query(
    "j1_stratified_split",
    f"WITH {_ranked(7)} SELECT o_orderkey, model_id, label, CASE WHEN rn <= ceil(round(n * 0.75e0, 9)) THEN 'train' ELSE 'test' END AS subset FROM r",
)
def split(spark, folder):
    return labels.stratified_split(_orders(spark, folder), ["model_id", "label"], ["o_orderkey"], 0.75, 7)


@query(
    "d13_training_complement",
    f"WITH {_ranked(7)} SELECT o_orderkey FROM r WHERE rn > ceil(round(n * 0.75e0, 9))",
)
def complement(spark, folder):
    o = _orders(spark, folder)
    train = labels.stratified_split(o, ["model_id", "label"], ["o_orderkey"], 0.75, 7).filter("subset = 'train'")
    return o.join(train, "o_orderkey", "left_anti").select("o_orderkey")


@query(
    "j10_stratified_folds",
    f"WITH {_ranked(3)} SELECT o_orderkey, model_id, label, ((rn - 1) % 10)::INTEGER AS fold FROM r",
)
def folds(spark, folder):
    return labels.stratified_folds(_orders(spark, folder), ["model_id", "label"], ["o_orderkey"], 10, 3)


@query(
    "j22_down_sampling",
    f"WITH {_ranked(5)} SELECT o_orderkey, model_id, label FROM r WHERE rn <= (SELECT min(n) FROM r r2 WHERE r2.model_id = r.model_id)",
)
def down(spark, folder):
    return labels.down_sample(_orders(spark, folder), ["model_id"], "label", ["o_orderkey"], 5)


@query(
    "j22_up_sampling",
    f"""
WITH {_ranked(5)}, t AS (SELECT model_id, max(n) AS top FROM r GROUP BY 1)
SELECT o_orderkey, r.model_id, label, unnest(generate_series(1, top // n + (rn <= top % n)::INTEGER)) AS copy FROM r JOIN t ON t.model_id = r.model_id""",
)
def up(spark, folder):
    return labels.up_sample(_orders(spark, folder), ["model_id"], "label", ["o_orderkey"], 5)


_KEYS = ["model_id", "subset"]
_POINTS = f"""{s.SCORED},
c AS (SELECT model_id, subset, prob, sum(label) AS pos, sum(1 - label) AS neg FROM scored GROUP BY 1, 2, 3),
cum AS (
  SELECT *, sum(pos) OVER w AS tp, sum(neg) OVER w AS fp, sum(pos) OVER g AS np, sum(neg) OVER g AS nn FROM c
  WINDOW w AS (PARTITION BY model_id, subset ORDER BY prob DESC), g AS (PARTITION BY model_id, subset)),
points AS (SELECT model_id, subset, prob AS threshold, tp, fp, tp / np AS tpr, fp / nn AS fpr FROM cum)"""


@query(
    "j11_roc_points",
    f"WITH {_POINTS} SELECT model_id, subset, threshold, tp::BIGINT AS tp, fp::BIGINT AS fp, round(tpr, 9) AS tpr, round(fpr, 9) AS fpr FROM points",
)
def roc(spark, folder):
    return s.rounded(metrics.roc_points(s.scored(spark, folder), _KEYS), 9, "tpr", "fpr")


@query(
    "j11_auc",
    f"""
WITH {s.SCORED},
ranked AS (SELECT *, (rank() OVER w + count(*) OVER (PARTITION BY model_id, subset, prob) / 2 - 0.5e0) AS r FROM scored WINDOW w AS (PARTITION BY model_id, subset ORDER BY prob))
SELECT model_id, subset, round((sum(r) FILTER (WHERE label = 1) - sum(label) * (sum(label) + 1) / 2) / (sum(label) * sum(1 - label)), 9) AS auc,
       sum(label)::BIGINT AS n_pos, sum(1 - label)::BIGINT AS n_neg FROM ranked GROUP BY 1, 2""",
)
def auc(spark, folder):
    return s.rounded(metrics.auc(s.scored(spark, folder), _KEYS), 9)


def _sweep(step, top):
    return f"""{s.SCORED},
cut AS (SELECT round(i * {step}, 2) AS cutoff FROM (SELECT unnest(generate_series(1, {top}))::DOUBLE AS i)),
four AS (
  SELECT model_id, cutoff, sum((prob > cutoff AND label = 1)::INTEGER) AS tp, sum((prob > cutoff AND label = 0)::INTEGER) AS fp,
         sum((prob <= cutoff AND label = 1)::INTEGER) AS fn, sum((prob <= cutoff AND label = 0)::INTEGER) AS tn FROM scored CROSS JOIN cut GROUP BY 1, 2),
rates AS (SELECT *, tp / (tp + fn) AS sens, tn / (tn + fp) AS spec FROM four),
sweep AS (
  SELECT model_id, cutoff, sens, spec, sqrt((1 - spec) ** 2 + (1 - sens) ** 2) AS dist,
         CASE WHEN tp + fp > 0 THEN tp / (tp + fp) END AS prec, sens AS recall, (tp + tn) / (tp + fp + fn + tn) AS acc FROM rates)"""


_ROUNDED = "model_id, cutoff, round(sens, 9) AS sens, round(spec, 9) AS spec, round(dist, 9) AS dist, round(prec, 9) AS prec, round(recall, 9) AS recall, round(acc, 9) AS acc"


@query("j12_cutoff_sweep", f"WITH {_sweep('0.05e0', 19)} SELECT {_ROUNDED} FROM sweep")
def sweep(spark, folder):
    return s.rounded(metrics.cutoff_sweep(s.scored(spark, folder), ["model_id"]), 9)


@query(
    "j12_fine_cutoff_sweep_with_auc",
    f"""
WITH {_sweep('0.01e0', 99)},
ranked AS (SELECT *, (rank() OVER w + count(*) OVER (PARTITION BY model_id, prob) / 2 - 0.5e0) AS r FROM scored WINDOW w AS (PARTITION BY model_id ORDER BY prob)),
a AS (SELECT model_id, (sum(r) FILTER (WHERE label = 1) - sum(label) * (sum(label) + 1) / 2) / (sum(label) * sum(1 - label)) AS roc FROM ranked GROUP BY 1)
SELECT {_ROUNDED.replace('model_id', 'sweep.model_id', 1)}, round(roc, 9) AS roc FROM sweep JOIN a ON a.model_id = sweep.model_id""",
)
def fine_sweep(spark, folder):
    return s.rounded(metrics.sweep_with_auc(s.scored(spark, folder), ["model_id"], metrics.CUTOFFS_1), 9)


@query(
    "g2_best_cutoff",
    f"""
WITH {_sweep('0.01e0', 99)}, d AS (SELECT model_id, cutoff, round(dist, 12) AS dist FROM sweep)
SELECT model_id, round(avg(cutoff), 9) AS best_cutoff, round(min(dist), 9) AS dist FROM d WHERE dist = (SELECT min(dist) FROM d d2 WHERE d2.model_id = d.model_id) GROUP BY 1""",
)
def best_cutoff(spark, folder):
    sw = metrics.cutoff_sweep(s.scored(spark, folder), ["model_id"], metrics.CUTOFFS_1)
    return s.rounded(metrics.best_cutoff(sw, ["model_id"]), 9)


@query(
    "g3_nearest_threshold",
    f"""
WITH {_POINTS}
SELECT model_id, subset, threshold, round(tpr, 9) AS curve_tpr FROM points
QUALIFY row_number() OVER (PARTITION BY model_id, subset ORDER BY round(abs(tpr - 0.5e0), 12), fpr, tpr) = 1""",
)
def nearest(spark, folder):
    points = metrics.roc_points(s.scored(spark, folder), _KEYS)
    return s.rounded(metrics.threshold_for(points, _KEYS, F.lit(0.5)), 9)


_CONFUSION = f"""{s.SCORED},
four AS (
  SELECT model_id, subset, count(*) FILTER (WHERE prob > 0.6e0 AND label = 1) AS tp, count(*) FILTER (WHERE prob > 0.6e0 AND label = 0) AS fp,
         count(*) FILTER (WHERE prob <= 0.6e0 AND label = 1) AS fn, count(*) FILTER (WHERE prob <= 0.6e0 AND label = 0) AS tn FROM scored GROUP BY 1, 2),
m AS (
  SELECT *, tp + fp + fn + tn AS n, (tp + tn) / n AS accuracy, ((tp + fp) * (tp + fn) + (fn + tn) * (fp + tn)) / (n * n) AS chance,
         greatest(tp + fn, fp + tn) / n AS accuracy_null FROM four),
tail AS (
  SELECT model_id, subset, sum(exp(lgamma(n + 1) - lgamma(k + 1) - lgamma(n - k + 1) + k * ln(accuracy_null) + (n - k) * ln(1 - accuracy_null))) AS pvalue
  FROM (SELECT *, unnest(generate_series(tp + tn, n))::DOUBLE AS k FROM m) GROUP BY 1, 2)"""


@query(
    "j13_confusion_and_rates",
    f"""
WITH {_CONFUSION}
SELECT model_id, subset, tp, fp, fn, tn, round(accuracy, 9) AS accuracy, round((accuracy - chance) / (1 - chance), 9) AS kappa,
       round(tp / (tp + fn), 9) AS sensitivity, round(tn / (tn + fp), 9) AS specificity, round(tp / (tp + fp), 9) AS ppv, round(tn / (tn + fn), 9) AS npv,
       round(tp / (tp + fp), 9) AS precision, round(tp / (tp + fn), 9) AS recall, round(accuracy_null, 9) AS accuracy_null, round(pvalue, 6) AS accuracy_pvalue
FROM m JOIN tail USING (model_id, subset)""",
)
def confusion(spark, folder):
    out = metrics.confusion(s.scored(spark, folder), _KEYS, F.lit(0.6))
    return out.withColumns({c: F.round(c, 6 if c == "accuracy_pvalue" else 9) for c, t in out.dtypes if t == "double"})


_GRID_SIZE = 10_000
_CURVE = f"""{_POINTS},
xs AS (SELECT i AS grid, i / {_GRID_SIZE - 1} AS x FROM (SELECT unnest(generate_series(0, {_GRID_SIZE - 1})) AS i)),
near AS (
  SELECT model_id, subset, grid, x, max(fpr) FILTER (WHERE fpr <= x + 1e-12) AS af, max(tpr) FILTER (WHERE fpr <= x + 1e-12) AS at_, min(threshold) FILTER (WHERE fpr <= x + 1e-12) AS ah,
         min(fpr) FILTER (WHERE fpr > x + 1e-12) AS bf, min(tpr) FILTER (WHERE fpr > x + 1e-12) AS bt, max(threshold) FILTER (WHERE fpr > x + 1e-12) AS bh
  FROM points CROSS JOIN xs GROUP BY 1, 2, 3, 4),
filled AS (SELECT model_id, subset, grid, x, coalesce(af, 0) AS af, coalesce(at_, 0) AS at_, coalesce(ah, bh) AS ah, bf, bt, bh FROM near),
curve AS (
  SELECT model_id, subset, grid, x AS fpr, CASE WHEN grid = 0 THEN 0 WHEN bf IS NULL OR x <= af THEN at_ ELSE at_ + (bt - at_) * ((x - af) / (bf - af)) END AS tpr,
         CASE WHEN bf IS NULL OR x <= af THEN ah ELSE ah + (bh - ah) * ((x - af) / (bf - af)) END AS threshold FROM filled),
mean AS (
  SELECT model_id, grid, fpr, CASE WHEN grid = {_GRID_SIZE - 1} THEN 1 ELSE avg(tpr) END AS tpr, stddev_pop(tpr) AS tpr_sd, avg(threshold) AS threshold FROM curve GROUP BY 1, 2, 3)"""


_FOLD_AUC = """
SELECT model_id, subset, (sum(r) FILTER (WHERE label = 1) - sum(label) * (sum(label) + 1) / 2) / (sum(label) * sum(1 - label)) AS auc
FROM (SELECT *, (rank() OVER w + count(*) OVER (PARTITION BY model_id, subset, prob) / 2 - 0.5e0) AS r FROM scored WINDOW w AS (PARTITION BY model_id, subset ORDER BY prob))
GROUP BY 1, 2"""


def _mean(spark, folder):
    points = metrics.roc_points(s.scored(spark, folder), _KEYS)
    return metrics.mean_roc(points, ["model_id"], "subset", _GRID_SIZE)


@query(
    "j20_mean_roc_over_folds",
    f"WITH {_CURVE} SELECT model_id, grid, round(fpr, 9) AS fpr, round(tpr, 9) AS tpr, round(tpr_sd, 9) AS tpr_sd, round(threshold, 9) AS threshold FROM mean",
)
def mean_roc(spark, folder):
    return s.rounded(_mean(spark, folder), 9)


@query(
    "j20_mean_auc",
    f"""
WITH {_CURVE}
SELECT model_id, mean_auc, round(stddev_pop(auc), 6) AS auc_sd
FROM (SELECT model_id, round(sum(tpr * CASE WHEN grid IN (0, {_GRID_SIZE - 1}) THEN 0.5e0 ELSE 1 END) / {_GRID_SIZE - 1}, 6) AS mean_auc FROM mean GROUP BY 1)
JOIN ({_FOLD_AUC}) USING (model_id) GROUP BY 1, 2""",
)
def mean_auc(spark, folder):
    area = metrics.curve_area(_mean(spark, folder), ["model_id"], _GRID_SIZE)
    return s.rounded(area.join(metrics.auc_spread(s.scored(spark, folder), ["model_id"], "subset"), "model_id"))


@query(
    "j19_threshold_for_sensitivity",
    f"""
WITH {_CURVE}
SELECT model_id, round(threshold, 6) AS threshold, round(tpr, 6) AS curve_tpr FROM mean
QUALIFY row_number() OVER (PARTITION BY model_id ORDER BY round(abs(tpr - 0.8e0), 12), fpr) = 1""",
)
def threshold_for(spark, folder):
    return s.rounded(metrics.threshold_for(_mean(spark, folder), ["model_id"], F.lit(0.8)))


_TARGETS = metrics.sensitivity_targets()


@query(
    "j21_sensitivity_response",
    f"""
WITH {_CURVE},
picked AS (
  SELECT model_id, target, threshold FROM mean CROSS JOIN (SELECT unnest([{', '.join(f"CAST('{t!r}' AS DOUBLE)" for t in _TARGETS)}]) AS target)
  QUALIFY row_number() OVER (PARTITION BY model_id, target ORDER BY round(abs(tpr - target), 12), fpr) = 1)
SELECT p.model_id, round(target, 6) AS target, round(threshold, 6) AS threshold, round(sum((prob > threshold AND label = 1)::INTEGER) / sum(label), 6) AS tpr,
       round(sum(((prob > threshold) = (label = 1))::INTEGER) / count(*), 6) AS accuracy,
       round(sum((prob <= threshold AND label = 0)::INTEGER) / sum(1 - label), 6) AS tnr
FROM scored s JOIN picked p ON p.model_id = s.model_id GROUP BY p.model_id, p.target, threshold""",
)
def sensitivity(spark, folder):
    out = metrics.sensitivity_response(s.scored(spark, folder), _mean(spark, folder), ["model_id"], _TARGETS)
    return s.rounded(out)


# Demonstration coefficients on standardised predictors.
COEFFICIENTS = (
    ("dry", "temp", 0.8, 0.3),
    ("dry", "wspd", -0.5, 0.3),
    ("wet", "precip", 1.2, 0.2),
    ("wet", "temp", -0.3, 0.2),
    ("wind", "wspd", 0.9, 0.5),
)
INTERCEPTS = {"dry": -1.0, "wet": -1.5, "wind": 0.1}


def _gappy(h):
    """Hours whose wind reading is missing above 30 mph."""
    return h.withColumn("wspd", F.when(F.col("wspd") <= 30, F.col("wspd")))


def coefficients(h):
    """Coefficient rows with the mean and spread of the given hours."""
    cols = ["temp", "precip", "wspd"]
    stats = h.agg(*[f(c).alias(f"{n}_{c}") for c in cols for f, n in ((F.avg, "m"), (F.stddev_samp, "s"))])
    cut = {m: c for m, _, _, c in COEFFICIENTS}
    rows = [
        F.struct(F.lit(m).alias("model_id"), F.lit(k).alias("key"), F.col(f"m_{k}").alias("mean"), F.col(f"s_{k}").alias("sd"), F.lit(b).alias("coef"), F.lit(c).alias("cutoff"))
        for m, k, b, c in COEFFICIENTS
    ] + [
        F.struct(F.lit(m).alias("model_id"), F.lit("(Intercept)").alias("key"), F.lit(0.0).alias("mean"), F.lit(1.0).alias("sd"), F.lit(b).alias("coef"), F.lit(cut[m]).alias("cutoff"))
        for m, b in INTERCEPTS.items()
    ]
    return stats.select(F.inline(F.array(*rows)))


def score_sql(source):
    z = lambda c: f"(({c} - m_{c}) / s_{c})"
    stats = ", ".join(f"avg({c}) AS m_{c}, stddev_samp({c}) AS s_{c}" for c in ("temp", "precip", "wspd"))
    parts = []
    for m, b0 in INTERCEPTS.items():
        odds = f"{b0}e0 + " + " + ".join(f"({b}e0) * {z(k)}" for mm, k, b, _ in COEFFICIENTS if mm == m)
        cut = next(c for mm, _, _, c in COEFFICIENTS if mm == m)
        parts.append(f"SELECT series_id, hour, '{m}' AS name, 1 / (1 + exp(-({odds}))) AS prob, {cut}e0 AS cutoff FROM gappy, stats")
    return f"""gappy AS (SELECT series_id, hour, temp, precip, CASE WHEN wspd <= 30 THEN wspd END AS wspd FROM {source}),
stats AS (SELECT {stats} FROM gappy),
scores AS (SELECT *, prob > cutoff AS exceedance FROM ({' UNION ALL '.join(parts)}))"""


_H = f"{s.stamp('hour')} AS hour"
_SCORES = f"WITH {s.HOURS}, {score_sql('hours')} SELECT series_id, {_H}, name, round(prob, 9) AS prob, exceedance FROM scores"


def _hours(spark, folder):
    return _gappy(weather.hourly_from_observations(s.observations(spark, folder), s.SERIES, "ts", ["temp", "wspd"]))


@query("j16_score_many_models", _SCORES)
def score_many(spark, folder):
    h = _hours(spark, folder)
    out = models.score_many(h, coefficients(h), ["series_id", "hour"]).drop("predictors")
    return shown(out, 9)


@query("j16_score_by_coefficient_join", _SCORES)
def score_long(spark, folder):
    h = _hours(spark, folder)
    keys = ["temp", "precip", "wspd"]
    long = h.select("series_id", "hour", F.explode(F.create_map(*[x for k in keys for x in (F.lit(k), F.col(k))])).alias("key", "value"))
    return shown(models.score_long(long, coefficients(h), ["series_id", "hour"]).drop("predictors"), 9)


@query(
    "j17_range_audit",
    f"""
WITH {s.HOURS}, long AS (SELECT series_id, hour, key, value FROM (UNPIVOT (SELECT series_id, hour, temp, precip FROM hours) ON temp, precip INTO NAME key VALUE value)),
r AS (SELECT series_id, key, min(value) AS lo, max(value) AS hi FROM long WHERE hour < TIMESTAMP '2024-01-20' GROUP BY 1, 2)
SELECT l.series_id AS model_id, l.key, count(*) AS n, count(*) FILTER (WHERE value < lo) AS n_below, count(*) FILTER (WHERE value > hi) AS n_above
FROM long l JOIN r ON r.series_id = l.series_id AND r.key = l.key GROUP BY 1, 2""",
)
def range_audit(spark, folder):
    h = weather.hourly_from_observations(s.observations(spark, folder), s.SERIES, "ts", ["temp"])
    long = reshape.to_long(h.withColumnRenamed("series_id", "model_id"), ["model_id", "hour"], ["temp", "precip"])
    train = long.filter(F.col("hour") < F.lit("2024-01-20").cast("timestamp"))
    audit = models.range_audit(long, summaries.ranges(train, ["model_id", "key"]))
    return audit.groupBy("model_id", "key").agg(
        F.count(F.lit(1)).alias("n"), F.count_if("below").alias("n_below"), F.count_if("above").alias("n_above")
    )


@query(
    "j24_effect_curve",
    f"""
WITH {s.HOURS}, {score_sql('hours')},
x AS (SELECT i * 0.5e0 AS x FROM (SELECT unnest(generate_series(0, 100)) AS i)),
c AS (SELECT 'dry' AS model_id, -1e0 AS b0, 0.8e0 AS b UNION ALL SELECT 'wet', -1.5e0, -0.3e0)
SELECT model_id, x, round(b0 + b * ((x - m_temp) / s_temp), 6) AS log_odds, round(1 / (1 + exp(-(b0 + b * ((x - m_temp) / s_temp)))), 6) AS prob FROM c, x, stats""",
)
def effect(spark, folder):
    return s.rounded(models.effect_curve(coefficients(_hours(spark, folder)), "temp", 0.0, 50.0, 100))


def newton_sql(source: str, predictors, keys=("model_id",), weight="1e0", masks=None, steps=16):
    """CTEs of logistic fits on centred and scaled predictors, one per group of ``source``.

    ``fits``: the keys, n, pos, b0.. (the intercept last), e0.. (standard errors) and loglik of the groups
    whose last step moved nothing. Each step solves its system by elimination. ``masks`` names a 0/1 column per predictor that leaves it out.
    """
    p, k = len(predictors), ", ".join(keys)
    cols, size = range(p), p + 1
    on = masks or ["1e0"] * p
    z = [f"z{i}" for i in cols] + ["1e0"]
    b = ", ".join(f"b{i}" for i in range(size))
    eta = " + ".join(f"b{i} * {z[i]}" for i in range(size))
    zs = ", ".join(f"(x{i} - m{i}) / s{i} * g{i} AS z{i}" for i in cols)
    sql = f"""whole AS (
  SELECT {k}, label AS y, ({weight})::DOUBLE AS w, {", ".join(f"{c} AS x{i}, ({on[i]})::DOUBLE AS g{i}" for i, c in enumerate(predictors))} FROM {source}
  WHERE label IS NOT NULL AND {" AND ".join(f"{c} IS NOT NULL" for c in predictors)}),
mo AS (SELECT {k}, sum(w) AS n, sum(w * y) AS pos, {", ".join(f"avg(x{i}) AS m{i}, stddev_samp(x{i}) AS s{i}" for i in cols)} FROM whole GROUP BY {k}),
zs AS (SELECT {", ".join(f"whole.{c}" for c in keys)}, y, w, n, pos, {zs}, {", ".join(f"g{i}" for i in cols)} FROM whole JOIN mo USING ({k})),
t0 AS (SELECT {k}, n, pos, {", ".join(f"0e0 AS b{i}" for i in cols)}, ln(pos / (n - pos)) AS b{p} FROM mo)"""
    for step in range(steps):
        last = step == steps - 1
        free = [f"max(1 - g{i})" for i in cols] + ["0e0"]  # a predictor left out has a system of its own
        h = [
            f"sum(w * p * (1 - p) * {z[i]} * {z[j]})" + (f" + {free[i]}" if i == j else "") + f" AS a{i}_{j}" for i in range(size) for j in range(size)
        ]
        right = [f"sum(w * (y - p) * {z[i]}) AS a{i}_{size}" for i in range(size)]
        ident = [f"{1 if i == j else 0}e0 AS a{i}_{size + 1 + j}" for i in range(size) for j in range(size)] if last else []
        width = size + 1 + (size if last else 0)
        sql += f""",
e{step}_0 AS (
  SELECT {k}, n, pos, {b}, sum(w * (y * eta - ln(1 + exp(eta)))) AS loglik, {", ".join(h + right + ident)}
  FROM (SELECT *, 1 / (1 + exp(-eta)) AS p FROM (SELECT zs.*, {b}, {eta} AS eta FROM zs JOIN (SELECT {k}, {b} FROM t{step}) USING ({k}))) GROUP BY {k}, n, pos, {b})"""
        for i in range(size):
            rows = []
            for r in range(size):
                for c in range(width):
                    value = f"a{i}_{c} / a{i}_{i}" if r == i else f"a{r}_{c} - a{r}_{i} * a{i}_{c} / a{i}_{i}"
                    rows.append(f"{value} AS a{r}_{c}")
            sql += f""",
e{step}_{i + 1} AS (SELECT {k}, n, pos, {b}, loglik, {", ".join(rows)} FROM e{step}_{i})"""
        new = ", ".join(f"b{i} + a{i}_{size} AS b{i}" for i in range(size))
        if last:
            errors = ", ".join(f"sqrt(a{i}_{size + 1 + i}) AS e{i}" for i in range(size))
            sql += f""",
fits AS (SELECT {k}, n, pos, loglik, {new}, {errors} FROM e{step}_{size} WHERE greatest({", ".join(f"abs(a{i}_{size})" for i in range(size))}) < 1e-6)"""
        else:
            sql += f""",
t{step + 1} AS (SELECT {k}, n, pos, {new} FROM e{step}_{size})"""
    return sql


_NULL_DEVIANCE = "(-2 * (pos * ln(pos / n) + (n - pos) * ln(1 - pos / n)))"


def _screen_sql():
    return f"""{s.LABELLED},
long AS (SELECT model_id, key AS var, sqrt(round(value, 5)) AS x, label FROM (UNPIVOT labelled ON log_text, vowel_share, log_lines, digit_share INTO NAME key VALUE value)
  UNION ALL SELECT model_id, 'constant', 1e0, label FROM labelled UNION ALL SELECT 'POOR', 'log_text', log_text, label FROM labelled WHERE label = 1),
can AS (SELECT model_id, var FROM long GROUP BY 1, 2 HAVING stddev_samp(x) > 0 AND min(label) < max(label)),
fitted AS (SELECT * FROM long JOIN can USING (model_id, var)),
{newton_sql("fitted", ["x"], ("model_id", "var"), steps=25)},
ranked AS (SELECT *, (rank() OVER w + count(*) OVER (PARTITION BY model_id, var, x) / 2 - 0.5e0) AS r FROM fitted WINDOW w AS (PARTITION BY model_id, var ORDER BY x)),
a AS (SELECT model_id, var, (sum(r) FILTER (WHERE label = 1) - sum(label) * (sum(label) + 1) / 2) / (sum(label) * sum(1 - label)) AS auc FROM ranked GROUP BY 1, 2),
every AS (SELECT model_id, var, count(*) AS n_sample, avg(label) AS frac_exceed FROM long GROUP BY 1, 2),
scale AS (SELECT model_id, var, s0 FROM mo)
SELECT model_id, var, n_sample, round(frac_exceed, 6) AS frac_exceed, round(4 - 2 * loglik, 4) AS aic, round(b0 / s0, 4) AS slope,
       round(CASE WHEN b0 < 0 THEN 1 - auc WHEN b0 >= 0 THEN auc END, 6) AS auc, loglik IS NOT NULL AS converged
FROM every LEFT JOIN fits USING (model_id, var) LEFT JOIN scale USING (model_id, var) LEFT JOIN a USING (model_id, var)"""


@query("j23_univariate_screening", "WITH " + _screen_sql())
def screening(spark, folder):
    """All groups, two kinds without a fit among them: a constant variable and a class alone."""
    rows = materialize(s.labelled(spark, folder), "labelled")
    long = reshape.to_long(rows, ["model_id", "label"], s.FEATURES, "var", "value").withColumn("x", F.sqrt(F.round("value", 5))).drop("value")
    constant = rows.select("model_id", "label", F.lit("constant").alias("var"), F.lit(1.0).alias("x"))
    alone = rows.filter("label = 1").select(F.lit("POOR").alias("model_id"), "label", F.lit("log_text").alias("var"), F.col("log_text").alias("x"))
    fit = models.univariate_screen(long.unionByName(constant).unionByName(alone), ["model_id", "var"])
    out = s.rounded(fit.drop("intercept"), 6, "frac_exceed", "auc")
    return s.rounded(out, 4, "aic", "slope")


# ------------------------------------------------------------- fits


def _training(spark, folder, folds=10):
    """Labelled rows with split and folds, written once because every fit reads them again."""
    x = s.labelled(spark, folder)
    x = labels.stratified_split(x, ["label"], ["doc_id"], 0.75, 11)
    return materialize(labels.stratified_folds(x, ["label"], ["doc_id"], folds, 13), "training")


_SPLIT = f"""{s.LABELLED},
placed AS (SELECT *, row_number() OVER (PARTITION BY label ORDER BY md5(doc_id::VARCHAR || ':11'), doc_id) AS rn, count(*) OVER (PARTITION BY label) AS of_class FROM labelled),
rows_ AS (SELECT * EXCLUDE (rn, of_class), CASE WHEN rn <= ceil(round(of_class * 0.75e0, 9)) THEN 'train' ELSE 'test' END AS subset FROM placed),
train AS (SELECT *, 'documents' AS of_model FROM rows_ WHERE subset = 'train')"""


def _terms_sql(predictors, digits=6):
    """Coefficient rows of ``fits``."""
    each = " UNION ALL ".join(
        f"SELECT of_model AS model_id, '{t}' AS term, b{i} AS estimate, e{i} AS std_error FROM fits" for i, t in enumerate([*predictors, "(Intercept)"])
    )
    return f"SELECT model_id, term, round(estimate, {digits}) AS estimate, round(std_error, {digits}) AS std_error, round(estimate / std_error, {digits}) AS z_value FROM ({each})"


@query(
    "j4_glm_coefficients",
    f"""
WITH {_SPLIT}, {newton_sql("train", s.FEATURES, ("of_model",))}
SELECT terms.*, round(-2 * loglik + {2 * len(s.FEATURES) + 2}, 6) AS aic, round(-2 * loglik, 6) AS deviance, round({_NULL_DEVIANCE}, 6) AS null_deviance,
       round(1 + 2 * loglik / {_NULL_DEVIANCE}, 6) AS r2, {len(s.FEATURES)}e0 AS n_predictors
FROM ({_terms_sql(s.FEATURES)}) terms, fits""",
)
def glm(spark, folder):
    t = _training(spark, folder).filter("subset = 'train'")
    fit = models.fit_glm(t, s.FEATURES)
    table = models.coefficient_table(spark, "documents", fit)
    return s.rounded(table.withColumns({k: F.lit(v) for k, v in fit.figures.items()}))


@query("j5_elastic_net_tuning")
def elastic(spark, folder):
    return models.tuning_table(spark, models.elastic_net(_training(spark, folder), s.FEATURES))


@query("j6_random_forest_scores")
def forest(spark, folder):
    t = _training(spark, folder)
    m = models.random_forest(t.filter("subset = 'train'"), s.FEATURES)
    return models.score_with(m, t).select("doc_id", "subset", "label", "prob")


@query("j7_boosted_tree_scores")
def boosted(spark, folder):
    t = _training(spark, folder)
    m = models.boosted_trees(t.filter("subset = 'train'"), s.FEATURES)
    return models.score_with(m, t).select("doc_id", "subset", "label", "prob")


def _forward_sql():
    """All sets of predictors are fitted, then the path is walked through them."""
    n = len(s.FEATURES)
    bits = [f"(mask >> {i}) & 1" for i in range(n)]
    walk = f"""w0 AS (SELECT 0 AS mask, {_NULL_DEVIANCE} + 2 AS aic, '(none)' AS term, 0 AS step FROM (SELECT sum(label) AS pos, count(*)::DOUBLE AS n FROM train))"""
    for k in range(n):
        term = " ".join(f"WHEN c.mask - w.mask = {1 << i} THEN '{f}'" for i, f in enumerate(s.FEATURES))
        walk += f""",
w{k + 1} AS (
  SELECT c.mask, c.aic, CASE {term} END AS term, {k + 1} AS step FROM aics c JOIN w{k} w ON (c.mask & w.mask) = w.mask AND c.size = {k + 1} AND c.aic < w.aic
  ORDER BY round(c.aic, 9), c.mask LIMIT 1)"""
    every = " UNION ALL ".join(f"SELECT step, term, aic FROM w{k}" for k in range(n + 1))
    return f"""
WITH {_SPLIT},
sets AS (SELECT train.*, mask FROM train, (SELECT unnest(generate_series(1, {2**n - 1}))::INTEGER AS mask)),
{newton_sql("sets", s.FEATURES, ("mask",), masks=bits)},
aics AS (SELECT mask, bit_count(mask) AS size, -2 * loglik + 2 * bit_count(mask) + 2 AS aic FROM fits),
{walk}
SELECT step::INTEGER AS step, term, round(aic, 6) AS aic FROM ({every})"""


@query("j8_forward_selection_path", _forward_sql())
def forward(spark, folder):
    t = _training(spark, folder).filter("subset = 'train'")
    _, path = models.forward_selection(t, s.FEATURES)
    return s.rounded(spark.createDataFrame([(i, t, float(a)) for i, t, a in path], "step int, term string, aic double"))


@query("j9_penalty_path")
def penalty(spark, folder):
    return models.tuning_table(spark, models.ridge_path(_training(spark, folder, 7), s.FEATURES))


_REPEATS, _FOLDS = 3, 10
_RESAMPLES = f"""{s.LABELLED},
folded AS ({" UNION ALL ".join(
    f"SELECT *, {r} AS rep, ((row_number() OVER (PARTITION BY label ORDER BY md5(doc_id::VARCHAR || ':{5 + r}'), doc_id) - 1) % {_FOLDS})::INTEGER AS fold FROM labelled"
    for r in range(1, _REPEATS + 1))}),
fitted AS (SELECT f.*, k FROM folded f JOIN (SELECT unnest(generate_series(0, {_FOLDS - 1}))::INTEGER AS k) ON fold <> k)"""


@query(
    "j10_repeated_cv_metrics",
    f"""
WITH {_RESAMPLES}, {newton_sql("fitted", s.FEATURES, ("rep", "k"))},
scored AS (
  SELECT f.rep, f.k, label, 1 / (1 + exp(-({" + ".join(f"b{i} * (({c} - m{i}) / s{i})" for i, c in enumerate(s.FEATURES))} + b{len(s.FEATURES)}))) AS prob
  FROM folded d JOIN fits f ON f.rep = d.rep AND f.k = d.fold JOIN mo ON mo.rep = f.rep AND mo.k = f.k),
ranked AS (SELECT *, rank() OVER (PARTITION BY rep, k ORDER BY prob) + count(*) OVER (PARTITION BY rep, k, prob) / 2 - 0.5e0 AS r FROM scored)
SELECT 'Fold' || lpad((k + 1)::VARCHAR, 2, '0') || '.Rep' || rep AS resample,
       round((sum(r) FILTER (WHERE label = 1) - sum(label) * (sum(label) + 1) / 2) / (sum(label) * sum(1 - label)), 6) AS roc,
       round(count(*) FILTER (WHERE prob > 0.2e0 AND label = 1) / sum(label), 6) AS sens, round(count(*) FILTER (WHERE prob <= 0.2e0 AND label = 0) / sum(1 - label), 6) AS spec
FROM ranked GROUP BY rep, k""",
)
def repeated(spark, folder):
    x = materialize(models.repeated_folds(s.labelled(spark, folder), ["label"], ["doc_id"], _FOLDS, _REPEATS, 5), "repeats")
    scored = models.held_out_scores(x, s.FEATURES, [f"fold_{r}" for r in range(1, _REPEATS + 1)], _FOLDS)
    return s.rounded(models.resample_metrics(materialize(scored, "held-out"), "resample"))


def _board(spark, folder):
    t = _training(spark, folder)
    train = t.filter("subset = 'train'")
    sets = {"all": s.FEATURES, "some": s.FEATURES[:2]}
    fitted = {(name, learner): m for name, cols in sets.items() for learner, m in models.train_learners(train, cols, "fold", 10).items()}
    return models.score_learners(t, fitted, ["doc_id", "subset", "label"])


@query("j14_leaderboard")
def leaderboard(spark, folder):
    return models.leaderboard(materialize(_board(spark, folder), "board"), ["predictor_set", "model_name"], cutoff=models.CUTOFF)


_RATES = ("accuracy", "kappa", "sensitivity", "specificity", "ppv", "npv", "accuracy_null", "accuracy_pvalue")


def _final_sql():
    figures = ["auc", *_RATES]
    wide = ", ".join(
        f"max(CASE WHEN subset = '{t}' THEN {f} END) AS {f}_{t}" for f in figures for t in ("train", "test")
    )
    shown = ", ".join(f"round({f}_{t}, {6 if f == 'accuracy_pvalue' else 9}) AS {f}_{t}" for f in figures for t in ("train", "test"))
    odds = " + ".join(f"b{i} * (({c} - m{i}) / s{i})" for i, c in enumerate(s.FEATURES))
    return f"""
WITH {_SPLIT}, {newton_sql("train", s.FEATURES)},
scored AS (SELECT r.model_id, subset, label, 1 / (1 + exp(-({odds} + b{len(s.FEATURES)}))) AS prob FROM rows_ r JOIN fits USING (model_id) JOIN mo USING (model_id)),
ranked AS (SELECT *, rank() OVER (PARTITION BY model_id, subset ORDER BY prob) + count(*) OVER (PARTITION BY model_id, subset, prob) / 2 - 0.5e0 AS r FROM scored),
four AS (
  SELECT model_id, subset, (sum(r) FILTER (WHERE label = 1) - sum(label) * (sum(label) + 1) / 2) / (sum(label) * sum(1 - label)) AS auc,
         count(*) FILTER (WHERE prob > 0.2e0 AND label = 1) AS tp, count(*) FILTER (WHERE prob > 0.2e0 AND label = 0) AS fp,
         count(*) FILTER (WHERE prob <= 0.2e0 AND label = 1) AS fn, count(*) FILTER (WHERE prob <= 0.2e0 AND label = 0) AS tn FROM ranked GROUP BY 1, 2),
m0 AS (
  SELECT *, tp + fp + fn + tn AS cnt, (tp + tn) / cnt AS accuracy, ((tp + fp) * (tp + fn) + (fn + tn) * (fp + tn)) / (cnt * cnt) AS chance,
         greatest(tp + fn, fp + tn) / cnt AS accuracy_null FROM four),
tail AS (
  SELECT model_id, subset, sum(exp(lgamma(cnt + 1) - lgamma(k + 1) - lgamma(cnt - k + 1) + k * ln(accuracy_null) + (cnt - k) * ln(1 - accuracy_null))) AS accuracy_pvalue
  FROM (SELECT *, unnest(generate_series(tp + tn, cnt))::DOUBLE AS k FROM m0) GROUP BY 1, 2),
m AS (
  SELECT *, CASE WHEN chance < 1 THEN (accuracy - chance) / (1 - chance) END AS kappa, CASE WHEN tp + fn > 0 THEN tp / (tp + fn) END AS sensitivity, CASE WHEN tn + fp > 0 THEN tn / (tn + fp) END AS specificity,
         CASE WHEN tp + fp > 0 THEN tp / (tp + fp) END AS ppv, CASE WHEN tn + fn > 0 THEN tn / (tn + fn) END AS npv FROM m0 JOIN tail USING (model_id, subset)),
wide AS (SELECT model_id, {wide} FROM m GROUP BY 1),
base AS (SELECT model_id, count(*) AS n_sample, avg(label) AS freq_exceedance FROM rows_ GROUP BY 1)
SELECT model_id, n_sample, round(freq_exceedance, 9) AS freq_exceedance, round(-2 * loglik + {2 * len(s.FEATURES) + 2}, 6) AS aic, round(-2 * loglik, 6) AS deviance,
       round({_NULL_DEVIANCE}, 6) AS null_deviance, round(1 + 2 * loglik / {_NULL_DEVIANCE}, 6) AS r2, CASE WHEN loglik IS NOT NULL THEN {len(s.FEATURES)} END::INTEGER AS n_predictors,
       round((auc_test - auc_train) / 2, 9) AS auc_diff, round((auc_test + auc_train) / 2, 9) AS auc_mean, {shown}, 0.2e0 AS cutoff,
       coalesce(accuracy_test > 0.8e0, FALSE) AND coalesce(sensitivity_test > 0.5e0, FALSE) AND coalesce(specificity_test > 0.85e0, FALSE) AS accepted
FROM base LEFT JOIN fits USING (model_id) LEFT JOIN wide USING (model_id)"""


@query("j15_final_model_table", _final_sql())
def final(spark, folder):
    t = _training(spark, folder)
    names = [r["model_id"] for r in t.select("model_id").distinct().orderBy("model_id").collect()]
    flags = {f"_is_{i}": (F.col("model_id") == m) & (F.col("subset") == "train") for i, m in enumerate(names)}
    specs = [newton.Spec((m,), tuple(s.FEATURES), f"_is_{i}") for i, m in enumerate(names)]
    fits = newton.fit_many(t.withColumns(flags), specs)
    figures = [(f.spec.name[0], f.aic, f.deviance, f.null_deviance, 1 - f.deviance / f.null_deviance, len(s.FEATURES)) for f in fits if f.converged]
    odds = F.lit(None).cast("double")
    for f in fits:
        if f.converged:
            odds = F.when(F.col("model_id") == f.spec.name[0], f.log_odds()).otherwise(odds)
    scored = materialize(t.select("model_id", "subset", "label", sigmoid(odds).alias("prob")), "final-scores")
    schema = "model_id string, aic double, deviance double, null_deviance double, r2 double, n_predictors int"
    out = models.final_table(t, scored, spark.createDataFrame(figures, schema))
    coarse = {"aic", "deviance", "null_deviance", "r2", "accuracy_pvalue_train", "accuracy_pvalue_test"}
    return out.withColumns({c: F.round(c, 6 if c in coarse else 9) + F.lit(0.0) for c, k in out.dtypes if k == "double" and c != "cutoff"})


@query("j18_variable_importance")
def importance(spark, folder):
    t = _training(spark, folder).filter("subset = 'train'")
    glm_rows = models.importance(spark, "glm", models.fit_glm(t, s.FEATURES))
    return glm_rows.unionByName(models.tree_importance(spark, "rf", models.random_forest(t, s.FEATURES)))


@query(
    "j26_weighted_fit",
    f"""
WITH {_SPLIT}, sizes AS (SELECT label, count(*) AS n_class FROM rows_ GROUP BY 1),
weighted AS (SELECT 'weighted' AS of_model, rows_.*, 0.5e0 / n_class AS wt FROM rows_ JOIN sizes USING (label)),
{newton_sql("weighted", s.FEATURES, ("of_model",), "wt")}
{_terms_sql(s.FEATURES)}""",
)
def weighted(spark, folder):
    t = summaries.class_weights(_training(spark, folder), [], "label")
    return s.rounded(models.coefficient_table(spark, "weighted", models.fit_glm(t, s.FEATURES, weight="weight")))


@query(
    "a14_model_save_and_load",
    f"""
WITH {_SPLIT}, {newton_sql("train", s.FEATURES, ("of_model",))}
SELECT doc_id, round(1 / (1 + exp(-({" + ".join(f"b{i} * (({c} - m{i}) / s{i})" for i, c in enumerate(s.FEATURES))} + b{len(s.FEATURES)}))), 6) AS prob,
       'documents' AS model_id, 0.2e0 AS cutoff, round(-2 * loglik + {2 * len(s.FEATURES) + 2}, 6) AS aic
FROM rows_, fits, mo""",
)
def save_load(spark, folder):
    t = _training(spark, folder)
    fit = models.fit_glm(t.filter("subset = 'train'"), s.FEATURES)
    info = spark.createDataFrame([("documents", 0.2, fit.figures["aic"])], "model_id string, cutoff double, aic double")
    path = scratch_dir(spark, "model")
    model_files.save_model(fit.model, path, info.withColumn("version", model_files.version_id("model_id", F.col("aic").cast("string"))))
    loaded, back = model_files.load_model(spark, path)
    scored = models.score_with(loaded, t).select("doc_id", "prob").crossJoin(F.broadcast(back.limit(1).drop("version")))
    return s.rounded(scored, 6, "prob", "aic")
