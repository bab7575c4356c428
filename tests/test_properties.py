"""Operators against brute force or independent computations, also on skewed input."""

import math
import random
from datetime import datetime, timedelta

import numpy as np
import pytest
from pyspark.sql import functions as F

from hydrosignal.operators import joins, labels, metrics, models, newton, ordered, reshape, rolling, status, summaries
from hydrosignal.operators.attach import attach
from hydrosignal.plans import scoring
from hydrosignal.sources import files, gated, keyed, payloads

START = datetime(2024, 1, 1)


@pytest.fixture(scope="module")
def skewed(spark):
    """Two thirds of the rows on one key."""
    rnd = random.Random(3)
    rows = [
        ("hot" if rnd.random() < 0.67 else f"k{rnd.randrange(4)}", i, START + timedelta(minutes=rnd.randrange(20_000)), round(rnd.random(), 2), int(rnd.random() < 0.3))
        for i in range(1500)
    ]
    return rows, spark.createDataFrame(rows, "key string, id long, t timestamp, prob double, label int").cache()


def test_running_totals_match_plain_order(spark, skewed):
    rows, df = skewed
    part = ordered.time_part(F.col("t"), 3600)
    got = {r["id"]: r["n"] for r in ordered.running_totals(df, ["key"], part, [F.col("t"), F.col("id")], {"n": F.col("id")}).collect()}
    totals = {}
    for k, i, t, _, _ in sorted(rows, key=lambda r: (r[2], r[1])):
        totals[k] = totals.get(k, 0) + i
        assert got[i] == totals[k]


def test_hash_rank_is_a_permutation_per_group(skewed):
    rows, df = skewed
    got = ordered.hash_rank(df, ["key"], ["id"], 5).collect()
    for k in {r[0] for r in rows}:
        ranks = sorted(r["rank"] for r in got if r["key"] == k)
        assert ranks == list(range(1, len(ranks) + 1))


def test_split_is_exact_and_repeatable(skewed):
    rows, df = skewed
    once = {r["id"]: r["subset"] for r in labels.stratified_split(df, ["key", "label"], ["id"], 0.75, 9).collect()}
    again = {r["id"]: r["subset"] for r in labels.stratified_split(df.repartition(7), ["key", "label"], ["id"], 0.75, 9).collect()}
    assert once == again
    for g in {(r[0], r[4]) for r in rows}:
        ids = [r[1] for r in rows if (r[0], r[4]) == g]
        assert sum(once[i] == "train" for i in ids) == math.ceil(0.75 * len(ids))


def test_folds_are_balanced(skewed):
    _, df = skewed
    sizes = labels.stratified_folds(df, ["label"], ["id"], 10, 1).groupBy("label", "fold").count().collect()
    for y in (0, 1):
        n = [r["count"] for r in sizes if r["label"] == y]
        assert len(n) == 10 and max(n) - min(n) <= 1


def test_balanced_samples(skewed):
    rows, df = skewed
    n = [sum(r[4] == y for r in rows) for y in (0, 1)]
    down = labels.down_sample(df, [], "label", ["id"]).groupBy("label").count().collect()
    up = labels.up_sample(df, [], "label", ["id"]).groupBy("label").count().collect()
    assert {r["count"] for r in down} == {min(n)} and {r["count"] for r in up} == {max(n)}


def test_asof_join_matches_scan(spark, skewed):
    rows, df = skewed
    rnd = random.Random(8)
    asks = [(k, START + timedelta(minutes=rnd.randrange(-50, 21_000)), n) for n, k in enumerate(["hot", "k1", "none"] * 60)]
    left = spark.createDataFrame(asks, "key string, asked timestamp, n int")
    got = {r["n"]: r["id"] for r in joins.asof_join(left, df, ["key"], "asked", "t", ["id"], ["id"]).collect()}
    assert len(got) == len(asks)
    for k, at, n in asks:
        seen = [(t, i) for kk, i, t, _, _ in rows if kk == k and t <= at]
        assert got[n] == (max(seen)[1] if seen else None)


def test_range_sums_match_scan(spark, skewed):
    rows, df = skewed
    edges = (0, 6, 30)
    got = joins.range_sums(df, df, ["key"], "t", "t", "prob", edges, part_seconds=5 * 3600).collect()
    for r in random.Random(1).sample(got, 80):
        for a, b in zip(edges, edges[1:]):
            want = sum(p for k, _, t, p, _ in rows if k == r["key"] and r["t"] - timedelta(hours=b) <= t < r["t"] - timedelta(hours=a))
            assert r[f"precip_{a}_{b}"] == pytest.approx(want, abs=1e-7)


def most_rows(df) -> int:
    """The most rows that a node of the plan hands on."""

    def walk(node) -> int:
        if node.nodeName().startswith("AdaptiveSparkPlan"):
            return walk(node.executedPlan())
        if "QueryStage" in node.nodeName():
            return walk(node.plan())
        made, below = node.metrics().get("numOutputRows"), node.children()
        return max([made.get().value() if made.isDefined() else 0, *[walk(below.apply(i)) for i in range(below.size())]])

    df.collect()
    return walk(df._jdf.queryExecution().executedPlan())


def test_range_sums_do_not_repeat_points(spark):
    rnd, edges = random.Random(4), (0, 12, 24, 48, 72, 96, 120)
    rain = [("a", START + timedelta(hours=i), rnd.choice([0.0, 0.25, None, 1.5])) for i in range(0, 96, 6)]
    rain += [("b", START, float("inf")), ("b", START + timedelta(hours=1), -2.0), (None, START, 1.0), ("a", None, 7.0)]
    points = [(k, START + timedelta(minutes=30 * i)) for k in "ab" for i in range(400)] + [("c", START), ("b", None)]
    p, r = spark.createDataFrame(points * 2, "key string, t timestamp"), spark.createDataFrame(rain, "key string, t timestamp, v double")
    out = joins.range_sums(p, r, ["key"], "t", "t", "v", edges)
    got = {(x["key"], x["t"]): x for x in out.collect()}
    assert out.count() == len(got) == 801 and ("b", None) not in got
    for (k, at), x in got.items():
        for a, b in zip(edges, edges[1:]):
            seen = [v for key, t, v in rain if key == k and t and at - timedelta(hours=b) <= t < at - timedelta(hours=a) and v is not None]
            if float("inf") in seen:
                assert math.isnan(x[f"precip_{a}_{b}"])
            else:
                assert x[f"precip_{a}_{b}"] == sum(seen)
    assert most_rows(out) <= 2 * len(points) + len(edges) * len(rain)  # before the points are distinct


def test_quantiles_match_numpy(skewed):
    rows, df = skewed
    got = {r["key"]: r for r in ordered.quantiles(df, ["key"], "prob", {"a": 0.25, "b": 0.5, "c": 0.9}).collect()}
    for k, r in got.items():
        want = np.quantile([x[3] for x in rows if x[0] == k], [0.25, 0.5, 0.9])
        assert [r["a"], r["b"], r["c"]] == pytest.approx(list(want))


def test_auc_matches_pairs(skewed):
    rows, df = skewed
    got = {r["key"]: r["auc"] for r in metrics.auc(df, ["key"]).collect()}
    for k, value in got.items():
        pos = [r[3] for r in rows if r[0] == k and r[4] == 1]
        neg = [r[3] for r in rows if r[0] == k and r[4] == 0]
        want = sum((p > n) + 0.5 * (p == n) for p in pos for n in neg) / (len(pos) * len(neg))
        assert value == pytest.approx(want)


def test_mean_roc_matches_interp(skewed):
    _, df = skewed
    points = metrics.roc_points(df, ["key"]).filter("key = 'hot'")
    grid = metrics.on_fpr_grid(points, ["key"], 101).orderBy("grid").collect()
    p = points.orderBy(F.col("threshold").desc()).collect()
    want = np.interp(np.linspace(0, 1, 101), [0.0, *[r["fpr"] for r in p]], [0.0, *[r["tpr"] for r in p]])
    want[0] = 0.0
    assert [r["grid"] for r in grid] == list(range(101))
    assert [r["tpr"] for r in grid] == pytest.approx(list(want), abs=1e-9)


@pytest.mark.parametrize("x,n,p", [(80, 100, 0.7), (3, 5, 0.9), (100, 100, 0.5), (0, 9, 0.4), (640, 1000, 0.6)])
def test_binomial_tail(x, n, p):
    want = sum(math.comb(n, k) * p**k * (1 - p) ** (n - k) for k in range(x, n + 1))
    assert metrics._upper_tail(float(x), float(n), p) == pytest.approx(want, rel=1e-9)


def test_rolling_in_parts_equals_whole(spark):
    rnd = random.Random(2)
    rows = [("a", START + timedelta(hours=i), round(rnd.random() * (rnd.random() < 0.3), 2)) for i in range(400)]
    df = spark.createDataFrame(rows, "s string, hour timestamp, precip double")
    feature = lambda d, k: rolling.antecedent(d, k, "hour", widths=(24, 48), lag_hours=(0, 24))
    whole = feature(df, ["s"]).orderBy("hour").collect()
    parts = rolling.in_time_parts(df, ["s"], "hour", 90 * 3600, 72 * 3600, feature).select(*whole[0].__fields__).orderBy("hour").collect()
    assert whole == parts
    both = [r for r in whole if r["hour"] >= START + timedelta(hours=48)]
    assert all(abs(r["precip_sum_p24hr_lag0hr"] + r["precip_sum_p24hr_lag24hr"] - r["precip_sum_p48hr_lag0hr"]) < 1e-7 for r in both)


def _irls(x, y, w=None):
    x = np.column_stack([np.ones(len(y)), x])
    w = np.ones(len(y)) if w is None else w
    b = np.zeros(x.shape[1])
    for _ in range(50):
        p = 1 / (1 + np.exp(-x @ b))
        b = b + np.linalg.solve((x * (w * p * (1 - p))[:, None]).T @ x, x.T @ (w * (y - p)))
    p = 1 / (1 + np.exp(-x @ b))
    return b, -2 * np.sum(w * (y * np.log(p) + (1 - y) * np.log(1 - p)))


@pytest.fixture(scope="module")
def fit_rows(spark):
    rng = np.random.default_rng(4)
    x = rng.normal(size=(400, 2))
    y = (rng.random(400) < 1 / (1 + np.exp(-(0.5 + x[:, 0] - 0.7 * x[:, 1])))).astype(float)
    df = spark.createDataFrame([(i, float(a), float(b), float(c)) for i, ((a, b), c) in enumerate(zip(x, y))], "id long, x1 double, x2 double, label double")
    return x, y, df.cache()


def test_glm_matches_newton(fit_rows):
    x, y, df = fit_rows
    z = (x - x.mean(0)) / x.std(0, ddof=1)
    b, dev = _irls(z, y)
    fit = models.fit_glm(df, ["x1", "x2"])
    est = {n: v for n, v, _ in fit.coefficients}
    assert [est["(Intercept)"], est["x1"], est["x2"]] == pytest.approx(list(b), abs=1e-5)
    assert fit.figures["deviance"] == pytest.approx(dev, rel=1e-8)
    assert fit.figures["aic"] == pytest.approx(dev + 6, rel=1e-8)


def test_scoring_keeps_rows_with_missing_predictors(fit_rows):
    _, _, df = fit_rows
    fit = models.fit_glm(df, ["x1", "x2"])
    gappy = df.withColumn("x2", F.when(F.col("id") % 4 > 0, F.col("x2")))
    out = fit.score(gappy)
    assert out.count() == 400 and out.filter("prob is null").count() == 100


def test_weighted_fit_matches_newton(fit_rows):
    x, y, df = fit_rows
    w = np.where(y == 1, 0.5 / y.sum(), 0.5 / (1 - y).sum()) * 400
    weighted = summaries.class_weights(df, [], "label").withColumn("weight", F.col("weight") * 400)
    z = (x[:, :1] - x[:, :1].mean(0)) / x[:, :1].std(0, ddof=1)
    b, _ = _irls(z, y, w)
    est = {n: v for n, v, _ in models.fit_glm(weighted, ["x1"], weight="weight").coefficients}
    assert [est["(Intercept)"], est["x1"]] == pytest.approx(list(b), abs=1e-3)


def test_univariate_screen_matches_newton(fit_rows):
    x, y, df = fit_rows
    long = df.unpivot(["label"], ["x1", "x2"], "var", "x")
    got = {r["var"]: r for r in models.univariate_screen(long, ["var"]).collect()}
    for i, v in enumerate(("x1", "x2")):
        b, dev = _irls(x[:, i : i + 1], y)
        assert got[v]["aic"] == pytest.approx(dev + 4, rel=1e-8)
        assert [got[v]["intercept"], got[v]["slope"]] == pytest.approx(list(b), abs=1e-6)
        assert got[v]["auc"] > 0.5


def test_forward_selection_takes_both(fit_rows):
    _, _, df = fit_rows
    best, path = models.forward_selection(df, ["x2", "x1"])
    assert sorted(best.predictors) == ["x1", "x2"] and [p[0] for p in path] == [0, 1, 2]


def test_changes_after_delete_do_not_revive(spark):
    base = spark.createDataFrame([(1, "a"), (2, "b"), (4, "d")], "id int, v string")
    log = spark.createDataFrame(
        [(1, 1, "delete", None), (1, 2, "update", "x"), (2, 1, "update", "y"), (3, 1, "update", "z"), (5, 1, "insert", "e"), (4, 1, "delete", None), (4, 2, "insert", "n")],
        "id int, version int, op string, v string",
    )
    got = {r["id"]: r["v"] for r in keyed.apply_changes(base, log, "id", "version").collect()}
    assert got == {2: "y", 4: "n", 5: "e"}


def test_upsert_last_delivery_wins(spark):
    old = spark.createDataFrame([("d1", "old", 0), ("d2", "old", 0)], "date string, json string, seq int")
    new = spark.createDataFrame([("d2", "n1", 1), ("d2", "n2", 2), ("d3", "n3", 1)], "date string, json string, seq int")
    got = {r["date"]: r["json"] for r in keyed.upsert(old, new, ["date"], [F.col("seq").desc()]).collect()}
    assert got == {"d1": "old", "d2": "n2", "d3": "n3"}


def test_empty_and_odd_documents(spark):
    docs = spark.createDataFrame(
        [("2024-01-01", '{"history":{"observations":[]}}'), ("2024-01-02", '{"other":1}')], "date string, json string"
    )
    assert payloads.weather_observations(docs).count() == 0
    flow = spark.createDataFrame([('{"value":{"timeSeries":[]}}',), ("{}",)], "json string")
    assert payloads.daily_flow(flow).count() == 0


def test_text_payload_of_any_width_and_with_quoted_line_breaks(spark):
    names = ",".join(f"c{i}" for i in range(80))
    body = f"x\nraw_text,{names}\n\n\"a \"\"b\"\",\nc\"," + ",".join(map(str, range(80))) + "\nv,,1\r\n"
    texts = spark.createDataFrame([("p", body), ("q", "no header")], "path string, value string")
    rows, rejected = payloads.preamble_csv(texts, "raw_text string, c0 int, c1 int, c79 int")
    assert sorted(map(tuple, rows.collect())) == [("p", 'a "b",\nc', 0, 1, 79), ("p", "v", None, 1, None)]
    assert [r.path for r in rejected.collect()] == ["q"]


def test_standardize_keeps_rows_with_nulls(spark):
    df = spark.createDataFrame([(1, 1.0, 5.0), (2, 3.0, 5.0), (3, None, 5.0), (4, 2.0, None)], "k int, a double, b double")
    got = {r.k: (r.a_z, r.b_z) for r in models.standardize(df, df, ["a", "b"]).collect()}
    assert got[1] == (pytest.approx(-(0.5**0.5)), 0.0) and got[3] == (None, 0.0) and got[4] == (0.0, None)


def test_antecedent_sums_of_coprime_widths(spark):
    df = spark.range(200).selectExpr("1 AS k", "id AS t", "CAST(id % 7 AS double) AS precip")
    got = rolling.antecedent(df, ["k"], "t", widths=(7, 61), lag_hours=(0, 3)).orderBy("t").collect()
    for r in got:
        for width in (7, 61):
            for lag in (0, 3):
                end = r.t - lag
                want = sum(i % 7 for i in range(end - width + 1, end + 1)) if end >= width - 1 else 0
                assert r[f"precip_sum_p{width}hr_lag{lag}hr"] == want


def test_levels_without_limit(spark):
    assert len(reshape.levels_of(spark.range(1001).selectExpr("CAST(id AS string) AS s"), "s")) == 1001


def test_date_conditions_take_every_row_once(spark):
    df = spark.createDataFrame([("2023-12-31",), ("2024-01-01",), ("2024-01-02",), ("2024-02-01",), (None,)], "d string")
    found = [df.filter(c).count() for c in files.date_predicates("d", ["2024-01-02", "2024-01-01"])]
    assert found == [2, 1, 2]


def test_attach_agrees_on_both_ways(spark):
    facts = spark.createDataFrame([(i, i % 3 if i % 5 else None) for i in range(60)], "i int, g int")
    small = facts.groupBy("g").agg(F.count("i").alias("n")).filter("g IS NULL OR g > 0")
    ways = [sorted(map(tuple, attach(facts, small, ["g"], limit=n).collect()), key=repr) for n in (100, 0)]
    assert ways[0] == ways[1] and len(ways[0]) == 60 and sum(r[2] is None for r in ways[0]) == 16


def test_what_is_too_large_to_attach_by_broadcast_is_not_broadcast(spark):
    facts = spark.createDataFrame([(i, i % 3 if i % 5 else None) for i in range(60)], "i int, g int")
    small = facts.groupBy("g").agg(F.count("i").alias("n"))
    for how in ("left", "inner"):
        out = attach(facts, small, ["g"], how, limit=0)
        assert out.count() == 60
        assert "Broadcast" not in out._jdf.queryExecution().executedPlan().toString()


def test_sparse_dummies_of_more_levels_than_a_broadcast_takes(spark, monkeypatch):
    monkeypatch.setattr(reshape, "attach", lambda df, small, keys: attach(df, small, keys, limit=10))
    df = spark.range(500).select("id", F.when(F.col("id") % 5 > 0, F.col("id") % 100).alias("c"))
    out = reshape.sparse_dummies(df, "c").select("id", "c", "c_level.size", F.col("c_level.indices")[0].alias("i"))
    assert "Broadcast" not in out._jdf.queryExecution().executedPlan().toString()
    rows = out.collect()
    assert sorted(r["id"] for r in rows) == list(range(500)) and {r["size"] for r in rows} == {81}
    assert {r["i"] for r in rows if r["c"] is None} == {80}
    places = {(r["c"], r["i"]) for r in rows if r["c"] is not None}
    assert len(places) == 80 and {i for _, i in places} == set(range(80))


def test_require_fails_only_on_violations(spark):
    df = spark.createDataFrame([(1, 2.0), (2, None)], "k int, x double")
    bad = summaries.null_violations(df, ["k"], ["x"])
    assert summaries.require(bad.filter("k = 1"), "nulls").count() == 0
    with pytest.raises(Exception, match="nulls"):
        summaries.require(bad, "nulls").collect()


def test_large_early_total_costs_later_bins_no_digits(spark):
    at = F.lit("2024-01-01").cast("timestamp")
    hour = F.make_dt_interval(hours=F.col("id").cast("int"))
    rain = spark.range(200).select(
        F.lit("a").alias("key"), (at + hour).alias("t"), F.when(F.col("id") == 0, 1e10).otherwise(0.01).alias("v")
    )
    point = spark.range(1).select(F.lit("a").alias("key"), (at + F.expr("INTERVAL 190 HOURS")).alias("t"))
    r = joins.range_sums(point, rain, ["key"], "t", "t", "v", (0, 12, 24)).collect()[0]
    assert (r["precip_0_12"], r["precip_12_24"]) == (0.12, 0.12)
    odd = rain.withColumn("v", F.when(F.hour("t") == 5, float("nan")).when(F.hour("t") == 6, None).otherwise(F.col("v")))
    assert str(joins.range_sums(point, odd, ["key"], "t", "t", "v", (0, 24)).collect()[0]["precip_0_24"]) == "nan"


def test_flag_segments_match_pairs(spark):
    """Ten times as many flags: one segment per change, the same flags per prediction as all pairs."""
    rnd = random.Random(9)
    t0 = datetime(2024, 1, 1)
    for n in (20, 200):
        flags = []
        for i in range(n):
            start = t0 + timedelta(minutes=rnd.randrange(5000))
            flags.append((i, rnd.choice("ab"), start, start + timedelta(minutes=rnd.choice([-5, 0, 7, 600])), rnd.choice(["ADVISORY", "OFFLINE"]), f"f{i}"))
        flags += [(n, "a", None, t0, "OFFLINE", "x"), (n + 1, "a", t0, None, "OFFLINE", "y"), (n + 2, "b", datetime(1900, 1, 1), datetime(9999, 1, 1), "OFFLINE", "z")]
        df = spark.createDataFrame(flags, "id int, location_id string, start_timestamp timestamp, end_timestamp timestamp, level string, description string")
        points = [(rnd.choice("abc"), t0 + timedelta(minutes=rnd.randrange(-50, 6000)), i) for i in range(300)] + [(None, t0, 300), ("a", None, 301)]
        p = spark.createDataFrame(points, "name string, timestamp timestamp, row int")
        got = {r["row"]: r["flag_ids"] for r in status.with_covering_flags(p, df).collect()}
        assert len(got) == 302
        for name, at, row in points:
            want = [f[0] for f in flags if name and at and f[1] == name and f[2] and f[3] and f[2] <= at <= f[3]]
            assert (got[row] or []) == want
        assert status.flag_segments(df.filter(f"id < {n}")).count() <= 2 * n


def test_upsert_keeps_null_keys_apart_from_none(spark):
    old = spark.createDataFrame([(None, "a"), (1, "b"), (2, "c")], "k int, v string")
    new = spark.createDataFrame([(None, "n", 1), (2, "m", 1), (2, "z", 2), (3, "q", 1)], "k int, v string, seq int")
    got = {r["k"]: r["v"] for r in keyed.upsert(old, new, ["k"], [F.col("seq").desc()]).collect()}
    assert got == {None: "n", 1: "b", 2: "z", 3: "q"}


def test_scoring_is_the_same_beyond_the_size_for_literals(spark, monkeypatch):
    rows = [(i, float(i % 7), None if i % 5 == 0 else float(i % 3)) for i in range(40)]
    df = spark.createDataFrame(rows, "id int, a double, b double")
    terms = [("m", "a", 3.0, 2.0, 0.7, 0.4), ("m", "(Intercept)", 0.0, 1.0, -0.2, 0.4), ("n", "a", 1.0, 1.0, 0.1, 0.5), ("n", "b", 1.0, 1.0, -0.3, 0.5)]
    coefficients = spark.createDataFrame(terms, "model_id string, key string, mean double, sd double, coef double, cutoff double")

    def scored():
        return {
            (r["id"], r["name"]): (r["prob"] and round(r["prob"], 12), r["exceedance"], r["predictors"])
            for r in models.score_many(df, coefficients, ["id"]).collect()
        }

    literal = scored()
    monkeypatch.setattr(models, "MAX_COEFFICIENTS", 3)
    assert len(literal) == 80 and scored() == literal


def test_a_run_without_predictors_fails(spark):
    p = spark.createDataFrame([("s", START, 1.0)], "series_id string, hour timestamp, x double")
    none = spark.createDataFrame([(START + timedelta(hours=1),)], "t timestamp")
    with pytest.raises(ValueError, match="no predictors"):
        scoring.rows_to_score(p, ["series_id"], "hour", listed=none)
    at = F.lit("2024-01-01 00:30:00").cast("timestamp")
    assert scoring.rows_to_score(p, ["series_id"], "hour", at=at).count() == 1


# ------------------------------------------------------------- shared Newton steps


def test_many_models_equal_single_fits(spark, fit_rows):
    x, y, df = fit_rows
    flags = df.withColumns({"low": F.col("id") < 200, "apart": F.col("label") + F.col("x1") * 0.001, "flat": F.lit(3.0)})
    gappy = flags.withColumn("holes", F.when(F.col("id") % 3 > 0, F.col("x2")))
    specs = [
        newton.Spec(("both",), ("x1", "x2")), newton.Spec(("low",), ("x1",), "low"), newton.Spec(("holes",), ("holes",)),
        newton.Spec(("apart",), ("apart",)), newton.Spec(("flat",), ("x1", "flat")),
    ]
    both, low, holes, apart, flat = newton.fit_many(gappy, specs)
    for fit, cols, keep in ((both, [0, 1], np.arange(400)), (low, [0], np.arange(200)), (holes, [1], np.flatnonzero(np.arange(400) % 3))):
        z = x[keep][:, cols]
        b, dev = _irls((z - z.mean(0)) / z.std(0, ddof=1), y[keep])
        assert fit.converged and fit.deviance == pytest.approx(dev, rel=1e-9)
        assert [fit.beta[-1], *fit.beta[:-1]] == pytest.approx(list(b), abs=1e-7)
    assert not apart.converged and not flat.converged


@pytest.mark.parametrize("alpha, strength", [(0.0, 0.1), (0.4, 0.02), (1.0, 0.05)])
def test_penalised_fits_agree_with_mllib(fit_rows, alpha, strength):
    from pyspark.ml import Pipeline
    from pyspark.ml.classification import LogisticRegression

    _, _, df = fit_rows
    lr = LogisticRegression(
        featuresCol="_features", labelCol="label", standardization=False, elasticNetParam=alpha, regParam=strength, tol=1e-10, maxIter=500
    )
    model = Pipeline(stages=[*models._scaled(["x1", "x2"]), lr]).fit(df).stages[-1]
    (fit,) = newton.fit_many(df, [newton.Spec(("net",), ("x1", "x2"), None, strength, alpha)])
    assert fit.converged and list(fit.beta) == pytest.approx([*model.coefficients, model.intercept], abs=1e-4)


def test_tuning_covers_the_grid_and_prefers_the_stronger_penalty(fit_rows):
    _, _, df = fit_rows
    folded = df.withColumn("fold", (F.col("id") % 3).cast("int"))
    tuned = models.elastic_net(folded, ["x1", "x2"], folds=3, alphas=(0.0, 1.0), lambdas=(0.001, 0.01, 50.0))
    assert len(tuned.settings) == 6 and all(a is None or 0.4 < a < 1 for _, _, a in tuned.settings)
    best = max(a for _, _, a in tuned.settings if a is not None)
    assert tuned.best[1] == max(x for _, x, a in tuned.settings if a is not None and a > best - 1e-12)
    assert models.score_with(tuned.bestModel, df).filter("prob IS NULL").count() == 0


def test_screening_keeps_groups_without_a_fit(spark):
    rows = [("same", 1.0, i % 2) for i in range(10)] + [("alone", float(i), 1) for i in range(10)] + [("apart", float(i), int(i > 4)) for i in range(10)]
    rows += [("null", None, i % 2) for i in range(4)] + [(None, float(i * 7 % 10), i % 2) for i in range(10)]
    long = spark.createDataFrame(rows, "var string, x double, label int")
    got = {r["var"]: r for r in models.univariate_screen(long, ["var"]).collect()}
    assert set(got) == {"same", "alone", "apart", "null", None}
    assert [got[k]["converged"] for k in ("same", "alone", "apart", "null", None)] == [False, False, False, False, True]
    assert got["apart"]["aic"] is None and got["apart"]["n_sample"] == 10 and got["null"]["n_sample"] == 0


# ------------------------------------------------------------- rows that were lost or doubled


def test_csv_with_quotes_and_line_breaks(spark, tmp_path):
    (tmp_path / "a.csv").write_text('id,text\n1,"two\nlines"\n2,"say ""hi"""\n3,"a, b"\n', encoding="utf-8")
    schema = "id long, text string"
    back = files.read_csv(spark, str(tmp_path / "a.csv"), schema, multi_line=True)
    want = {1: "two\nlines", 2: 'say "hi"', 3: "a, b"}
    assert {r["id"]: r["text"] for r in back.collect()} == want
    files.write_csv(back, str(tmp_path / "b"))
    assert {r["id"]: r["text"] for r in files.read_csv(spark, str(tmp_path / "b"), schema, multi_line=True).collect()} == want


def test_appended_keys_are_unique_and_null_safe(spark):
    schema = "k string, v int"
    stored = spark.createDataFrame([("a", 1), (None, 2)], schema)
    new = spark.createDataFrame([("a", 9), (None, 9), ("b", 5), ("b", 4), ("c", 1)], schema)
    assert sorted((r["k"], r["v"]) for r in keyed.new_rows(stored, new, ["k"]).collect()) == [("b", 4), ("c", 1)]
    assert {(r["k"], r["n_new"], r["n_stored"]) for r in keyed.key_conflicts(stored, new, ["k"]).collect()} == {("a", 1, 1), (None, 1, 1), ("b", 2, 0)}


def test_one_row_is_copied_by_many_tasks(spark):
    df = spark.range(5000).select("id", (F.col("id") == 7).cast("int").alias("label"), F.lit("g").alias("k"))
    out = labels.up_sample(df, ["k"], "label", ["id"], chunk=100)
    assert {r["label"]: r["count"] for r in out.groupBy("label").count().collect()} == {0: 4999, 1: 4999}
    rare = out.filter("label = 1")
    assert rare.select("copy").distinct().count() == 4999 and rare.select(F.spark_partition_id()).distinct().count() > 1


@pytest.mark.parametrize("n, x, p", [(3e7, 1.5e7 + 2000, 0.5), (3e7, 2.7e7 - 800, 0.9), (5e7, 5e5 + 300, 0.01)])
def test_tail_expansion_equals_the_fraction(n, x, p):
    a, b = x, n - x + 1
    fraction = 1 - metrics._beta_ratio(b, a, 1 - p) if p > (a + 1) / (a + b + 2) else metrics._beta_ratio(a, b, p)
    assert metrics._upper_tail(x, n, p) == pytest.approx(fraction, abs=1e-6)


def test_tail_of_very_many_trials():
    n = 1e13
    for z in (-3.0, -0.5, 0.0, 1e-4, 2.0):
        got = metrics._upper_tail(n * 0.3 + z * math.sqrt(n * 0.21), n, 0.3)
        assert got == pytest.approx(0.5 * math.erfc(z / math.sqrt(2)), abs=1e-6)


def test_a_table_whose_gate_fails_is_not_published(spark, tmp_path):
    path = str(tmp_path / "table")
    good = spark.createDataFrame([(1, "a"), (2, "b")], "k int, v string")
    gates = [*gated.complete("k", "v"), gated.adds_up("total", F.col("k").cast("double"), 3.0)]
    assert gated.publish(good, path, gates) == {"nulls_k": 0, "nulls_v": 0, "total": 0.0}
    with pytest.raises(gated.GateFailed) as failed:
        gated.publish(spark.createDataFrame([(1, None), (5, "x")], good.schema), path, gates)
    assert failed.value.figures == {"nulls_k": 0, "nulls_v": 1, "total": 3.0}

    def broken(batches):
        yield from batches
        raise RuntimeError("lost")

    with pytest.raises(Exception, match="lost"):
        gated.publish(good.mapInArrow(broken, good.schema), path, gates)
    assert sorted(tuple(r) for r in spark.read.parquet(path).collect()) == [(1, "a"), (2, "b")]
    gated.publish(spark.createDataFrame([(3, "c")], good.schema), path, gates)
    assert [tuple(r) for r in spark.read.parquet(path).collect()] == [(3, "c")]


def test_sparse_dummies_of_very_many_levels(spark):
    df = spark.range(300_000).select("id", F.when(F.col("id") % 3 > 0, F.concat(F.lit("level "), F.col("id").cast("string"))).alias("c"))
    out = reshape.sparse_dummies(df, "c").select("c", "c_level.size", F.col("c_level.indices")[0].alias("i"))
    got = out.groupBy(F.col("c").isNull().alias("none")).agg(F.countDistinct("i").alias("n"), F.min("i").alias("low"), F.max("i").alias("high"), F.max("size").alias("size"))
    assert {r["none"]: tuple(r)[1:] for r in got.collect()} == {False: (200_000, 0, 199_999, 200_001), True: (1, 200_000, 200_000, 200_001)}
