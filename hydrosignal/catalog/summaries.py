"""Group summaries, cross-tabs, fits and weights on the given tables."""

from __future__ import annotations

from pyspark.sql import functions as F

from hydrosignal.catalog import standins as s
from hydrosignal.catalog.registry import query
from hydrosignal.operators import reshape, summaries

_EXC = "CASE WHEN ResultValue > 1000 THEN 'yes' ELSE 'no' END"


def _samples(spark, folder):
    x = s.samples(spark, folder)
    return x.withColumns({"exceed": F.col("ResultValue") > 1000, "class": F.when(F.col("ResultValue") > 1000, "yes").otherwise("no")})


@query(
    "e4_counts_and_exceedance_share",
    f"WITH {s.SAMPLES} SELECT CharacteristicID AS model_id, count(*) AS n_samples, round(avg((ResultValue > 1000)::INTEGER), 6) AS frac_exceed FROM samples GROUP BY 1",
)
def counts(spark, folder):
    x = _samples(spark, folder).withColumnRenamed("CharacteristicID", "model_id")
    return s.rounded(summaries.share_by(x, ["model_id"], F.col("exceed")))


@query(
    "e5_exceedance_by_year",
    f"""
WITH {s.SAMPLES} SELECT CharacteristicID AS model_id, year(Datetime)::INTEGER AS year, count(*) AS n, round(avg((ResultValue > 1000)::INTEGER), 6) AS frac_exceed
FROM samples GROUP BY 1, 2""",
)
def by_year(spark, folder):
    x = _samples(spark, folder).withColumnRenamed("CharacteristicID", "model_id").withColumn("year", F.year("Datetime"))
    return s.rounded(summaries.share_by(x, ["model_id", "year"], F.col("exceed"), n="n"))


def _tab(extra=""):
    return f"""
WITH {s.SAMPLES}
SELECT CharacteristicID, count(*) FILTER (WHERE ProjectID = 'CSORWM') AS "CSORWM", count(*) FILTER (WHERE ProjectID = 'RECFLAG') AS "RECFLAG" {extra}"""


@query("e6_cross_tab", _tab() + " FROM samples GROUP BY 1")
def cross_tab(spark, folder):
    return summaries.cross_tab(_samples(spark, folder), "CharacteristicID", "ProjectID", ["CSORWM", "RECFLAG"])


@query(
    "e7_row_proportions",
    f"""
WITH {s.SAMPLES}
SELECT CharacteristicID, round(avg(({_EXC} = 'no')::INTEGER), 6) AS "no", round(avg(({_EXC} = 'yes')::INTEGER), 6) AS "yes" FROM samples GROUP BY 1""",
)
def row_shares(spark, folder):
    return s.rounded(summaries.row_shares(_samples(spark, folder), "CharacteristicID", "class", ["no", "yes"]))


@query(
    "e8_cross_tab_with_totals",
    _tab(', count(*) AS "Total"').replace("SELECT CharacteristicID,", "SELECT coalesce(CharacteristicID, 'Total') AS CharacteristicID,")
    + " FROM samples GROUP BY ROLLUP (CharacteristicID)",
)
def totals(spark, folder):
    return summaries.cross_tab_totals(_samples(spark, folder), "CharacteristicID", "ProjectID", ["CSORWM", "RECFLAG"])


@query(
    "e9_predictor_ranges",
    f"""
WITH {s.OBS}
SELECT series_id, key, round(min(value), 6) AS min, round(quantile_cont(value, 0.5), 6) AS median, round(avg(value), 6) AS mean, round(max(value), 6) AS max
FROM (UNPIVOT (SELECT series_id, temp, pressure, precip FROM obs) ON temp, pressure, precip INTO NAME key VALUE value) GROUP BY 1, 2""",
)
def ranges(spark, folder):
    long = reshape.to_long(s.observations(spark, folder), ["series_id"], ["temp", "pressure", "precip"])
    return s.rounded(summaries.ranges(long, ["series_id", "key"]))


@query("e12_count_by_hour", f"WITH {s.SAMPLES} SELECT hour(Datetime)::INTEGER AS hour, count(*) AS n FROM samples GROUP BY 1")
def by_hour(spark, folder):
    return s.samples(spark, folder).groupBy(F.hour("Datetime").alias("hour")).agg(F.count(F.lit(1)).alias("n"))


@query(
    "e12_histogram",
    """
SELECT event_type AS series_id, CASE WHEN value < 0 THEN 0 WHEN value >= 400 THEN 21 ELSE floor(value / 20)::BIGINT + 1 END AS bucket, count(*) AS n
FROM events GROUP BY 1, 2""",
)
def histogram(spark, folder):
    return summaries.histogram(s.observations(spark, folder), ["series_id"], "value", 0, 400, 20)


_NUM = ["temp", "dewpt", "wspd", "precip"]
_PAIRS = [(a, b) for i, a in enumerate(_NUM) for b in _NUM[i + 1 :]]


@query(
    "e13_correlation_matrix",
    f"WITH {s.OBS} " + " UNION ALL ".join(f"SELECT series_id, '{a}' AS a, '{b}' AS b, round(corr({a}, {b}), 6) AS r FROM obs GROUP BY series_id" for a, b in _PAIRS),
)
def correlations(spark, folder):
    return s.rounded(summaries.correlations(s.observations(spark, folder), _NUM, ["series_id"]))


@query(
    "e14_distribution_summary",
    """
SELECT l_returnflag, l_linestatus, round(min(v), 6) AS min, round(quantile_cont(v, 0.25), 6) AS q1, round(quantile_cont(v, 0.5), 6) AS median,
       round(avg(v), 6) AS mean, round(quantile_cont(v, 0.75), 6) AS q3, round(max(v), 6) AS max
FROM (SELECT l_returnflag, l_linestatus, l_suppkey, avg(l_quantity) AS v FROM lineitem GROUP BY 1, 2, 3) GROUP BY 1, 2""",
)
def distribution(spark, folder):
    li = s.read(spark, folder, "lineitem")
    means = li.groupBy("l_returnflag", "l_linestatus", "l_suppkey").agg(F.avg("l_quantity").alias("v"))
    return s.rounded(summaries.distribution(means, ["l_returnflag", "l_linestatus"], "v"))


@query(
    "e16_class_weights",
    """
SELECT doc_id, quality, round(0.5e0 / count(*) OVER (PARTITION BY quality), 9) AS weight FROM labels""",
)
def weights(spark, folder):
    x = s.read(spark, folder, "labels").select("doc_id", "quality")
    return s.rounded(summaries.class_weights(x, [], "quality"), 9)


@query(
    "e17_ordered_text",
    """
SELECT n_regionkey, string_agg(n_name, ' ' ORDER BY n_nationkey) AS names, count(*) AS n FROM nation GROUP BY 1""",
)
def ordered_text(spark, folder):
    n = s.read(spark, folder, "nation")
    return n.groupBy("n_regionkey").agg(
        F.expr("listagg(n_name, ' ') within group (order by n_nationkey)").alias("names"), F.count(F.lit(1)).alias("n")
    )


@query("e18_majority_baseline", "SELECT round(1 - avg(toxic), 6) AS baseline, count(*) AS n FROM labels")
def baseline(spark, folder):
    return s.rounded(s.read(spark, folder, "labels").agg((1 - F.avg("toxic")).alias("baseline"), F.count(F.lit(1)).alias("n")))


@query(
    "e19_linear_fit_of_two_series",
    f"""
WITH {s.FLOW},
w AS (SELECT date, max(flow) FILTER (WHERE station_id = '1') AS a, max(flow) FILTER (WHERE station_id = '2') AS b FROM flow GROUP BY date)
SELECT round(regr_slope(b, a), 6) AS slope, round(regr_intercept(b, a), 6) AS intercept, round(regr_r2(b, a), 6) AS r2 FROM w""",
)
def linear_fit(spark, folder):
    w = reshape.pivot_series(s.flow(spark, folder), ["date"], "station_id", ["1", "2"], ["flow"])
    return s.rounded(summaries.linear_fit(w, "2_flow", "1_flow"))
