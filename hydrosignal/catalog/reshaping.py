"""Unions, pivots, sequences, dummies and comparisons on the given tables."""

from __future__ import annotations

from pyspark.sql import functions as F

from hydrosignal.catalog import standins as s
from hydrosignal.catalog.registry import query
from hydrosignal.operators import grid, joins, reshape
from hydrosignal.plans import predictors as predictor_plan


@query(
    "h1_union_by_name",
    """
SELECT o_orderkey AS id, o_totalprice AS amount, o_orderpriority AS note, NULL::VARCHAR AS segment FROM orders
UNION ALL SELECT c_custkey, c_acctbal, NULL, c_mktsegment FROM customer UNION ALL SELECT s_suppkey, s_acctbal, NULL, NULL FROM supplier""",
)
def union_by_name(spark, folder):
    o = s.read(spark, folder, "orders").select(F.col("o_orderkey").alias("id"), F.col("o_totalprice").alias("amount"), F.col("o_orderpriority").alias("note"))
    c = s.read(spark, folder, "customer").select(F.col("c_custkey").alias("id"), F.col("c_mktsegment").alias("segment"), F.col("c_acctbal").alias("amount"))
    p = s.read(spark, folder, "supplier").select(F.col("s_suppkey").alias("id"), F.col("s_acctbal").alias("amount"))
    return reshape.stack(o, c, p)


@query(
    "h2_tagged_union",
    """
SELECT CASE WHEN l_linestatus = 'O' THEN 'training' ELSE 'testing' END AS dataset, l_returnflag, count(*) AS n FROM lineitem GROUP BY 1, 2""",
)
def tagged(spark, folder):
    li = s.read(spark, folder, "lineitem").select("l_returnflag", "l_linestatus")
    both = reshape.stack_tagged("dataset", training=li.filter("l_linestatus = 'O'"), testing=li.filter("l_linestatus = 'F'"))
    return both.groupBy("dataset", "l_returnflag").agg(F.count(F.lit(1)).alias("n"))


@query("h3_distinct_values", "SELECT DISTINCT p_brand FROM part")
def distinct_values(spark, folder):
    return s.read(spark, folder, "part").select("p_brand").distinct()


@query(
    "i1_unpivot",
    """
SELECT l_orderkey, l_linenumber, l_partkey, key, value FROM (
  UNPIVOT (SELECT l_orderkey, l_linenumber, l_partkey, l_quantity, l_discount, l_tax FROM lineitem) ON l_quantity, l_discount, l_tax INTO NAME key VALUE value)""",
)
def unpivot(spark, folder):
    li = s.read(spark, folder, "lineitem")
    return reshape.to_long(li, ["l_orderkey", "l_linenumber", "l_partkey"], ["l_quantity", "l_discount", "l_tax"])


@query(
    "i2_pivot",
    f"""
WITH {s.FLOW}
SELECT strftime(date, '%Y-%m-%d') AS date, {', '.join(f'max(flow) FILTER (WHERE station_id = {chr(39)}{x}{chr(39)}) AS "{x}"' for x in s.STATIONS)} FROM flow GROUP BY date""",
)
def pivot(spark, folder):
    w = reshape.to_wide(s.flow(spark, folder), ["date"], "station_id", s.STATIONS, "flow")
    return w.withColumn("date", F.date_format("date", "yyyy-MM-dd"))


@query(
    "i5_time_sequence",
    f"""
WITH {s.OBS},
t AS (SELECT unnest(generate_series(date_trunc('day', min(ts)), date_trunc('day', max(ts)), INTERVAL 4 HOUR)) AS t FROM obs)
SELECT {s.stamp('t.t')} AS t, count(o.event_id) AS n FROM t LEFT JOIN obs o ON o.ts >= t.t AND o.ts < t.t + INTERVAL 4 HOUR GROUP BY t.t""",
)
def sequence(spark, folder):
    o = s.observations(spark, folder)
    span = o.agg(F.date_trunc("day", F.min("ts")).alias("a"), F.date_trunc("day", F.max("ts")).alias("b"))
    t = span.select(F.explode(F.sequence("a", "b", F.expr("INTERVAL 4 HOURS"))).alias("t"))
    at = F.timestamp_seconds(F.floor(F.unix_seconds("ts") / 14400) * 14400)
    n = o.groupBy(at.alias("t")).agg(F.count("event_id").alias("n"))
    return t.join(n, "t", "left").select(s.text("t").alias("t"), F.coalesce("n", F.lit(0)).alias("n"))


_EDGES = (0, 12, 24, 48, 72, 96, 120)


def _flow_bins(x):
    return ", ".join(
        f"round(coalesce(sum(r.precip) FILTER (WHERE r.at >= {x} - INTERVAL {b} HOUR AND r.at < {x} - INTERVAL {a} HOUR), 0), 6) AS precip_{a}_{b}"
        for a, b in zip(_EDGES, _EDGES[1:])
    )


def _positional(c):
    return (
        f"CASE WHEN {c} IS NOT NULL THEN {c} WHEN b_{c}.x <> a_{c}.x THEN b_{c}.y + (a_{c}.y - b_{c}.y) * ((pos - b_{c}.x) / (a_{c}.x - b_{c}.x)::DOUBLE) "
        f"WHEN b_{c}.y IS NOT NULL THEN b_{c}.y ELSE 0 END AS {c}"
    )


def _around(c):
    k = f"CASE WHEN {c} IS NOT NULL THEN struct_pack(x := pos, y := {c}) END IGNORE NULLS"
    return f"last_value({k}) OVER up AS b_{c}, last_value({k}) OVER down AS a_{c}"


SCENARIO = f"""{s.OBS}, {s.FLOW},
rain AS (SELECT date_trunc('hour', ts) AS at, sum(precip) AS precip FROM obs GROUP BY 1),
t AS (SELECT unnest(generate_series(TIMESTAMP '2023-12-30', TIMESTAMP '2024-02-05', INTERVAL 4 HOUR)) AS t),
fl AS (SELECT station_id, date::TIMESTAMP AS at, flow, flow - lag(flow) OVER (PARTITION BY station_id ORDER BY date) AS flow_deriv FROM flow),
looked AS (
  SELECT st.station_id, t.t, fl.flow, fl.flow_deriv, row_number() OVER (PARTITION BY st.station_id ORDER BY t.t) AS pos
  FROM t CROSS JOIN (SELECT unnest({s.STATIONS}) AS station_id) st LEFT JOIN fl ON fl.station_id = st.station_id AND fl.at = t.t),
known AS (
  SELECT *, {_around('flow')}, {_around('flow_deriv')} FROM looked
  WINDOW up AS (PARTITION BY station_id ORDER BY pos ROWS BETWEEN UNBOUNDED PRECEDING AND CURRENT ROW),
         down AS (PARTITION BY station_id ORDER BY pos DESC ROWS BETWEEN UNBOUNDED PRECEDING AND CURRENT ROW)),
filled AS (SELECT station_id, t, {_positional('flow')}, {_positional('flow_deriv')} FROM known),
bins AS (SELECT t.t, {_flow_bins('t.t')} FROM t LEFT JOIN rain r ON r.at < t.t AND r.at >= t.t - INTERVAL 120 HOUR GROUP BY t.t)"""


@query(
    "i6_scenario_features",
    f"""
WITH {SCENARIO}
SELECT {s.stamp('f.t')} AS t, {', '.join(f'round(max({c}) FILTER (WHERE station_id = {chr(39)}{x}{chr(39)}), 10) AS flow_{x}_{n}' for x in s.STATIONS for c, n in (('flow', 'current'), ('flow_deriv', 'deriv')))},
       {', '.join(f'max(precip_{a}_{b}) AS precip_{a}_{b}' for a, b in zip(_EDGES, _EDGES[1:]))}
FROM filled f JOIN bins USING (t) GROUP BY f.t""",
)
def scenario(spark, folder):
    ts = lambda x: F.lit(x).cast("timestamp")
    t = grid.time_sequence(spark, ts("2023-12-30"), ts("2024-02-05"), "4 hours", "t")
    from hydrosignal.plans.flow import flow_derivative

    f = flow_derivative(s.flow(spark, folder), ["station_id"], "date").withColumn("at", F.col("date").cast("timestamp"))
    o = s.observations(spark, folder).select(F.date_trunc("hour", "ts").alias("at"), "precip")
    out = predictor_plan.scenario_table(t, "t", f, "station_id", s.STATIONS, "at", o, "at", "precip", _EDGES)
    out = s.rounded(out.withColumn("t", s.text("t")), 10, *[c for c in out.columns if c.startswith("flow_")])
    return s.rounded(out, 6, *[c for c in out.columns if c.startswith("precip_")])


@query(
    "i7_nest_and_unnest",
    f"WITH {s.FLOW} SELECT station_id, strftime(date, '%Y-%m') AS month, strftime(date, '%Y-%m-%d') AS date, flow FROM flow",
)
def nest_unnest(spark, folder):
    days = s.flow(spark, folder).select(
        "station_id", F.date_format("date", "yyyy-MM").alias("month"), F.date_format("date", "yyyy-MM-dd").alias("date"), "flow"
    )
    keys = ["station_id", "month"]  # at most 31 rows per group
    return reshape.unnest(reshape.nest(days, keys), keys)


@query(
    "i8_dummies",
    """
SELECT o_orderkey, (coalesce(st, '') = 'O')::INTEGER AS st_O, (st IS NULL)::INTEGER AS st_nan
FROM (SELECT o_orderkey, nullif(o_orderstatus, 'P') AS st FROM orders)""",
)
def dummies(spark, folder):
    o = s.read(spark, folder, "orders").select("o_orderkey", F.nullif(F.col("o_orderstatus"), F.lit("P")).alias("st"))
    return reshape.dummies(o, "st", reshape.levels_of(o, "st")).drop("st")


@query(
    "i8_sparse_dummies",
    """
WITH c AS (SELECT o_orderkey, nullif(o_custkey, 1) AS cust FROM orders),
levels AS (SELECT cust, row_number() OVER (ORDER BY md5(cust::VARCHAR)) - 1 AS i FROM (SELECT DISTINCT cust FROM c WHERE cust IS NOT NULL))
SELECT o_orderkey, (SELECT count(*) FROM levels) + 1 AS size, coalesce(i, (SELECT count(*) FROM levels)) AS place, 1e0 AS value
FROM c LEFT JOIN levels ON levels.cust = c.cust""",
)
def sparse(spark, folder):
    o = s.read(spark, folder, "orders").select("o_orderkey", F.nullif(F.col("o_custkey"), F.lit(1)).alias("cust"))
    out = reshape.sparse_dummies(o, "cust")
    return out.select("o_orderkey", "cust_level.size", F.col("cust_level.indices")[0].alias("place"), F.col("cust_level.values")[0].alias("value"))


@query(
    "i9_two_sources_side_by_side",
    f"""
WITH {s.SAMPLES},
once AS (
  SELECT ProjectID, LocationID, Datetime::DATE AS date, ResultValue FROM samples
  QUALIFY row_number() OVER (PARTITION BY ProjectID, LocationID, Datetime::DATE ORDER BY Datetime, ResultValue) = 1)
SELECT a.LocationID, strftime(a.date, '%Y-%m-%d') AS date, a.ResultValue AS "CSORWM", b.ResultValue AS "RECFLAG"
FROM once a JOIN once b ON a.LocationID = b.LocationID AND a.date = b.date AND a.ProjectID = 'CSORWM' AND b.ProjectID = 'RECFLAG'""",
)
def side_by_side(spark, folder):
    x = s.samples(spark, folder).withColumn("date", F.date_format("Datetime", "yyyy-MM-dd"))
    return reshape.side_by_side(
        x, ["LocationID", "date"], "ProjectID", ("CSORWM", "RECFLAG"), "ResultValue", [F.col("Datetime"), F.col("ResultValue")]
    )


@query(
    "i10_probability_beside_predictors",
    f"""
WITH {s.OBS}
SELECT series_id AS name, strftime(ts, '%Y-%m-%d %H:%M:%S') AS timestamp, key, round(value, 6) AS value, round(prob, 6) AS exceedence_probability
FROM (UNPIVOT (SELECT series_id, ts, temp, precip, value / 500 AS prob FROM obs) ON temp, precip INTO NAME key VALUE value)""",
)
def beside(spark, folder):
    o = s.observations(spark, folder).select(
        F.col("series_id").alias("name"), F.col("ts").alias("timestamp"), (F.col("value") / 500).alias("prob"), "temp", "precip"
    )
    stored = o.select("name", "timestamp", "prob", F.to_json(F.struct("temp", "precip")).alias("predictors"))
    out = predictor_plan.probability_and_value(predictor_plan.report_values(stored))
    return s.rounded(out.withColumn("timestamp", s.text("timestamp")))


__all__ = ["joins"]
