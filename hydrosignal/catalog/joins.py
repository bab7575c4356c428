"""Equi, interval, range-sum and as-of joins on the given tables."""

from __future__ import annotations

from pyspark.sql import functions as F

from hydrosignal.catalog import standins as s
from hydrosignal.catalog.registry import query
from hydrosignal.catalog.windows import shown
from hydrosignal.operators import joins, ordered
from hydrosignal.functions import times
from hydrosignal.plans import weather

K = s.SERIES
_H = f"{s.stamp('hour')} AS hour"


@query(
    "d2_m4_prior_day_means",
    f"""
WITH {s.HOURS},
days AS (SELECT series_id, hour::DATE + 1 AS date, avg(temp) AS temp_mean_p1d, avg(wspd) AS wspd_mean_p1d FROM hours GROUP BY series_id, hour::DATE)
SELECT h.series_id, {s.stamp('h.hour')} AS hour, round(h.temp, 6) AS temp, round(temp_mean_p1d, 6) AS temp_mean_p1d, round(wspd_mean_p1d, 6) AS wspd_mean_p1d
FROM hours h LEFT JOIN days d ON d.series_id = h.series_id AND d.date = h.hour::DATE""",
)
def prior_day(spark, folder):
    h = weather.hourly_from_observations(s.observations(spark, folder), K, "ts", ["temp", "wspd"])
    out = weather.prior_day_means(h, K, "hour", ["temp", "wspd"])
    return shown(out.select("series_id", "hour", "temp", "temp_mean_p1d", "wspd_mean_p1d"))


@query(
    "d3_day_features_on_hours",
    f"""
WITH {s.GRID}, {s.FLOW},
wide AS (SELECT date, {', '.join(f"max(flow) FILTER (WHERE station_id = '{x}') AS f{x}" for x in s.STATIONS)} FROM flow GROUP BY date)
SELECT series_id, {_H}, {', '.join(f'round(f{x}, 6) AS f{x}' for x in s.STATIONS)} FROM grid LEFT JOIN wide ON wide.date = grid.hour::DATE""",
)
def day_on_hour(spark, folder):
    wide = s.flow(spark, folder).groupBy("date").agg(
        *[F.max(F.when(F.col("station_id") == x, F.col("flow"))).alias(f"f{x}") for x in s.STATIONS]
    )
    h = s.rain(spark, folder).withColumn("date", F.to_date("hour"))
    return shown(h.join(wide, "date", "left").select("series_id", "hour", *[f"f{x}" for x in s.STATIONS]))


@query(
    "d4_d9_samples_at_hour",
    f"""
WITH {s.HOURS}
SELECT o.event_id, {s.stamp("date_trunc('hour', o.ts)")} AS hour, round(h.temp, 6) AS temp, round(h.precip, 6) AS precip
FROM obs o LEFT JOIN hours h ON h.series_id = o.series_id AND h.hour = date_trunc('hour', o.ts)""",
)
def sample_at_hour(spark, folder):
    o = s.observations(spark, folder).select("event_id", "series_id", times.floor_hour(F.col("ts")).alias("hour"))
    h = weather.hourly_from_observations(s.observations(spark, folder), K, "ts", ["temp"])
    return shown(o.join(h, ["series_id", "hour"], "left").select("event_id", "hour", "temp", "precip"))


@query(
    "d5_chained_dimension_joins",
    """
SELECT r_name, n_name, count(*) AS n, round(sum(o_totalprice), 2) AS total
FROM orders JOIN customer ON o_custkey = c_custkey JOIN nation ON c_nationkey = n_nationkey JOIN region ON n_regionkey = r_regionkey GROUP BY 1, 2""",
)
def chained(spark, folder):
    o = s.read(spark, folder, "orders").select(F.col("o_custkey").alias("c_custkey"), "o_totalprice")
    c = s.read(spark, folder, "customer").select("c_custkey", F.col("c_nationkey").alias("n_nationkey"))
    n = s.read(spark, folder, "nation").withColumnRenamed("n_regionkey", "r_regionkey")
    r = s.read(spark, folder, "region")
    j = joins.chain_dimensions(o, (c, ["c_custkey"]), (n, ["n_nationkey"]), (r, ["r_regionkey"]))
    return j.groupBy("r_name", "n_name").agg(F.count(F.lit(1)).alias("n"), F.round(F.sum("o_totalprice"), 2).alias("total"))


@query(
    "d6_predictors_of_model",
    f"""
WITH {s.OBS}, names AS (SELECT * FROM (VALUES ('click', 'temp'), ('click', 'precip'), ('view', 'pressure')) t(series_id, key))
SELECT l.event_id, l.key, round(l.value, 6) AS value
FROM (UNPIVOT (SELECT event_id, series_id, temp, pressure, precip FROM obs) ON temp, pressure, precip INTO NAME key VALUE value) l
JOIN names n ON n.series_id = l.series_id AND n.key = l.key""",
)
def predictors_of_model(spark, folder):
    long = s.observations(spark, folder).unpivot(["event_id", "series_id"], ["temp", "pressure", "precip"], "key", "value")
    rows = F.array(*[F.struct(F.lit(a).alias("series_id"), F.lit(b).alias("key")) for a, b in (("click", "temp"), ("click", "precip"), ("view", "pressure"))])
    names = spark.range(1).select(F.inline(rows))
    return s.rounded(long.join(names, ["series_id", "key"]).select("event_id", "key", "value"))


@query(
    "d7_flags_covering_predictions",
    f"""
WITH {s.PREDICTIONS}, {s.FLAGS}
SELECT p.name, {s.stamp('p.timestamp')} AS timestamp, f.id, f.level FROM predictions p
JOIN flags f ON f.location_id = p.name AND f.start_timestamp <= p.timestamp AND p.timestamp <= f.end_timestamp""",
)
def covering(spark, folder):
    f = s.flags(spark, folder).withColumnRenamed("location_id", "name")
    p = s.predictions(spark, folder).select("name", "timestamp")
    out = joins.covering_intervals(p, f, ["name"], "timestamp", "start_timestamp", "end_timestamp")
    return out.select("name", s.text("timestamp").alias("timestamp"), "id", "level")


_BINS = (0, 12, 24, 48, 72, 96, 120)


@query(
    "d8_rain_sum_bins",
    f"""
WITH {s.OBS},
rain AS (SELECT series_id, date_trunc('hour', ts) AS at, sum(precip) AS precip FROM obs GROUP BY 1, 2),
p AS (SELECT DISTINCT series_id, ts FROM obs)
SELECT p.series_id, strftime(p.ts, '%Y-%m-%d %H:%M:%S.%f') AS ts, """
    + ", ".join(
        f"round(coalesce(sum(r.precip) FILTER (WHERE r.at >= p.ts - INTERVAL {b} HOUR AND r.at < p.ts - INTERVAL {a} HOUR), 0), 6) AS precip_{a}_{b}"
        for a, b in zip(_BINS, _BINS[1:])
    )
    + """
FROM p LEFT JOIN rain r ON r.series_id = p.series_id AND r.at < p.ts AND r.at >= p.ts - INTERVAL 120 HOUR GROUP BY p.series_id, p.ts""",
)
def rain_bins(spark, folder):
    o = s.observations(spark, folder)
    rain = o.select("series_id", times.floor_hour(F.col("ts")).alias("at"), "precip")
    out = joins.range_sums(o, rain, K, "ts", "at", "precip", _BINS)
    return s.rounded(out.withColumn("ts", F.date_format("ts", "yyyy-MM-dd HH:mm:ss.SSSSSS")))


@query(
    "d10_code_names",
    """
SELECT c_custkey, n_name AS c_nationkey FROM customer LEFT JOIN (SELECT * FROM nation WHERE n_regionkey <> 3) n ON c_nationkey = n_nationkey""",
)
def code_names(spark, folder):
    n = s.read(spark, folder, "nation").filter("n_regionkey <> 3")
    c = s.read(spark, folder, "customer").select("c_custkey", "c_nationkey")
    return joins.replace_codes(c, "c_nationkey", n, "n_nationkey", "n_name")


@query(
    "d10_unmatched_codes",
    """
SELECT c_nationkey, count(*) AS n FROM customer WHERE c_nationkey NOT IN (SELECT n_nationkey FROM nation WHERE n_regionkey <> 3) GROUP BY 1""",
)
def unmatched(spark, folder):
    n = s.read(spark, folder, "nation").filter("n_regionkey <> 3")
    return joins.unmatched_codes(s.read(spark, folder, "customer"), "c_nationkey", n, "n_nationkey")


@query(
    "d11_parameter_grid",
    """
SELECT event_type AS model_id, alpha, penalty, count(*) AS n FROM events
CROSS JOIN (SELECT unnest([0e0, 0.2e0, 0.4e0, 0.6e0, 0.8e0, 1e0]) AS alpha) a CROSS JOIN (SELECT unnest([0.0001e0, 0.001e0, 0.01e0, 0.1e0]) AS penalty) l
GROUP BY 1, 2, 3""",
)
def parameter_grid(spark, folder):
    from hydrosignal.operators.models import ALPHAS, LAMBDAS

    groups = s.read(spark, folder, "events").groupBy(F.col("event_type").alias("model_id")).agg(F.count(F.lit(1)).alias("n"))
    one = lambda vs, n: spark.range(1).select(F.explode(F.array(*[F.lit(v) for v in vs])).alias(n))
    return groups.crossJoin(one(ALPHAS, "alpha")).crossJoin(one(LAMBDAS, "penalty"))


@query(
    "d12_semi_join",
    "SELECT o_orderkey FROM orders WHERE o_custkey IN (SELECT c_custkey FROM customer WHERE c_mktsegment = 'BUILDING')",
)
def semi(spark, folder):
    c = s.read(spark, folder, "customer").filter("c_mktsegment = 'BUILDING'").select(F.col("c_custkey").alias("o_custkey"))
    return s.read(spark, folder, "orders").join(c, "o_custkey", "left_semi").select("o_orderkey")


@query(
    "d13_anti_join",
    "SELECT p_partkey FROM part WHERE p_partkey NOT IN (SELECT l_partkey FROM lineitem WHERE l_returnflag = 'R' AND l_linestatus = 'O' AND l_quantity > 25)",
)
def anti(spark, folder):
    li = s.read(spark, folder, "lineitem").filter("l_returnflag = 'R' AND l_linestatus = 'O' AND l_quantity > 25")
    return s.read(spark, folder, "part").join(li.select(F.col("l_partkey").alias("p_partkey")), "p_partkey", "left_anti").select("p_partkey")


@query(
    "d14_all_sites_with_latest",
    f"""
WITH {s.PREDICTIONS}, {s.SITES},
latest AS (SELECT * FROM predictions QUALIFY row_number() OVER (PARTITION BY name ORDER BY timestamp DESC) = 1)
SELECT s.name, s.tweet_name, {s.stamp('l.timestamp')} AS timestamp, l.prob FROM sites s LEFT JOIN latest l ON l.name = s.name""",
)
def sites_latest(spark, folder):
    latest = ordered.first_per_key(s.predictions(spark, folder), ["name"], [F.col("timestamp").desc()])
    out = s.sites(spark, folder).join(latest, "name", "left")
    return out.select("name", "tweet_name", s.text("timestamp").alias("timestamp"), "prob")


@query(
    "d15_latest_at_instant",
    f"""
WITH {s.OBS}
SELECT series_id, event_id, round(temp, 6) AS temp FROM obs WHERE ts <= TIMESTAMP '2024-01-15 12:00:00'
QUALIFY row_number() OVER (PARTITION BY series_id ORDER BY ts DESC) = 1""",
)
def latest_at(spark, folder):
    at = F.lit("2024-01-15 12:00:00").cast("timestamp")
    out = joins.latest_at(s.observations(spark, folder), K, "ts", at)
    return s.rounded(out.select("series_id", "event_id", "temp"))


@query(
    "d15_asof_join",
    f"""
WITH {s.OBS}, {s.FLOW},
q AS (SELECT station_id, date + INTERVAL 30 DAY + INTERVAL 6 HOUR AS asked FROM flow),
wet AS (SELECT substr('12345', (abs(user_id) % 5 + 1)::INTEGER, 1) AS station_id, ts, event_id, temp FROM obs)
SELECT q.station_id, {s.stamp('q.asked')} AS asked, w.event_id, round(w.temp, 6) AS temp
FROM (SELECT * FROM q UNION ALL SELECT station_id, asked - INTERVAL 32 DAY AS asked FROM q) q ASOF LEFT JOIN wet w ON w.station_id = q.station_id AND w.ts <= q.asked""",
)
def asof(spark, folder):
    f = s.flow(spark, folder)
    at = lambda days: (F.date_add("date", days).cast("timestamp") + F.expr("INTERVAL 6 HOURS")).alias("asked")
    q = f.select("station_id", at(30)).unionByName(f.select("station_id", at(-2)))
    o = s.observations(spark, folder)
    wet = o.select(F.element_at(F.array(*[F.lit(x) for x in "12345"]), (F.abs("user_id") % 5).cast("int") + 1).alias("station_id"), "ts", "event_id", "temp")
    out = joins.asof_join(q, wet, ["station_id"], "asked", "ts", ["event_id", "temp"], ["event_id"])
    return s.rounded(out.select("station_id", s.text("asked").alias("asked"), "event_id", "temp"))
