"""Hourly roll-ups, lags, rolling features, rain events, interpolation and ordering."""

from __future__ import annotations

from pyspark.sql import functions as F

from hydrosignal.catalog import standins as s
from hydrosignal.catalog.registry import query
from hydrosignal.operators import events, fill, grid, metrics, models, rolling, summaries
from hydrosignal.operators.ordered import first_per_key
from hydrosignal.plans import flow as flow_plan
from hydrosignal.plans import weather

_H = f"{s.stamp('hour')} AS hour"
K = s.SERIES


def shown(df, digits=6, time="hour"):
    return s.rounded(df.withColumn(time, s.text(time)), digits)


@query(
    "flagship_hourly_rain_features",
    f"""
WITH {s.HOURS}
SELECT series_id, {_H}, n_hour, missing_hour, round(temp, 6) AS temp,
       round(CASE WHEN row_number() OVER w >= 24 THEN sum(precip) OVER (w ROWS BETWEEN 23 PRECEDING AND CURRENT ROW) ELSE 0 END, 6) AS precip_sum_p24hr_lag0hr,
       round(CASE WHEN row_number() OVER w >= 48 THEN sum(precip) OVER (w ROWS BETWEEN 47 PRECEDING AND 24 PRECEDING) ELSE 0 END, 6) AS precip_sum_p24hr_lag24hr
FROM hours WINDOW w AS (PARTITION BY series_id ORDER BY hour)""",
)
def flagship(spark, folder):
    h = weather.hourly_from_observations(s.observations(spark, folder), K, "ts", ["temp"])
    out = rolling.antecedent(h, K, "hour", widths=(24,), lag_hours=(0, 24))
    return shown(out.select("series_id", "hour", "n_hour", "missing_hour", "temp", "precip_sum_p24hr_lag0hr", "precip_sum_p24hr_lag24hr"))


@query(
    "e1_hourly_rollup",
    f"""
WITH {s.ROLLED}
SELECT series_id, {_H}, n_hour, round(temp, 6) AS temp, round(dewpt, 6) AS dewpt, round(precip, 6) AS precip FROM rolled""",
)
def rollup(spark, folder):
    return shown(grid.hourly_rollup(s.observations(spark, folder), K, "ts", ["temp", "dewpt"], ["precip"]))


_DAILY = ", ".join(
    f"round(min({v}), 6) AS {v}_min, round(max({v}), 6) AS {v}_max, round(avg({v}), 6) AS {v}_mean" for v in s.VARIABLES
)


@query(
    "e2_daily_rollup",
    f"""
WITH {s.HOURS}
SELECT series_id, strftime(hour::DATE, '%Y-%m-%d') AS date, count(*) AS n_day, sum(n_hour)::BIGINT AS n_hour, {_DAILY},
       round(sum(precip), 6) AS precip_sum, round(max(precip), 6) AS precip_max
FROM hours GROUP BY series_id, hour::DATE""",
)
def daily(spark, folder):
    d = grid.daily_rollup(s.hours(spark, folder), K, "hour", s.VARIABLES, "precip", "n_hour")
    return s.rounded(d.withColumn("date", F.date_format("date", "yyyy-MM-dd")))


@query(
    "d1_i4_complete_hourly_grid",
    f"WITH {s.GRID} SELECT series_id, {_H}, n_hour, missing_hour, round(precip, 6) AS precip FROM grid",
)
def complete_grid(spark, folder):
    return shown(s.rain(spark, folder))


@query(
    "i4_complete_daily_between_bounds",
    f"""
WITH {s.FLOW},
days AS (SELECT station_id, unnest(generate_series(DATE '2023-12-20', DATE '2026-03-01', INTERVAL 1 DAY))::DATE AS date FROM (SELECT DISTINCT station_id FROM flow))
SELECT d.station_id, strftime(d.date, '%Y-%m-%d') AS date, f.flow FROM days d LEFT JOIN flow f ON f.station_id = d.station_id AND f.date = d.date""",
)
def complete_days(spark, folder):
    d = lambda x: F.lit(x).cast("date")
    out = flow_plan.flow_series(s.flow(spark, folder), ["station_id"], d("2023-12-20"), d("2026-03-01"))
    return out.select("station_id", F.date_format("date", "yyyy-MM-dd").alias("date"), "flow")


@query(
    "f1_row_number",
    f"WITH {s.FLOW} SELECT station_id, strftime(date, '%Y-%m-%d') AS date, row_number() OVER (PARTITION BY station_id ORDER BY date)::INTEGER AS row FROM flow",
)
def row_number(spark, folder):
    out = rolling.row_numbers(s.flow(spark, folder), ["station_id"], "date")
    return out.select("station_id", F.date_format("date", "yyyy-MM-dd").alias("date"), "row")


_LAGS = ", ".join(
    [f"round(lag({v}, {d}) OVER w, 6) AS {v}_p{d}d" for d in range(1, 6) for v in ("flow", "logflow")]
    + [f"round(lag({v}, 1) OVER w - lag({v}, {d}) OVER w, 6) AS {v}_change_p{d}d_p1d" for d in range(2, 6) for v in ("flow", "logflow")]
)
_LAGGED = f"""{s.FLOW},
logs AS (SELECT *, log10(flow) AS logflow FROM flow),
lagged AS (SELECT station_id, date, {_LAGS} FROM logs WINDOW w AS (PARTITION BY station_id ORDER BY date))"""


@query(
    "f2_f3_flow_lags_and_changes",
    f"WITH {_LAGGED} SELECT * REPLACE (strftime(date, '%Y-%m-%d') AS date) FROM lagged",
)
def flow_lags(spark, folder):
    out = flow_plan.flow_features(s.flow(spark, folder), ["station_id"])
    return s.rounded(out.withColumn("date", F.date_format("date", "yyyy-MM-dd")))


@query(
    "i3_flow_predictor_table",
    f"WITH {_LAGGED} SELECT strftime(date, '%Y-%m-%d') AS date, "
    + ", ".join(
        f"max({c}) FILTER (WHERE station_id = '{st}') AS \"{st}_{c}\"" for st in s.STATIONS for c in flow_plan.feature_names()
    )
    + " FROM lagged GROUP BY date",
)
def flow_table(spark, folder):
    out = flow_plan.flow_predictors(s.flow(spark, folder), "station_id", s.STATIONS)
    return s.rounded(out.withColumn("date", F.date_format("date", "yyyy-MM-dd")))


def antecedent_sql(widths, lags, source="grid"):
    """Each width as its own frame: an independent form of the block composition."""
    base = ", ".join(
        f"CASE WHEN rn >= {k} THEN sum(precip) OVER (w ROWS BETWEEN {k - 1} PRECEDING AND CURRENT ROW) ELSE 0 END AS s{k}, "
        f"CASE WHEN rn >= {k} THEN max(precip) OVER (w ROWS BETWEEN {k - 1} PRECEDING AND CURRENT ROW) ELSE 0 END AS m{k}"
        for k in widths
    )
    cols = ", ".join(
        f"round(coalesce(lag({a}{k}, {n}) OVER w, 0), 6) AS precip_{name}_p{k}hr_lag{n}hr"
        for k in widths
        for n in lags
        for a, name in (("s", "sum"), ("m", "max"))
    )
    return f"""numbered AS (SELECT *, row_number() OVER (PARTITION BY series_id ORDER BY hour) AS rn FROM {source}),
based AS (SELECT series_id, hour, {base} FROM numbered WINDOW w AS (PARTITION BY series_id ORDER BY hour)),
rainfall AS (SELECT series_id, hour, {cols} FROM based WINDOW w AS (PARTITION BY series_id ORDER BY hour))"""


_RAIN = [f"precip_{a}_p{k}hr_lag{n}hr" for k in rolling.RAIN_WIDTHS for n in rolling.RAIN_LAGS for a in ("sum", "max")]


@query(
    "f4_antecedent_rainfall",
    f"WITH {s.GRID}, {antecedent_sql(rolling.RAIN_WIDTHS, rolling.RAIN_LAGS)} SELECT * REPLACE ({s.stamp('hour')} AS hour) FROM rainfall",
)
def antecedent(spark, folder):
    out = rolling.antecedent(s.rain(spark, folder), K, "hour")
    return shown(out.select("series_id", "hour", *_RAIN))


@query(
    "f4_antecedent_rainfall_in_time_parts",
    f"WITH {s.GRID}, {antecedent_sql(rolling.RAIN_WIDTHS, rolling.RAIN_LAGS)} SELECT * REPLACE ({s.stamp('hour')} AS hour) FROM rainfall",
)
def antecedent_parts(spark, folder):
    feature = lambda df, keys: rolling.antecedent(df, keys, "hour")
    reach = max(rolling.RAIN_WIDTHS) + max(rolling.RAIN_LAGS)
    out = rolling.in_time_parts(s.rain(spark, folder), K, "hour", 300 * 3600, reach * 3600, feature)
    return shown(out.drop("n_hour", "missing_hour", "precip"))


_MEANS = ", ".join(
    f"round(CASE WHEN count({v}) OVER (w ROWS BETWEEN {k - 1} PRECEDING AND CURRENT ROW) = {k} "
    f"THEN avg({v}) OVER (w ROWS BETWEEN {k - 1} PRECEDING AND CURRENT ROW) END, 11) AS {v}_mean_p{k}hr, "
    f"round({v} - lag({v}, {k}) OVER w, 11) AS {v}_change_p{k}hr"
    for k in rolling.WEATHER_WIDTHS
    for v in ("temp", "pressure")
)


@query(
    "f5_f6_rolling_means_and_changes",
    f"WITH {s.HOURS} SELECT series_id, {_H}, {_MEANS} FROM hours WINDOW w AS (PARTITION BY series_id ORDER BY hour)",
)
def means_changes(spark, folder):
    h = weather.hourly_from_observations(s.observations(spark, folder), K, "ts", ["temp", "pressure"])
    out = rolling.changes(rolling.rolling_means(h, K, "hour", ["temp", "pressure"]), K, "hour", ["temp", "pressure"])
    return shown(out.drop("n_hour", "missing_hour", "temp", "pressure", "precip"), 11)


def events_sql(source="grid"):
    return f"""wet0 AS (SELECT series_id, hour, precip, precip > 0 AS w0 FROM {source}),
turns AS (SELECT *, CASE WHEN w0 IS NOT DISTINCT FROM lag(w0) OVER (PARTITION BY series_id ORDER BY hour) THEN 0 ELSE 1 END AS turn FROM wet0),
runs AS (SELECT *, sum(turn) OVER (PARTITION BY series_id ORDER BY hour) AS run FROM turns),
wet1 AS (SELECT *, CASE WHEN w0 OR count(*) OVER (PARTITION BY series_id, run) < 8 THEN 1 ELSE 0 END AS w1 FROM runs),
spells AS (SELECT *, abs(w1 - coalesce(lag(w1) OVER (PARTITION BY series_id ORDER BY hour), 0)) AS step FROM wet1),
spelled AS (SELECT *, sum(step) OVER (PARTITION BY series_id ORDER BY hour) AS spell FROM spells),
kept AS (SELECT series_id, hour, precip, CASE WHEN sum(precip) OVER (PARTITION BY series_id, spell) > 0.1e0 THEN 1 ELSE 0 END AS wet FROM spelled),
again AS (SELECT *, abs(wet - coalesce(lag(wet) OVER (PARTITION BY series_id ORDER BY hour), 0)) AS step FROM kept),
ev AS (SELECT series_id, hour, precip, wet, (sum(step) OVER (PARTITION BY series_id ORDER BY hour))::BIGINT AS event_id FROM again),
evc AS (
  SELECT series_id, hour, precip, wet, event_id,
         count(*) OVER e AS event_duration, (row_number() OVER (PARTITION BY series_id, event_id ORDER BY hour))::INTEGER AS event_hour,
         CASE WHEN wet = 1 THEN 'Wet' ELSE 'Dry' END AS event_type,
         sum(precip * wet) OVER (PARTITION BY series_id, event_id ORDER BY hour) AS event_precip_cumsum,
         max(precip * wet) OVER (PARTITION BY series_id, event_id ORDER BY hour) AS event_precip_cummax,
         sum(precip * wet) OVER e AS event_precip_sum, max(precip * wet) OVER e AS event_precip_max
  FROM ev WINDOW e AS (PARTITION BY series_id, event_id)),
marked AS (SELECT *, row_number() OVER (PARTITION BY series_id ORDER BY hour) AS rn FROM evc),
since AS (
  SELECT *, {', '.join(f"rn - coalesce(max(CASE WHEN event_precip_sum >= {d}e0 THEN rn END) OVER (PARTITION BY series_id ORDER BY hour), 0) AS {events.since_name(d)}" for d in events.SINCE_DEPTHS)}
  FROM marked)"""


@query(
    "f7_f8_rain_events",
    f"WITH {s.GRID}, {events_sql()} SELECT series_id, {_H}, wet, event_id FROM ev",
)
def rain_events(spark, folder):
    out = events.rain_events(s.rain(spark, folder), K, "hour")
    return shown(out.select("series_id", "hour", "wet", "event_id"))


@query(
    "f9_event_columns",
    f"""
WITH {s.GRID}, {events_sql()}
SELECT series_id, {_H}, event_duration, event_hour, event_type, round(event_precip_cumsum, 6) AS event_precip_cumsum,
       round(event_precip_cummax, 6) AS event_precip_cummax, round(event_precip_sum, 6) AS event_precip_sum,
       round(event_precip_max, 6) AS event_precip_max FROM evc""",
)
def event_cols(spark, folder):
    out = events.event_columns(events.rain_events(s.rain(spark, folder), K, "hour"), K, "hour")
    names = ["duration", "hour", "type", "precip_cumsum", "precip_cummax", "precip_sum", "precip_max"]
    return shown(out.select("series_id", "hour", *[f"event_{n}" for n in names]))


@query(
    "f10_hours_since_event",
    f"WITH {s.GRID}, {events_sql()} SELECT series_id, {_H}, {', '.join(events.since_name(d) for d in events.SINCE_DEPTHS)} FROM since",
)
def hours_since(spark, folder):
    e = events.event_columns(events.rain_events(s.rain(spark, folder), K, "hour"), K, "hour")
    out = events.hours_since(e, K, "hour")
    out = out.select("series_id", "hour", *[F.col(events.since_name(d)).cast("long").alias(events.since_name(d)) for d in events.SINCE_DEPTHS])
    return shown(out)


@query(
    "e3_event_sums_having",
    f"""
WITH {s.GRID}, {events_sql()}
SELECT series_id, event_id, round(sum(precip), 6) AS precip_sum FROM ev GROUP BY 1, 2 HAVING sum(precip) > 0.1e0""",
)
def event_sums(spark, folder):
    e = events.rain_events(s.rain(spark, folder), K, "hour")
    sums = e.groupBy("series_id", "event_id").agg(F.sum("precip").alias("precip_sum")).filter(F.col("precip_sum") > 0.1)
    return s.rounded(sums)


@query(
    "e10_longest_missing_run",
    f"""
WITH {s.GRID},
t AS (SELECT *, CASE WHEN missing_hour IS NOT DISTINCT FROM lag(missing_hour) OVER (PARTITION BY series_id ORDER BY hour) THEN 0 ELSE 1 END AS turn FROM grid),
r AS (SELECT series_id, missing_hour, sum(turn) OVER (PARTITION BY series_id ORDER BY hour) AS run FROM t)
SELECT series_id, max(n)::BIGINT AS longest FROM (SELECT series_id, run, sum(missing_hour::INTEGER) AS n FROM r GROUP BY 1, 2) GROUP BY 1""",
)
def longest_gap(spark, folder):
    return events.longest_run(s.rain(spark, folder), K, "hour", "missing_hour")


@query(
    "f11_interpolate_in_time",
    f"WITH {s.HOURS} SELECT series_id, {_H}, round(temp, 10) AS temp, round(wspd, 10) AS wspd, round(pressure, 10) AS pressure FROM hours",
)
def interpolate(spark, folder):
    return shown(s.hours(spark, folder).select("series_id", "hour", "temp", "wspd", "pressure"), 10)


@query(
    "f11_interpolate_in_time_parts",
    f"WITH {s.HOURS} SELECT series_id, {_H}, round(temp, 10) AS temp, round(pressure, 10) AS pressure FROM hours",
)
def interpolate_parts(spark, folder):
    h = grid.hourly_series(s.observations(spark, folder), K, "ts", ["temp", "pressure"])
    return shown(fill.interpolate_parts(h, K, "hour", ["temp", "pressure"], 36 * 3600).select("series_id", "hour", "temp", "pressure"), 10)


@query(
    "f12_latest_row_per_name",
    f"WITH {s.PREDICTIONS} SELECT name, {s.stamp('timestamp')} AS timestamp, prob FROM predictions QUALIFY row_number() OVER (PARTITION BY name ORDER BY timestamp DESC) = 1",
)
def latest_row(spark, folder):
    p = first_per_key(s.predictions(spark, folder), ["name"], [F.col("timestamp").desc()])
    return p.select("name", s.text("timestamp").alias("timestamp"), "prob")


@query(
    "f13_first_row_per_project_and_date",
    f"""
WITH {s.SAMPLES}
SELECT ProjectID, strftime(Datetime, '%Y-%m-%d') AS date, l_orderkey, l_linenumber, l_partkey FROM samples
QUALIFY row_number() OVER (PARTITION BY ProjectID, Datetime::DATE ORDER BY Datetime, l_orderkey, l_linenumber, l_partkey) = 1""",
)
def first_row(spark, folder):
    x = s.samples(spark, folder).withColumn("date", F.date_format("Datetime", "yyyy-MM-dd"))
    once = first_per_key(x, ["ProjectID", "date"], [F.col(c) for c in ("Datetime", "l_orderkey", "l_linenumber", "l_partkey")])
    return once.select("ProjectID", "date", "l_orderkey", "l_linenumber", "l_partkey")


@query(
    "f14_best_row_per_group",
    """
SELECT p_type, p_brand, n FROM (SELECT p_type, p_brand, count(*) AS n FROM part GROUP BY 1, 2)
QUALIFY row_number() OVER (PARTITION BY p_type ORDER BY n DESC, p_brand) = 1""",
)
def best_row(spark, folder):
    n = s.read(spark, folder, "part").groupBy("p_type", "p_brand").agg(F.count(F.lit(1)).alias("n"))
    return models.best_by(n, ["p_type"], F.col("n"), [F.col("p_brand")])


@query(
    "f15_first_difference",
    f"WITH {s.FLOW} SELECT station_id, strftime(date, '%Y-%m-%d') AS date, round(flow - lag(flow) OVER (PARTITION BY station_id ORDER BY date), 6) AS flow_deriv FROM flow",
)
def difference(spark, folder):
    out = rolling.first_difference(s.flow(spark, folder), ["station_id"], "date", "flow", "flow_deriv")
    return s.rounded(out.select("station_id", F.date_format("date", "yyyy-MM-dd").alias("date"), "flow_deriv"))


@query(
    "f16_forward_fill",
    f"""
WITH {s.GRID}
SELECT series_id, {_H}, round(last_value(temp IGNORE NULLS) OVER (PARTITION BY series_id ORDER BY hour ROWS BETWEEN UNBOUNDED PRECEDING AND CURRENT ROW), 6) AS temp
FROM grid""",
)
def ffill(spark, folder):
    g = grid.hourly_series(s.observations(spark, folder), K, "ts", ["temp"])
    return shown(fill.forward_fill(g, K, "hour", ["temp"]).select("series_id", "hour", "temp"))


_HOURLY_FLOW = f"""{s.FLOW},
fsteps AS (SELECT station_id, unnest(generate_series(min(date)::TIMESTAMP, max(date)::TIMESTAMP, INTERVAL 1 HOUR)) AS hour FROM flow GROUP BY 1),
fgrid AS (SELECT g.station_id, g.hour, f.flow, CASE WHEN f.flow IS NOT NULL THEN 'USGS' END AS agency_cd FROM fsteps g LEFT JOIN flow f ON f.station_id = g.station_id AND f.date::TIMESTAMP = g.hour),
faround AS (
  SELECT *, last_value(agency_cd IGNORE NULLS) OVER up AS agency,
         last_value(CASE WHEN flow IS NOT NULL THEN struct_pack(x := epoch_us(hour), y := flow) END IGNORE NULLS) OVER up AS b_flow,
         last_value(CASE WHEN flow IS NOT NULL THEN struct_pack(x := epoch_us(hour), y := flow) END IGNORE NULLS) OVER down AS a_flow
  FROM fgrid
  WINDOW up AS (PARTITION BY station_id ORDER BY hour ROWS BETWEEN UNBOUNDED PRECEDING AND CURRENT ROW),
         down AS (PARTITION BY station_id ORDER BY hour DESC ROWS BETWEEN UNBOUNDED PRECEDING AND CURRENT ROW)),
hflow AS (SELECT station_id, hour, agency AS agency_cd, {s.line_sql('flow')} FROM faround)"""


@query(
    "f17_daily_to_hourly_flow",
    f"WITH {_HOURLY_FLOW} SELECT station_id, {_H}, agency_cd, flow FROM hflow",
)
def hourly_flow(spark, folder):
    d = s.flow(spark, folder).select("station_id", F.col("date").cast("timestamp").alias("hour"), "flow", F.lit("USGS").alias("agency_cd"))
    out = flow_plan.hourly_flow(d, ["station_id"], "hour", ["flow"], ["agency_cd"])
    return out.select("station_id", s.text("hour").alias("hour"), "agency_cd", "flow")


@query(
    "f18_interpolate_by_position",
    f"""
WITH {s.ROLLED},
n AS (SELECT series_id, hour, row_number() OVER (PARTITION BY series_id ORDER BY hour) AS pos, CASE WHEN temp < 18 THEN temp END AS temp FROM rolled),
a AS (
  SELECT *, last_value(CASE WHEN temp IS NOT NULL THEN struct_pack(x := pos, y := temp) END IGNORE NULLS) OVER up AS b,
         last_value(CASE WHEN temp IS NOT NULL THEN struct_pack(x := pos, y := temp) END IGNORE NULLS) OVER down AS f
  FROM n WINDOW up AS (PARTITION BY series_id ORDER BY pos ROWS BETWEEN UNBOUNDED PRECEDING AND CURRENT ROW),
               down AS (PARTITION BY series_id ORDER BY pos DESC ROWS BETWEEN UNBOUNDED PRECEDING AND CURRENT ROW))
SELECT series_id, {_H}, round(CASE WHEN temp IS NOT NULL THEN temp WHEN b.x <> f.x THEN b.y + (f.y - b.y) * ((pos - b.x) / (f.x - b.x)::DOUBLE)
       WHEN b.y IS NOT NULL THEN b.y ELSE 0 END, 10) AS temp FROM a""",
)
def by_position(spark, folder):
    r = grid.hourly_rollup(s.observations(spark, folder), K, "ts", ["temp"])
    gappy = r.select("series_id", "hour", F.when(F.col("temp") < 18, F.col("temp")).alias("temp"))
    return shown(fill.interpolate_rows(gappy, K, "hour", ["temp"]), 10)


@query("g1_sorted_result", "SELECT o_orderkey, o_orderpriority, strftime(o_orderdate, '%Y-%m-%d') AS date FROM orders")
def sorted_rows(spark, folder):
    o = s.read(spark, folder, "orders").select("o_orderkey", "o_orderpriority", F.date_format("o_orderdate", "yyyy-MM-dd").alias("date"))
    return o.orderBy(F.col("o_orderpriority"), F.col("date").desc(), F.col("o_orderkey"))


@query(
    "e11_time_bounds",
    f"""
SELECT event_type AS series_id, {s.stamp('min(ts)')} AS first, {s.stamp('max(ts)')} AS last, count(*) AS n FROM events GROUP BY 1""",
)
def time_bounds(spark, folder):
    o = s.observations(spark, folder)
    return o.groupBy("series_id").agg(
        s.text(F.min("ts")).alias("first"), s.text(F.max("ts")).alias("last"), F.count(F.lit(1)).alias("n")
    )


__all__ = ["antecedent_sql", "events_sql", "shown", "summaries", "metrics"]
