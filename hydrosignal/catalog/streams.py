"""Streaming forms run to the end of the available input, with the batch answer as SQL."""

from __future__ import annotations

from pyspark.sql import functions as F

from hydrosignal.catalog import standins as s
from hydrosignal.catalog.modelling import coefficients, score_sql, _hours
from hydrosignal.catalog.registry import query
from hydrosignal.catalog.windows import antecedent_sql, events_sql, shown
from hydrosignal.functions import times
from hydrosignal.operators import events, grid, models, rolling
from hydrosignal.operators.attach import attach
from hydrosignal.session import materialize, scratch_dir
from hydrosignal.streaming import hourly, rain_state, runs, state

K = s.SERIES
_H = f"{s.stamp('hour')} AS hour"


def _stream(spark, folder):
    return s.observe(runs.read_table_stream(spark, f"{folder}/events.parquet"))


def _table_stream(df, name):
    """A derived table written to scratch and read back as a stream."""
    path = scratch_dir(df.sparkSession, name)
    df.write.parquet(path)
    return runs.read_table_stream(df.sparkSession, path)


@query(
    "l1_hourly_windows",
    f"""
WITH {s.ROLLED}
SELECT series_id, {_H}, n_hour, round(temp, 6) AS temp, round(precip, 6) AS precip FROM rolled""",
)
def hourly_windows(spark, folder):
    out = hourly.hourly_windows(_stream(spark, folder), K, "ts", ["temp"], ["precip"])
    return shown(runs.run_updates(out, "hourly", K, "hour"))


@query(
    "l2_late_data_upsert",
    """
SELECT o_custkey AS station_id, strftime(o_orderdate, '%Y-%m-%d') AS date, o_totalprice AS flow, o_orderkey FROM orders
QUALIFY row_number() OVER (PARTITION BY o_custkey, o_orderdate::DATE ORDER BY o_orderkey DESC) = 1""",
)
def late_upsert(spark, folder):
    o = runs.read_table_stream(spark, f"{folder}/orders.parquet")
    rows = o.select(
        F.col("o_custkey").alias("station_id"),
        F.date_format("o_orderdate", "yyyy-MM-dd").alias("date"),
        F.col("o_totalprice").alias("flow"),
        "o_orderkey",
        F.date_format("o_orderdate", "yyyy").alias("year"),
    )
    path = scratch_dir(spark, "flow-table")
    sink = hourly.upsert_sink(
        path, "station_id long, date string, flow double, o_orderkey long, year string", ["station_id", "date"], [F.col("o_orderkey").desc()], "year", newer_only=True
    )
    runs.run_batches(rows, "flow-upsert", sink, "append")
    return spark.read.parquet(path).drop("year")


@query("l3_deduplicated_observations", "SELECT event_id, event_type AS series_id, value FROM events")
def dedupe(spark, folder):
    twice = _stream(spark, folder).unionByName(_stream(spark, folder))
    once = hourly.deduplicated(twice, "ts", ["event_id"])
    return runs.run_append(once.select("event_id", "series_id", "value"), "dedupe")


@query(
    "l4_rain_sessions",
    f"""
WITH {s.GRID},
w AS (SELECT series_id, hour, precip, CASE WHEN hour - lag(hour) OVER (PARTITION BY series_id ORDER BY hour) <= INTERVAL 8 HOUR THEN 0 ELSE 1 END AS turn FROM grid WHERE precip > 0),
g AS (SELECT *, sum(turn) OVER (PARTITION BY series_id ORDER BY hour) AS run FROM w)
SELECT series_id, {s.stamp('min(hour)')} AS first_wet, {s.stamp('max(hour)')} AS last_wet, round(sum(precip), 6) AS depth, round(max(precip), 6) AS peak FROM g GROUP BY series_id, run
HAVING sum(precip) > 0.1e0""",
)
def sessions(spark, folder):
    """Open sessions are in the table too; an hour that comes late replaces those that it joins."""
    found = _events_of_deliveries(spark, folder, "sessions").filter("wet = 1")
    out = found.select("series_id", "first_wet", "last_wet", F.col("event_precip_sum").alias("depth"), F.col("event_precip_max").alias("peak"))
    return s.rounded(out.withColumns({"first_wet": s.text("first_wet"), "last_wet": s.text("last_wet")}))


@query(
    "l4_closed_rain_sessions",
    f"""
WITH {s.GRID},
w AS (SELECT series_id, hour, precip, CASE WHEN hour - lag(hour) OVER (PARTITION BY series_id ORDER BY hour) <= INTERVAL 8 HOUR THEN 0 ELSE 1 END AS turn FROM grid WHERE precip > 0),
g AS (SELECT *, sum(turn) OVER (PARTITION BY series_id ORDER BY hour) AS run FROM w)
SELECT series_id, {s.stamp('min(hour)')} AS first_wet, {s.stamp('max(hour)')} AS last_wet, round(sum(precip), 6) AS depth, round(max(precip), 6) AS peak FROM g GROUP BY series_id, run
HAVING sum(precip) > 0.1e0 AND max(hour) + INTERVAL 8 HOUR <= (SELECT max(hour) - INTERVAL 1 DAY FROM grid)""",
)
def closed_sessions(spark, folder):
    """Only sessions that the watermark has closed, as session windows in append mode give them."""
    h = _table_stream(s.rain(spark, folder).select("series_id", "hour", "precip"), "hourly-rain")
    out = runs.run_append(hourly.rain_sessions(h, K, "hour"), "sessions")
    return s.rounded(out.withColumns({"first_wet": s.text("first_wet"), "last_wet": s.text("last_wet")}))


@query(
    "l5_sliding_rain_sums",
    f"""
WITH {s.GRID}
SELECT series_id, {_H}, round(sum(precip) OVER w, 6) AS precip_sum_p24hr_lag0hr, round(max(precip) OVER w, 6) AS precip_max_p24hr_lag0hr, count(*) OVER w AS n
FROM grid WINDOW w AS (PARTITION BY series_id ORDER BY hour ROWS BETWEEN 23 PRECEDING AND CURRENT ROW)""",
)
def sliding(spark, folder):
    rain = s.rain(spark, folder).select("series_id", "hour", "precip")
    h = _table_stream(rain, "hourly-rain")
    out = runs.run_updates(hourly.sliding_sums(h, K, "hour", "precip", 24), "sliding", K, "hour")
    # windows that end after the last known hour are still filling
    last = rain.groupBy("series_id").agg(F.max("hour").alias("_last"))
    return shown(attach(out, last, K).filter("hour <= _last").drop("_last"))


@query(
    "l5_antecedent_grid",
    f"WITH {s.GRID}, {antecedent_sql(rolling.RAIN_WIDTHS, rolling.RAIN_LAGS)} SELECT * REPLACE ({s.stamp('hour')} AS hour) FROM rainfall",
)
def antecedent_grid(spark, folder):
    """Hours arrive in several deliveries; each recomputes the grid it reaches."""
    rain = s.rain(spark, folder).select("series_id", "hour", "precip", F.to_date("hour").alias("day"))
    path = scratch_dir(spark, "rain-deliveries")
    rain.repartitionByRange(3, "hour").write.parquet(path)
    hours_path, grid_path = scratch_dir(spark, "rain-hours"), scratch_dir(spark, "rain-grid")
    sink = hourly.antecedent_sink(hours_path, grid_path, rain.schema, K, "hour")
    runs.run_batches(runs.read_table_stream(spark, path, files=1), "antecedent", sink, "append")
    return s.rounded(shown(spark.read.parquet(grid_path).drop("day", "precip")))


@query(
    "l6_event_clock_state",
    f"""
WITH {s.HOURS}, {events_sql('grid')}
SELECT g.series_id, {s.stamp('g.hour')} AS hour, s.{events.since_name(0.5)} AS hours_since,
       round(last_value(g.temp IGNORE NULLS) OVER (PARTITION BY g.series_id ORDER BY g.hour ROWS BETWEEN UNBOUNDED PRECEDING AND CURRENT ROW), 6) AS last_flow
FROM grid g JOIN since s ON s.series_id = g.series_id AND s.hour = g.hour""",
)
def event_clock(spark, folder):
    h = grid.hourly_series(s.observations(spark, folder), K, "ts", ["temp"], ["precip"])
    e = events.event_columns(events.rain_events(h, K, "hour"), K, "hour")
    table = e.select("series_id", "hour", (F.col("event_precip_sum") >= 0.5).alias("is_event"), F.col("temp").alias("flow"))
    out = state.event_clock(_table_stream(table, "hourly-events"), "series_id")
    return shown(runs.run_append(out, "event-clock"))


@query(
    "l6_f7_f9_events_of_arriving_hours",
    f"""
WITH {s.GRID}, {events_sql()}
SELECT series_id, {_H}, event_id, wet, event_hour, event_duration, event_type, round(event_precip_sum, 6) AS event_precip_sum,
       round(event_precip_max, 6) AS event_precip_max, {", ".join(f"{events.since_name(d)}::BIGINT AS {events.since_name(d)}" for d in events.SINCE_DEPTHS)}
FROM since""",
)
def arriving_events(spark, folder):
    return shown(rain_state.event_hours(_events_of_deliveries(spark, folder, "rain-events")))


def _events_of_deliveries(spark, folder, name):
    """Events of the hours as they were read, without those that are missing, in four deliveries."""
    rolled = grid.hourly_rollup(s.observations(spark, folder), K, "ts", (), ["precip"])
    read = materialize(rolled.select("series_id", "hour", "precip"), "hours-read")
    seconds = F.unix_seconds("hour")
    span = read.agg(F.min(seconds).alias("a"), F.max(seconds).alias("b")).first()
    path = scratch_dir(spark, "hour-deliveries")
    for i in range(4):
        part = F.floor((seconds - F.lit(span["a"])) * 4 / F.lit(span["b"] - span["a"] + 1))
        read.filter(part == i).coalesce(1).write.mode("append").parquet(path)
    stream = rain_state.rain_event_stream(runs.read_table_stream(spark, path, files=1), "series_id", "hour")
    with rain_state.rocks_state(spark):
        found = runs.run_newest(stream, name, ["series_id", "first_hour"], "first_hour", "version")
    return found.filter("event_id IS NOT NULL")


@query(
    "l7_stream_scoring",
    f"""WITH {s.HOURS}, {score_sql('hours')} SELECT series_id, {_H}, name, round(prob, 9) AS prob, exceedance FROM scores""",
)
def stream_scoring(spark, folder):
    h = materialize(_hours(spark, folder).select("series_id", "hour", "temp", "precip", "wspd"), "hours")
    stream = _table_stream(h, "hours-stream")
    out = models.score_many(stream, coefficients(h), ["series_id", "hour"]).drop("predictors")
    return shown(runs.run_append(out, "scores"), 9)


@query(
    "l8_latest_by_site",
    f"WITH {s.PREDICTIONS} SELECT name, {s.stamp('timestamp')} AS timestamp, prob, exceedance FROM predictions QUALIFY row_number() OVER (PARTITION BY name ORDER BY timestamp DESC) = 1",
)
def latest(spark, folder):
    e = runs.read_table_stream(spark, f"{folder}/events.parquet")
    prob = F.when(F.col("value") >= 2, F.col("value") / 500)
    p = e.select(F.col("event_type").alias("name"), times.as_instant(F.col("ts")).alias("timestamp"), prob.alias("prob"), (prob > 0.2).alias("exceedance"))
    path = scratch_dir(spark, "latest")

    def keep(batch, _):
        batch.write.mode("overwrite").parquet(path)

    runs.run_batches(state.latest_by_site(p, "name", "timestamp", ["prob", "exceedance"]), "latest-state", keep, "complete")
    return spark.read.parquet(path).withColumn("timestamp", s.text("timestamp"))
