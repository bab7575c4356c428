"""Interval states, status decisions, feed and bulletin on the given tables."""

from __future__ import annotations

from pyspark.sql import functions as F

from hydrosignal.catalog import standins as s
from hydrosignal.catalog.columns import zone_sql
from hydrosignal.catalog.registry import query
from hydrosignal.operators import status

NOW = "2024-01-20 15:00:00"
LINK = "https://example.org/advisory"


def _now():
    return F.lit(NOW).cast("timestamp")


_STATE = f"CASE WHEN end_timestamp < TIMESTAMP '{NOW}' THEN 'EXPIRED' WHEN start_timestamp > TIMESTAMP '{NOW}' THEN 'PENDING' ELSE 'ACTIVE' END"


def decide_sql(p="exceedance"):
    over = f"(n_flags > 0 AND coalesce({p}, false) AND NOT any_offline)"
    kind = (
        f"CASE WHEN {over} THEN 'advisory' WHEN n_flags > 0 AND any_advisory THEN 'advisory' WHEN n_flags > 0 AND any_uncertain THEN 'uncertain' "
        f"WHEN n_flags > 0 THEN 'unknown' WHEN {p} IS NULL THEN 'unknown' WHEN {p} THEN 'advisory' ELSE 'good' END"
    )
    reason = (
        f"CASE WHEN {over} THEN '{status.HIGH} ' || flag_text WHEN n_flags > 0 THEN flag_text WHEN {p} IS NULL THEN '{status.NO_DATA}' "
        f"WHEN {p} THEN '{status.HIGH}' ELSE '{status.LOW}' END"
    )
    label = "CASE status_type WHEN 'advisory' THEN 'Advisory' WHEN 'uncertain' THEN 'Uncertain' WHEN 'good' THEN 'Good' ELSE 'Not Available' END"
    return kind, label, reason


_KIND, _LABEL, _REASON = decide_sql()

_SUMMARY = """count(*) AS n_flags, bool_or(level = 'OFFLINE') AS any_offline, bool_or(level = 'ADVISORY') AS any_advisory,
       bool_or(level = 'UNCERTAIN') AS any_uncertain, string_agg(description, ' ' ORDER BY id) AS flag_text"""

_COVERED = f"""{s.PREDICTIONS}, {s.FLAGS},
covered AS (
  SELECT p.name, p.timestamp, {_SUMMARY} FROM (SELECT DISTINCT name, timestamp FROM predictions) p
  JOIN flags f ON f.location_id = p.name AND f.start_timestamp <= p.timestamp AND p.timestamp <= f.end_timestamp GROUP BY 1, 2),
joined AS (
  SELECT p.name, p.timestamp, p.prob, p.exceedance, p.event_id, coalesce(n_flags, 0) AS n_flags, any_offline, any_advisory, any_uncertain, flag_text
  FROM predictions p LEFT JOIN covered c ON c.name = p.name AND c.timestamp = p.timestamp),
decided AS (SELECT *, {_KIND} AS status_type, {_REASON} AS reason FROM joined)"""


def _flat(df, *cols):
    return df.select(*cols, F.col("status.type").alias("status_type"), F.col("status.label").alias("label"), F.col("status.reason").alias("reason"))


@query("k1_interval_state", f"WITH {s.FLAGS} SELECT id, location_id, {_STATE} AS state FROM flags")
def interval_state(spark, folder):
    state = status.interval_state(F.col("start_timestamp"), F.col("end_timestamp"), _now())
    return s.flags(spark, folder).select("id", "location_id", state.alias("state"))


@query(
    "k2_status_of_every_prediction",
    f"WITH {_COVERED} SELECT event_id, n_flags, status_type, {_LABEL} AS label, reason FROM decided",
)
def decisions(spark, folder):
    rows = status.with_covering_flags(s.predictions(spark, folder), s.flags(spark, folder))
    rows = rows.withColumns({"status": status.decide(F.col("exceedance")), "n_flags": F.coalesce("n_flags", F.lit(0))})
    return _flat(rows, "event_id", "n_flags")


_LT = "(timestamp AT TIME ZONE 'UTC' AT TIME ZONE 'US/Eastern')"
_RECENT = f"{_LT}::DATE >= (TIMESTAMP '{NOW}' AT TIME ZONE 'UTC' AT TIME ZONE 'US/Eastern')::DATE - 6"


@query(
    "k3_seven_day_feed",
    f"""
WITH {_COVERED}
SELECT event_id, strftime({_LT}, '%b %d %Y') AS day_label,
       strftime({_LT}, '%b %-d %Y %-H:%M ') || lower(strftime({_LT}, '%p')) || ' ' || {zone_sql('timestamp', _LT)} AS timestamp_local,
       status_type, {_LABEL} AS label, reason
FROM decided WHERE {_RECENT}""",
)
def feed(spark, folder):
    rows = status.feed(s.predictions(spark, folder), s.flags(spark, folder), _now())
    return _flat(rows, "event_id", "day_label", "timestamp_local")


@query(
    "k3_flags_of_feed",
    f"""
WITH {s.PREDICTIONS}, {s.FLAGS}
SELECT p.event_id, f.id AS flag_id FROM predictions p
LEFT JOIN flags f ON f.location_id = p.name AND f.start_timestamp <= p.timestamp AND p.timestamp <= f.end_timestamp WHERE {_RECENT}""",
)
def feed_flags(spark, folder):
    rows = status.feed(s.predictions(spark, folder), s.flags(spark, folder), _now())
    return rows.select("event_id", F.explode_outer("flag_ids").alias("flag_id"))


@query(
    "k4_site_history",
    f"""
WITH {_COVERED}, {s.SITES}
SELECT name, tweet_name, {s.stamp('timestamp')} AS timestamp, event_id, n_flags, status_type, {_LABEL} AS label, reason
FROM decided JOIN sites USING (name) WHERE {_RECENT}""",
)
def history(spark, folder):
    rows = status.site_history(s.sites(spark, folder), s.predictions(spark, folder), s.flags(spark, folder), _now())
    rows = rows.withColumns({"timestamp": s.text("timestamp"), "n_flags": F.coalesce("n_flags", F.lit(0))})
    return _flat(rows, "name", "tweet_name", "timestamp", "event_id", "n_flags")


@query(
    "k4_site_flags",
    f"WITH {s.FLAGS}, {s.SITES} SELECT name, tweet_name, id, level, description, {_STATE} AS state FROM flags JOIN sites ON name = location_id",
)
def site_flags(spark, folder):
    rows = status.site_flags(s.sites(spark, folder), s.flags(spark, folder), _now())
    return rows.select("name", "tweet_name", "id", "level", "description", "state")


@query(
    "k4_current_status_per_site",
    f"""
WITH {s.PREDICTIONS}, {s.FLAGS}, {s.SITES},
latest AS (SELECT * FROM predictions WHERE {_RECENT} QUALIFY row_number() OVER (PARTITION BY name ORDER BY timestamp DESC) = 1),
active AS (SELECT location_id AS name, {_SUMMARY} FROM flags WHERE {_STATE} = 'ACTIVE' GROUP BY 1),
joined AS (
  SELECT s.name, s.tweet_name, l.timestamp, l.prob, l.exceedance, coalesce(n_flags, 0) AS n_flags, any_offline, any_advisory, any_uncertain, flag_text
  FROM sites s LEFT JOIN latest l ON l.name = s.name LEFT JOIN active a ON a.name = s.name),
decided AS (SELECT *, {_KIND} AS status_type, {_REASON} AS reason FROM joined)
SELECT name, tweet_name, {s.stamp('timestamp')} AS timestamp, prob, status_type, {_LABEL} AS label, reason FROM decided""",
)
def current(spark, folder):
    rows = status.current_status(s.sites(spark, folder), s.predictions(spark, folder), s.flags(spark, folder), _now())
    return _flat(rows.withColumn("timestamp", s.text("timestamp")), "name", "tweet_name", "timestamp", "prob")


@query(
    "k5_bulletin",
    f"""
WITH {s.PREDICTIONS}, {s.SITES},
latest AS (SELECT * FROM predictions QUALIFY row_number() OVER (PARTITION BY name ORDER BY timestamp DESC) = 1)
SELECT string_agg(tweet_name || ': ' || CASE WHEN exceedance IS NULL THEN 'Not Available' WHEN exceedance THEN 'Advisory' ELSE 'Good' END, chr(10) ORDER BY name)
       || chr(10) || chr(10) || 'More Info: {LINK}' AS text
FROM latest JOIN sites USING (name)""",
)
def bulletin(spark, folder):
    return status.bulletin(s.sites(spark, folder), s.predictions(spark, folder), LINK)


@query(
    "k6_status_colours",
    f"""
WITH {_COVERED}
SELECT CASE status_type WHEN 'good' THEN 'green' WHEN 'advisory' THEN 'red' WHEN 'uncertain' THEN 'yellow' ELSE 'gray' END AS colour, count(*) AS n
FROM decided GROUP BY 1""",
)
def colours(spark, folder):
    rows = status.with_covering_flags(s.predictions(spark, folder), s.flags(spark, folder))
    kind = status.decide(F.col("exceedance"))["type"]
    return rows.groupBy(status.colour(kind).alias("colour")).agg(F.count(F.lit(1)).alias("n"))
