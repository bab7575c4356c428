"""The given tables in the roles of the library's inputs, as frames and as SQL CTEs.

events -> observations of one series per event type, predictions and advisory intervals;
orders -> daily flow per priority; lineitem -> samples; labels with documents -> labelled rows.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from hydrosignal.functions import times
from hydrosignal.plans import weather

FMT = "yyyy-MM-dd HH:mm:ss"
SERIES = ["series_id"]
VARIABLES = ("temp", "dewpt", "wspd", "pressure")


def read(spark: SparkSession, folder: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{folder}/{name}.parquet")


def text(c: str | Column) -> Column:
    return F.date_format(c, FMT)


def rounded(df: DataFrame, digits: int = 6, *cols: str) -> DataFrame:
    """Doubles rounded, so that two engines' last bits agree."""
    chosen = cols or [c for c, t in df.dtypes if t == "double"]
    return df.withColumns({c: F.round(c, digits) + F.lit(0.0) for c in chosen})


def measures(k: Column) -> dict[str, Column]:
    """Weather-like readings derived from an event row."""
    return {
        "temp": F.col("value") / 5,
        "dewpt": k.cast("double"),
        "wspd": (F.col("user_id") % 40).cast("double"),
        "pressure": F.lit(29.0) + k / 100,
        "precip": F.greatest(F.col("value") - 150, F.lit(0.0)) / 100,
    }


def observations(spark: SparkSession, folder: str) -> DataFrame:
    return observe(read(spark, folder, "events"))


def observe(e: DataFrame) -> DataFrame:
    """Event rows (batch or stream) as observations."""
    k = F.get_json_object("props", "$.k").cast("int")
    return e.select(
        "event_id",
        F.col("event_type").alias("series_id"),
        times.as_instant(F.col("ts")).alias("ts"),
        "user_id",
        "value",
        k.alias("k"),
    ).withColumns(measures(F.col("k")))


def hours(spark: SparkSession, folder: str) -> DataFrame:
    """Complete hourly series with interpolated readings."""
    return weather.hourly_from_observations(observations(spark, folder), SERIES, "ts", VARIABLES)


def rain(spark: SparkSession, folder: str) -> DataFrame:
    """Complete hourly rain only."""
    from hydrosignal.operators import grid

    return grid.hourly_series(observations(spark, folder), SERIES, "ts", (), ["precip"])


def flow(spark: SparkSession, folder: str) -> DataFrame:
    """Daily flow per station, dated so that it overlaps the observations."""
    o = read(spark, folder, "orders")
    day = F.date_add(F.to_date("o_orderdate"), 10592)
    return o.groupBy(F.substring("o_orderpriority", 1, 1).alias("station_id"), day.alias("date")).agg(
        (F.round(F.sum("o_totalprice"), 2) / 1000).alias("flow")
    )


STATIONS = ["1", "2", "3", "4", "5"]


def samples(spark: SparkSession, folder: str) -> DataFrame:
    """Water samples in the raw file layout."""
    li = read(spark, folder, "lineitem")
    at = F.timestamp_seconds(
        F.unix_seconds(times.as_instant(F.col("l_shipdate")))
        + F.col("l_linenumber") * 7200
        + F.col("l_quantity").cast("long") * 60
    )
    return li.select(
        at.alias("Datetime"),
        F.col("l_suppkey").cast("string").alias("LocationID"),
        F.when(F.col("l_linestatus") == "O", "RECFLAG").otherwise("CSORWM").alias("ProjectID"),
        F.when(F.col("l_returnflag") == "A", "ECOLI")
        .when(F.col("l_returnflag") == "N", "ENT")
        .otherwise("OTHER")
        .alias("CharacteristicID"),
        (F.col("l_extendedprice") / 50).alias("ResultValue"),
        F.when(F.col("l_tax") > 0.07, F.lit("H")).alias("FlagID"),
        F.when(F.col("l_discount") < 0.09, F.lit("MPN/100ml")).otherwise("CFU/100ml").alias("Units"),
        (F.col("l_suppkey") % 3).cast("int").alias("LocationTypeID"),
        "l_orderkey",
        "l_linenumber",
        "l_partkey",
    )


def predictions(spark: SparkSession, folder: str) -> DataFrame:
    """Saved predictions: one per (site, instant)."""
    e = read(spark, folder, "events")
    prob = F.when(F.col("value") >= 2, F.col("value") / 500)
    return e.select(
        F.col("event_type").alias("name"),
        times.as_instant(F.col("ts")).alias("timestamp"),
        prob.alias("prob"),
        (prob > 0.2).alias("exceedance"),
        F.col("event_id"),
    )


def flags(spark: SparkSession, folder: str) -> DataFrame:
    """Advisory intervals: the strongest readings open one of six hours."""
    e = read(spark, folder, "events").filter("value > 300")
    level = F.element_at(F.array(F.lit("UNCERTAIN"), F.lit("ADVISORY"), F.lit("OFFLINE")), (F.col("event_id") % 3).cast("int") + 1)
    start = times.as_instant(F.col("ts"))
    return e.select(
        F.col("event_id").alias("id"),
        F.col("event_type").alias("location_id"),
        start.alias("start_timestamp"),
        (start + F.expr("INTERVAL 6 HOURS")).alias("end_timestamp"),
        F.lit("OTHER").alias("type"),
        level.alias("level"),
        F.concat(F.lit("Flag "), F.col("event_id").cast("string"), F.lit(".")).alias("description"),
    )


def sites(spark: SparkSession, folder: str) -> DataFrame:
    """One site per market segment and one per event type: some sites have no prediction."""
    e = read(spark, folder, "events").select(F.col("event_type").alias("name")).distinct()
    c = read(spark, folder, "customer").select(F.col("c_mktsegment").alias("name")).distinct()
    return e.unionByName(c).withColumn("tweet_name", F.initcap(F.lower("name")))


def labelled(spark: SparkSession, folder: str) -> DataFrame:
    """Labelled rows for fits: one row per labelled document."""
    d = read(spark, folder, "documents").select(
        "doc_id",
        "lang",
        "source",
        "n_chars",
        F.length("text").cast("double").alias("n_text"),
        F.length(F.regexp_replace("text", "[^aeiou]", "")).cast("double").alias("n_vowels"),
        F.size(F.split("text", "\n")).cast("double").alias("n_lines"),
        F.length(F.regexp_replace("text", "[^0-9]", "")).cast("double").alias("n_digits"),
    )
    lb = read(spark, folder, "labels")
    return lb.join(d, "doc_id").select(
        "doc_id",
        F.when(F.col("lang") == "en", "EN").otherwise("OTHER").alias("model_id"),
        F.col("source"),
        (1 - F.col("quality")).cast("double").alias("label"),
        F.log10(F.col("n_text") + 1).alias("log_text"),
        (F.col("n_vowels") / (F.col("n_text") + 1)).alias("vowel_share"),
        F.log10(F.col("n_lines") + 1).alias("log_lines"),
        (F.col("n_digits") / (F.col("n_text") + 1)).alias("digit_share"),
    )


FEATURES = ["log_text", "vowel_share", "log_lines", "digit_share"]


def scored(spark: SparkSession, folder: str) -> DataFrame:
    """Scored rows with many ties: model, subset, prob, label."""
    li = read(spark, folder, "lineitem")
    return li.select(
        F.col("l_returnflag").alias("model_id"),
        F.when(F.col("l_linestatus") == "O", "train").otherwise("test").alias("subset"),
        F.round(F.col("l_quantity") * 0.018 + F.col("l_discount"), 4).alias("prob"),
        (F.col("l_extendedprice") > 60000).cast("int").alias("label"),
    )


# ---------------------------------------------------------------- SQL counterparts


def ceil_sql(ts: str) -> str:
    return f"CASE WHEN {ts} > date_trunc('hour', {ts}) THEN date_trunc('hour', {ts}) + INTERVAL 1 HOUR ELSE {ts} END"


def stamp(c: str) -> str:
    return f"strftime({c}, '%Y-%m-%d %H:%M:%S')"


OBS = """obs AS (
  SELECT event_id, event_type AS series_id, ts, user_id, value, k,
         value / 5 AS temp, k::DOUBLE AS dewpt, (user_id % 40)::DOUBLE AS wspd,
         29e0 + k / 100e0 AS pressure, greatest(value - 150, 0e0) / 100 AS precip
  FROM (SELECT *, json_extract_string(props, '$.k')::INTEGER AS k FROM events))"""

ROLLED = f"""{OBS},
rolled AS (
  SELECT series_id, {ceil_sql('ts')} AS hour, count(*) AS n_hour, avg(temp) AS temp, avg(dewpt) AS dewpt,
         avg(wspd) AS wspd, avg(pressure) AS pressure, max(precip) AS precip
  FROM obs GROUP BY 1, 2)"""

GRID = f"""{ROLLED},
steps AS (
  SELECT series_id, unnest(generate_series(min(hour), max(hour), INTERVAL 1 HOUR)) AS hour FROM rolled GROUP BY series_id),
grid AS (
  SELECT s.series_id, s.hour, coalesce(n_hour, 0) AS n_hour, n_hour IS NULL AS missing_hour,
         temp, dewpt, wspd, pressure, coalesce(precip, 0e0) AS precip
  FROM steps s LEFT JOIN rolled r ON s.series_id = r.series_id AND s.hour = r.hour)"""


def line_sql(c: str) -> str:
    return (
        f"CASE WHEN {c} IS NOT NULL THEN {c} WHEN b_{c}.x <> a_{c}.x THEN "
        f"b_{c}.y + (a_{c}.y - b_{c}.y) * ((epoch_us(hour) - b_{c}.x) / (a_{c}.x - b_{c}.x)::DOUBLE) END AS {c}"
    )


_KNOWN = ", ".join(
    f"last_value(CASE WHEN {c} IS NOT NULL THEN struct_pack(x := epoch_us(hour), y := {c}) END IGNORE NULLS) OVER up AS b_{c}, "
    f"last_value(CASE WHEN {c} IS NOT NULL THEN struct_pack(x := epoch_us(hour), y := {c}) END IGNORE NULLS) OVER down AS a_{c}"
    for c in VARIABLES
)

HOURS = f"""{GRID},
around AS (
  SELECT *, {_KNOWN} FROM grid
  WINDOW up AS (PARTITION BY series_id ORDER BY hour ROWS BETWEEN UNBOUNDED PRECEDING AND CURRENT ROW),
         down AS (PARTITION BY series_id ORDER BY hour DESC ROWS BETWEEN UNBOUNDED PRECEDING AND CURRENT ROW)),
hours AS (
  SELECT series_id, hour, n_hour, missing_hour, precip, {', '.join(line_sql(c) for c in VARIABLES)} FROM around)"""

FLOW = """flow AS (
  SELECT substr(o_orderpriority, 1, 1) AS station_id, (o_orderdate::DATE + 10592)::DATE AS date,
         round(sum(o_totalprice), 2) / 1000 AS flow
  FROM orders GROUP BY 1, 2)"""

SAMPLES = """samples AS (
  SELECT l_shipdate + to_hours(2 * l_linenumber) + to_minutes(l_quantity::BIGINT) AS Datetime,
         l_suppkey::VARCHAR AS LocationID,
         CASE WHEN l_linestatus = 'O' THEN 'RECFLAG' ELSE 'CSORWM' END AS ProjectID,
         CASE l_returnflag WHEN 'A' THEN 'ECOLI' WHEN 'N' THEN 'ENT' ELSE 'OTHER' END AS CharacteristicID,
         l_extendedprice / 50 AS ResultValue,
         CASE WHEN l_tax > 0.07e0 THEN 'H' END AS FlagID,
         CASE WHEN l_discount < 0.09e0 THEN 'MPN/100ml' ELSE 'CFU/100ml' END AS Units,
         (l_suppkey % 3)::INTEGER AS LocationTypeID, l_orderkey, l_linenumber, l_partkey
  FROM lineitem)"""

PREDICTIONS = """predictions AS (
  SELECT event_type AS name, ts AS timestamp, CASE WHEN value >= 2 THEN value / 500 END AS prob,
         CASE WHEN value >= 2 THEN value / 500 > 0.2e0 END AS exceedance, event_id
  FROM events)"""

FLAGS = """flags AS (
  SELECT event_id AS id, event_type AS location_id, ts AS start_timestamp, ts + INTERVAL 6 HOUR AS end_timestamp,
         'OTHER' AS type, ['UNCERTAIN', 'ADVISORY', 'OFFLINE'][(event_id % 3 + 1)::INTEGER] AS level,
         'Flag ' || event_id::VARCHAR || '.' AS description
  FROM events WHERE value > 300)"""

SITES = """sites AS (
  SELECT name, upper(substr(name, 1, 1)) || lower(substr(name, 2)) AS tweet_name
  FROM (SELECT DISTINCT event_type AS name FROM events UNION ALL SELECT DISTINCT c_mktsegment FROM customer))"""

LABELLED = """labelled AS (
  SELECT doc_id, CASE WHEN lang = 'en' THEN 'EN' ELSE 'OTHER' END AS model_id, source, (1 - quality)::DOUBLE AS label,
         log10(n_text + 1) AS log_text, n_vowels / (n_text + 1) AS vowel_share, log10(n_lines + 1) AS log_lines,
         n_digits / (n_text + 1) AS digit_share
  FROM (SELECT l.doc_id, l.quality, d.lang, d.source, length(text)::DOUBLE AS n_text,
               length(regexp_replace(text, '[^aeiou]', '', 'g'))::DOUBLE AS n_vowels,
               len(string_split(text, chr(10)))::DOUBLE AS n_lines,
               length(regexp_replace(text, '[^0-9]', '', 'g'))::DOUBLE AS n_digits
        FROM labels l JOIN documents d ON l.doc_id = d.doc_id))"""

SCORED = """scored AS (
  SELECT l_returnflag AS model_id, CASE WHEN l_linestatus = 'O' THEN 'train' ELSE 'test' END AS subset,
         round(l_quantity * 0.018e0 + l_discount, 4) AS prob, (l_extendedprice > 60000)::INTEGER AS label
  FROM lineitem)"""
