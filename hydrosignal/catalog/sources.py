"""Scans, payloads, keyed writes and sinks on the given tables."""

from __future__ import annotations

from pyspark.sql import functions as F
from pyspark.sql.types import StructType

from hydrosignal.catalog import standins as s
from hydrosignal.catalog.registry import query
from hydrosignal.functions import times
from hydrosignal.operators.ordered import first_per_key
from hydrosignal.session import scratch_dir
from hydrosignal.sources import files, keyed, payloads

_RAW = ["DateHour", "LocationID", "CharacteristicID", "ResultValue", "Units", "FlagID", "LocationTypeID"]


@query(
    "a1_typed_csv_scan",
    f"""
WITH {s.SAMPLES}
SELECT LocationID, CharacteristicID, count(*) AS n, round(sum(ResultValue), 3) AS total, max(LocationTypeID) AS top_type,
       count(FlagID) AS n_flag, {s.stamp('min(Datetime)')} AS first_time
FROM samples GROUP BY 1, 2""",
)
def typed_csv(spark, folder):
    path = scratch_dir(spark, "samples-csv")
    rows = s.samples(spark, folder).withColumnRenamed("Datetime", "DateHour").select(*_RAW)
    rows.write.option("header", True).option("timestampFormat", s.FMT).csv(path)
    back = files.read_csv(spark, path, files.typed_schema(_RAW), timestamp_format=s.FMT)
    return back.groupBy("LocationID", "CharacteristicID").agg(
        F.count(F.lit(1)).alias("n"),
        F.round(F.sum("ResultValue"), 3).alias("total"),
        F.max("LocationTypeID").alias("top_type"),
        F.count("FlagID").alias("n_flag"),
        s.text(F.min("DateHour")).alias("first_time"),
    )


@query(
    "a2_latin1_dates_csv",
    """
SELECT lang, count(*) AS n, sum(length(text))::BIGINT AS n_chars,
       sum(length(regexp_replace(text, '[^à-ÿ]', '', 'g')))::BIGINT AS n_accents,
       strftime(max(DATE '2016-01-01' + (doc_id % 365)::INTEGER), '%Y-%m-%d %H:%M:%S') AS last_time
FROM documents GROUP BY lang""",
)
def latin1_csv(spark, folder):
    """Texts as they are, with their line breaks and quotes."""
    path = scratch_dir(spark, "latin1-csv")
    day = F.date_add(F.lit("2016-01-01").cast("date"), (F.col("doc_id") % 365).cast("int"))
    docs = s.read(spark, folder, "documents").select("doc_id", "lang", "text", F.date_format(day, "MM/dd/yyyy").alias("DateHour"))
    files.write_csv(docs.repartition("doc_id"), path, encoding="ISO-8859-1")
    schema = StructType.fromDDL("doc_id long, lang string, text string, DateHour timestamp")
    back = files.read_csv(spark, path, schema, encoding="ISO-8859-1", timestamp_format="MM/dd/yyyy", multi_line=True)
    return back.groupBy("lang").agg(
        F.count(F.lit(1)).alias("n"),
        F.sum(F.length("text")).alias("n_chars"),
        F.sum(F.length(F.regexp_replace("text", "[^à-ÿ]", ""))).alias("n_accents"),
        s.text(F.max("DateHour")).alias("last_time"),
    )


@query(
    "a3_gauge_tab_file",
    f"WITH {s.FLOW} SELECT 'USGS' AS agency_cd, station_id AS site_no, strftime(date, '%Y-%m-%d') AS datetime, flow FROM flow",
)
def gauge_file(spark, folder):
    path = scratch_dir(spark, "gauge-tab")
    data = s.flow(spark, folder).select(
        F.lit("USGS").alias("agency_cd"),
        F.col("station_id").alias("site_no"),
        F.date_format("date", "yyyy-MM-dd").alias("datetime"),
        F.col("flow").cast("string").alias("flow"),
    )
    head = "agency_cd\tsite_no\tdatetime\tflow"
    notes = ["# retrieved", "# daily values", head, "# types", "5s\t15s\t20d\t14n"]
    data.write.options(header=True, sep="\t").csv(path)
    data.limit(1).select(F.explode(F.array(*[F.lit(x) for x in notes]))).write.mode("append").text(path)
    return files.read_gauge_table(
        spark, path, ["agency_cd", "site_no", "datetime", "flow"], {"flow": "double", "datetime": "date"}
    ).withColumn("datetime", F.date_format("datetime", "yyyy-MM-dd"))


@query(
    "a4_lookup_files",
    """
SELECT r_name, count(*) AS n, round(sum(s_acctbal), 2) AS total
FROM supplier JOIN nation ON s_nationkey = n_nationkey JOIN region ON n_regionkey = r_regionkey GROUP BY 1""",
)
def lookup_files(spark, folder):
    base = scratch_dir(spark, "lookups")
    s.read(spark, folder, "nation").write.options(header=True, sep="\t").csv(f"{base}/nation")
    s.read(spark, folder, "region").write.options(header=True).csv(f"{base}/region")
    nation = files.read_lookup(spark, f"{base}/nation", "n_nationkey int, n_name string, n_regionkey int", "\t")
    region = files.read_lookup(spark, f"{base}/region", "r_regionkey int, r_name string")
    rows = s.read(spark, folder, "supplier")
    return (
        rows.join(nation, rows.s_nationkey == nation.n_nationkey)
        .join(region, F.col("n_regionkey") == F.col("r_regionkey"))
        .groupBy("r_name")
        .agg(F.count(F.lit(1)).alias("n"), F.round(F.sum("s_acctbal"), 2).alias("total"))
    )


@query(
    "a5_table_scan_pushdown",
    """
SELECT o_orderkey, strftime(o_orderdate, '%Y-%m-%d') AS date, o_totalprice AS flow FROM orders
WHERE o_orderpriority = '1-URGENT' AND o_orderdate >= TIMESTAMP '1997-01-01' AND o_orderdate <= TIMESTAMP '1998-12-31'""",
)
def table_scan(spark, folder):
    wanted = (
        (F.col("o_orderpriority") == "1-URGENT")
        & (F.col("o_orderdate") >= F.lit("1997-01-01").cast("timestamp_ntz"))
        & (F.col("o_orderdate") <= F.lit("1998-12-31").cast("timestamp_ntz"))
    )
    rows = files.scan(spark, f"{folder}/orders.parquet", ["o_orderkey", "o_orderdate", "o_totalprice"], wanted)
    return rows.select(
        "o_orderkey", F.date_format("o_orderdate", "yyyy-MM-dd").alias("date"), F.col("o_totalprice").alias("flow")
    )


def weather_documents(spark, folder):
    """One document per event: its reading twice (a repeated delivery) and a special report; some empty."""
    o = s.observations(spark, folder)
    part = lambda p: F.date_format("ts", p)
    utc = F.struct(
        part("yyyy").alias("year"), part("MM").alias("mon"), part("dd").alias("mday"), part("HH").alias("hour"), part("mm").alias("min")
    )

    def reading(metar):
        num = lambda c: F.col(c).cast("string")
        return F.struct(
            utc.alias("utcdate"),
            num("temp").alias("tempi"),
            F.when(F.col("k") < 5, "-9999").otherwise(num("dewpt")).alias("dewpti"),
            F.when(F.col("k") > 90, "N/A").otherwise(num("k")).alias("hum"),
            num("wspd").alias("wspdi"),
            F.lit("180").alias("wdird"),
            F.lit("10.0").alias("visi"),
            num("pressure").alias("pressurei"),
            F.when(F.col("precip") > 0, num("precip")).otherwise("-9999").alias("precipi"),
            F.concat(F.lit(metar), num("event_id")).alias("metar"),
            F.lit("0").alias("fog"),
            F.when(F.col("precip") > 0, "1").otherwise("0").alias("rain"),
            F.lit("0").alias("snow"),
            F.lit("0").alias("hail"),
            F.lit("0").alias("thunder"),
        )

    full = F.array(reading("METAR "), reading("METAR "), reading("SPECI "))
    kept = F.when(F.col("k") == 50, F.slice(full, 1, 0)).otherwise(full)
    return o.select(
        "series_id",
        F.to_date("ts").alias("date"),
        F.to_json(F.struct(F.struct(kept.alias("observations")).alias("history"))).alias("json"),
    )


@query(
    "a6_weather_document_rows",
    f"""
WITH {s.OBS}
SELECT series_id, strftime(ts, '%Y-%m-%d %H:%M:00') AS utc_timestamp, r.metar || event_id::VARCHAR AS metar,
       round(temp, 6) AS temp, precip > 0 AS wet
FROM obs CROSS JOIN (SELECT unnest(['METAR ', 'METAR ', 'SPECI ']) AS metar) r WHERE k <> 50""",
)
def weather_rows(spark, folder):
    rows = payloads.weather_observations(weather_documents(spark, folder))
    return rows.select(
        "series_id",
        s.text("utc_timestamp").alias("utc_timestamp"),
        "metar",
        F.round(F.col("tempi").cast("double"), 6).alias("temp"),
        (F.col("rain") == "1").alias("wet"),
    )


@query(
    "b3_b4_clean_weather_rows",
    f"""
WITH {s.OBS}
SELECT series_id, strftime(ts, '%Y-%m-%d %H:%M:00') AS utc_timestamp, 'METAR ' || event_id::VARCHAR AS metar,
       round(temp, 6) AS temp, CASE WHEN k >= 5 THEN dewpt END AS dewpt, CASE WHEN k <= 90 THEN k::DOUBLE END AS hum,
       round(precip, 6) AS precip, precip > 0 AS rain, false AS fog
FROM obs WHERE k <> 50""",
)
def weather_clean(spark, folder):
    rows = payloads.clean_weather(payloads.weather_observations(weather_documents(spark, folder)), s.SERIES)
    out = rows.select("series_id", s.text("utc_timestamp").alias("utc_timestamp"), "metar", "temp", "dewpt", "hum", "precip", "rain", "fog")
    return s.rounded(out, 6, "temp", "precip")


def metar_documents(spark, folder):
    o = s.observations(spark, folder)

    def report(kind, shift):
        num = lambda c: F.col(c).cast("string")
        return F.struct(
            F.lit(kind).alias("metar_type"),
            F.date_format(F.col("ts") + F.expr(f"INTERVAL {shift} MINUTES"), "yyyy-MM-dd'T'HH:mm:ss'Z'").alias("observation_time"),
            F.round("temp", 1).cast("string").alias("temp_c"),
            F.when(F.col("k") < 5, "").otherwise(num("dewpt")).alias("dewpoint_c"),
            num("wspd").alias("wind_speed_kt"),
            F.when(F.col("precip") > 0, num("precip")).otherwise("").alias("precip_in"),
            (F.lit(1000) + F.col("k")).cast("string").alias("sea_level_pressure_mb"),
        )

    both = F.array(report("METAR", 0), report("SPECI", 10), report("METAR", 20))
    return o.select("series_id", F.to_date("ts").alias("date"), F.to_json(both).alias("json"))


_METAR = f"""{s.OBS},
reports AS (
  SELECT series_id, date_trunc('second', ts) + to_minutes(m) AS observation_time, round(temp, 1) AS temp_c,
         CASE WHEN k >= 5 THEN dewpt END AS dewpoint_c, wspd AS wind_speed_kt, precip AS precip_in, 1000e0 + k AS sea_level_pressure_mb
  FROM obs CROSS JOIN (SELECT unnest([0, 20]) AS m) x
  WHERE ts::DATE BETWEEN DATE '2024-01-05' AND DATE '2024-01-20')"""


@query(
    "a7_metar_hourly_function",
    f"""
WITH {_METAR}
SELECT series_id, {s.stamp('observation_time')} AS observation_time, temp_c, dewpoint_c, wind_speed_kt,
       round(precip_in, 6) AS precip_in, sea_level_pressure_mb FROM reports""",
)
def metar_rows(spark, folder):
    d = lambda x: F.lit(x).cast("date")
    rows = payloads.metar_hourly(metar_documents(spark, folder), d("2024-01-05"), d("2024-01-20")).drop("date")
    return s.rounded(rows.withColumn("observation_time", s.text("observation_time")), 6, "precip_in")


def _text_payloads(spark, folder):
    """One downloaded text per event; readings below 5 lost their header."""
    o = s.observations(spark, folder)
    ts = F.date_format("ts", "yyyy-MM-dd'T'HH:mm:ss'Z'")
    row = lambda x: F.concat_ws(",", F.concat(F.lit('"KBOS '), F.col("event_id"), F.lit(f' {x},raw"')), F.lit("KBOS"), ts, F.round("temp", 1).cast("string"))
    body = F.concat_ws(
        "\n",
        F.lit("No errors"),
        F.lit("No warnings"),
        F.lit("2 results"),
        F.when(F.col("value") >= 5, F.lit("raw_text,station_id,observation_time,temp_c")),
        row("a"),
        F.lit(""),
        row("b"),
    )
    return o.select("event_id", body.alias("value"))


@query(
    "a8_text_payload_rows",
    f"""
WITH {s.OBS}
SELECT event_id, 'KBOS ' || event_id || ' ' || x || ',raw' AS raw_text, 'KBOS' AS station_id, round(temp, 1) AS temp_c
FROM obs CROSS JOIN (SELECT unnest(['a', 'b']) AS x) r WHERE value >= 5""",
)
def text_rows(spark, folder):
    rows, _ = payloads.preamble_csv(_text_payloads(spark, folder), "raw_text string, station_id string, temp_c double")
    return rows


@query("a8_text_payload_rejects", "SELECT event_id FROM events WHERE value < 5")
def text_rejects(spark, folder):
    _, rejected = payloads.preamble_csv(_text_payloads(spark, folder), "raw_text string")
    return rejected


@query(
    "a9_daily_flow_json",
    """
SELECT o_orderpriority AS station_id, strftime(o_orderdate + to_days(i), '%Y-%m-%d') AS date,
       CASE WHEN i = 0 THEN o_totalprice END AS flow
FROM orders CROSS JOIN (SELECT unnest([0, 1]) AS i) x WHERE o_orderstatus <> 'P'""",
)
def flow_json(spark, folder):
    o = s.read(spark, folder, "orders")
    value = lambda day, v: F.struct(
        F.date_format(F.date_add("o_orderdate", day), "yyyy-MM-dd'T'00:00:00.000").alias("dateTime"), v.alias("value")
    )
    block = lambda *v: F.struct(F.array(*v).alias("value"))
    first = block(value(0, F.col("o_totalprice").cast("string")), value(1, F.lit("Ice")))
    empty = F.struct(F.slice(first["value"], 1, 0).alias("value"))
    second = block(value(5, F.lit("-1")))
    series = lambda code, b: F.struct(
        F.struct(F.array(F.struct(code.alias("value"))).alias("siteCode")).alias("sourceInfo"), F.array(b, second).alias("values")
    )
    has = F.when(F.col("o_orderstatus") == "P", empty).otherwise(first)
    docs = o.select(
        F.to_json(
            F.struct(F.struct(F.array(series(F.col("o_orderpriority"), has), series(F.lit("x"), second)).alias("timeSeries")).alias("value"))
        ).alias("json")
    )
    return payloads.daily_flow(docs).withColumn("date", F.date_format("date", "yyyy-MM-dd"))


def _flow_rows(spark, folder, new: bool):
    o = s.read(spark, folder, "orders")
    chosen = F.col("o_orderstatus") == "P"
    return o.filter(chosen if new else ~chosen).select(
        F.col("o_custkey").alias("station_id"), F.to_date("o_orderdate").alias("date"), F.col("o_totalprice").alias("flow"), "o_orderkey"
    )


_STORED = """stored AS (
  SELECT o_custkey AS station_id, o_orderdate::DATE AS date, o_totalprice AS flow, o_orderkey FROM orders WHERE o_orderstatus <> 'P'
  QUALIFY row_number() OVER (PARTITION BY o_custkey, o_orderdate::DATE ORDER BY o_orderkey DESC) = 1),
fresh AS (
  SELECT o_custkey AS station_id, o_orderdate::DATE AS date, o_totalprice AS flow, o_orderkey FROM orders WHERE o_orderstatus = 'P')"""
_DAY = "strftime(date, '%Y-%m-%d') AS date"


def _stored(spark, folder):
    return first_per_key(_flow_rows(spark, folder, False), ["station_id", "date"], [F.col("o_orderkey").desc()])


@query(
    "a10_upsert_by_key",
    f"""
WITH {_STORED}
SELECT station_id, {_DAY}, flow, o_orderkey
FROM (SELECT *, 1 AS n FROM fresh UNION ALL SELECT *, 0 AS n FROM stored)
QUALIFY row_number() OVER (PARTITION BY station_id, date ORDER BY n DESC, o_orderkey DESC) = 1""",
)
def upsert_rows(spark, folder):
    out = keyed.upsert(_stored(spark, folder), _flow_rows(spark, folder, True), ["station_id", "date"], [F.col("o_orderkey").desc()])
    return out.withColumn("date", F.date_format("date", "yyyy-MM-dd"))


@query(
    "a11_append_new_keys",
    f"WITH {_STORED} SELECT f.station_id, strftime(f.date, '%Y-%m-%d') AS date, f.flow, f.o_orderkey FROM fresh f "
    "WHERE NOT EXISTS (SELECT 1 FROM stored s WHERE s.station_id = f.station_id AND s.date = f.date) "
    "QUALIFY row_number() OVER (PARTITION BY f.station_id, f.date ORDER BY f.flow, f.o_orderkey) = 1",
)
def append_rows(spark, folder):
    out = keyed.new_rows(_stored(spark, folder), _flow_rows(spark, folder, True), ["station_id", "date"])
    return out.withColumn("date", F.date_format("date", "yyyy-MM-dd"))


@query(
    "a11_key_conflicts",
    f"""
WITH {_STORED},
n AS (SELECT station_id, date, count(*) AS n_new FROM fresh GROUP BY 1, 2)
SELECT n.station_id, strftime(n.date, '%Y-%m-%d') AS date, n_new, CASE WHEN s.flow IS NULL THEN 0 ELSE 1 END AS n_stored
FROM n LEFT JOIN stored s ON s.station_id = n.station_id AND s.date = n.date WHERE n_new > 1 OR s.flow IS NOT NULL""",
)
def conflicts(spark, folder):
    out = keyed.key_conflicts(_stored(spark, folder), _flow_rows(spark, folder, True), ["station_id", "date"])
    return out.withColumn("date", F.date_format("date", "yyyy-MM-dd"))


@query(
    "a12_csv_sink_formatted",
    f"""
WITH {s.SAMPLES}
SELECT LocationID, {s.stamp('Datetime')} AS timestamp, count(*) AS n FROM samples GROUP BY 1, 2""",
)
def csv_sink(spark, folder):
    path = scratch_dir(spark, "csv-sink")
    rows = s.samples(spark, folder).select("LocationID", F.col("Datetime").alias("timestamp"))
    files.write_csv(rows, path, ["timestamp"])
    return (
        spark.read.option("header", True).schema("LocationID string, timestamp string").csv(path)
        .groupBy("LocationID", "timestamp").agg(F.count(F.lit(1)).alias("n"))
    )


@query(
    "a13_dataset_sink",
    f"WITH {s.FLOW} SELECT station_id, strftime(date, '%Y-%m-%d') AS date, flow FROM flow",
)
def dataset_sink(spark, folder):
    path = scratch_dir(spark, "dataset")
    files.write_dataset(s.flow(spark, folder), path, ["station_id"])
    back = spark.read.schema("date date, flow double, station_id string").parquet(path)
    return back.select("station_id", F.date_format("date", "yyyy-MM-dd").alias("date"), "flow")


@query(
    "a15_predictor_json_to_long",
    f"""
WITH {s.OBS}
SELECT event_id, key, round(value, 6) AS value
FROM (UNPIVOT (SELECT event_id, temp, dewpt, pressure, precip FROM obs) ON temp, dewpt, pressure, precip INTO NAME key VALUE value)""",
)
def predictor_json(spark, folder):
    o = s.observations(spark, folder)
    stored = o.select(
        "event_id", payloads.predictors_to_json(F.struct("temp", "dewpt", "pressure", "precip")).alias("predictors")
    )
    return s.rounded(payloads.json_to_long(stored, ["event_id"], "predictors"))


@query(
    "a16_backfill_days",
    """
SELECT strftime(d, '%Y-%m-%d') AS date FROM (SELECT unnest(generate_series(TIMESTAMP '1994-12-01', TIMESTAMP '2001-12-31', INTERVAL 1 DAY)) AS d)
WHERE d NOT IN (SELECT DISTINCT date_trunc('day', o_orderdate) FROM orders WHERE o_orderpriority = '1-URGENT')""",
)
def backfill(spark, folder):
    landed = s.read(spark, folder, "orders").filter("o_orderpriority = '1-URGENT'").select(F.to_date("o_orderdate").alias("date"))
    d = lambda x: F.lit(x).cast("date")
    return keyed.backfill_days(spark, landed, d("1994-12-01"), d("2001-12-31")).select(F.date_format("date", "yyyy-MM-dd").alias("date"))


@query(
    "a17_request_bounds",
    """
SELECT strftime(d, '%Y-%m-%d') AS date,
       strftime(d AT TIME ZONE 'US/Eastern' AT TIME ZONE 'UTC', '%Y-%m-%d %H:%M:%S') AS start_time,
       strftime((d + INTERVAL 1 DAY) AT TIME ZONE 'US/Eastern' AT TIME ZONE 'UTC' - INTERVAL 1 SECOND, '%Y-%m-%d %H:%M:%S') AS end_time
FROM (SELECT DISTINCT date_trunc('day', o_orderdate) AS d FROM orders)""",
)
def bounds(spark, folder):
    days = s.read(spark, folder, "orders").select(F.to_date("o_orderdate").alias("date")).distinct()
    out = keyed.request_bounds(days)
    return out.select(F.date_format("date", "yyyy-MM-dd").alias("date"), s.text("start_time").alias("start_time"), s.text("end_time").alias("end_time"))


@query(
    "a18_apply_changes",
    """
WITH log AS (
  SELECT o_custkey AS id, o_orderkey AS version, o_totalprice AS amount,
         CASE o_orderstatus WHEN 'F' THEN 'update' WHEN 'O' THEN 'delete' ELSE 'insert' END AS op FROM orders),
base AS (SELECT c_custkey AS id, -1 AS version, c_acctbal AS amount FROM customer WHERE c_mktsegment <> 'MACHINERY'),
life AS (
  SELECT id, max(version) FILTER (WHERE op IN ('insert', 'base')) AS born, max(version) FILTER (WHERE op = 'delete') AS died
  FROM (SELECT id, version, op FROM log UNION ALL SELECT id, version, 'base' FROM base) GROUP BY id),
latest AS (
  SELECT id, amount FROM (SELECT id, version, amount, op FROM log UNION ALL SELECT id, version, amount, 'base' FROM base)
  QUALIFY row_number() OVER (PARTITION BY id ORDER BY version DESC) = 1)
SELECT l.id, l.amount FROM latest l JOIN life USING (id) WHERE born IS NOT NULL AND (died IS NULL OR born > died)""",
)
def changes(spark, folder):
    o = s.read(spark, folder, "orders")
    op = F.when(F.col("o_orderstatus") == "F", "update").when(F.col("o_orderstatus") == "O", "delete").otherwise("insert")
    log = o.select(F.col("o_custkey").alias("id"), F.col("o_orderkey").alias("version"), F.col("o_totalprice").alias("amount"), op.alias("op"))
    c = s.read(spark, folder, "customer").filter("c_mktsegment <> 'MACHINERY'")
    base = c.select(F.col("c_custkey").alias("id"), F.col("c_acctbal").alias("amount"))
    return keyed.apply_changes(base, log, "id", "version")
