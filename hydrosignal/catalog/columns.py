"""Projections, filters, checks and scalar functions on the given tables."""

from __future__ import annotations

from pyspark.sql import functions as F

from hydrosignal.catalog import standins as s
from hydrosignal.catalog.registry import query
from hydrosignal.functions import clean, times
from hydrosignal.operators import joins, labels, models, reshape, summaries
from hydrosignal.session import scratch_dir
from hydrosignal.sources import gated

_SAMPLE_ID = "l_orderkey, l_linenumber, l_partkey"
_ID = ["l_orderkey", "l_linenumber", "l_partkey"]


@query(
    "b1_select_rename_reorder",
    "SELECT l_orderkey AS visit_id, l_extendedprice AS concentration, l_returnflag AS parameter, l_quantity FROM lineitem",
)
def select_rename(spark, folder):
    li = s.read(spark, folder, "lineitem").drop("l_tax", "l_discount")
    named = li.withColumnsRenamed({"l_returnflag": "parameter", "l_extendedprice": "concentration", "l_orderkey": "visit_id"})
    front = ["visit_id", "concentration"]
    return named.select(*front, *[c for c in named.columns if c not in front]).select("visit_id", "concentration", "parameter", "l_quantity")


@query(
    "b2_columns_by_prefix",
    "SELECT o_orderkey, round(o_totalprice, 1) AS o_totalprice FROM orders",
)
def by_prefix(spark, folder):
    o = s.read(spark, folder, "orders").select("o_orderkey", "o_totalprice")
    return reshape.transform_columns(o, reshape.with_prefix(o, "o_total"), lambda c: F.round(c, 1))


@query(
    "b3_bulk_casts",
    """
SELECT doc_id, try_cast(source AS INTEGER) AS as_int, try_cast(substr(source, 4) AS INTEGER) % 2 = 1 AS as_flag, n_chars::DOUBLE AS as_double
FROM documents""",
)
def casts(spark, folder):
    d = s.read(spark, folder, "documents")
    parity = (F.substring("source", 4, 9).try_cast("int") % 2).cast("string")
    return d.select(
        "doc_id",
        F.col("source").try_cast("int").alias("as_int"),
        clean.to_flag(parity).alias("as_flag"),
        clean.to_number(F.col("n_chars").cast("string")).alias("as_double"),
    )


@query(
    "b4_sentinel_to_null",
    """
SELECT event_id, CASE WHEN value < 50 THEN NULL ELSE value END AS value, nullif(event_type, 'error') AS event_type FROM events""",
)
def sentinels(spark, folder):
    e = s.read(spark, folder, "events")
    coded = e.select("event_id", F.when(F.col("value") < 50, "-9999").otherwise(F.col("value").cast("string")).alias("value"), "event_type")
    return coded.select("event_id", clean.to_number(F.col("value")).alias("value"), clean.null_if(F.col("event_type"), "error").alias("event_type"))


@query(
    "b5_default_for_null",
    f"WITH {s.PREDICTIONS} SELECT event_id, coalesce(prob, 0e0) AS prob FROM predictions",
)
def defaults(spark, folder):
    return s.predictions(spark, folder).select("event_id", clean.or_zero(F.col("prob")).alias("prob"))


@query("b6_text_prefix_filter", "SELECT page_id, url FROM pages WHERE url LIKE 'http://m.%'")
def prefix_filter(spark, folder):
    return s.read(spark, folder, "pages").filter(F.col("url").startswith("http://m.")).select("page_id", "url")


@query(
    "b7_date_range_and_key_filter",
    """
SELECT o_orderkey, strftime(o_orderdate, '%Y-%m-%d') AS date FROM orders
WHERE o_orderpriority = '2-HIGH' AND o_orderdate BETWEEN TIMESTAMP '1996-05-01' AND TIMESTAMP '1999-10-31'""",
)
def date_filter(spark, folder):
    o = s.read(spark, folder, "orders")
    stamp = lambda x: F.lit(x).cast("timestamp_ntz")
    return o.filter(
        (F.col("o_orderpriority") == "2-HIGH") & F.col("o_orderdate").between(stamp("1996-05-01"), stamp("1999-10-31"))
    ).select("o_orderkey", F.date_format("o_orderdate", "yyyy-MM-dd").alias("date"))


@query(
    "b8_membership_filter",
    "SELECT c_custkey, c_mktsegment FROM customer WHERE c_mktsegment IN ('BUILDING', 'MACHINERY')",
)
def membership(spark, folder):
    c = s.read(spark, folder, "customer")
    wanted = F.lit("BUILDING + MACHINERY + RIVER")
    return c.filter(clean.in_delimited(F.col("c_mktsegment"), wanted)).select("c_custkey", "c_mktsegment")


@query(
    "b9_characteristic_unit_filter",
    f"""
WITH {s.SAMPLES}
SELECT {_SAMPLE_ID}, CharacteristicID, ResultValue FROM samples
WHERE ((CharacteristicID = 'ECOLI' AND Units = 'MPN/100ml') OR (CharacteristicID = 'ENT' AND Units = 'MPN/100ml')) AND FlagID IS NULL""",
)
def any_pair_filter(spark, folder):
    x = s.samples(spark, folder)
    pairs = [("ECOLI", "MPN/100ml"), ("ENT", "MPN/100ml")]
    return x.filter(clean.any_pair(F.col("CharacteristicID"), F.col("Units"), pairs) & F.col("FlagID").isNull()).select(
        *_ID, "CharacteristicID", "ResultValue"
    )


@query(
    "b10_season_filter",
    f"""
WITH {s.SAMPLES}
SELECT {_SAMPLE_ID}, {s.stamp('Datetime')} AS timestamp FROM samples
WHERE year(Datetime) BETWEEN 1996 AND 1999 AND month(Datetime) BETWEEN 5 AND 10""",
)
def season(spark, folder):
    x = s.samples(spark, folder)
    return x.filter(clean.in_season(F.col("Datetime"), 1996, 1999)).select(*_ID, s.text("Datetime").alias("timestamp"))


@query(
    "b11_from_first_reference_row",
    "SELECT o_orderkey FROM orders WHERE o_orderdate >= (SELECT min(l_shipdate) + INTERVAL 400 DAY FROM lineitem)",
)
def from_first(spark, folder):
    o = s.read(spark, folder, "orders").select("o_orderkey", "o_orderdate")
    ref = s.read(spark, folder, "lineitem").select((F.col("l_shipdate") + F.expr("INTERVAL 400 DAYS")).alias("t"))
    return joins.from_first(o, "o_orderdate", ref, "t").select("o_orderkey")


@query(
    "b12_drop_null_rows",
    f"WITH {s.PREDICTIONS} SELECT event_id, prob FROM predictions WHERE prob IS NOT NULL",
)
def drop_nulls(spark, folder):
    return s.predictions(spark, folder).dropna(subset=["prob"]).select("event_id", "prob")


@query("b13_distinct_rows", "SELECT DISTINCT l_orderkey, l_linenumber FROM lineitem")
def distinct_rows(spark, folder):
    return s.read(spark, folder, "lineitem").select("l_orderkey", "l_linenumber").dropDuplicates()


@query(
    "b14_class_dummy_clamp",
    f"""
WITH {s.OBS}
SELECT event_id, CASE WHEN value > 200 THEN 'yes' ELSE 'no' END AS exceedance_class,
       CASE WHEN precip < 0.001e0 THEN 0 ELSE 1 END AS any_rain, round(log10(greatest(precip, 0.1e0)), 6) AS log_precip FROM obs""",
)
def class_dummy(spark, folder):
    o = s.observations(spark, folder)
    return s.rounded(
        o.select(
            "event_id",
            clean.class_label(F.col("value") > 200).alias("exceedance_class"),
            F.when(F.col("precip") < 0.001, 0).otherwise(1).alias("any_rain"),
            clean.log10_floor(F.col("precip"), 0.1).alias("log_precip"),
        )
    )


@query(
    "b15_exceedance_by_standard",
    f"""
WITH {s.SAMPLES}
SELECT {_SAMPLE_ID}, CharacteristicID AS parameter, ResultValue AS concentration,
       CASE CharacteristicID WHEN 'ECOLI' THEN 1260e0 WHEN 'ENT' THEN 350e0 END AS standard_value,
       ResultValue > CASE CharacteristicID WHEN 'ECOLI' THEN 1260e0 WHEN 'ENT' THEN 350e0 END AS exceedance FROM samples""",
)
def exceedance(spark, folder):
    x = s.samples(spark, folder).select(
        *_ID, F.col("CharacteristicID").alias("parameter"), F.col("ResultValue").alias("concentration")
    )
    return labels.label_exceedance(x, labels.standards(spark, "Boating"))


@query(
    "b15_exceedance_swimming_share",
    f"""
WITH {s.SAMPLES}
SELECT CharacteristicID AS parameter, count(*) AS n_samples,
       round(avg((ResultValue > CASE CharacteristicID WHEN 'ECOLI' THEN 235e0 ELSE 104e0 END)::INTEGER), 6) AS frac_exceed
FROM samples WHERE CharacteristicID <> 'OTHER' GROUP BY 1""",
)
def exceedance_swimming(spark, folder):
    x = s.samples(spark, folder).filter("CharacteristicID <> 'OTHER'").select(
        F.col("CharacteristicID").alias("parameter"), F.col("ResultValue").alias("concentration")
    )
    labelled = labels.label_exceedance(x, labels.standards(spark, "Swimming"))
    return s.rounded(summaries.share_by(labelled, ["parameter"], F.col("exceedance")))


@query(
    "b16_null_gate",
    f"""
WITH {s.GRID}
SELECT series_id, 'temp' AS "column", count(*) FILTER (WHERE temp IS NULL) AS n_null FROM grid GROUP BY 1 HAVING n_null > 0
UNION ALL
SELECT series_id, 'precip', count(*) FILTER (WHERE precip IS NULL) AS n_null FROM grid GROUP BY 1 HAVING n_null > 0""",
)
def null_gate(spark, folder):
    from hydrosignal.operators import grid

    g = grid.hourly_series(s.observations(spark, folder), s.SERIES, "ts", ["temp"], ["precip"])
    return summaries.null_violations(g, s.SERIES, ["temp", "precip"])


@query(
    "b16_single_row_gate",
    "SELECT l_orderkey, l_linenumber, count(*) AS n FROM lineitem GROUP BY 1, 2 HAVING count(*) <> 1",
)
def single_gate(spark, folder):
    return summaries.not_single(s.read(spark, folder, "lineitem"), ["l_orderkey", "l_linenumber"])


@query(
    "b16_checksum_gate",
    """
WITH d AS (
  SELECT l_returnflag, round(sum(CASE WHEN l_linestatus = 'O' THEN 0 ELSE l_extendedprice END), 2) AS difference FROM lineitem GROUP BY 1)
SELECT l_returnflag, difference, abs(difference) < 0.1e0 AS ok FROM d""",
)
def checksum_gate(spark, folder):
    li = s.read(spark, folder, "lineitem").select("l_returnflag", "l_extendedprice", "l_linestatus")
    out = summaries.checksum(li, li.filter("l_linestatus = 'O'"), ["l_returnflag"], "l_extendedprice")
    return s.rounded(out, 2)


@query(
    "b16_gated_write",
    """
SELECT l_returnflag, count(*) AS n, round(sum(l_quantity), 2) AS quantity, (SELECT count(*) FROM lineitem WHERE l_tax IS NULL) AS nulls_l_tax,
       (SELECT count(*) FROM lineitem) AS all_rows FROM lineitem GROUP BY 1""",
)
def gated_write(spark, folder):
    """A table published after its gates held, which were counted while it was written."""
    path = scratch_dir(spark, "published")
    li = s.read(spark, folder, "lineitem").select("l_returnflag", "l_quantity", "l_tax")
    gates = [*gated.complete("l_returnflag", "l_tax"), gated.Gate("all_rows", F.count(F.lit(1)), 1, 1e18)]
    figures = gated.publish(li, path, gates, ["l_returnflag"])
    out = spark.read.parquet(path).groupBy("l_returnflag").agg(F.count(F.lit(1)).alias("n"), F.round(F.sum("l_quantity"), 2).alias("quantity"))
    return out.withColumns({c: F.lit(figures[c]) for c in ("nulls_l_tax", "all_rows")})


@query(
    "b17_unit_conversion",
    f"""
WITH {s.OBS}
SELECT event_id, round(temp * 9 / 5 + 32, 6) AS temp, round(wspd * 1.152e0, 6) AS wspd, round(pressure * 0.02953e0, 6) AS pressure FROM obs""",
)
def units(spark, folder):
    return s.rounded(
        s.observations(spark, folder).select(
            "event_id",
            clean.fahrenheit(F.col("temp")).alias("temp"),
            clean.miles_per_hour(F.col("wspd")).alias("wspd"),
            clean.inches_of_mercury(F.col("pressure")).alias("pressure"),
        )
    )


@query("c1_timestamp_from_parts", "SELECT event_id, strftime(ts, '%Y-%m-%d %H:%M:00') AS t FROM events")
def from_parts(spark, folder):
    o = s.observations(spark, folder)
    part = lambda p: F.date_format("ts", p)
    t = times.from_parts(part("yyyy"), part("M"), part("d"), part("H"), part("m"))
    return o.select("event_id", s.text(t).alias("t"))


@query(
    "c2_wall_clock_of_zone",
    f"WITH {s.SAMPLES} SELECT {_SAMPLE_ID}, strftime(Datetime AT TIME ZONE 'UTC' AT TIME ZONE 'US/Eastern', '%Y-%m-%d %H:%M:%S') AS local FROM samples",
)
def wall(spark, folder):
    return s.samples(spark, folder).select(*_ID, s.text(times.wall_clock(F.col("Datetime"))).alias("local"))


@query(
    "c3_instant_of_wall_clock",
    f"WITH {s.SAMPLES} SELECT {_SAMPLE_ID}, strftime(Datetime AT TIME ZONE 'US/Eastern' AT TIME ZONE 'UTC', '%Y-%m-%d %H:%M:%S') AS utc FROM samples",
)
def instant(spark, folder):
    return s.samples(spark, folder).select(*_ID, s.text(times.instant_of(F.col("Datetime"))).alias("utc"))


@query(
    "c4_c5_ceil_and_floor_hour",
    f"""
SELECT event_id, {s.stamp(s.ceil_sql('ts'))} AS up, {s.stamp("date_trunc('hour', ts)")} AS down,
       {s.stamp(s.ceil_sql("date_trunc('hour', ts)"))} AS exact FROM events""",
)
def ceil_floor(spark, folder):
    ts = F.col("ts")
    return s.observations(spark, folder).select(
        "event_id",
        s.text(times.ceil_hour(ts)).alias("up"),
        s.text(times.floor_hour(ts)).alias("down"),
        s.text(times.ceil_hour(times.floor_hour(ts))).alias("exact"),
    )


@query(
    "c6_calendar_parts",
    f"""
WITH {s.SAMPLES},
l AS (SELECT {_SAMPLE_ID}, Datetime AT TIME ZONE 'UTC' AT TIME ZONE 'US/Eastern' AS t FROM samples)
SELECT {_SAMPLE_ID}, strftime(t, '%Y-%m-%d') AS date, year(t)::INTEGER AS year, month(t)::INTEGER AS month, day(t)::INTEGER AS day,
       dayofyear(t)::INTEGER AS jday, hour(t)::INTEGER AS hour, minute(t)::INTEGER AS minute FROM l""",
)
def parts(spark, folder):
    x = s.samples(spark, folder).withColumns(times.calendar(F.col("Datetime"), times.EASTERN))
    return x.select(*_ID, F.date_format("date", "yyyy-MM-dd").alias("date"), "year", "month", "day", "jday", "hour", "minute")


@query(
    "c7_date_arithmetic",
    """
SELECT o_orderkey, strftime(o_orderdate + INTERVAL 1 DAY, '%Y-%m-%d') AS next_day, strftime(o_orderdate - INTERVAL 200 DAY, '%Y-%m-%d') AS look_back
FROM orders""",
)
def date_math(spark, folder):
    d = F.to_date("o_orderdate")
    return s.read(spark, folder, "orders").select(
        "o_orderkey",
        F.date_format(F.date_add(d, 1), "yyyy-MM-dd").alias("next_day"),
        F.date_format(F.date_sub(d, 200), "yyyy-MM-dd").alias("look_back"),
    )


LOCAL = "(Datetime AT TIME ZONE 'UTC' AT TIME ZONE 'US/Eastern')"


def zone_sql(ts: str, local: str) -> str:
    return f"CASE WHEN epoch({local}) - epoch({ts}) = -18000 THEN 'EST' ELSE 'EDT' END"


@query(
    "c8_local_labels",
    f"""
WITH {s.SAMPLES}
SELECT {_SAMPLE_ID}, strftime({LOCAL}, '%b %d %Y') AS day_label,
       strftime({LOCAL}, '%b %-d %Y %-H:%M ') || lower(strftime({LOCAL}, '%p')) || ' ' || {zone_sql('Datetime', LOCAL)} AS local_time FROM samples""",
)
def local_labels(spark, folder):
    t = F.col("Datetime")
    return s.samples(spark, folder).select(*_ID, times.day_label(t).alias("day_label"), times.local_text(t).alias("local_time"))


@query(
    "c9_flexible_time_parsing",
    f"""
WITH {s.SAMPLES}
SELECT {_SAMPLE_ID}, CASE WHEN l_linenumber < 6 THEN strftime(date_trunc('minute', Datetime) AT TIME ZONE 'US/Eastern' AT TIME ZONE 'UTC', '%Y-%m-%d %H:%M:%S') END AS t
FROM samples""",
)
def flexible(spark, folder):
    x = s.samples(spark, folder)
    written = (
        F.when(F.col("l_linenumber") >= 6, "not a time")
        .when(F.col("l_linenumber") % 2 == 0, F.date_format("Datetime", "yyyy-MM-dd HH:mm"))
        .otherwise(F.date_format("Datetime", "yyyyMMddHHmm"))
    )
    return x.select(*_ID, s.text(times.parse_local(written)).alias("t"))


@query(
    "c10_math",
    f"""
WITH {s.OBS}
SELECT event_id, CASE WHEN precip > 0 THEN round(log10(precip), 6) END AS log_precip, round(sqrt(round(precip, 5)), 6) AS root,
       round(pow(10, precip), 4) AS power, round(temp, 1) AS temp FROM obs""",
)
def math(spark, folder):
    p = F.col("precip")
    out = s.observations(spark, folder).select(
        "event_id",
        F.log10(p).alias("log_precip"),
        F.sqrt(F.round(p, 5)).alias("root"),
        F.round(F.pow(F.lit(10.0), p), 4).alias("power"),
        F.round("temp", 1).alias("temp"),
    )
    return s.rounded(out, 6, "log_precip", "root")


@query(
    "c11_log_odds",
    """
SELECT event_id, round(1 / (1 + exp(-(value - 100) / 50)), 6) AS prob, round((value - 100) / 50, 6) AS back FROM events""",
)
def log_odds(spark, folder):
    p = clean.sigmoid((F.col("value") - 100) / 50)
    return s.rounded(s.read(spark, folder, "events").select("event_id", p.alias("prob"), clean.logit(p).alias("back")))


@query(
    "c12_text_keys",
    """
SELECT p_partkey, p_type || '_' || p_brand AS model_id, split_part(p_brand, '#', 2) AS brand, substr(p_name, 1, 10) AS short,
       lpad(p_size::VARCHAR, 3, '0') AS code FROM part""",
)
def text_keys(spark, folder):
    return s.read(spark, folder, "part").select(
        "p_partkey",
        F.concat_ws("_", "p_type", "p_brand").alias("model_id"),
        F.split("p_brand", "#")[1].alias("brand"),
        F.substring("p_name", 1, 10).alias("short"),
        F.format_string("%03d", F.col("p_size")).alias("code"),
    )


@query(
    "c13_recode",
    """
SELECT o_orderkey, CASE o_orderstatus WHEN 'F' THEN 'final' WHEN 'O' THEN 'open' ELSE o_orderstatus END AS status,
       CASE o_orderstatus WHEN 'F' THEN 1260e0 WHEN 'O' THEN 350e0 END AS standard FROM orders""",
)
def recode(spark, folder):
    c = F.col("o_orderstatus")
    return s.read(spark, folder, "orders").select(
        "o_orderkey",
        clean.recode(c, {"F": "final", "O": "open"}).alias("status"),
        clean.lookup(c, {"F": 1260.0, "O": 350.0}).alias("standard"),
    )


@query("c14_json_path", "SELECT event_id, json_extract_string(props, '$.k')::INTEGER AS k FROM events")
def json_path(spark, folder):
    return s.read(spark, folder, "events").select("event_id", F.get_json_object("props", "$.k").cast("int").alias("k"))


@query(
    "e15_z_scores",
    """
SELECT l_orderkey, l_linenumber, l_partkey, l_returnflag,
       round((l_quantity - avg(l_quantity) OVER w) / stddev_samp(l_quantity) OVER w, 5) AS l_quantity,
       round((l_discount - avg(l_discount) OVER w) / stddev_samp(l_discount) OVER w, 5) AS l_discount
FROM lineitem WINDOW w AS (PARTITION BY l_returnflag)""",
)
def z_scores(spark, folder):
    li = s.read(spark, folder, "lineitem").select(*_ID, "l_returnflag", "l_quantity", "l_discount")
    return s.rounded(summaries.z_scores(li, ["l_returnflag"], ["l_quantity", "l_discount"]), 5)


@query(
    "j2_mean_imputation",
    f"""
WITH {s.PREDICTIONS}
SELECT event_id, round(coalesce(prob, (SELECT avg(prob) FROM predictions)), 6) AS prob FROM predictions""",
)
def impute(spark, folder):
    return s.rounded(models.impute_mean(s.predictions(spark, folder).select("event_id", "prob"), ["prob"]))


@query(
    "j3_centre_and_scale",
    f"""
WITH {s.LABELLED},
t AS (SELECT avg(log_text) AS m, stddev_samp(log_text) AS d, avg(vowel_share) AS m2, stddev_samp(vowel_share) AS d2 FROM labelled WHERE model_id = 'EN')
SELECT doc_id, round((log_text - m) / d, 5) AS log_text_z, round((vowel_share - m2) / d2, 5) AS vowel_share_z FROM labelled, t""",
)
def scale(spark, folder):
    x = s.labelled(spark, folder)
    z = models.standardize(x.filter("model_id = 'EN'"), x, ["log_text", "vowel_share"])
    return s.rounded(z.select("doc_id", "log_text_z", "vowel_share_z"), 5)
