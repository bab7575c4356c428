"""Composite jobs on the given tables."""

from __future__ import annotations

from pyspark.sql import functions as F

from hydrosignal.catalog import standins as s
from hydrosignal.catalog.modelling import coefficients, score_sql
from hydrosignal.catalog.registry import query
from hydrosignal.catalog.sources import _METAR, metar_documents, weather_documents
from hydrosignal.catalog.windows import _LAGGED, antecedent_sql, events_sql, shown
from hydrosignal.operators import events, labels, rolling
from hydrosignal.operators.attach import attach
from hydrosignal.plans import flow as flow_plan
from hydrosignal.plans import predictors as predictor_plan
from hydrosignal.plans import samples as sample_plan
from hydrosignal.plans import scoring, weather
from hydrosignal.session import materialize, scratch_dir

K = s.SERIES
_H = f"{s.stamp('hour')} AS hour"
_ID = ["l_orderkey", "l_linenumber", "l_partkey"]


def series_sql(source, time, variables, keys="series_id"):
    """Roll-up, grid and interpolation of any observation CTE."""
    known = ", ".join(
        f"last_value(CASE WHEN {c} IS NOT NULL THEN struct_pack(x := epoch_us(hour), y := {c}) END IGNORE NULLS) OVER {w} AS {p}_{c}"
        for c in variables
        for p, w in (("b", "up"), ("a", "down"))
    )
    return f"""srolled AS (
  SELECT {keys}, {s.ceil_sql(time)} AS hour, count(*) AS n_hour, {', '.join(f'avg({c}) AS {c}' for c in variables)}, max(precip) AS precip FROM {source} GROUP BY 1, 2),
ssteps AS (SELECT {keys}, unnest(generate_series(min(hour), max(hour), INTERVAL 1 HOUR)) AS hour FROM srolled GROUP BY 1),
sgrid AS (
  SELECT g.{keys}, g.hour, coalesce(n_hour, 0) AS n_hour, n_hour IS NULL AS missing_hour, {', '.join(variables)}, coalesce(precip, 0e0) AS precip
  FROM ssteps g LEFT JOIN srolled r ON r.{keys} = g.{keys} AND r.hour = g.hour),
saround AS (
  SELECT *, {known} FROM sgrid
  WINDOW up AS (PARTITION BY {keys} ORDER BY hour ROWS BETWEEN UNBOUNDED PRECEDING AND CURRENT ROW),
         down AS (PARTITION BY {keys} ORDER BY hour DESC ROWS BETWEEN UNBOUNDED PRECEDING AND CURRENT ROW)),
series AS (SELECT {keys}, hour, n_hour, missing_hour, precip, {', '.join(s.line_sql(c) for c in variables)} FROM saround)"""


def _rounded_list(cols, digits=6):
    return ", ".join(f"round({c}, {digits}) AS {c}" for c in cols)


@query(
    "m1_metar_hourly_series",
    f"""
WITH {_METAR},
units AS (
  SELECT series_id, observation_time AS t, temp_c * 9 / 5 + 32 AS temp, dewpoint_c * 9 / 5 + 32 AS dewpt, wind_speed_kt * 1.152e0 AS wspd,
         sea_level_pressure_mb * 0.02953e0 AS pressure, precip_in AS precip FROM reports),
{series_sql('units', 't', weather.METAR_VARIABLES)}
SELECT series_id, {_H}, n_hour, missing_hour, {_rounded_list([*weather.METAR_VARIABLES, 'precip'], 11)} FROM series""",
)
def metar_series(spark, folder):
    d = lambda x: F.lit(x).cast("date")
    docs = metar_documents(spark, folder)
    return shown(weather.metar_series(docs, K, d("2024-01-05"), d("2024-01-20")), 11)


_DOCUMENTS = """docs AS (
  SELECT series_id, date_trunc('minute', ts) AS t, temp, CASE WHEN k >= 5 THEN dewpt END AS dewpt, CASE WHEN k <= 90 THEN k::DOUBLE END AS hum, wspd, 10e0 AS vis, pressure, precip
  FROM obs WHERE k <> 50)"""


@query(
    "m2_weather_document_series",
    f"""
WITH {s.OBS}, {_DOCUMENTS},
{series_sql('docs', 't', weather.DOCUMENT_VARIABLES)}
SELECT series_id, {_H}, n_hour, missing_hour, {_rounded_list([*weather.DOCUMENT_VARIABLES, 'precip'], 11)} FROM series""",
)
def document_series(spark, folder):
    return shown(weather.document_series(weather_documents(spark, folder), K), 11)


_RAIN = [f"precip_{a}_p{k}hr_lag{n}hr" for k in rolling.RAIN_WIDTHS for n in rolling.RAIN_LAGS for a in ("sum", "max")]
_SINCE = [events.since_name(d) for d in events.SINCE_DEPTHS]


def _trends(variables):
    return [f"{v}_{m}_p{k}hr" for k in rolling.WEATHER_WIDTHS for m in ("mean", "change") for v in variables]


def _trend_sql(variables):
    out = []
    for k in rolling.WEATHER_WIDTHS:
        for v in variables:
            frame = f"(w ROWS BETWEEN {k - 1} PRECEDING AND CURRENT ROW)"
            out.append(f"CASE WHEN count({v}) OVER {frame} = {k} THEN avg({v}) OVER {frame} END AS {v}_mean_p{k}hr")
            out.append(f"{v} - lag({v}, {k}) OVER w AS {v}_change_p{k}hr")
    return ", ".join(out)


def predictors_sql(variables, source):
    """CTEs up to ``predictors`` from an hourly series with these variables."""
    return f"""{antecedent_sql(rolling.RAIN_WIDTHS, rolling.RAIN_LAGS, source)}, {events_sql(source)},
trend AS (SELECT series_id, hour, {_trend_sql(variables)} FROM {source} WINDOW w AS (PARTITION BY series_id ORDER BY hour)),
prior AS (SELECT series_id, hour::DATE + 1 AS date, {', '.join(f'avg({v}) AS {v}_mean_p1d' for v in variables)} FROM {source} GROUP BY series_id, hour::DATE),
predictors AS (
  SELECT h.series_id, h.hour::DATE AS date, h.hour, {', '.join('h.' + v for v in variables)}, {', '.join('t.' + c for c in _trends(variables))},
         {', '.join(f'p.{v}_mean_p1d' for v in variables)}, e.event_type, {', '.join('e.' + c for c in _SINCE)}, {', '.join('r.' + c for c in _RAIN)}
  FROM {source} h JOIN trend t ON t.series_id = h.series_id AND t.hour = h.hour
  JOIN since e ON e.series_id = h.series_id AND e.hour = h.hour JOIN rainfall r ON r.series_id = h.series_id AND r.hour = h.hour
  LEFT JOIN prior p ON p.series_id = h.series_id AND p.date = h.hour::DATE)"""


def _show(variables):
    return f"series_id, strftime(date, '%Y-%m-%d') AS date, {_H}, event_type, {', '.join(_SINCE)}, {', '.join(_RAIN)}, {_rounded_list([*variables, *_trends(variables), *[v + '_mean_p1d' for v in variables]], 11)}"


PREDICTORS = f"{s.HOURS}, {predictors_sql(s.VARIABLES, 'hours')}"
_SHOW = _show(s.VARIABLES)


def _predictors(spark, folder):
    return _counted(weather.weather_predictors(s.hours(spark, folder), K))


def _counted(p):
    return p.withColumns({c: F.col(c).cast("long") for c in _SINCE})


def _shown_predictors(p):
    out = shown(p.withColumn("date", F.date_format("date", "yyyy-MM-dd")), 11)
    return s.rounded(out, 6, *_RAIN)


@query("m3_weather_predictors", f"WITH {PREDICTORS} SELECT {_SHOW} FROM predictors")
def weather_predictors(spark, folder):
    return _shown_predictors(_predictors(spark, folder))


@query(
    "m3_weather_predictors_with_humidity",
    f"""WITH {s.OBS}, {_DOCUMENTS},
{series_sql('docs', 't', weather.DOCUMENT_VARIABLES)},
{predictors_sql(weather.DOCUMENT_PREDICTORS, 'series')}
SELECT {_show(weather.DOCUMENT_PREDICTORS)} FROM predictors""",
)
def humid_predictors(spark, folder):
    """The form with humidity, from the weather documents."""
    h = weather.document_series(weather_documents(spark, folder), K)
    return _shown_predictors(_counted(weather.weather_predictors(h, K, variables=weather.DOCUMENT_PREDICTORS)))


_FLOW_COLUMNS = [f"{x}_{c}" for x in s.STATIONS for c in flow_plan.feature_names()]
_FLOW_WIDE = f"""{_LAGGED},
flow_wide AS (SELECT date, {', '.join(f'max({c[2:]}) FILTER (WHERE station_id = {chr(39)}{c[0]}{chr(39)}) AS "{c}"' for c in _FLOW_COLUMNS)} FROM lagged GROUP BY date)"""


@query(
    "m6_all_predictors",
    f"""WITH {PREDICTORS}, {_FLOW_WIDE}
SELECT {_SHOW.replace("strftime(date,", "strftime(predictors.date,")}, {', '.join(f'round("{c}", 6) AS "{c}"' for c in _FLOW_COLUMNS)} FROM predictors LEFT JOIN flow_wide ON flow_wide.date = predictors.date""",
)
def all_predictors(spark, folder):
    wide = flow_plan.flow_predictors(s.flow(spark, folder), "station_id", s.STATIONS)
    p = predictor_plan.all_predictors(s.hours(spark, folder), K, wide)
    out = p.withColumns({c: F.col(c).cast("long") for c in _SINCE} | {c: F.round(c, 6) + F.lit(0.0) for c in _FLOW_COLUMNS})
    return _shown_predictors(out)


@query(
    "m7_labelled_samples",
    f"""
WITH {s.SAMPLES},
lm AS (SELECT s_suppkey::VARCHAR AS LocationID, 'SITE' || s_nationkey AS ModelLocation FROM supplier WHERE s_nationkey < 20),
mc AS (SELECT 'SITE' || n_nationkey AS ModelLocation, CASE WHEN n_regionkey % 2 = 0 THEN 'ECOLI' ELSE 'ENT' END AS CharacteristicID FROM nation)
SELECT lm.ModelLocation || '_' || x.CharacteristicID AS model_id, x.LocationID AS location_id, ProjectID AS project_id, x.CharacteristicID AS parameter,
       CASE x.CharacteristicID WHEN 'ECOLI' THEN 1260e0 ELSE 350e0 END AS standard_value,
       strftime(Datetime AT TIME ZONE 'US/Eastern' AT TIME ZONE 'UTC', '%Y-%m-%d %H:%M:%S') AS timestamp, round(ResultValue, 6) AS concentration,
       ResultValue > CASE x.CharacteristicID WHEN 'ECOLI' THEN 1260e0 ELSE 350e0 END AS exceedance
FROM samples x JOIN lm ON lm.LocationID = x.LocationID JOIN mc ON mc.ModelLocation = lm.ModelLocation AND mc.CharacteristicID = x.CharacteristicID""",
)
def labelled_samples(spark, folder):
    x = s.samples(spark, folder)
    lm = s.read(spark, folder, "supplier").filter("s_nationkey < 20").select(
        F.col("s_suppkey").cast("string").alias("LocationID"), F.concat(F.lit("SITE"), "s_nationkey").alias("ModelLocation")
    )
    mc = s.read(spark, folder, "nation").select(
        F.concat(F.lit("SITE"), "n_nationkey").alias("ModelLocation"),
        F.when(F.col("n_regionkey") % 2 == 0, "ECOLI").otherwise("ENT").alias("CharacteristicID"),
    )
    parts = [x.filter("ProjectID = 'RECFLAG'"), x.filter("ProjectID = 'CSORWM'")]
    out = sample_plan.labelled_samples(parts, lm, mc, labels.standards(spark)).drop("model_location")
    return s.rounded(out.withColumn("timestamp", s.text("timestamp")))


def _site_samples(spark, folder):
    """Samples at the observed series, in the labelled layout."""
    o = s.observations(spark, folder)
    return o.select(
        "series_id", F.col("series_id").alias("model_id"), "event_id", F.col("ts").alias("timestamp"),
        (F.col("value") * 10).alias("concentration"), (F.col("value") * 10 > 1260).alias("exceedance"),
    )


_MODEL_TABLE = f"""{s.GRID}, {antecedent_sql((24, 48), (0, 24))},
mt AS (
  SELECT o.series_id AS model_id, o.event_id, o.value * 10 AS concentration, o.value * 10 > 1260 AS exceedance, date_trunc('hour', o.ts)::DATE AS date,
         round(precip_sum_p24hr_lag0hr, 5) AS p24, round(precip_sum_p48hr_lag24hr, 5) AS p48
  FROM obs o LEFT JOIN rainfall r ON r.series_id = o.series_id AND r.hour = date_trunc('hour', o.ts)
  WHERE date_trunc('hour', o.ts) >= (SELECT min(hour) FROM rainfall) AND month(date_trunc('hour', o.ts)) BETWEEN 1 AND 10)"""


def _model_table(spark, folder):
    rain = rolling.antecedent(s.rain(spark, folder), K, "hour", widths=(24, 48), lag_hours=(0, 24)).drop("precip", "n_hour", "missing_hour")
    season = {"first_year": 2024, "last_year": 2024, "first_month": 1, "last_month": 10}
    return sample_plan.model_table(_site_samples(spark, folder), rain, K, season=season)


@query(
    "m8_model_table",
    f"""WITH {_MODEL_TABLE} SELECT model_id, event_id, strftime(date, '%Y-%m-%d') AS date, CASE WHEN exceedance THEN 'yes' ELSE 'no' END AS exceedance_class,
    p24 AS precip_sum_p24hr_lag0hr, p48 AS precip_sum_p48hr_lag24hr FROM mt""",
)
def model_table(spark, folder):
    return _model_table(spark, folder).select(
        "model_id", "event_id", F.date_format("date", "yyyy-MM-dd").alias("date"), "exceedance_class", "precip_sum_p24hr_lag0hr", "precip_sum_p48hr_lag24hr"
    )


@query(
    "m8_model_summary",
    f"WITH {_MODEL_TABLE} SELECT model_id, count(*) AS n_samples, round(avg(exceedance::INTEGER), 6) AS frac_exceed FROM mt GROUP BY 1",
)
def model_summary(spark, folder):
    return s.rounded(sample_plan.model_summary(_model_table(spark, folder)))


@query(
    "m9_prepared_samples",
    f"""
WITH {s.SAMPLES}
SELECT l_orderkey, l_linenumber, l_partkey, r_name AS "LocationTypeID", (Units = 'MPN/100ml')::INTEGER AS "Units_MPN/100ml", 0 AS "Units_nan",
       (FlagID IS NULL)::INTEGER AS "FlagID_nan"
FROM samples LEFT JOIN region ON r_regionkey = LocationTypeID""",
)
def prepared(spark, folder):
    types = s.read(spark, folder, "region").select(F.col("r_regionkey").alias("ID"), F.col("r_name").alias("LocationTypeName"))
    flows = s.flow(spark, folder)
    frames, _, names = sample_plan.prepare(
        {"all": s.samples(spark, folder)}, flows, types, {"Units": ["CFU/100ml", "MPN/100ml"], "FlagID": ["H"]}, ["station_id"], "date"
    )
    return frames["all"].select(*_ID, "LocationTypeID", *names)


_EDGES = (0, 12, 24, 48, 72, 96, 120)
_MATRIX = f"""{s.SAMPLES}, {s.FLOW},
x AS (SELECT * REPLACE (date_trunc('hour', Datetime) AS Datetime) FROM samples WHERE ((CharacteristicID = 'ECOLI' AND Units = 'MPN/100ml') OR (CharacteristicID = 'ENT' AND Units = 'MPN/100ml')) AND FlagID IS NULL),
ch AS (SELECT *, flow - lag(flow) OVER (PARTITION BY station_id ORDER BY date) AS flow_deriv FROM flow),
fl AS (SELECT date::TIMESTAMP + INTERVAL 8 HOUR - INTERVAL 10592 DAY AS at, {', '.join(f"max({v}) FILTER (WHERE station_id = '{x}') AS {v}_{x}" for x in s.STATIONS for v in ('flow', 'flow_deriv'))} FROM ch GROUP BY 1),
rain AS (SELECT o_orderdate AS at, sum(o_totalprice) / 1000 AS precip FROM orders GROUP BY 1),
t AS (SELECT DISTINCT Datetime FROM x),
bins AS (
  SELECT t.Datetime, {', '.join(f'round(coalesce(sum(r.precip) FILTER (WHERE r.at >= t.Datetime - INTERVAL {b} HOUR AND r.at < t.Datetime - INTERVAL {a} HOUR), 0), 6) AS precip_{a}_{b}' for a, b in zip(_EDGES, _EDGES[1:]))}
  FROM t LEFT JOIN rain r ON r.at < t.Datetime AND r.at >= t.Datetime - INTERVAL 120 HOUR GROUP BY 1)"""


_FLOWS = [f"{v}_{x}" for x in s.STATIONS for v in ("flow", "flow_deriv")]
_BINS = [f"precip_{a}_{b}" for a, b in zip(_EDGES, _EDGES[1:])]


@query(
    "j25_feature_matrix",
    f"""
WITH {_MATRIX},
joined AS (SELECT x.*, {', '.join(_FLOWS)}, {', '.join(_BINS)} FROM x LEFT JOIN fl ON fl.at = x.Datetime LEFT JOIN bins ON bins.Datetime = x.Datetime),
means AS (SELECT {', '.join(f'avg({c}) AS mean_{c}' for c in _FLOWS)} FROM joined)
SELECT l_orderkey, l_linenumber, l_partkey, (CharacteristicID = 'ECOLI' AND ResultValue > 1260)::INTEGER AS label,
       {', '.join(f'round(coalesce({c}, mean_{c}), 6) AS {c}' for c in _FLOWS)}, {', '.join(_BINS)},
       1e0 AS "Units_MPN/100ml", 0e0 AS "Units_nan", 1e0 AS "FlagID_nan"
FROM joined, means""",
)
def feature_matrix(spark, folder):
    types = s.read(spark, folder, "region").select(F.col("r_regionkey").alias("ID"), F.col("r_name").alias("LocationTypeName"))
    levels = {"Units": ["CFU/100ml", "MPN/100ml"], "FlagID": ["H"]}
    x = s.samples(spark, folder).withColumn("Datetime", F.date_trunc("hour", "Datetime"))
    # the dummies replace their columns, which the row filter still needs
    x = x.withColumns({"_units": F.col("Units"), "_flag": F.col("FlagID")})
    frames, flows, names = sample_plan.prepare({"all": x}, s.flow(spark, folder), types, levels, ["station_id"], "date")
    coded = frames["all"].drop("Units", "FlagID").withColumnsRenamed({"_units": "Units", "_flag": "FlagID"})
    f = flows.groupBy((F.date_sub("date", 10592).cast("timestamp") + F.expr("INTERVAL 8 HOURS")).alias("Datetime")).agg(
        *[F.max(F.when(F.col("station_id") == x, F.col(v))).alias(f"{v}_{x}") for x in s.STATIONS for v in ("flow", "flow_deriv")]
    )
    o = s.read(spark, folder, "orders")
    rain = o.select(F.col("o_orderdate").cast("timestamp").alias("at"), (F.col("o_totalprice") / 1000).alias("precip"))
    pairs = [("ECOLI", "MPN/100ml"), ("ENT", "MPN/100ml")]
    rows, features = sample_plan.feature_matrix(coded, pairs, f, rain, names, "Datetime", "at", "precip", _EDGES)
    out = sample_plan.train_test(rows, {"ECOLI": 1260.0}, features, [*_ID, "ResultValue", "LocationID"])
    return s.rounded(out.select(*_ID, "label", *features))


def _saved(spark, folder):
    o = s.observations(spark, folder)
    return o.select(
        F.col("series_id").alias("name"), F.col("ts").alias("timestamp"), (F.col("value") / 500).alias("prob"),
        F.to_json(F.struct("temp", "precip")).alias("predictors"),
    )


_REPORT = f"""{s.OBS},
ranges AS (
  SELECT series_id, key, min(value) AS lo, quantile_cont(value, 0.5) AS med, max(value) AS hi
  FROM (UNPIVOT (SELECT series_id, temp, precip FROM obs WHERE ts < TIMESTAMP '2024-01-15') ON temp, precip INTO NAME key VALUE value) GROUP BY 1, 2),
v AS (
  SELECT series_id, ts, event_id, key, value FROM (UNPIVOT (SELECT series_id, ts, event_id, temp, precip, value / 500 AS exceedence_probability FROM obs) ON temp, precip, exceedence_probability INTO NAME key VALUE value))"""


def _report_sql(where="true"):
    return f"""
WITH {_REPORT}
SELECT v.series_id AS name, strftime(v.ts, '%Y-%m-%d %H:%M:%S') AS timestamp, v.key, round(value, 6) AS value, round(lo, 6) AS min, round(med, 6) AS median, round(hi, 6) AS max
FROM v LEFT JOIN ranges r ON r.series_id = v.series_id AND r.key = v.key WHERE {where}"""


def _reported(spark, folder, saved):
    train = s.observations(spark, folder).filter(F.col("ts") < F.lit("2024-01-15").cast("timestamp")).withColumnRenamed("series_id", "model_id")
    rows = F.array(*[F.lit("temp"), F.lit("precip")])
    names = train.select("model_id").distinct().select("model_id", F.explode(rows).alias("key"))
    ranges = predictor_plan.training_ranges(train, names, ["temp", "dewpt", "precip"]).withColumnRenamed("model_id", "name").drop("mean")
    out = attach(predictor_plan.report_values(saved), ranges, ["name", "key"])
    return s.rounded(out.withColumn("timestamp", s.text("timestamp")))


@query("m10_prediction_report", _report_sql())
def report(spark, folder):
    return _reported(spark, folder, _saved(spark, folder))


@query("m10_prediction_report_of_a_year", _report_sql("v.ts::DATE >= DATE '2025-01-15' - 365"))
def report_of_a_year(spark, folder):
    return _reported(spark, folder, predictor_plan.since_days(_saved(spark, folder), F.lit("2025-01-15").cast("date")))


@query(
    "m11_hindcast",
    f"""
WITH {s.HOURS}, {score_sql("hours")},
seen AS (SELECT event_type AS series_id, ['dry', 'wet', 'wind'][(event_id % 3 + 1)::INTEGER] AS name, date_trunc('hour', ts) AS hour, max(value) > 250 AS observed FROM events GROUP BY 1, 2, 3)
SELECT scores.series_id, scores.name, {s.stamp('scores.hour')} AS hour, round(prob, 9) AS prob, exceedance, observed
FROM scores LEFT JOIN seen ON seen.series_id = scores.series_id AND seen.name = scores.name AND seen.hour = scores.hour""",
)
def hindcast(spark, folder):
    h = weather.hourly_from_observations(s.observations(spark, folder), K, "ts", ["temp", "wspd"])
    h = h.withColumn("wspd", F.when(F.col("wspd") <= 30, F.col("wspd")))
    model = F.element_at(F.array(F.lit("dry"), F.lit("wet"), F.lit("wind")), (F.col("event_id") % 3).cast("int") + 1)
    seen = s.observations(spark, folder).groupBy(
        "series_id", model.alias("model_id"), F.date_trunc("hour", "ts").alias("hour")
    ).agg((F.max("value") > 250).alias("exceedance"))
    return shown(predictor_plan.hindcast(h, coefficients(h), seen, "hour", K), 9)


@query(
    "m6_scoring_targets",
    f"""
WITH {s.GRID}, {antecedent_sql((24,), (0,))},
t AS (SELECT unnest(generate_series((SELECT min(ts)::DATE FROM obs)::TIMESTAMP, (SELECT max(ts)::DATE FROM obs)::TIMESTAMP, INTERVAL 1 DAY)) + INTERVAL 7 HOUR AS hour)
SELECT series_id, {s.stamp('rainfall.hour')} AS hour, precip_sum_p24hr_lag0hr FROM rainfall JOIN t ON t.hour = rainfall.hour""",
)
def targets(spark, folder):
    p = rolling.antecedent(s.rain(spark, folder), K, "hour", widths=(24,), lag_hours=(0,)).select("series_id", "hour", "precip_sum_p24hr_lag0hr")
    span = s.observations(spark, folder).agg(F.date_trunc("day", F.min("ts")).alias("a"), F.date_trunc("day", F.max("ts")).alias("b"))
    seven = F.expr("INTERVAL 7 HOURS")
    t = span.select(F.explode(F.sequence(F.col("a") + seven, F.col("b") + seven, F.expr("INTERVAL 1 DAY"))).alias("t"))
    return shown(predictor_plan.target_rows(p, K, "hour", t))


@query(
    "m6_look_back_window",
    "SELECT strftime(min(ts)::DATE - 200, '%Y-%m-%d') AS start, strftime(max(ts)::DATE, '%Y-%m-%d') AS end FROM events",
)
def look_back(spark, folder):
    w = predictor_plan.look_back(s.observations(spark, folder), "ts")
    return w.select(F.date_format("start", "yyyy-MM-dd").alias("start"), F.date_format("end", "yyyy-MM-dd").alias("end"))


# Demonstration models on the predictors of a period (model, predictor, mean, sd, coefficient).
_TERMS = (
    ("dry", "temp", 50.0, 20.0, 0.75),
    ("dry", "1_flow_p1d", 400.0, 200.0, -0.5),
    ("wet", "precip_sum_p24hr_lag0hr", 2.0, 1.5, 1.25),
    ("wet", "pressure", 29.5, 0.25, -0.25),
    ("wind", "wspd", 20.0, 10.0, 0.5),
)
_BASES = {"dry": (-1.0, 0.25), "wet": (-1.5, 0.25), "wind": (0.5, 0.5)}
_FIRST = ("2024-01-10 07:00:00", "2024-01-12 07:00:00")
_SECOND = ("2024-01-12 07:00:00", "2024-01-15 07:00:00")
_AS_OF = "2024-01-18 15:30:00"


def _model_rows(spark):
    rows = [(m, k, a, b, c, _BASES[m][1]) for m, k, a, b, c in _TERMS]
    rows += [(m, "(Intercept)", 0.0, 1.0, b0, cut) for m, (b0, cut) in _BASES.items()]
    return spark.createDataFrame(rows, "model_id string, key string, mean double, sd double, coef double, cutoff double")


def _version_sql(m):
    b0, cut = _BASES[m]
    terms = [f"{k},{a},{b},{c},{cut}" for n, k, a, b, c in _TERMS if n == m] + [f"(Intercept),0.0,1.0,{b0},{cut}"]
    return f"md5('{m}|{';'.join(sorted(terms))}')"


def _odds_sql(m):
    return f"{_BASES[m][0]}e0" + "".join(f' + ({c}e0) * (("{k}" - {a}e0) / {b}e0)' for n, k, a, b, c in _TERMS if n == m)


_STAMPS = lambda hours: ", ".join(f"TIMESTAMP '{h}'" for h in hours)
_RUN = f"""{_METAR},
units AS (
  SELECT series_id, observation_time AS t, temp_c * 9 / 5 + 32 AS temp, dewpoint_c * 9 / 5 + 32 AS dewpt, wind_speed_kt * 1.152e0 AS wspd,
         sea_level_pressure_mb * 0.02953e0 AS pressure, precip_in AS precip FROM reports),
{series_sql('units', 't', weather.METAR_VARIABLES)},
{antecedent_sql((24,), (0,), 'series')}, {s.FLOW},
ready AS (
  SELECT s.series_id, s.hour, s.temp, s.wspd, s.pressure, r.precip_sum_p24hr_lag0hr, f.flow AS "1_flow_p1d"
  FROM series s JOIN rainfall r ON r.series_id = s.series_id AND r.hour = s.hour
  LEFT JOIN flow f ON f.station_id = '1' AND f.date = s.hour::DATE - 1 AND f.date BETWEEN DATE '2024-01-05' AND DATE '2024-01-20'),
picked AS (
  SELECT * FROM ready WHERE hour IN ({_STAMPS(sorted({*_FIRST, *_SECOND}))}) UNION
  SELECT * FROM ready WHERE hour <= TIMESTAMP '{_AS_OF}' QUALIFY row_number() OVER (PARTITION BY series_id ORDER BY hour DESC) = 1),
results AS ({' UNION ALL '.join(f"SELECT *, '{m}' AS name, {_version_sql(m)} AS version, 1 / (1 + exp(-({_odds_sql(m)}))) AS prob, {_BASES[m][1]}e0 AS cutoff FROM picked" for m in _BASES)})"""


def _scoring_run(spark, folder):
    """Two runs at listed hours and one as of an instant, each appended; the table and all conflicts."""
    d = lambda x: F.lit(x).cast("date")
    path = scratch_dir(spark, "prediction-table")
    table = scoring.predictors_of_period(
        metar_documents(spark, folder), s.flow(spark, folder), K, "station_id", s.STATIONS, d("2024-01-05"), d("2024-01-20")
    )
    table, models = materialize(table, "predictors"), _model_rows(spark)
    conflicts = None
    for listed, at in ((_FIRST, None), (_SECOND, None), (None, _AS_OF)):
        if listed:
            hours = spark.createDataFrame([(h,) for h in listed], "t string").select(F.col("t").cast("timestamp"))
            rows = scoring.rows_to_score(table, K, "hour", listed=hours)
        else:
            rows = scoring.rows_to_score(table, K, "hour", at=F.lit(at).cast("timestamp"))
        new = scoring.predictions(rows, models, K, "hour")
        stored = spark.createDataFrame([], new.schema) if conflicts is None else spark.read.schema(new.schema).parquet(path)
        refused = scoring.append_predictions(stored, new, path, K)
        conflicts = refused if conflicts is None else conflicts.unionByName(refused)
    return spark.read.schema(new.schema).parquet(path), conflicts


_USED = {m: [k for n, k, *_ in _TERMS if n == m] for m in _BASES}


@query(
    "m12_scoring_run",
    f"""
WITH {_RUN}
{' UNION ALL '.join(f"SELECT series_id, name, {s.stamp('hour')} AS timestamp, version, '{k}' AS key, round({chr(34)}{k}{chr(34)}, 9) AS value, round(prob, 9) AS prob, prob > cutoff AS exceedance FROM results WHERE name = '{m}'" for m, used in _USED.items() for k in used)}""",
)
def scoring_run(spark, folder):
    saved, _ = _scoring_run(spark, folder)
    long = saved.select(
        "series_id", "name", s.text("timestamp").alias("timestamp"), "version",
        F.explode(F.from_json("predictors", "map<string,double>")).alias("key", "value"),
        F.round("prob", 9).alias("prob"), "exceedance",
    )
    return s.rounded(long, 9, "value")


@query(
    "m12_scoring_conflicts",
    f"WITH {_RUN} SELECT series_id, name, {s.stamp('hour')} AS timestamp, 1::BIGINT AS n_new, 1::BIGINT AS n_stored FROM results WHERE hour IN ({_STAMPS(sorted({*_FIRST} & {*_SECOND}))})",
)
def scoring_conflicts(spark, folder):
    return _scoring_run(spark, folder)[1].withColumn("timestamp", s.text("timestamp"))
