"""Hand-made cases: rain events, grids, interpolation, bins, status rules, zones."""

from datetime import datetime, timedelta

import pytest
from pyspark.sql import functions as F

from hydrosignal.functions import clean, times
from hydrosignal.operators import events, fill, grid, joins, metrics, rolling, status
from hydrosignal.plans import flow as flow_plan
from hydrosignal.plans import weather

START = datetime(2024, 1, 1)
K = ["series_id"]


def hour(n):
    return START + timedelta(hours=n)


def series(spark, values, col="precip", key="a"):
    rows = [(key, hour(i), None if v is None else float(v)) for i, v in values]
    return spark.createDataFrame(rows, f"series_id string, hour timestamp, {col} double")


@pytest.fixture(scope="module")
def rain39(spark):
    wet = {4: 0.60, 6: 0.50, 15: 0.10, 25: 0.12, 33: 0.20}
    a = series(spark, [(i, wet.get(i, 0.0)) for i in range(1, 40)])
    b = series(spark, [(i, 0.0) for i in range(1, 40)], key="b")
    e = events.event_columns(events.rain_events(a.unionByName(b), K, "hour"), K, "hour")
    out = rolling.antecedent(events.hours_since(e, K, "hour"), K, "hour", widths=(24,), lag_hours=(0,))
    rows = out.collect()
    return {(r["series_id"], int((r["hour"] - START).total_seconds() // 3600)): r for r in rows}


# hour: wet, event, since 0.10, since 0.50, since 1.00, 24 h sum
GOLDEN = {
    1: (1, 1, 0, 0, 0, 0),
    3: (1, 1, 0, 0, 0, 0),
    4: (1, 1, 0, 0, 0, 0),
    6: (1, 1, 0, 0, 0, 0),
    7: (0, 2, 1, 1, 1, 0),
    14: (0, 2, 8, 8, 8, 0),
    15: (0, 2, 9, 9, 9, 0),
    16: (0, 2, 10, 10, 10, 0),
    24: (0, 2, 18, 18, 18, 1.20),
    25: (1, 3, 0, 19, 19, 1.32),
    26: (1, 3, 0, 20, 20, 1.32),
    32: (1, 3, 0, 26, 26, 0.22),
    33: (1, 3, 0, 27, 27, 0.42),
    34: (1, 3, 0, 28, 28, 0.42),
    39: (1, 3, 0, 33, 33, 0.32),
}


@pytest.mark.parametrize("h", sorted(GOLDEN))
def test_rain_events(rain39, h):
    r = rain39["a", h]
    got = (
        r["wet"],
        r["event_id"],
        r["hours_since_010in_precip_event"],
        r["hours_since_050in_precip_event"],
        r["hours_since_100in_precip_event"],
        r["precip_sum_p24hr_lag0hr"],
    )
    assert got == GOLDEN[h]


def test_all_dry_neighbour_series_is_independent(rain39):
    last = rain39["b", 39]
    assert (last["wet"], last["event_id"], last["hours_since_010in_precip_event"]) == (0, 0, 39)


def test_ceil_hour(spark):
    rows = [("06:54:00", 7), ("07:00:00", 7), ("07:00:01", 8)]
    df = spark.createDataFrame([(datetime.fromisoformat(f"2024-01-01 {t}"), h) for t, h in rows], "t timestamp, h int")
    assert all(r[0] == r[1] for r in df.select(F.hour(times.ceil_hour(F.col("t"))), "h").collect())


def test_interpolation_keeps_ends_null(spark):
    df = series(spark, enumerate([None, 10, None, None, 16], 1), "x")
    got = [r["x"] for r in fill.interpolate(df, K, "hour", ["x"]).orderBy("hour").collect()]
    assert got == [None, 10.0, 12.0, 14.0, 16.0]


def test_interpolation_by_position_fills_ends(spark):
    df = series(spark, enumerate([None, 10, None, 16, None], 1), "x")
    got = [r["x"] for r in fill.interpolate_rows(df, K, "hour", ["x"]).orderBy("hour").collect()]
    assert got == [0.0, 10.0, 13.0, 16.0, 16.0]


def test_interpolation_in_parts_crosses_empty_parts(spark):
    df = series(spark, [(i, i * 2.0 if i in (0, 50, 51) else None) for i in range(60)], "x")
    whole = fill.interpolate(df, K, "hour", ["x"]).orderBy("hour").collect()
    parts = fill.interpolate_parts(df, K, "hour", ["x"], 6 * 3600).orderBy("hour").collect()
    assert [r["x"] for r in whole] == [r["x"] for r in parts]
    assert parts[25]["x"] == pytest.approx(50.0)


def test_fill_gaps_inserts_only_missing(spark):
    df = series(spark, [(0, 1), (1, 2), (4, 3)]).unionByName(series(spark, [(9, 1)], key="b"))
    got = [(r["series_id"], r["hour"], r["precip"], r["missing"]) for r in grid.fill_gaps(df, K, "hour").orderBy("series_id", "hour").collect()]
    assert got == [
        ("a", hour(0), 1.0, False),
        ("a", hour(1), 2.0, False),
        ("a", hour(2), None, True),
        ("a", hour(3), None, True),
        ("a", hour(4), 3.0, False),
        ("b", hour(9), 1.0, False),
    ]


def test_longest_gap_of_one_and_eleven_hours(spark):
    df = grid.fill_gaps(series(spark, [(0, 1), (2, 1), (14, 1)]), K, "hour")
    assert events.longest_run(df, K, "hour", "missing").collect()[0]["longest"] == 11


def test_rain_bins_are_half_open(spark):
    rain = series(spark, [(12, 1), (23, 2), (24, 4)])
    point = spark.createDataFrame([("a", hour(24))], "series_id string, t timestamp")
    r = joins.range_sums(point, rain, K, "t", "hour", "precip", (0, 12, 24)).collect()[0]
    assert (r["precip_0_12"], r["precip_12_24"]) == (3.0, 0.0)


def test_units(spark):
    r = spark.range(1).select(
        clean.fahrenheit(F.lit(10.0)), clean.miles_per_hour(F.lit(10.0)), clean.inches_of_mercury(F.lit(1000.0))
    ).collect()[0]
    assert [round(x, 6) for x in r] == [50.0, 11.52, 29.53]


def test_flow_features_do_not_leak_between_stations(spark):
    rows = [(s, datetime(2024, 1, d).date(), float(d * f)) for s, f in (("x", 1), ("y", 10)) for d in (1, 2, 3)]
    df = spark.createDataFrame(rows, "station_id string, date date, flow double")
    got = flow_plan.flow_features(df, ["station_id"]).orderBy("station_id", "date").collect()
    assert [r["flow_p1d"] for r in got] == [None, 1.0, 2.0, None, 10.0, 20.0]
    assert [r["flow_change_p2d_p1d"] for r in got] == [None, None, 1.0, None, None, 10.0]
    assert len(flow_plan.feature_names()) == 18


def test_log_of_zero_flow_is_null(spark):
    df = spark.createDataFrame([("x", datetime(2024, 1, d).date(), f) for d, f in ((1, 0.0), (2, 5.0))], "s string, date date, flow double")
    assert flow_plan.flow_features(df, ["s"]).orderBy("date").collect()[1]["logflow_p1d"] is None


def test_cutoff_distance(spark):
    # sensitivity 0.6, specificity 0.7
    rows = [(0.9, 1)] * 6 + [(0.1, 1)] * 4 + [(0.9, 0)] * 3 + [(0.1, 0)] * 7
    df = spark.createDataFrame(rows, "prob double, label int")
    r = metrics.cutoff_sweep(df, [], (0.5,)).collect()[0]
    assert r["dist"] == pytest.approx(0.5)


def test_predictor_table_width(spark):
    df = series(spark, [(i, 0.0) for i in range(30)])
    hours = df.withColumns({v: F.lit(1.0) for v in weather.METAR_VARIABLES})
    assert len(weather.weather_predictors(hours, [*K]).columns) == 123 + len(K)
    hours = df.withColumns({v: F.lit(1.0) for v in weather.DOCUMENT_VARIABLES})
    wide = weather.weather_predictors(hours, [*K], variables=weather.DOCUMENT_PREDICTORS)
    assert len(wide.columns) == 131 + len(K)


def test_prior_day_mean_needs_the_day_before(spark):
    df = series(spark, [(i, 1.0 + (i >= 24)) for i in range(72)], "x").filter(~((F.hour("hour") == 3) & (F.dayofmonth("hour") == 2)))
    out = weather.prior_day_means(df, K, "hour", ["x"]).orderBy("hour").collect()
    by_day = {r["hour"].day: r["x_mean_p1d"] for r in out}
    assert by_day == {1: None, 2: 1.0, 3: 2.0}


STATUS_CASES = [
    (True, [], "advisory", "High probability"),
    (False, [], "good", "Low probability"),
    (None, [], "unknown", "Data unavailable"),
    (False, ["UNCERTAIN"], "uncertain", "text1"),
    (True, ["UNCERTAIN"], "advisory", "High probability of elevated bacteria levels. text1"),
    (True, ["OFFLINE"], "unknown", "text1"),
    (True, ["OFFLINE", "ADVISORY"], "advisory", "text1 text2"),
    (False, ["ADVISORY", "UNCERTAIN"], "advisory", "text1 text2"),
]


@pytest.mark.parametrize("exceed,levels,kind,reason", STATUS_CASES)
def test_status_rules(spark, exceed, levels, kind, reason):
    p = spark.createDataFrame([("s", START, exceed)], "name string, timestamp timestamp, exceedance boolean")
    f = spark.createDataFrame(
        # bounds equal to the prediction instant still cover it
        [(i, "s", START, START, lv, f"text{i}") for i, lv in enumerate(levels, 1)],
        "id int, location_id string, start_timestamp timestamp, end_timestamp timestamp, level string, description string",
    )
    r = status.with_covering_flags(p, f).select(status.decide(F.col("exceedance")).alias("s")).collect()[0]["s"]
    assert r["type"] == kind and r["reason"].startswith(reason)


def test_open_ended_interval_is_cut_to_the_points(spark):
    p = spark.createDataFrame([("s", START), ("s", hour(30))], "name string, t timestamp")
    f = spark.createDataFrame([("s", 1, datetime(1900, 1, 1), datetime(9999, 1, 1))], "name string, id int, a timestamp, b timestamp")
    assert joins.covering_intervals(p, f, ["name"], "t", "a", "b").count() == 2


def test_daylight_saving_days(spark):
    days = spark.createDataFrame([("2024-03-10",), ("2024-11-03",), ("2024-07-01",)], "d string").select(F.to_date("d").alias("date"))
    a, b = times.day_bounds(F.col("date"))
    got = {str(r[0]): r[1] for r in days.select("date", ((F.unix_seconds(b) - F.unix_seconds(a) + 1) / 3600)).collect()}
    assert got == {"2024-03-10": 23.0, "2024-11-03": 25.0, "2024-07-01": 24.0}


def test_local_text_names_the_zone(spark):
    df = spark.createDataFrame([(datetime(2024, 1, 5, 18, 4),), (datetime(2024, 7, 5, 4, 4),)], "t timestamp")
    got = [r[0] for r in df.select(times.local_text(F.col("t"))).collect()]
    assert got == ["Jan 5 2024 13:04 pm EST", "Jul 5 2024 0:04 am EDT"]
