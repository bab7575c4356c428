"""Landed provider payloads (nested JSON, text with a preamble) to typed rows."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from hydrosignal.functions import clean, times

# Payload field names.
WEATHER_FIELDS = (
    "utcdate struct<year:string,mon:string,mday:string,hour:string,min:string>, "
    "tempi string, dewpti string, hum string, wspdi string, wdird string, visi string, "
    "pressurei string, precipi string, metar string, "
    "fog string, rain string, snow string, hail string, thunder string"
)
METAR_FIELDS = (
    "metar_type string, observation_time string, temp_c string, dewpoint_c string, "
    "wind_speed_kt string, precip_in string, sea_level_pressure_mb string"
)
FLOW_DDL = (
    "value struct<timeSeries:array<struct<"
    "sourceInfo:struct<siteCode:array<struct<value:string>>>,"
    "values:array<struct<value:array<struct<dateTime:string,value:string>>>>>>>"
)


def _array_of(fields: str) -> str:
    return f"array<struct<{', '.join(f.strip().replace(' ', ':', 1) for f in _split(fields))}>>"


def _split(fields: str) -> list[str]:
    out, depth, word = [], 0, ""
    for ch in fields:
        depth += (ch == "<") - (ch == ">")
        if ch == "," and depth == 0:
            out.append(word)
            word = ""
        else:
            word += ch
    return [*out, word]


def weather_observations(docs: DataFrame, json: str = "json") -> DataFrame:
    """Daily weather documents to raw observation rows; empty documents give no rows."""
    path = F.get_json_object(F.col(json), "$.history.observations")
    rest = [c for c in docs.columns if c != json]
    rows = docs.select(*rest, F.explode(F.from_json(path, _array_of(WEATHER_FIELDS))).alias("o")).select(*rest, "o.*")
    d = F.col("utcdate")
    return rows.withColumn(
        "utc_timestamp", times.from_parts(d["year"], d["mon"], d["mday"], d["hour"], d["min"])
    ).drop("utcdate")


def clean_weather(raw: DataFrame, keys: list[str] | None = None) -> DataFrame:
    """Distinct observations with typed, unit-named columns; routine reports only."""
    keys = keys or []
    names = {
        "temp": "tempi", "dewpt": "dewpti", "hum": "hum", "wspd": "wspdi",
        "wdird": "wdird", "vis": "visi", "pressure": "pressurei",
    }
    flags = ("fog", "rain", "snow", "hail", "thunder")
    chosen = raw.filter(F.col("metar").startswith("METAR")).select(
        *keys,
        "utc_timestamp",
        *[clean.to_number(F.col(src)).alias(dst) for dst, src in names.items()],
        clean.or_zero(clean.to_number(F.col("precipi"))).alias("precip"),
        *[clean.to_flag(F.col(f)).alias(f) for f in flags],
        "metar",
    )
    return chosen.dropDuplicates()


def metar_hourly(docs: DataFrame, start: Column, end: Column, json: str = "json") -> DataFrame:
    """Routine reports of a date range, typed. The array is filtered before it is expanded."""
    rest = [c for c in docs.columns if c != json]
    arr = F.filter(F.from_json(F.col(json), _array_of(METAR_FIELDS)), lambda o: o["metar_type"] == "METAR")
    rows = docs.filter(F.col("date").between(start, end)).select(*rest, F.explode(arr).alias("o"))
    number = lambda f: F.nullif(F.col(f"o.{f}"), F.lit("")).cast("double")
    return rows.select(
        *rest,
        F.col("o.observation_time").cast("timestamp").alias("observation_time"),
        number("temp_c").alias("temp_c"),
        number("dewpoint_c").alias("dewpoint_c"),
        number("wind_speed_kt").alias("wind_speed_kt"),
        clean.or_zero(number("precip_in")).alias("precip_in"),
        number("sea_level_pressure_mb").alias("sea_level_pressure_mb"),
    )


def metar_units(rows: DataFrame, keys: list[str]) -> DataFrame:
    """Metric report columns to the units of the predictors."""
    return rows.select(
        *keys,
        F.col("observation_time").alias("timestamp"),
        clean.fahrenheit(F.col("temp_c")).alias("temp"),
        clean.fahrenheit(F.col("dewpoint_c")).alias("dewpt"),
        clean.miles_per_hour(F.col("wind_speed_kt")).alias("wspd"),
        clean.inches_of_mercury(F.col("sea_level_pressure_mb")).alias("pressure"),
        F.col("precip_in").alias("precip"),
    )


def read_whole_text(spark, path) -> DataFrame:
    """One row per file: path and whole content."""
    return spark.read.option("wholetext", True).text(path).select(F.input_file_name().alias("path"), "value")


#: Lines of a text whose quoted cells may hold line breaks, and the cells of a line.
_RECORD = r"((?:[^\"\n]++|\"(?:[^\"]++|\"\")*+\")++)"
_CELL = r"(?:^|,)(\"(?:[^\"]|\"\")*+\"|[^,]*+)"


def _cells(line):
    """Cells of a CSV line as an array: quotes removed, an empty unquoted cell is null."""
    return F.transform(
        F.regexp_extract_all(line, F.lit(_CELL), 1),
        lambda x: F.when(x.startswith('"'), F.replace(x.substr(F.lit(2), F.length(x) - 2), F.lit('""'), F.lit('"'))).when(
            x != "", x
        ),
    )


def preamble_csv(texts: DataFrame, ddl: str, marker: str = "raw_text", text: str = "value") -> tuple[DataFrame, DataFrame]:
    """CSV rows after a preamble, and the payloads without a header line.

    The header is the first line that starts with ``marker``; it may have any number of names, and
    they decide which column a value goes to. Quoted cells may hold commas and line breaks. Blank
    lines are skipped. ``ddl`` lists the wanted columns.
    """
    rest = [c for c in texts.columns if c != text]
    plain = F.regexp_replace(F.col(text), "\r\n", "\n")
    at = F.regexp_instr(plain, F.lit(f"(?m)^\\Q{marker}\\E"))
    located = texts.select(*rest, F.when(at > 0, plain.substr(at, F.length(plain))).alias("_body"))
    rejected = located.filter("_body IS NULL").select(*rest)
    lines = F.filter(F.regexp_extract_all("_body", F.lit(_RECORD), 1), lambda x: F.length(F.trim(x)) > 0)
    split = located.filter("_body IS NOT NULL").select(*rest, lines.alias("_lines"))
    rows = split.select(
        *rest,
        F.split(F.get("_lines", F.lit(0)), ",").alias("_names"),
        F.explode(F.slice("_lines", F.lit(2), F.size("_lines"))).alias("_line"),
    ).select(*rest, "_names", _cells(F.col("_line")).alias("_values"))
    wanted = [f.strip().split(" ", 1) for f in _split(ddl)]

    def cell(name):
        where = F.array_position("_names", name).cast("int")
        return F.when(where > 0, F.get("_values", where - 1))

    return rows.select(*rest, *[cell(n).try_cast(t).alias(n) for n, t in wanted]), rejected


def daily_flow(docs: DataFrame, json: str = "json") -> DataFrame:
    """Daily gauge responses to (station_id, date, flow); first series and first block only."""
    series = F.from_json(F.col(json), FLOW_DDL)["value"]["timeSeries"]
    first = F.get(series, F.lit(0))
    block = F.get(first["values"], F.lit(0))["value"]
    station = F.get(first["sourceInfo"]["siteCode"], F.lit(0))["value"]
    rows = docs.select(station.alias("station_id"), F.explode(block).alias("v"))
    return rows.select(
        "station_id",
        F.substring("v.dateTime", 1, 10).cast("date").alias("date"),
        F.col("v.value").try_cast("double").alias("flow"),
    )


def predictors_to_json(predictors: Column) -> Column:
    """A map or struct of predictors as JSON text."""
    return F.to_json(predictors)


def json_to_long(df: DataFrame, ids: list[str], json: str) -> DataFrame:
    """JSON predictors to (ids, key, value)."""
    return df.select(*ids, F.explode(F.from_json(F.col(json), "map<string,double>")).alias("key", "value"))
