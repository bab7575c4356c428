"""Typed file scans, table scans and sinks."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.types import StringType, StructField, StructType

# The typed columns of the sample files; every other column is text.
SAMPLE_TYPES = {
    "DateHour": "timestamp",
    "VisitID": "int",
    "ID": "int",
    "ResultValue": "double",
    "MethodID": "int",
    "SampleDepth": "double",
    "Datetime": "timestamp",
    "HasFlow": "int",
    "Latitude": "double",
    "Longitude": "double",
    "LocationTypeID": "int",
    "InWatershed": "int",
    "StaffGage": "int",
    "Precip.48": "double",
}


def typed_schema(columns: Sequence[str], types: dict[str, str] | None = None) -> StructType:
    """A schema in file order where unlisted columns are text."""
    types = SAMPLE_TYPES if types is None else types
    ddl = ", ".join(f"`{c}` {types.get(c, 'string')}" for c in columns)
    return StructType.fromDDL(ddl)


def read_csv(
    spark: SparkSession,
    path,
    schema: StructType,
    encoding: str = "UTF-8",
    timestamp_format: str | None = None,
    separator: str = ",",
    quote: str = '"',
    escape: str = '"',
    multi_line: bool = False,
) -> DataFrame:
    """CSV with a header and a declared schema; nothing is inferred.

    A value may stand in quotes; a quote inside it is doubled (or follows another ``escape``).
    Values that hold line breaks need ``multi_line``: then a file is read by one task, because
    only its beginning tells where a row starts, so large tables should be several files.
    """
    reader = spark.read.schema(schema).option("header", True).option("sep", separator).option("encoding", encoding)
    reader = reader.option("quote", quote).option("escape", escape).option("multiLine", multi_line)
    if timestamp_format:
        reader = reader.option("timestampFormat", timestamp_format)
    return reader.csv(path)


def read_gauge_table(spark: SparkSession, path, columns: Sequence[str], types: dict[str, str]) -> DataFrame:
    """Tab file with ``#`` comment lines and a format row (``5s 15s 20d``) below its header.

    The format row is recognised by content, so it may be read by any task.
    """
    text = StructType([StructField(c, StringType()) for c in columns])
    raw = (
        spark.read.schema(text).option("header", True).option("sep", "\t").option("comment", "#").csv(path)
    )
    rows = raw.filter(~F.coalesce(F.col(columns[0]).rlike("^[0-9]+[sdn]$"), F.lit(False)))
    return rows.select(*[F.col(c).try_cast(types[c]).alias(c) if c in types else F.col(c) for c in columns])


def read_lookup(spark: SparkSession, path, ddl: str, separator: str = ",") -> DataFrame:
    """A code table. Spark broadcasts it when its measured size is below the session's limit."""
    return read_csv(spark, path, StructType.fromDDL(ddl), separator=separator)


def scan(
    spark: SparkSession, path: str, columns: Sequence[str], condition: Column | str | None = None, fmt: str = "parquet"
) -> DataFrame:
    """Table scan; the columns and the condition reach the file reader."""
    df = spark.read.format(fmt).load(path)
    if condition is not None:
        df = df.filter(condition)
    return df.select(*columns)


def date_predicates(column: str, days: Sequence[str]) -> list[str]:
    """Conditions for ``spark.read.jdbc(predicates=...)`` that together take every row exactly once.

    One read task each: before the first edge or null, between edges, from the last edge on.
    """
    edges = sorted(days)
    if not edges:
        return ["1 = 1"]
    between = [f"{column} >= '{a}' AND {column} < '{b}'" for a, b in zip(edges, edges[1:])]
    return [f"{column} < '{edges[0]}' OR {column} IS NULL", *between, f"{column} >= '{edges[-1]}'"]


def write_csv(
    df: DataFrame, path: str, timestamps: Sequence[str] = (), pattern: str = "yyyy-MM-dd HH:mm:ss", encoding: str = "UTF-8"
) -> None:
    """CSV with a header; the named timestamps are written as text in the session zone.

    Quotes inside values are doubled and blanks at their ends kept, so that ``read_csv`` gives the
    same values back (a null and an empty text alike are read as null).
    """
    options = {"header": True, "encoding": encoding, "escape": '"', "ignoreLeadingWhiteSpace": False, "ignoreTrailingWhiteSpace": False}
    df.withColumns({c: F.date_format(c, pattern) for c in timestamps}).write.options(**options).csv(path)


def write_dataset(df: DataFrame, path: str, partition_by: Sequence[str] = (), mode: str = "errorifexists") -> None:
    df.write.mode(mode).partitionBy(*partition_by).parquet(path)
