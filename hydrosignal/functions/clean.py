"""Cleaning, unit and recoding expressions."""

from __future__ import annotations

from collections.abc import Iterable, Mapping

from pyspark.sql import Column
from pyspark.sql import functions as F

# Markers for a missing reading.
MISSING_TEXT = ("N/A", "")
MISSING_NUMBER = (-9999.0,)


def null_if(col: Column, *sentinels) -> Column:
    for s in sentinels:
        col = F.nullif(col, F.lit(s))
    return col


def to_number(text: Column) -> Column:
    """Text reading to double: markers are removed before the cast, bad text is null."""
    number = null_if(F.trim(text), *MISSING_TEXT).try_cast("double")
    number = null_if(number, *MISSING_NUMBER)
    return F.nanvl(number, F.lit(None).cast("double"))


def to_flag(text: Column) -> Column:
    return null_if(F.trim(text), *MISSING_TEXT).try_cast("int").cast("boolean")


def or_zero(col: Column) -> Column:
    return F.coalesce(col, F.lit(0.0))


def fahrenheit(celsius: Column) -> Column:
    return celsius * 9 / 5 + 32


def miles_per_hour(knots: Column) -> Column:
    return knots * 1.152


def inches_of_mercury(hectopascal: Column) -> Column:
    return hectopascal * 0.02953


def log10_floor(col: Column, floor: float) -> Column:
    return F.log10(F.greatest(col, F.lit(floor)))


def class_label(flag: Column) -> Column:
    return F.when(flag, F.lit("yes")).when(~flag, F.lit("no"))


def recode(col: Column, mapping: Mapping) -> Column:
    """Dictionary recode; values outside the dictionary stay as they are."""
    pairs = [F.lit(x) for kv in mapping.items() for x in kv]
    return F.coalesce(F.create_map(*pairs)[col], col)


def lookup(col: Column, mapping: Mapping) -> Column:
    """Dictionary lookup; values outside the dictionary give null."""
    pairs = [F.lit(x) for kv in mapping.items() for x in kv]
    return F.create_map(*pairs)[col]


def any_pair(left: Column, right: Column, pairs: Iterable[tuple[str, str]]) -> Column:
    """True when (left, right) is one of the listed pairs."""
    hit = F.lit(False)
    for a, b in pairs:
        hit = hit | ((left == a) & (right == b))
    return hit


def in_delimited(value: Column, text: Column, delimiter_regex: str = r" \+ ") -> Column:
    return F.array_contains(F.split(text, delimiter_regex), value)


def in_season(date: Column, first_year=2005, last_year=2016, first_month=5, last_month=10) -> Column:
    """Months of a season in a range of years, for a date or timestamp column.

    The range of the years is also given as a plain range of the column, which reaches the scan.
    """
    first, end = f"{first_year}-{first_month:02d}-01", f"{last_year + last_month // 12}-{last_month % 12 + 1:02d}-01"
    inside = (date >= F.lit(first).cast("date")) & (date < F.lit(end).cast("date"))
    return inside & F.month(date).between(first_month, last_month)


def sigmoid(log_odds: Column) -> Column:
    return 1 / (1 + F.exp(-log_odds))


def logit(p: Column) -> Column:
    return F.log(p / (1 - p))
