"""Interpolation and carry-forward on ordered series.

Looking ahead uses a window in descending order: a frame that ends at the last row would
be re-read for every row.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from hydrosignal.operators.ordered import PART, time_part


def _micros(col):
    return F.unix_micros(col)


def _known_around(df: DataFrame, keys, time, position, cols):
    back = Window.partitionBy(*keys).orderBy(F.col(time).asc()).rowsBetween(Window.unboundedPreceding, 0)
    ahead = Window.partitionBy(*keys).orderBy(F.col(time).desc()).rowsBetween(Window.unboundedPreceding, 0)
    known = {c: F.when(F.col(c).isNotNull(), F.struct(position.alias("x"), F.col(c).cast("double").alias("y"))) for c in cols}
    return df.withColumns({f"_b_{c}": F.last(known[c], ignorenulls=True).over(back) for c in cols}).withColumns(
        {f"_a_{c}": F.last(known[c], ignorenulls=True).over(ahead) for c in cols}
    )


def _line(c: str, position):
    b, a = F.col(f"_b_{c}"), F.col(f"_a_{c}")
    share = (position - b["x"]) / (a["x"] - b["x"])
    between = b["y"] + (a["y"] - b["y"]) * share
    return F.when(F.col(c).isNotNull(), F.col(c).cast("double")).when(a["x"] != b["x"], between)


def interpolate(df: DataFrame, keys: Sequence[str], time: str, cols: Sequence[str]) -> DataFrame:
    """Linear in time between known neighbours; nothing beyond the first and last known value."""
    position = _micros(F.col(time))
    work = _known_around(df, keys, time, position, cols)
    return work.withColumns({c: _line(c, position) for c in cols}).drop(*[f"_{s}_{c}" for c in cols for s in "ba"])


def interpolate_rows(df: DataFrame, keys: Sequence[str], time: str, cols: Sequence[str]) -> DataFrame:
    """Linear by row position; the tail carries the last value, the head becomes 0."""
    work = df.withColumn("_pos", F.row_number().over(Window.partitionBy(*keys).orderBy(time)))
    position = F.col("_pos")
    work = _known_around(work, keys, time, position, cols)
    return work.withColumns(
        {c: F.coalesce(_line(c, position), F.col(f"_b_{c}")["y"], F.lit(0.0)) for c in cols}
    ).drop("_pos", *[f"_{s}_{c}" for c in cols for s in "ba"])


def forward_fill(df: DataFrame, keys: Sequence[str], time: str, cols: Sequence[str]) -> DataFrame:
    w = Window.partitionBy(*keys).orderBy(time).rowsBetween(Window.unboundedPreceding, 0)
    return df.withColumns({c: F.last(c, ignorenulls=True).over(w) for c in cols})


def interpolate_parts(
    df: DataFrame, keys: Sequence[str], time: str, cols: Sequence[str], part_seconds: int
) -> DataFrame:
    """``interpolate`` for series too long for one task.

    Neighbours are looked up inside time parts; where a part has none on one side the
    edge of the nearest earlier or later part is used. Only one edge row per part is
    gathered per series.
    """
    work = df.withColumn(PART, time_part(F.col(time), part_seconds))
    position = _micros(F.col(time))
    known = {c: F.when(F.col(c).isNotNull(), F.struct(position.alias("x"), F.col(c).cast("double").alias("y"))) for c in cols}
    edges = work.groupBy(*keys, PART).agg(
        *[F.max(known[c]).alias(f"_hi_{c}") for c in cols], *[F.min(known[c]).alias(f"_lo_{c}") for c in cols]
    )
    up = Window.partitionBy(*keys).orderBy(F.col(PART).asc()).rowsBetween(Window.unboundedPreceding, -1)
    down = Window.partitionBy(*keys).orderBy(F.col(PART).desc()).rowsBetween(Window.unboundedPreceding, -1)
    edges = edges.select(
        *keys,
        PART,
        *[F.last(f"_hi_{c}", ignorenulls=True).over(up).alias(f"_eb_{c}") for c in cols],
        *[F.last(f"_lo_{c}", ignorenulls=True).over(down).alias(f"_ea_{c}") for c in cols],
    )
    near = _known_around(work, [*keys, PART], time, position, cols).join(edges, [*keys, PART], "left")
    near = near.withColumns(
        {f"_b_{c}": F.coalesce(f"_b_{c}", f"_eb_{c}") for c in cols} | {f"_a_{c}": F.coalesce(f"_a_{c}", f"_ea_{c}") for c in cols}
    )
    helpers = [f"_{s}_{c}" for c in cols for s in ("b", "a", "eb", "ea")]
    return near.withColumns({c: _line(c, position) for c in cols}).drop(PART, *helpers)
