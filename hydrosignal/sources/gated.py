"""Tables that are published only if their rows hold what is asked of them.

The figures of the gates are gathered while the rows are written, so nothing is read twice. The
rows go to a folder beside the table; a gate that fails removes it, otherwise it takes the table's
place by a rename.
"""

from __future__ import annotations

import uuid
from collections.abc import Sequence
from dataclasses import dataclass

from pyspark.sql import Column, DataFrame, Observation, SparkSession
from pyspark.sql import functions as F

from hydrosignal.session import discard


@dataclass(frozen=True)
class Gate:
    """A figure of all rows (an aggregate) that must lie between ``least`` and ``most``, ends included."""

    name: str
    figure: Column
    least: float = 0.0
    most: float = 0.0


class GateFailed(ValueError):
    """A table that was not published, with the figures of its gates."""

    def __init__(self, figures: dict[str, float | None], failed: Sequence[str]):
        super().__init__(f"not published: {', '.join(f'{n} = {figures[n]}' for n in failed)}")
        self.figures = figures


def complete(*columns: str) -> list[Gate]:
    """No null in these columns."""
    return [Gate(f"nulls_{c}", F.count_if(F.col(c).isNull())) for c in columns]


def adds_up(name: str, value: Column, total: float, tolerance: float = 0.1) -> Gate:
    """The sum of ``value`` differs from ``total`` by less than the tolerance or just as much."""
    return Gate(name, F.coalesce(F.sum(value), F.lit(0.0)) - F.lit(total), -tolerance, tolerance)


def _folder(spark: SparkSession, path: str):
    at = spark._jvm.org.apache.hadoop.fs.Path(path)
    return at.getFileSystem(spark._jsc.hadoopConfiguration()), at


def publish(df: DataFrame, path: str, gates: Sequence[Gate], partition_by: Sequence[str] = ()) -> dict[str, float | None]:
    """Writes ``df`` as the table at ``path`` if all gates hold; the figures of the gates.

    Readers see the former table until the rename, and a run that ends half-way leaves it as it is.
    A former table is kept beside the new one until the rename is done. An empty table has the
    figures of no rows; a null figure fails. A broken job leaves a folder ``_staged-...`` behind,
    which no reader takes for the table.
    """
    if not gates:
        raise ValueError("no gate is given")
    spark = df.sparkSession
    stage, former = (f"{path.rstrip('/')}._{x}-{uuid.uuid4().hex}" for x in ("staged", "former"))
    seen = Observation()
    observed = df.observe(seen, *[g.figure.alias(g.name) for g in gates])
    observed.write.partitionBy(*partition_by).parquet(stage)
    figures = {g.name: seen.get.get(g.name) for g in gates}
    failed = [g.name for g in gates if figures[g.name] is None or not g.least <= figures[g.name] <= g.most]
    if failed:
        discard(spark, stage)
        raise GateFailed(figures, failed)
    system, table = _folder(spark, path)
    there = system.exists(table)
    if there:
        system.rename(table, _folder(spark, former)[1])
    if not system.rename(_folder(spark, stage)[1], table):
        if there:
            system.rename(_folder(spark, former)[1], table)
        raise OSError(f"{stage} could not take the place of {path}")
    if there:
        discard(spark, former)
    return figures
