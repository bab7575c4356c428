"""Query registry."""

from __future__ import annotations

from collections.abc import Callable
from dataclasses import dataclass, field

from pyspark.sql import DataFrame, SparkSession

Query = Callable[[SparkSession, str], DataFrame]


@dataclass
class Registry:
    queries: dict[str, Query] = field(default_factory=dict)
    sql: dict[str, str] = field(default_factory=dict)


REGISTRY = Registry()


def query(name: str, sql: str | None = None) -> Callable[[Query], Query]:
    """Register ``f(spark, folder)``; times are read and shown in UTC."""

    def wrap(f: Query) -> Query:
        def run(spark: SparkSession, folder: str) -> DataFrame:
            spark.conf.set("spark.sql.session.timeZone", "UTC")
            return f(spark, folder)

        if name in REGISTRY.queries:
            raise ValueError(f"query {name} registered twice")
        REGISTRY.queries[name] = run
        if sql is not None:
            REGISTRY.sql[name] = sql.strip()
        return f

    return wrap
