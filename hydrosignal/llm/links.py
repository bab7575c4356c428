"""Connected components of a table of links."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from hydrosignal.operators.attach import attach
from hydrosignal.session import materialize


def components(edges: DataFrame, a: str = "a", b: str = "b") -> DataFrame:
    """(node, component) for every node of ``edges``; the component is its smallest node.

    Each round replaces both ends of a link by their current roots and drops what has become
    one root; every root with a smaller neighbour is hooked below the smallest of them, and
    chains of hooks are shortened by doubling. At least half of the linked roots vanish per
    round. The links are never grouped by a node: minima combine map-side, and roots are looked
    up with the size-checked ``attach``, so a node with very many links is no hot key.
    Rounds are cut by written tables. Links with a null end and links to itself count as none.
    """
    live = materialize(
        edges.select(F.least(a, b).alias("lo"), F.greatest(a, b).alias("hi"))
        .filter(F.col(a).isNotNull() & F.col(b).isNotNull() & (F.col(a) != F.col(b)))
        .distinct(),
        "links",
    )
    labels = materialize(
        live.select(F.explode(F.array("lo", "hi")).alias("node")).distinct().withColumn("component", F.col("node")),
        "labels",
    )
    while not live.isEmpty():
        hooks = materialize(live.groupBy("hi").agg(F.min("lo").alias("lo")), "hooks")
        while True:
            step = attach(hooks, hooks.select(F.col("hi").alias("lo"), F.col("lo").alias("up")), ["lo"])
            if step.filter("up IS NOT NULL").isEmpty():
                break
            hooks = materialize(step.select("hi", F.coalesce("up", "lo").alias("lo")), "hooks")
        labels = materialize(
            attach(labels, hooks.withColumnRenamed("hi", "component"), ["component"]).select(
                "node", F.coalesce("lo", "component").alias("component")
            ),
            "labels",
        )
        low = attach(live, hooks.select(F.col("hi").alias("lo"), F.col("lo").alias("lo_root")), ["lo"])
        both = attach(low, hooks.select("hi", F.col("lo").alias("hi_root")), ["hi"])
        lo, hi = F.coalesce("lo_root", "lo"), F.coalesce("hi_root", "hi")
        live = materialize(
            both.filter(lo != hi).select(F.least(lo, hi).alias("lo"), F.greatest(lo, hi).alias("hi")).distinct(),
            "links",
        )
    return labels
