"""Value slices with and without the finer division give the same exact answers."""

import random

import pytest
from pyspark.sql import functions as F

from hydrosignal.operators import metrics, ordered


@pytest.mark.parametrize("partitions", ["4", "600"])
def test_slices_follow_the_order(spark, partitions):
    old = spark.conf.get("spark.sql.shuffle.partitions")
    rnd = random.Random(6)
    rows = [(rnd.choice([rnd.random(), rnd.random() * 1e-3, 0.5]), int(rnd.random() < 0.4)) for _ in range(2000)]
    df = spark.createDataFrame(rows, "prob double, label int").coalesce(4)
    try:
        spark.conf.set("spark.sql.shuffle.partitions", partitions)
        got = df.select("prob", ordered.value_part(df, "prob").alias("p")).orderBy("prob").collect()
        assert all(a["p"] <= b["p"] for a, b in zip(got, got[1:]))
        spark.conf.set("spark.sql.shuffle.partitions", "4")
        pos, neg = [p for p, y in rows if y], [p for p, y in rows if not y]
        want = sum((p > n) + 0.5 * (p == n) for p in pos for n in neg) / (len(pos) * len(neg))
        assert metrics.auc(df, []).select(F.col("auc")).collect()[0][0] == pytest.approx(want)
    finally:
        spark.conf.set("spark.sql.shuffle.partitions", old)
