"""Results that don't depend on the order in which rows and partitions come."""

import random

from pyspark.sql import functions as F

from lakegauge.plans import baseline as bl


def test_null_corridor_is_the_same_for_every_order_of_partitions(spark):
    r = random.Random(3)
    rows = [("c", r.randrange(1, 40), r.randrange(41, 90)) for _ in range(40)]
    found = set()
    for seed in range(8):
        random.Random(seed).shuffle(rows)
        stats = spark.createDataFrame(rows, "column string, nulls long, rows long").coalesce(1)
        found.add(bl.null_corridor(stats, 0.1).first()["null_mean"])
    assert len(found) == 1
    assert abs(found.pop() - sum(n / m for _, n, m in rows) / len(rows)) < 1e-15


def test_distinct_estimate_is_the_same_for_every_order_of_values(spark):
    texts = spark.range(5000).select(F.md5(F.col("id").cast("string")).alias("v"))
    found = {texts.repartition(n, "v").sortWithinPartitions(by).agg(bl.distinct_estimate("v")).first()[0]
             for n in (1, 3) for by in (F.col("v"), F.col("v").desc())}
    assert len(found) == 1 and abs(found.pop() - 5000) < 250
