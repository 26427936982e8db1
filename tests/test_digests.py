"""Row reconciliation by a digest tree: against brute force, and reading only what differs."""

import datetime as dt
from collections import defaultdict

import pytest
from pyspark.sql import functions as F

from lakegauge.operators import reconcile


def brute(a, b, n_key):
    sides = defaultdict(lambda: ([], []))
    for i, rows in enumerate((a, b)):
        for r in rows:
            sides[r[:n_key]][i].append(r[n_key:])
    name = lambda x, y: "missing" if not y else "extra" if not x else "match" if sorted(map(repr, x)) == sorted(map(repr, y)) else "changed"
    return {k: (len(x), len(y), name(x, y)) for k, (x, y) in sides.items()}


BIG = 2 ** 63
CASES = {
    "numbers": ("k bigint, v string", 1, [(i, f"v{i % 7}") for i in range(-50, 50)],
                [(i, f"v{i % 7}" if i not in (-13, 40) else None) for i in range(-48, 53)]),
    "extremes": ("k bigint, v int", 1, [(-BIG, 1), (BIG - 1, 2), (0, 3), (7, None)], [(-BIG, 1), (BIG - 1, 3), (0, 3), (7, None), (8, 1)]),
    "null keys": ("k int, m string, v int", 2, [(None, "a", 1), (None, None, 1), (1, None, 1), (1, "a", 1), (2, "a", 1)],
                  [(None, "a", 2), (None, None, 1), (1, None, 1), (1, "a", 1), (2, "a", None)]),
    "repeated": ("k smallint, v int", 1, [(1, 1), (1, 1), (2, 1), (2, 2), (3, 5), (3, 5)], [(1, 1), (2, 2), (2, 1), (3, 6), (3, 6)]),
    "text": ("k string, v double", 1, [(c, float(i)) for i, c in enumerate("abcdefgh")] + [("", 0.0), (None, 1.0)],
             [(c, float(i)) for i, c in enumerate("abcxefgh")] + [("", -1.0), (None, 1.0)]),
    "dates": ("k date, v int", 1, [(dt.date(2024, 1, 1) + dt.timedelta(d), d) for d in range(40)],
              [(dt.date(2024, 1, 1) + dt.timedelta(d), d + (d == 17)) for d in range(40)]),
    "keys only": ("k int", 1, [(1,), (2,), (2,)], [(1,), (2,), (3,)]),
    "one side empty": ("k int, v int", 1, [(1, 1), (None, 2)], []),
    "both empty": ("k int, v int", 1, [], []),
    "null keys alone": ("k int, v int", 1, [(None, 1), (None, 2)], [(None, 2), (None, 2)]),
    "equal": ("k int, v int", 1, [(1, 1), (5, 2)], [(5, 2), (1, 1)]),
}


@pytest.mark.parametrize("case", CASES)
@pytest.mark.parametrize("ranges,rows", [(4096, 1_000_000), (4, 1)])
def test_statuses(spark, case, ranges, rows):
    schema, n_key, a, b = CASES[case]
    left, right = spark.createDataFrame(a, schema), spark.createDataFrame(b, schema)
    key = left.columns[:n_key]
    tree = reconcile.digest_tree(left, right, key, None, ranges, rows)
    want = brute(a, b, n_key)
    take = lambda df: {tuple(r[k] for k in key): (r["source_rows"], r["landed_rows"], r["status"]) for r in df.collect()}
    assert take(tree.statuses()) == want
    assert take(tree.differences()) == {k: v for k, v in want.items() if v[2] != "match"}


def test_one_changed_row_reads_one_range(spark, tmp_path):
    path = str(tmp_path / "landed")
    a = spark.range(-20_000, 80_000, 1, 8).withColumn("v", F.hash("id"))
    a.withColumn("v", F.expr("CASE WHEN id = 31415 THEN 0 ELSE v END")).write.parquet(path)
    b = spark.read.parquet(path)
    tree = reconcile.digest_tree(a, b, ["id"], ranges=256, range_rows=10)
    assert [(x["read"], x["differing"]) for x in tree.levels] == [(1, 1)] * len(tree.levels) and len(tree.levels) >= 2
    assert tree.levels[-1]["rows"] <= 10
    assert [tuple(r) for r in tree.differences().collect()] == [(31415, 1, 1, "changed")]
    plan = tree.differing_rows()._jdf.queryExecution().executedPlan().toString()
    assert "GreaterThanOrEqual(id," in plan and "LessThanOrEqual(id," in plan       # the range reaches the scan
    assert tree.differing_rows().count() <= 20


def test_many_changes_stop_early(spark):
    """Changes all over the table are not chased range by range."""
    a = spark.range(0, 10_000, 1, 4).withColumn("v", F.lit(1))
    tree = reconcile.digest_tree(a, a.withColumn("v", F.expr("IF(id % 3 = 0, 2, 1)")), ["id"], ranges=64, range_rows=4)
    assert len(tree.levels) == 1
    assert {r["status"]: r["count"] for r in tree.statuses().groupBy("status").count().collect()} == {"match": 6666, "changed": 3334}


@pytest.mark.parametrize("numbers,most,want", [
    ([], 3, []), ([5], 3, [(5, 5)]), ([1, 2, 3], 2, [(1, 3)]), ([1, 2, 9, 20, 21], 2, [(1, 9), (20, 21)]), ([1, 2, 9, 20, 21], 9, [(1, 2), (9, 9), (20, 21)])])
def test_intervals_cover(numbers, most, want):
    assert reconcile._intervals(numbers, most) == want
