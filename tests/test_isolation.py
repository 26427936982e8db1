"""Rules that raise errors are findings of their own, and samples of rows without a partition are kept."""

import datetime as dt

import pytest
from pyspark.sql import functions as F

from lakegauge.contract import ColumnContract, parse_contract
from lakegauge.operators import onepass, predicates, rules
from lakegauge.operators.prepare import PART, PART_DATE
from lakegauge.plans import baseline as bl
from lakegauge.plans.evaluate import evaluate

NOW = dt.datetime(2024, 6, 1)


@pytest.fixture(scope="module")
def rows(spark):
    """Five partitions, one without a name; ``n`` is zero in the second, ``s`` no number in the third."""
    data = [(p, i, 0 if p == "b" and i == 3 else i + 1, "x" if p == "c" else str(i)) for p in ("a", "b", "c", "d", None) for i in range(6)]
    return spark.createDataFrame(data, f"{PART} string, i long, n long, s string").withColumn(PART_DATE, F.lit(None).cast("date"))


def test_errors_stay_in_their_rule_and_partition(rows):
    made = [rules.predicate("zero", "10 / n > 2"), rules.predicate("cast", "CAST(s AS INT) < 5"), rules.predicate("fine", "i < 4"),
            rules.predicate("none", "1 / (i - i) > 0")]
    parts = rows.select(PART, PART_DATE).distinct()
    got = {(r["rule_id"], r[PART]): r for r in predicates.isolated(rows, [PART, PART_DATE], made, parts).collect()}
    assert len(got) == 4 * 5
    assert {k for k, r in got.items() if r["error"]} == {("zero", "b"), ("cast", "c"), *(("none", p) for p in ("a", "b", "c", "d", None))}
    assert "DIVIDE_BY_ZERO" in got["zero", "b"]["error"] and "CAST_INVALID_INPUT" in got["cast", "c"]["error"]
    assert got["zero", "a"]["unexpected_count"] == 2 and got["cast", None]["unexpected_count"] == 1 and got["fine", "b"]["unexpected_count"] == 2
    assert not any(r["success"] for k, r in got.items() if r["error"])


def test_a_run_survives_raising_rules_and_keeps_samples_of_unnamed_partitions(rows):
    c = parse_contract("k", {"kolom": [{"nama": "i", "tipe": "integer", "rentang": [0, 3], "profil_distribusi": True}, {"nama": "s"}],
                             "validasi": {"data_quality": [{"check": "zero", "validation": "10 / n > 2", "columns": []}]}})
    c.columns.append(ColumnContract("s", allowed=[dt.date(2024, 1, 1)]))
    base = bl.learn(rows.where(F.col(PART).isNotNull()), c)
    got = {(r["rule_id"], r["partition"]): r for r in evaluate(rows, c, base, now=NOW, samples=5).collect()}
    assert got["6.predicate.zero", "b"]["error"] and got["6.predicate.zero", "a"]["error"] is None
    bounds = [r for (rule, p), r in got.items() if p is None and rule.endswith(".i") and r["unexpected_count"] == 2]
    assert bounds and all(r["sample"] == ["4.0", "5.0"] for r in bounds)


@pytest.mark.parametrize("values,found", [
    ([dt.date(2024, 1, 2)], 1), ([dt.datetime(2024, 1, 2)], 1), ([1, "x"], 2), ([1.0, 2.5], 2), ([True], 2), ([None, "x"], 1), (["2.50"], 0)])
def test_allowed_values_of_any_kind(spark, values, found):
    df = spark.createDataFrame([("g", v) for v in ("1", "2.5", "x", "true", "2024-01-02", None)], f"{PART} string, v string")
    (r,) = onepass.grouped_checks(df, [PART], [rules.in_set("r", "v", values)]).collect()
    assert (r["element_count"], r["missing_count"], r["unexpected_count"]) == (6, 1, 5 - found)
