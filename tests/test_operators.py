import math
import random

import numpy as np
import pytest
from pyspark.sql import functions as F

from lakegauge.functions import numbers, text, times
from lakegauge.operators import distribution, keys, membership, onepass, order_stats, reconcile, rules
from lakegauge.session import scratch_dir


def counts(df, *rule_list, group="g"):
    out = onepass.grouped_checks(df.withColumn("g", F.lit(1)) if "g" not in df.columns else df, [group], rule_list)
    return {r["rule_id"]: (r["element_count"], r["missing_count"], r["unexpected_count"], r["success"]) for r in out.collect()}


def test_nulls_are_not_tested(spark):
    df = spark.createDataFrame([(1, "a"), (None, None), (9, "bbb")], "x int, s string")
    got = counts(df, rules.between("r", "x", 0, 5), rules.length_between("l", "s", 1, 2), rules.not_null("n", "x"))
    assert got == {"r": (3, 1, 1, False), "l": (3, 1, 1, False), "n": (3, 0, 1, False)}


def test_pairs_are_skipped_only_when_both_are_null(spark):
    df = spark.createDataFrame([(1, 1), (1, None), (None, 1), (None, None), (2, 1), (1, 2)], "a int, b int")
    got = counts(df, rules.equal("eq", "a", "b"), rules.at_least("ge", "a", "b"))
    assert got["eq"] == (6, 1, 4, False) and got["ge"] == (6, 1, 3, False)


def test_flag_null_disagrees(spark):
    df = spark.createDataFrame([(True, 1.0), (False, None), (None, None), (True, None)], "f boolean, x double")
    assert counts(df, rules.flag_agrees("f", "f", "x", rules.present(F.col("x"))))["f"] == (4, 0, 2, False)


def test_empty_group_is_no_row_and_constant_group_passes(spark):
    df = spark.createDataFrame([(1, None)], "g int, s string")
    assert counts(df, rules.free_of("m", "s", "[<>]"))["m"] == (1, 1, 0, True)
    assert counts(df.filter("g = 2"), rules.free_of("m", "s", "[<>]")) == {}


def test_many_rules_are_cut_into_passes(spark):
    df = spark.createDataFrame([(i, i % 3) for i in range(30)], "x int, g int")
    many = [rules.between(f"r{i:03d}", "x", hi=i) for i in range(200)]
    got = {(r["g"], r["rule_id"]): r["unexpected_count"] for r in onepass.grouped_checks(df, ["g"], many, slots=17).collect()}
    assert len(got) == 600
    assert all(n == sum(1 for x in range(30) if x % 3 == g and x > int(rid[1:])) for (g, rid), n in got.items())


def test_value_checks_equal_row_checks(spark):
    rnd = random.Random(3)
    pool = ["ok", " pad", "null", "<b>", "", "x\ny", None, "é"]
    df = spark.createDataFrame([(rnd.randrange(4), rnd.choice(pool), rnd.choice(pool)) for _ in range(800)], "g int, a string, b string")
    rs = [r for c in ("a", "b") for r in (
        *[rules.free_of(f"{k}:{c}", c, p) for k, p, _ in text.DIRTY_TEXT], rules.length_between(f"l:{c}", c, 1, 2),
        rules.matches_any(f"m:{c}", c, [text.PRINTABLE_ASCII]))]
    a = sorted(map(tuple, onepass.grouped_checks(df, ["g"], rs).collect()))
    b = sorted(map(tuple, onepass.grouped_value_checks(df, ["g"], rs, slots=7).collect()))
    assert a == b and len(a) == 4 * len(rs)


def test_samples_are_bounded_and_ordered(spark):
    df = spark.range(10_000).selectExpr("id % 2 AS g", "id AS x")
    s = onepass.samples(df, ["g"], [rules.between("r", "x", hi=10)], 5).collect()
    assert len(s) == 2 and all(len(r["sample"]) == 5 and r["sample"] == sorted(r["sample"]) for r in s)


@pytest.mark.parametrize("pattern,value,hit", [
    (r"^\s|\s$", "a ", True), (r"^\s*$", "", True), (r"^\s*$", " ", True), (r"[\x00-\x1F\x7F]", "a\x1cb", True),
    (r"^a$", "a\n", True), (r"^a$", "a\r", False), (r"^\d+$", "٣", True), (r"\bnull\b", "is null.", True), (r"\bnull\b", "nullable", False),
    (r"(?P<y>\d{4})", "in 2024", True), (r"^[\x20-\x7E]+$", "\U0001F600", False)])
def test_regex_dialect(spark, pattern, value, hit):
    df = spark.createDataFrame([(value,)], "v string")
    assert df.select(text.finds(F.col("v"), pattern)).first()[0] is hit


def test_number_coercion(spark):
    vals = ["1", " 2.5 ", "-3e2", "1.5d", "0x1", "", "abc", ".5", "5.", None, "1f"]
    df = spark.createDataFrame([(v,) for v in vals], "v string")
    got = [r[0] for r in df.select(numbers.as_number(F.col("v"), df.schema["v"].dataType)).collect()]
    assert got == [1.0, 2.5, -300.0, None, None, None, None, 0.5, 5.0, None, None]
    nan = spark.createDataFrame([(float("nan"),), (1.0,)], "v double")
    assert [r[0] for r in nan.select(numbers.as_number(F.col("v"), nan.schema["v"].dataType)).collect()] == [None, 1.0]


def test_bytes_text(spark):
    df = spark.createDataFrame([(999,), (1500,), (2_000_000,), (5_000_000_000,)], "n bigint")
    assert [r[0] for r in df.select(numbers.bytes_text(F.col("n"))).collect()] == ["999 B", "1.50 KB", "2.00 MB", "5.00 GB"]


def test_log_bucket_never_decreases(spark):
    rnd = random.Random(1)
    xs = sorted([rnd.uniform(-1e6, 1e6) for _ in range(500)] + [rnd.uniform(-1, 1) * 10 ** rnd.randint(-300, 300) for _ in range(500)]
                + [0.0, -0.0, float("inf"), float("-inf"), 5e-324, -5e-324])
    b = [r[0] for r in spark.createDataFrame([(x,) for x in xs], "x double").coalesce(1).select(numbers.log_bucket(F.col("x"))).collect()]
    assert b == sorted(b)



@pytest.mark.parametrize("one_job", [True, False])
def test_exact_ranks_on_difficult_groups(spark, one_job):
    """A hot value, a narrow cluster, negatives, extremes, a single row, and an undated group."""
    rnd = random.Random(7)
    groups = {"hot": [0.0] * 4000 + [rnd.random() for _ in range(999)], "narrow": [1 + rnd.random() * 1e-9 for _ in range(3000)],
              "negative": [-rnd.expovariate(0.01) for _ in range(2001)], "wide": [rnd.choice([-1, 1]) * 10 ** rnd.uniform(-300, 308) for _ in range(1500)],
              "single": [42.0], "two": [1.0, 2.0], None: [rnd.gauss(0, 1) for _ in range(1000)], "infinite": [float("inf")] * 3 + [1.0] * 2}
    df = spark.createDataFrame([(g, x) for g, xs in groups.items() for x in xs] + [("hot", None), ("all_null", None)], "g string, x double")
    long = order_stats.long_values(df, ["g"], {"x": F.col("x")})
    qs = [0.0, 0.25, 0.5, 0.75, 0.95, 0.99, 1.0]
    for definition in ("lower", "nearest"):
        got = {(r["g"], r["name"]): r["value"] for r in order_stats.quantiles(long, ["g"], qs, definition, one_job).collect()}
        assert len(got) == len(groups) * len(qs)
        for g, xs in groups.items():
            s = sorted(xs)
            for q in qs:
                k = int(q * (len(s) - 1)) if definition == "lower" else int(np.rint(q * (len(s) - 1)))
                assert got[g, str(q)] == s[k], (g, q, definition)
    med = {r["g"]: r["median"] for r in order_stats.median(long, ["g"]).collect()}
    assert all(med[g] == pytest.approx(float(np.median(xs)), nan_ok=True) for g, xs in groups.items())


def test_edges_and_bins(spark):
    assert distribution.edges(0, 1000) == [0.0, 0.1, 3.0, 13.0, 33.0, 66.0, 133.0, 333.0, 1000.0]
    assert distribution.edges(5, 5) == [5, 6.0]
    assert distribution.edges(0, 1e-7) == [0, 5e-8, 1e-7]
    df = spark.createDataFrame([(x,) for x in (-1.0, 0.0, 0.1, 2.9, 3.0, 1000.0, 1000.1, None)], "x double")
    row = df.agg(*[c.alias(k) for k, c in distribution.bin_counts(F.col("x"), [0, 0.1, 3, 1000]).items()]).first()
    assert tuple(row) == (1, 1, 2, 2, 1)


def test_divergence_by_hand(spark):
    """Weights .5 .5 0: inner .49 .49 .01, tails .005 each, already summing to one."""
    q = [0.005, 0.49, 0.49, 0.01, 0.005]
    p = [0.1, 0.2, 0.6, 0.1, 0.0]
    want = sum(a * math.log(a / b) for a, b in zip(p, q) if a)
    assert distribution.held_out_weights([0.5, 0.5, 0.0]) == pytest.approx(q)
    df = spark.createDataFrame([(1, 2, 6, 1, 0), (0, 0, 0, 0, 0)], "a int, b int, c int, d int, e int")
    got = [r[0] for r in df.select(distribution.divergence([F.col(c) for c in "abcde"], [0.5, 0.5, 0.0])).collect()]
    assert got == [pytest.approx(want), None]
    # no empty bin: the inner holdout is lost before renormalising
    assert sum(distribution.held_out_weights([0.25, 0.75])) == pytest.approx(1.0)
    assert distribution.held_out_weights([0.25, 0.75])[0] == pytest.approx(0.005 / 0.99)


def test_z_score_of_a_constant_column_is_zero(spark):
    df = spark.createDataFrame([("a", 5.0)] * 4 + [(None, 1.0), (None, 2.0), ("b", 1.0)], "g string, x double")
    stats = df.groupBy("g").agg(F.avg("x").alias("x__mean"), F.stddev_samp("x").alias("x__sd"))
    got = {r["g"]: (r["element_count"], r["unexpected_count"], r["success"]) for r in
           distribution.z_outliers(df, ["g"], {"x": F.col("x")}, stats, 0.5).collect()}
    assert got == {"a": (4, 0, True), None: (2, 2, False), "b": (1, 0, True)}


def test_uniqueness_counts_every_member(spark):
    df = spark.createDataFrame([(1, 1), (1, 1), (1, None), (1, None), (None, None), (None, None), (2, 1)], "a int, b int")
    r = keys.uniqueness(df.withColumn("g", F.lit(0)), ["g"], ["a", "b"], "k").first()
    assert (r["element_count"], r["missing_count"], r["unexpected_count"], r["success"]) == (7, 2, 4, False)
    one = keys.uniqueness(df.withColumn("g", F.lit(0)), ["g"], ["b"], "k").first()
    assert (one["missing_count"], one["unexpected_count"]) == (4, 3)


def test_key_stability(spark):
    df = spark.createDataFrame([("p1", 1), ("p1", 2), ("p2", 1), ("p2", 3)], "p string, k int")
    r = keys.key_stability(df, "p", ["k"]).first()
    assert tuple(r) == (4, 3, True, False)


def test_membership_of_whole_numbers_and_pairs(spark):
    df = spark.createDataFrame([(1, "x"), (2, "x"), (None, None), (None, "x"), (3, None)], "a int, b string")
    master = spark.createDataFrame([("a", "1"), ("a", "2"), ("a", "2")], "column string, code string")
    r = membership.against_master(membership.value_counts(df, [], ["a"]), [], master).first()
    assert (r["element_count"], r["missing_count"], r["unexpected_count"], r["success"]) == (5, 2, 1, False)
    pairs = spark.createDataFrame([("a->b", "1", "x")], "relation string, a string, b string")
    p = membership.pairs_against(membership.pair_counts(df, [], [("a", "b")]), [], pairs).first()
    assert (p["element_count"], p["missing_count"], p["unexpected_count"]) == (5, 1, 3)


def test_row_reconciliation_sees_copies(spark):
    a = spark.createDataFrame([(1, "x"), (1, "x"), (2, "y"), (3, "z"), (5, "p"), (5, "q")], "k int, v string")
    b = spark.createDataFrame([(1, "x"), (2, "y"), (4, "w"), (5, "q"), (5, "p")], "k int, v string")
    got = {r["k"]: r["status"] for r in reconcile.reconcile_rows(a, b, ["k"]).collect()}
    assert got == {1: "changed", 2: "match", 3: "missing", 4: "extra", 5: "match"}


def test_epoch_nanoseconds_keep_every_digit(spark):
    df = spark.createDataFrame([(1_704_067_200_123_456_789,), (-1,)], "n bigint")
    got = [str(r[0]) for r in df.select(times.from_epoch(F.col("n"), "nanodetik")).collect()]
    assert got == ["2024-01-01 00:00:00.123456", "1969-12-31 23:59:59.999999"]


@pytest.mark.parametrize("path,day", [
    ("b/recorded_year=2026/recorded_month=10/recorded_day=6/x.parquet", "2026-10-06"),
    ("recorded_year=2026/recorded_month=10/recorded_week=01/x", "2026-10-01"), ("recorded_year=2026/recorded_month=10/recorded_week=w5/x", "2026-10-29"),
    ("recorded_year=2026/recorded_month=02/recorded_week=05/x", None), ("recorded_year=2026/recorded_month=10/recorded_week=0/x_20260101.parquet", None),
    ("recorded_year=2026/recorded_month=10/recorded_week=6/x", None), ("snapshot_date=2026-10-06/f", "2026-10-06"),
    ("a/f_20260131.parquet", "2026-01-31"), ("a/f_20261331.parquet", None), ("20260131/f.parquet", None), ("a/f.parquet", None),
    ("a\\snapshot_date=2024-02-29\\f", "2024-02-29"), ("a/f_2024022912345.parquet", "2024-02-29")])
def test_date_from_path(spark, path, day):
    got = spark.createDataFrame([(path,)], "p string").select(times.date_from_path(F.col("p"))).first()[0]
    assert (got and str(got)) == day


def test_week_of_month(spark):
    df = spark.createDataFrame([("2024-02-29",), ("2024-01-07",), ("2024-01-08",), ("2024-01-31",)], "d string").select(F.col("d").cast("date").alias("d"))
    got = [(r[0], str(r[1])) for r in df.select(times.week_of_month(F.col("d")), times.week_start(F.col("d"))).collect()]
    assert got == [(5, "2024-02-29"), (1, "2024-01-01"), (2, "2024-01-08"), (5, "2024-01-29")]


def test_scratch_needs_a_shared_folder_off_local(spark):
    assert scratch_dir(spark)

    class Far:
        conf = type("C", (), {"get": staticmethod(lambda k, d=None: d)})
        sparkContext = type("S", (), {"master": "spark://far:7077", "applicationId": "x", "getConf": staticmethod(
            lambda: type("G", (), {"get": staticmethod(lambda k, d=None: d)}))})
    with pytest.raises(RuntimeError):
        scratch_dir(Far)


def test_zoned_times_are_utc_in_any_session_zone(spark):
    df = spark.createDataFrame([(1_710_054_000_123_456,)], "n bigint").select(F.timestamp_micros("n").alias("t"), "n")
    before = spark.conf.get("spark.sql.session.timeZone")
    try:
        spark.conf.set("spark.sql.session.timeZone", "America/New_York")
        row = df.select(times.as_time(F.col("t"), df.schema["t"].dataType).cast("string").alias("a"),
                        times.from_epoch(F.col("n"), "mikrodetik").cast("string").alias("b")).first()
    finally:
        spark.conf.set("spark.sql.session.timeZone", before)
    assert row["a"] == row["b"] == "2024-03-10 07:00:00.123456"


def test_keys_of_another_table_by_type(spark):
    """Whole numbers of any width and dates are compared as they are, other pairs as text; nulls are not tested."""
    df = spark.createDataFrame([("a", 1, "1", "2024-01-01"), ("a", 7, "01", "2024-01-02"), ("a", None, None, None), ("b", 7, "7", None),
                                (None, 2, "2", "2024-01-03")], "g string, i int, s string, d string").withColumn("d", F.to_date("d"))
    master = spark.createDataFrame([(1, "2024-01-01"), (1, "2024-01-01"), (2, "2024-01-03"), (None, None)], "k bigint, d string").withColumn(
        "d", F.to_date("d"))

    def bad(column, key):
        got = membership.referential(df, ["g"], column, master, key).collect()
        return {r["g"]: (r["element_count"], r["missing_count"], r["unexpected_count"]) for r in got}
    assert bad("i", "k") == {"a": (3, 1, 1), "b": (1, 0, 1), None: (1, 0, 0)}
    assert bad("s", "k") == {"a": (3, 1, 1), "b": (1, 0, 1), None: (1, 0, 0)}
    assert bad("d", "d") == {"a": (3, 1, 1), "b": (1, 1, 0), None: (1, 0, 0)}
    assert bad("d", "k") == {"a": (3, 1, 2), "b": (1, 1, 0), None: (1, 0, 1)}


def test_keys_missing_everywhere(spark):
    df = spark.createDataFrame([("a", 1), ("a", None)], "g string, i int")
    none = spark.createDataFrame([], "k bigint")
    assert membership.referential(df, ["g"], "i", none, "k").first()["unexpected_count"] == 1
    assert membership.referential(df.limit(0), ["g"], "i", none, "k").isEmpty()
