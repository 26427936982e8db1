"""Order statistics by brackets, commits, and baselines from remembered states."""

import datetime as dt
import random

import pyarrow as pa
import pyarrow.parquet as pq
from pyspark.sql import functions as F

from lakegauge.contract import parse_contract
from lakegauge.operators import order_stats
from lakegauge.operators.prepare import PART, PART_DATE
from lakegauge.plans import baseline as bl
from lakegauge.plans import evaluate as ev
from lakegauge.plans import validate
from lakegauge.sources import commits, reader


def test_brackets_are_exact_with_ties_infinities_and_a_hot_group(spark):
    r = random.Random(1)
    rows = [(g, "x", v) for g, n in (("hot", 6000), ("few", 7), (None, 900)) for v in (
        r.choice([3.25, float("inf"), -float("inf"), r.gauss(0, 1), r.gauss(0, 1) * 1e9]) for _ in range(n))]
    df = spark.createDataFrame(rows, "g string, column string, v double")
    qs = [0.0, 0.1, 0.5, 0.77, 0.99, 1.0]
    want = {(g, str(q)): sorted(v for k, _, v in rows if k == g)[int(q * (sum(k == g for k, *_ in rows) - 1))] for g in ("hot", "few", None) for q in qs}
    for bound in (50, 10 ** 6):
        assert {(x["g"], x["name"]): x["value"] for x in order_stats.quantiles(df, ["g"], qs, bound=bound).collect()} == want
    counted = df.groupBy("g", "column", "v").agg(F.count("*").alias("n"))
    sketches = df.groupBy("g", "column").agg(order_stats.sketch().alias("sketch"))
    got = order_stats.quantiles(counted, ["g"], qs, weight="n", sketches=sketches, bound=50)
    assert {(x["g"], x["name"]): x["value"] for x in got.collect()} == want


def test_commits_replace_and_hide(spark, tmp_path):
    root, table = str(tmp_path), lambda rows: spark.createDataFrame(rows, "k string, v long")
    assert not commits.any_commit(spark, root, "t")
    commits.commit(table([("a", 1), ("a", 2), (None, 3), ("b", 4)]), root, "t", ["k"])
    commits.commit(table([("a", 5)]), root, "t", ["k"], table([("a", 0), ("b", 0)]))
    table([("a", 9), ("z", 9)]).write.parquet(f"{root}/t/data/commit=stopped")
    got = commits.committed(spark, root, "t", ["k"])
    assert sorted(map(tuple, got.collect()), key=str) == [("a", 5), (None, 3)] and commits.any_commit(spark, root, "t")


def test_only_new_and_changed_partitions_are_read(spark, tmp_path, monkeypatch):
    root, store = f"{tmp_path}/lake", f"{tmp_path}/store"
    spec = {"sumber": {"lokal": f"{root}"}, "kolom": [{"nama": "v", "tipe": "float", "profil_distribusi": True}, {"nama": "s", "referensi": True}]}
    c = parse_contract("k", spec)

    def put(day, rows):
        p = tmp_path / "lake" / f"snapshot_date=2024-01-{day:02d}"
        p.mkdir(parents=True, exist_ok=True)
        pq.write_table(pa.table({"v": [float(v) for v, _ in rows], "s": [s for _, s in rows]}), p / "x.parquet")

    for d in range(1, 5):
        put(d, [(d * i, f"c{i % d}") for i in range(20)])
    seen, plain = [], reader.read_partitions

    def counting(spark, files, probed):
        seen.append(sorted(r["part"][-2:] for r in files.select("part").distinct().collect()))
        return plain(spark, files, probed)

    monkeypatch.setattr(reader, "read_partitions", counting)
    validate.build_baseline(spark, c, store)
    put(5, [(1000, "new")])
    put(6, [(0, "left out")])
    put(2, [(-7, "changed"), (7, None)])
    b = validate.build_baseline(spark, c, store)
    assert seen == [["01", "02", "03"], ["02", "04", "05"]]
    frame = plain(spark, *_opened(spark, root))
    full = bl.learn(frame, c)
    assert b.volume == full.volume and b.missing == full.missing and b.master_sizes == full.master_sizes == {"s": 6}
    assert b.distribution["v"]["quantiles"] == full.distribution["v"]["quantiles"] and b.distribution["v"]["weights"] == full.distribution["v"]["weights"]
    assert b.text["s"]["patterns"] == full.text["s"]["patterns"] and b.text["s"]["distinct_values"] == 6
    assert sorted(r["code"] for r in b.master.collect()) == ["c0", "c1", "c2", "c3", "changed", "new"]


def test_values_counted_for_many_rows_are_read_off_in_one_job(spark, monkeypatch):
    """Few different values on very many rows need no brackets: what one task sorts is the values, not the rows behind them."""
    written, plain = [], order_stats.materialise
    monkeypatch.setattr(order_stats, "materialise", lambda df, tag: written.append(tag) or plain(df, tag))
    rows = [(g, "x", float(v), 10 ** 9) for g in ("a", None) for v in range(-20, 20)]
    df = spark.createDataFrame(rows, "g string, column string, v double, n long")
    got = {(r["g"], r["name"]): r["value"] for r in order_stats.quantiles(df, ["g"], [0.0, 0.25, 0.5, 1.0], weight="n").collect()}
    assert got == {(g, q): v for g in ("a", None) for q, v in (("0.0", -20.0), ("0.25", -11.0), ("0.5", -1.0), ("1.0", 19.0))}
    assert written == ["zones"]


def test_a_sweep_counts_nothing_that_the_baseline_has_counted(spark, monkeypatch):
    """Values out of range and without partition date included, the results are those of an evaluation on its own."""
    spec = {"kunci": {"surrogate": "id", "bisnis": ["who", "ts"], "waktu": "ts", "granularitas": "jam"},
            "kolom": [{"nama": "id", "tipe": "integer"}, {"nama": "who", "tipe": "integer", "wajib": False}, {"nama": "ts", "tipe": "datetime"},
                      {"nama": "s", "tipe": "string", "referensi": True, "wajib": False},
                      {"nama": "v", "tipe": "float", "rentang": [0, 50], "profil_distribusi": True, "wajib": False},
                      {"nama": "z", "tipe": "integer", "profil_distribusi": True, "wajib": False}]}
    c = parse_contract("k", spec)
    df = spark.range(600).select(
        "id", F.when(F.col("id") % 9 > 0, F.col("id") % 7).alias("who"), F.expr("TIMESTAMP_NTZ '2024-01-01 00:00:00' + make_dt_interval(0, id)").alias("ts"),
        F.when(F.col("id") % 5 > 0, F.concat(F.lit("c"), (F.col("id") % 3).cast("string"))).alias("s"),
        F.expr("CASE WHEN id % 11 = 0 THEN double('NaN') WHEN id % 13 > 0 THEN id % 61 - 2.5D END").alias("v"),
        F.when(F.col("id") < 480, F.when(F.col("id") % 3 == 0, F.when(F.col("id") % 5 == 0, 4).otherwise(0))).alias("z"))
    day = F.to_date("ts")
    frame = df.withColumns({PART_DATE: F.when(F.col("id") >= 24, day), PART: day.cast("string")})
    now = dt.datetime(2024, 6, 1)
    alone = ev.evaluate(frame, c, bl.learn(frame, c, now=now), now=now, run_id="r").drop("sample").collect()
    states = bl.gather(frame, c)
    base = bl.learn_from(states, c, now=now)
    for module, name in ((ev.order_stats, "long_values"), (ev.onepass, "value_counts"), (ev.keys, "distinct_count")):
        monkeypatch.setattr(module, name, None)
    shared = ev.evaluate(frame, c, base, now=now, run_id="r", states=states).drop("sample").collect()
    assert sorted(map(str, shared)) == sorted(map(str, alone)) and len(alone) > 500
    assert {r["rule_kind"] for r in alone} >= {"quantile_shape", "median_zero", "in_master", "same_set", "entity_corridor", "z_score"}


def _opened(spark, root):
    from lakegauge.sources import inventory
    files = inventory.dated(inventory.list_files(spark, root))
    return files, reader.footers(files)
