import datetime as dt
import os
import random
import statistics
import tempfile

import pytest
from pyspark.sql import functions as F

from lakegauge.contract import load_contracts, parse_contract
from lakegauge.functions import text
from lakegauge.operators.prepare import PART, PART_DATE, with_partition
from lakegauge.plans import baseline as bl
from lakegauge.plans import history, infer, patterns, summary, validate
from lakegauge.plans.evaluate import evaluate
from lakegauge.sources import inventory

NOW = dt.datetime(2024, 6, 1)
SENSOR = {
    "sumber": {"partisi": "harian"}, "meta_audit": {"wajib": ["loaded_at", "batch_no"]},
    "kunci": {"surrogate": "id", "bisnis": ["unit", "at"], "waktu": "at", "waktu_muat": "loaded_at", "granularitas": "jam"},
    "kolom": [{"nama": "id", "tipe": "integer"}, {"nama": "unit", "referensi": True}, {"nama": "at", "tipe": "datetime"},
              {"nama": "loaded_at", "tipe": "datetime"}, {"nama": "area", "referensi": True},
              {"nama": "v", "tipe": "decimal", "wajib": False, "rentang": [0, 1005], "profil_distribusi": True},
              {"nama": "ok", "tipe": "boolean"}, {"nama": "plot", "wajib": False, "regex": r"^K\d\d-PLOT$"}],
    "relasi": [["unit", "area"]], "urutan_waktu": [["loaded_at", "at"]],
    "flag_dq": [{"flag": "ok", "kolom": "v", "aturan": "ada_dan_dalam_rentang"}]}
SCHEMA = ("id bigint, unit string, at timestamp_ntz, loaded_at timestamp_ntz, area string, v decimal(18,4), ok boolean, "
          "plot string")


def sensor_rows(days=5, units=4, seed=1):
    rnd, rows, n = random.Random(seed), [], 0
    for d in range(days):
        for u in range(units):
            for h in range(24):
                at = dt.datetime(2024, 1, 1 + d, h)
                v = None if (h + u) % 11 == 0 else round(rnd.expovariate(0.02) % 900, 2)
                rows.append((n, f"U-{u:02d}", at, at + dt.timedelta(hours=3), f"A{u % 2}", v, v is not None,
                             None if h % 5 else f"K{u}{h % 10}-PLOT"))
                n += 1
    return rows


def sensor(spark, rows=None):
    from decimal import Decimal
    rows = [(*r[:5], None if r[5] is None else Decimal(str(r[5])), *r[6:]) for r in (rows or sensor_rows())]
    return with_partition(spark.createDataFrame(rows, SCHEMA), F.to_date("at"))


@pytest.fixture(scope="module")
def contract():
    return parse_contract("sensor", SENSOR)


@pytest.fixture(scope="module")
def learned(spark, contract):
    return bl.learn(sensor(spark), contract, now=NOW)


def outcome(df):
    return {(str(r["partition"]), r["rule_id"]): r for r in df.collect()}


# --- patterns ---------------------------------------------------------------------------------

def derive(spark, values):
    return patterns.derive(spark.createDataFrame([(v,) for v in values], "s string"), ["s"])["s"]


def test_patterns_of_known_shapes(spark):
    assert derive(spark, ["KX-77Q2M9RB41", "PLM-5T0W8Y"]) == [r"^[A-Z]{2,3}\-[A-Z0-9]{6,10}$"]
    assert derive(spark, ["a", "b"]) == ["^[a-z]$"]
    assert derive(spark, ["A1", "B2", "x"]) == [r"^[A-Z]\d$", "^[a-z]$"]
    assert derive(spark, ["aB1c", "zZ9y"]) == ["^[A-Za-z0-9]{4}$"]
    assert derive(spark, [None, ""]) == ["^.*$"]


def test_many_shapes_become_one_general_pattern(spark):
    values = ["-" * i + "a1" for i in range(14)] + ["Z."]
    assert derive(spark, values) == [r"^[A-Za-z0-9\-\.]{2,15}$"]


def test_letters_beyond_ascii_still_match_their_own_pattern(spark):
    values = ["Éa", "ñB", "中文", "plain"]
    found = derive(spark, values)
    df = spark.createDataFrame([(v,) for v in values], "s string")
    assert df.filter(~text.finds_any(F.col("s"), found)).count() == 0


def test_patterns_row_by_row_equal_folded(spark, monkeypatch):
    values = [f"X{i}-{i * i}" for i in range(50)] + ["a b", "c\nd"]
    folded = derive(spark, values)
    monkeypatch.setattr(patterns, "_VALUES_WORTH_FOLDING", -1)
    assert derive(spark, values) == folded


# --- baseline ---------------------------------------------------------------------------------

def test_baseline_by_brute_force(spark, contract, learned):
    rows = [r for r in sensor_rows() if r[2].day < 5]
    by_day = {}
    for r in rows:
        by_day.setdefault(r[2].day, []).append(r)
    assert learned.meta["partitions_excluded"] == ["2024-01-05"] and learned.meta["partitions_used"] == 4
    v = learned.volume
    assert (v["rows_min"], v["rows_median"], v["rows_low"], v["rows_high"]) == (96, 96, int(96 * .85), int(96 * 1.15))
    assert (v["entities_min"], v["entities_max"], v["periods"]) == (4, 4, 24)
    d = learned.distribution["v"]
    vals = [[r[5] for r in day if r[5] is not None] for day in by_day.values()]
    flat = [x for day in vals for x in day]
    assert d["n"] == len(flat)
    assert d["mean_global"] == pytest.approx(statistics.mean(flat)) and d["sd_global"] == pytest.approx(statistics.pstdev(flat))
    assert d["mean_max"] == pytest.approx(max(map(statistics.mean, vals)))
    assert d["sd_max"] == pytest.approx(max(map(statistics.pstdev, vals)))
    for q in (0.5, 0.75, 0.95, 0.99):
        per = [sorted(x)[int(q * (len(x) - 1))] for x in vals]
        assert d["quantile_range"][str(q)] == (min(per), max(per))
    for q in (0.5, 0.75, 0.9, 0.95, 0.99):
        assert d["quantiles"][str(q)] == sorted(flat)[int(q * (len(flat) - 1))]
    counts = [sum(1 for x in flat if (a <= x <= b if i == 7 else a <= x < b)) for i, (a, b) in enumerate(zip(d["bins"], d["bins"][1:]))]
    assert d["weights"] == pytest.approx([c / len(flat) for c in counts])
    rates = [sum(r[5] is None for r in day) / len(day) for day in by_day.values()]
    assert learned.missing["v"]["null_max"] == pytest.approx(max(rates))
    assert learned.missing["v"]["min_present"] == round(max(0, 1 - (max(rates) + 0.05)), 4)
    assert learned.missing["id"]["min_present"] == 1.0
    assert learned.master_sizes == {"unit": 4, "area": 2} and learned.relation_sizes == {"unit->area": 4}
    assert learned.violations.count() == 0 and learned.text["unit"]["patterns"] == [r"^[A-Z]\-\d{2}$"]


def test_baseline_survives_storage(spark, learned):
    root = tempfile.mkdtemp(prefix="lakegauge-test-")
    assert bl.to_build(spark, root, ["sensor"], rebuild=False) == ["sensor"]
    bl.save(learned, root, spark)
    again = bl.load(spark, root, "sensor")
    assert again.volume == learned.volume and again.text == learned.text
    assert again.distribution["v"]["weights"] == learned.distribution["v"]["weights"]
    assert again.master.count() == learned.master.count()
    assert bl.to_build(spark, root, ["sensor"], rebuild=False) == []


def test_one_partition_is_circular(spark, contract):
    rows = [r for r in sensor_rows() if r[2].day == 1]
    b = bl.learn(sensor(spark, rows), contract, now=NOW)
    assert b.meta["circular"] and b.meta["partitions_excluded"] == []
    with pytest.raises(ValueError):
        bl.learn(sensor(spark, rows), contract, ["2024-01-01"])


def test_rejected_values_stay_out(spark, contract):
    rows = [(*r[:5], 5000.0 if r[0] in (3, 7) else r[5], *r[6:]) for r in sensor_rows()]
    b = bl.learn(sensor(spark, rows), contract, now=NOW)
    assert b.meta["rejected_values"] == 2 and b.distribution["v"]["max"] <= 1000
    assert sorted(r["value"] for r in b.rejects.collect()) == [5000.0, 5000.0]


def test_corridors_of_negative_measures():
    d = {"mean_min": -80.0, "mean_max": -60.0, "max": -50.0}
    assert bl.mean_bounds(d, None, 2.0, reference=False) == (-80.0, 0.0)
    assert bl.mean_bounds(d, None, 2.0, reference=True) == (-80.0, -50.0)
    assert bl.quantile_bounds(-90.0, -60.0, None, 0.5, 1.5, reference=False) == (-135.0, -30.0)
    assert bl.quantile_bounds(-90.0, -60.0, None, 0.5, 1.5, reference=True) == (0.0, 1.0)
    assert bl.quantile_bounds(10.0, 20.0, (0, 25), 0.5, 1.5, False) == bl.quantile_bounds(10.0, 20.0, (0, 25), 0.5, 1.5, True) == (5.0, 25.0)


# --- evaluation -------------------------------------------------------------------------------

def test_clean_history_passes(spark, contract, learned):
    r = outcome(evaluate(sensor(spark), contract, learned, now=NOW))
    failed = {k[1] for k, x in r.items() if x["success"] is False}
    # the contract demands an audit column no file has
    assert failed == {"12.audit_columns"}
    assert r["2024-01-03", "9.reconcile"]["severity"] == "skipped" and r["2024-01-03", "9.reconcile"]["note"]
    assert len({k[0] for k in r}) == 5


def fault(rows, change, pick=lambda r: r[2].day == 2):
    return [change(r) if pick(r) else r for r in rows]


@pytest.mark.parametrize("name,change,flips", [
    ("half the day", lambda rows: [r for r in rows if r[2].day != 2 or (r[0] + r[0] // 24) % 2], {"2.row_corridor"}),
    ("every row twice", lambda rows: rows + [r for r in rows if r[2].day == 2],
     {"2.row_corridor", "2.capacity.unit", "5.surrogate_unique.id", "5.business_unique.unit+at", "5.one_per_period.unit+_period_floor"}),
    ("padded code", lambda rows: fault(rows, lambda r: (r[0], " " + r[1], *r[2:]), lambda r: r[0] == 100),
     {"2.entity_corridor.unit", "6.in_master.unit", "6.relation.unit->area", "7.same_set.unit", "8.pattern.unit", "8.length.unit", "8.no_padding.unit"}),
    ("mapping moved", lambda rows: fault(rows, lambda r: (*r[:4], "A1" if r[4] == "A0" else "A0", *r[5:])), {"6.relation.unit->area"}),
    ("value out of range", lambda rows: fault(rows, lambda r: (*r[:5], 5000.0, *r[6:]), lambda r: r[0] == 100),
     {"7.physical_range.v", "6.flag_agrees.ok", "7.stdev_corridor.v"}),
    ("flag lies", lambda rows: fault(rows, lambda r: (*r[:6], not r[6], r[7]), lambda r: r[0] == 100), {"6.flag_agrees.ok"}),
    ("loaded before it happened", lambda rows: fault(rows, lambda r: (*r[:3], r[2] - dt.timedelta(hours=1), *r[4:]), lambda r: r[0] == 100),
     {"3.lag.loaded_at", "6.ordered.loaded_at,at"}),
    ("plot", lambda rows: fault(rows, lambda r: (*r[:7], "12345"), lambda r: r[0] == 100),
     {"8.pattern.plot", "8.length.plot", "10.format.plot"}),
    ("stuck sensor", lambda rows: fault(rows, lambda r: (*r[:5], 999.0, True, r[7])), {"7.mean_corridor.v", "7.quantile_shape.v", "7.kl_divergence.v"}),
    ("off the grid", lambda rows: fault(rows, lambda r: (*r[:2], r[2] + dt.timedelta(seconds=1), *r[3:]), lambda r: r[0] == 100),
     {"3.on_grid.at"}),
])
def test_planted_fault_flips_exactly_its_rules(spark, contract, learned, name, change, flips):
    r = outcome(evaluate(sensor(spark, change(sensor_rows())), contract, learned, now=NOW))
    failed = {k for k, x in r.items() if x["success"] is False and k[1] != "12.audit_columns"}
    assert failed == {("2024-01-02", f) for f in flips}, name


def test_sweep_equals_single_partition(spark, contract, learned):
    rows = fault(sensor_rows(), lambda r: (*r[:5], 5000.0, *r[6:]), lambda r: r[0] in (100, 101))
    df = sensor(spark, rows)
    drop = ("run_id",)
    sweep = {k: x for k, x in outcome(evaluate(df, contract, learned, now=NOW, samples=3).drop(*drop)).items() if k[0] == "2024-01-02"}
    single = outcome(evaluate(df.filter(F.col(PART) == "2024-01-02"), contract, learned, now=NOW, samples=3).drop(*drop))
    assert sweep == single
    hit = single["2024-01-02", "7.physical_range.v"]
    assert hit["unexpected_count"] == 2 and hit["sample"] == ["5000.0", "5000.0"]


def test_missing_column_and_type_drift_fail_without_stopping(spark, contract, learned):
    df = sensor(spark).drop("area").withColumn("plot", F.lit(5)).withColumn("extra", F.lit(1)).withColumn("ok", F.lit("yes"))
    r = outcome(evaluate(df, contract, learned, now=NOW))
    day = {k[1]: x for k, x in r.items() if k[0] == "2024-01-01"}
    assert day["1.column_set"]["success"] is False and "area" in day["1.column_set"]["observed_text"]
    assert day["1.type.plot"]["success"] is False and day["1.type.area"]["error"]
    for rule in ("4.not_null.area", "8.no_blank.area", "6.in_master.area", "10.format.plot", "6.flag_agrees.ok"):
        assert day[rule]["success"] is False and day[rule]["error"], rule
    assert day["6.relation.unit->area"]["success"] is False
    assert day["4.not_null.id"]["success"] is True


def test_undated_partition_skips_its_window(spark, contract, learned):
    df = sensor(spark).withColumn(PART_DATE, F.lit(None).cast("date")).withColumn(PART, F.lit("loose.parquet"))
    r = {x["rule_id"]: x for x in evaluate(df, contract, learned, now=NOW).collect()}
    assert r["3.in_window.at"]["success"] is None and r["3.in_window.at"]["severity"] == "skipped"
    assert r["3.reaches_end.at"]["success"] is None
    assert r["7.quantile_shape.v"]["success"] is not None and r["7.z_score.v"]["element_count"] == 480


def test_reconciliation_against_a_source(spark, learned):
    c = parse_contract("sensor", {**SENSOR, "sumber": {"sql_server": {"tabel": "dbo.t", "kolom_waktu": "at"}}})
    src = sensor(spark).drop(PART, PART_DATE).withColumnRenamed("plot", "plot_code")
    landed = sensor(spark, [r for r in sensor_rows() if r[0] != 100])
    r = outcome(evaluate(landed, c, learned, now=NOW, source=src))
    assert r["2024-01-02", "9.row_count.dbo.t"]["success"] is False and r["2024-01-03", "9.row_count.dbo.t"]["success"] is True
    assert r["2024-01-03", "9.source_columns"]["success"] is False
    undated = landed.withColumn(PART_DATE, F.lit(None).cast("date")).withColumn(PART, F.lit("all.parquet"))
    whole = {x["rule_id"]: x for x in evaluate(undated, c, learned, now=NOW, source=src).collect()}
    assert whole["9.row_count.dbo.t"]["observed_text"] == "source 480" and whole["9.row_count.dbo.t"]["success"] is False


def test_declared_extra_rules(spark, learned):
    c = parse_contract("sensor", {**SENSOR, "validasi": {"data_quality": [
        {"check": "null_percentage", "threshold": 0.05, "columns": ["v"]}, {"check": "duplicate_check", "threshold": 5, "columns": ["unit"]},
        {"check": "bounds", "validation": "v < 900 AND id >= 0", "columns": []}]},
        "distribusi": [{"kolom": "ok", "expected_ratio": 0.9}, {"kolom": "area", "expected_values": ["A0"]}]})
    day = {k[1]: x for k, x in outcome(evaluate(sensor(spark), c, learned, now=NOW)).items() if k[0] == "2024-01-01"}
    assert day["4.null_limit.v"]["success"] is False and day["5.duplicate_limit.unit"]["unexpected_count"] == 92
    nulls = sum(r[5] is None for r in sensor_rows() if r[2].day == 1)
    assert day["6.predicate.bounds"]["unexpected_count"] == nulls
    assert day["7.expected_ratio.ok"]["success"] is True and day["6.allowed_values.area"]["unexpected_count"] == 48


# --- files ------------------------------------------------------------------------------------

@pytest.fixture(scope="module")
def lake(spark):
    """Six days: two files on day 1, an empty file on day 3, garbage on day 4, a drifted file on day 5, no rows on day 6, one undated."""
    root = tempfile.mkdtemp(prefix="lakegauge-test-")
    df = sensor(spark, sensor_rows(6)).drop(PART, PART_DATE)

    def write(part, day, name):
        folder = f"{root}/recorded_year=2024/recorded_month=01/recorded_day={day:02d}"
        os.makedirs(folder, exist_ok=True)
        part.toPandas().to_parquet(f"{folder}/{name}.parquet")
    for d in range(1, 6):
        day = df.filter(F.dayofmonth("at") == d)
        if d == 1:
            write(day.filter("id % 2 = 0"), d, "a")
            write(day.filter("id % 2 = 1"), d, "b")
        elif d == 5:
            write(day.drop("plot").withColumn("id", F.col("id").cast("string")), d, "a")
        else:
            write(day, d, "a")
    for d, data in ((3, b""), (4, b"garbage")):
        with open(f"{root}/recorded_year=2024/recorded_month=01/recorded_day={d:02d}/x.parquet", "wb") as fh:
            fh.write(data)
    write(df.filter("id < 0"), 6, "a")
    df.filter("id < 5").toPandas().to_parquet(f"{root}/loose.parquet")
    return root


def test_lake_to_findings(spark, lake, learned):
    c = parse_contract("sensor", {**SENSOR, "sumber": {"s3": lake}, "ukuran_berkas": {"rentang": [1, 9000]}})
    r = outcome(validate.validate(spark, c, learned, where="s3", sweep=True, now=NOW))
    prefix = "recorded_year=2024/recorded_month=01/recorded_day="
    labels = {k[0] for k in r}
    assert labels == {f"{prefix}01 (2 file)", f"{prefix}02/a.parquet", f"{prefix}03 (2 file)", f"{prefix}04 (2 file)",
                      f"{prefix}05/a.parquet", f"{prefix}06/a.parquet", "loose.parquet"}
    for d in ("03", "04"):
        mine = [k[1] for k in r if k[0] == f"{prefix}{d} (2 file)"]
        assert mine == ["11.readable"] and r[f"{prefix}{d} (2 file)", "11.readable"]["error"]
    assert r[f"{prefix}01 (2 file)", "2.row_corridor"]["success"] is True
    empty = {k[1]: x for k, x in r.items() if k[0] == f"{prefix}06/a.parquet"}
    assert empty["2.not_empty"]["success"] is False and empty["4.not_null.id"]["success"] is True
    assert empty["5.surrogate_unique.id"]["success"] is True and empty["11.size"]["observed_num"] > 0
    assert {x["success"] for k, x in r.items() if k[1] == "11.size"} == {True, False}
    assert r["loose.parquet", "3.in_window.at"]["success"] is None


def test_select_one_partition(spark, lake, learned):
    c = parse_contract("sensor", {**SENSOR, "sumber": {"s3": lake}})
    files, parts, probed, broken = validate.open_dataset(spark, c, "s3")
    pick = lambda **kw: str(inventory.select(parts, "harian", **kw).first()["part_date"])
    assert pick() == "2024-01-06" and pick(day="2024-01-02") == "2024-01-02"
    assert pick(day="2030-01-01", fallback_latest=True) == "2024-01-06"
    with pytest.raises(inventory.SourceError):
        inventory.select(parts, "harian", day="2030-01-01")
    with pytest.raises(inventory.SourceError):
        inventory.select(parts, "mingguan", day="2024-01-09", fallback_latest=True)
    assert str(inventory.select(parts, "mingguan", day="2024-01-07").first()["part_date"]) == "2024-01-01"
    r = validate.validate(spark, c, learned, where="s3", day="2024-01-02", now=NOW)
    assert {x["partition"] for x in r.collect()} == {"recorded_year=2024/recorded_month=01/recorded_day=02/a.parquet"}
    only_bad = validate.validate(spark, c, learned, where="s3", day="2024-01-04", now=NOW).collect()
    assert [x["rule_id"] for x in only_bad] == ["11.readable"]


def test_lake_sweep_equals_each_day(spark, lake, learned):
    """Every day alone and in the sweep gives the same rows, whatever the other days' files look like."""
    c = parse_contract("sensor", {**SENSOR, "sumber": {"s3": lake}})
    show = lambda df: {k: (x["success"], x["severity"], x["unexpected_count"], x["observed_text"], x["error"]) for k, x in outcome(df).items()}
    sweep = show(validate.validate(spark, c, learned, where="s3", sweep=True, now=NOW))
    drifted = {k[1] for k, x in sweep.items() if "day=05" in k[0] and x[0] is False}
    assert {"1.column_count", "1.column_set", "1.type.id", "1.type.plot"} <= drifted
    assert all(x[0] for k, x in sweep.items() if "day=02" in k[0] and k[1].startswith("1."))
    for d in (1, 2, 4, 5, 6):
        one = show(validate.validate(spark, c, learned, where="s3", day=f"2024-01-0{d}", now=NOW))
        assert one == {k: x for k, x in sweep.items() if f"day=0{d}" in k[0]}, d


def test_source_of_a_lake(spark, lake, learned):
    c = parse_contract("sensor", {**SENSOR, "sumber": {"s3": lake, "sql_server": {"tabel": "t", "kolom_waktu": "at"}}})
    src = sensor(spark, sensor_rows(8)).drop(PART, PART_DATE)
    rows = [r for r in validate.validate(spark, c, learned, where="s3", sweep=True, now=NOW, source_table=lambda: src).collect()
            if r["rule_id"] == "9.row_count.t"]
    assert {str(r["part_date"]): r["success"] for r in rows if r["part_date"]} == {
        "2024-01-01": True, "2024-01-02": True, "2024-01-05": True, "2024-01-06": False, "2024-01-07": False, "2024-01-08": False}
    one = {r["rule_id"]: r for r in validate.validate(spark, c, learned, where="s3", day="2024-01-02", now=NOW, source_table=src).collect()}
    assert one["9.row_count.t"]["observed_text"] == "source 96"

    def fails():
        return spark.read.parquet(f"{lake}/nowhere")
    lost = {r["rule_id"]: r for r in validate.validate(spark, c, learned, where="s3", day="2024-01-02", now=NOW, source_table=fails).collect()}
    assert lost["9.reconcile"]["success"] is None and "PATH_NOT_FOUND" in lost["9.reconcile"]["note"]


def test_locations(monkeypatch):
    c = parse_contract("d", {"sumber": {"s3": "s3://${NOT_SET_HERE}/x"}, "kolom": ["a"]})
    for source in ("s3", "lokal"):
        with pytest.raises(inventory.SourceError):
            inventory.location(c, source)


def test_build_and_validate_local_glob(spark):
    root = tempfile.mkdtemp(prefix="lakegauge-test-")
    for d in range(1, 5):
        sensor(spark).filter(F.dayofmonth("at") == d).drop(PART, PART_DATE).toPandas().to_parquet(f"{root}/t_2024010{d}.parquet")
    c = parse_contract("sensor", {**SENSOR, "sumber": {"lokal": f"{root}/t_*.parquet"}})
    b = validate.build_baseline(spark, c, f"{root}/baselines", exclude=["t_20240101.parquet"])
    assert b.meta["partitions_excluded"] == ["2024-01-01"]
    r = validate.validate(spark, c, b, day="2024-01-01", now=NOW)
    assert {x["rule_id"] for x in r.filter("success = false").collect()} == {"12.audit_columns"}


# --- summaries and reports --------------------------------------------------------------------

def test_summary_gate_and_report(spark, contract, learned):
    r = evaluate(sensor(spark), contract, learned, now=NOW).cache()
    s = {(x["partition"], x["category"]): x for x in summary.summarise(r).collect()}
    total = s["2024-01-01", None]
    assert total["checks"] == total["pass"] + total["fail"] + total["skip"] and total["fail_blocking"] == 1
    assert summary.gate(r).first()[0] == 1
    assert summary.gate(summary.for_layer(r, "gold")).first()[0] == 0
    assert {x["verdict"] for x in summary.sweep(r).collect()} == {"TIDAK LAYAK"}
    doc = history.markdown(r.filter("partition = '2024-01-01'"), "sensor")
    assert "TIDAK LAYAK" in doc and "12.audit_columns" in doc and "| 7. DISTRIBUTION |" in doc


# --- inference --------------------------------------------------------------------------------

def test_inferred_contract_loads_and_holds(spark, tmp_path):
    df = sensor(spark).withColumn("area_copy", F.col("area")).withColumn("manual", F.lit(False))
    d = infer.infer(df)
    assert d.surrogate == "id" and (d.event_time, d.load_time) == ("at", "loaded_at") and d.grain == "jam"
    assert d.business_key == ["unit", "at"] and ("loaded_at", "at") in d.ordered_pairs
    assert d.equal_pairs == [("area", "area_copy")] and ("area", "area_copy") in d.relations
    assert ("area", "unit") not in d.relations and "v" in d.profiled
    assert {"flag": "manual", "harus": False, "severity": "warning"} in d.flags
    p = tmp_path / "draft.yml"
    p.write_text("datasets:\n" + infer.to_yaml(d, "sensor", local="x/*.parquet"))
    c = load_contracts(str(p))["sensor"]
    assert c.business_key == ["unit", "at"] and c.column("v").kind == "decimal" and not c.column("v").required
    b = bl.learn(df, c, now=NOW)
    bad = {x["rule_id"] for x in evaluate(df, c, b, now=NOW).filter("success = false AND severity = 'blocking'").collect()}
    assert bad == set()


def test_a_draft_with_odd_names_loads_again(tmp_path):
    names = ["a: b, c", "no", "x#y", "[z]", "ü 'q' \"r\"", "plain"]
    columns = [{"column": n, "kind": "integer", "required": True, "nulls": 0, "rows": 3, "min": 1.0, "max": 2.0} for n in names]
    d = infer.Draft(columns=columns)
    d.business_key, d.relations = ["no", "x#y"], [("[z]", "a: b, c")]
    p = tmp_path / "odd.yml"
    p.write_text("datasets:\n" + infer.to_yaml(d, "data: set", local='C:\\"x"/*.parquet'))
    c = load_contracts(str(p))["data: set"]
    assert c.column_names == names and c.local == 'C:\\"x"/*.parquet'
    assert c.business_key == ["no", "x#y"] and c.relations == [("[z]", "a: b, c")]


def test_dependency_ignores_rows_with_a_null(spark):
    df = spark.createDataFrame([("a", None), (None, "x"), ("a", "x"), ("b", "y"), ("b", "y")], "l string, r string")
    got = {(r["left_column"], r["right_column"]): r["determines"] for r in infer.dependencies(df, ["l", "r"]).collect()}
    assert got == {("l", "r"): True, ("r", "l"): True}


# --- batch ------------------------------------------------------------------------------------

def test_batch_over_layers(spark):
    from lakegauge.plans import batch
    root = tempfile.mkdtemp(prefix="lakegauge-test-")
    for d in range(1, 5):
        sensor(spark).filter(F.dayofmonth("at") == d).drop(PART, PART_DATE).toPandas().to_parquet(f"{root}/t_2024010{d}.parquet")
    own = {**SENSOR, "sumber": {"lokal": f"{root}/t_*.parquet"}}
    good = parse_contract("good", {**own, "meta_audit": {"wajib": []}})
    lost = parse_contract("lost", {**own, "sumber": {"lokal": f"{root}/none_*.parquet"}})
    strict = parse_contract("strict", own)
    run = batch.run_layers(spark, {"gold": {"good": good}, "bronze": {"strict": strict, "lost": lost}}, root, where="lokal",
                           day="2024-01-03", now=NOW)
    got = {(r["layer"], r["dataset"]): r["status"] for r in run.statuses.collect()}
    # the missing audit column counts in bronze; a dataset without files is broken and stops nobody
    assert got == {("gold", "good"): "LOLOS", ("bronze", "strict"): "GAGAL", ("bronze", "lost"): "ERROR"} and run.exit_code == 1
    assert [r["dataset"] for r in run.errors.collect()] == ["lost"]
    again = batch.run_layers(spark, {"gold": {"good": good}}, root, where="lokal", rebuild=False, day="auto", now=NOW)
    assert again.exit_code == 0 and {str(r["part_date"]) for r in again.results.select("part_date").distinct().collect()} == {"2024-01-04"}
    assert history.read_layer_summary(spark, root).filter("layer = 'gold' AND dataset IS NULL").first()["checks"] > 0
    history.append_sweep(again.results, root)
    assert history.read_sweep(spark, root)[0].first()["verdict"] == "LAYAK"
    rows = history.read(spark, root).count()
    history.append(again.results, root)                 # the same run once more replaces itself
    assert history.read(spark, root).count() == rows


def test_master_tables(spark, learned):
    c = parse_contract("sensor", {**SENSOR, "validasi": {"referential_integrity": [
        {"kolom": "unit", "source_table": "units", "source_column": "code"}, {"kolom": "area", "source_table": "areas", "source_column": "code"}]}})
    units = spark.createDataFrame([("U-00",), ("U-01",), ("U-02",)], "code string")
    day = {k[1]: x for k, x in outcome(evaluate(sensor(spark), c, learned, now=NOW, masters={"units": units})).items() if k[0] == "2024-01-01"}
    assert day["6.master_table.unit"]["unexpected_count"] == 24 and day["6.master_table.area"]["severity"] == "skipped"


def test_text_beyond_the_basic_plane(spark):
    assert derive(spark, ["a\U0001F600", "b\U0001F600"]) == ["^[a-z]\U0001F600$"]
    many = ["a\U0001F600" + "-" * i for i in range(1, 15)]
    found = derive(spark, many)
    df = spark.createDataFrame([(v,) for v in many], "s string")
    assert len(found) == 1 and df.filter(~text.finds_any(F.col("s"), found)).count() == 0


def test_outliers_are_counted_where_extremes_reach(spark, contract, learned):
    rows = sensor_rows(5, units=40)
    rows = fault(rows, lambda r: (*r[:5], 90000.0, *r[6:]), lambda r: r[0] in (970, 971))
    c = parse_contract("sensor", {**SENSOR, "ambang": {"batas_zscore": 15.0}})
    r = outcome(evaluate(sensor(spark, rows), c, learned, now=NOW))
    got = {k[0]: (x["unexpected_count"], x["success"]) for k, x in r.items() if k[1] == "7.z_score.v"}
    assert got == {"2024-01-01": (0, True), "2024-01-02": (2, True), "2024-01-03": (0, True), "2024-01-04": (0, True), "2024-01-05": (0, True)}
