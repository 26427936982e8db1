"""Listing, footers, and reading files whose columns differ."""

import datetime as dt
import os

import pyarrow as pa
import pyarrow.parquet as pq
import pytest
from pyspark.sql import functions as F
from pyspark.sql import types as T

from lakegauge.contract import parse_contract
from lakegauge.operators.prepare import PART
from lakegauge.operators.schema import schema_diff_by_file
from lakegauge.sources import inventory, lattice, reader


def put(path, **columns):
    os.makedirs(os.path.dirname(path), exist_ok=True)
    pq.write_table(pa.table(columns), path)


def opened(spark, root):
    files = inventory.dated(inventory.list_files(spark, root), root)
    return files, reader.footers(files)


def names(spark, path, root):
    return sorted((r["path"].removeprefix(f"{root}/"), r["siblings"]) for r in inventory.list_files(spark, path).collect())


@pytest.mark.parametrize("one,two,both", [
    ("int", "bigint", "bigint"), ("tinyint", "smallint", "smallint"), ("float", "double", "double"), ("bigint", "double", "double"),
    ("decimal(10,2)", "decimal(18,4)", "decimal(18,4)"), ("decimal(10,2)", "decimal(6,4)", "decimal(12,4)"), ("int", "decimal(6,2)", "decimal(12,2)"),
    ("decimal(38,0)", "decimal(38,10)", "double"), ("decimal(5,1)", "float", "double"), ("date", "timestamp_ntz", "timestamp_ntz"),
    ("date", "timestamp", "timestamp"), ("timestamp", "timestamp_ntz", "timestamp_ntz"), ("string", "int", "string"), ("void", "date", "date"),
    ("boolean", "int", "string"), ("array<int>", "array<int>", "array<int>"), ("array<int>", "string", "string")])
def test_join_of_types(spark, one, two, both):
    a, b, c = (T._parse_datatype_string(x) for x in (one, two, both))
    assert lattice.join(a, b) == c == lattice.join(b, a)


def test_every_widening_a_scan_promises(spark, tmp_path):
    kinds = [T._parse_datatype_string(k) for k in (
        "tinyint", "smallint", "int", "bigint", "float", "double", "decimal(6,2)", "decimal(12,4)", "decimal(22,2)", "date", "timestamp_ntz")]
    row = spark.range(1).select(*[(F.lit(dt.date(2024, 1, 2)) if "dat" in k.simpleString() or "time" in k.simpleString() else F.lit(7)).cast(k).alias(
        f"c{i}") for i, k in enumerate(kinds)])
    row.write.parquet(f"{tmp_path}/t")
    for i, have in enumerate(kinds):
        for want in kinds:
            if lattice.scan_widens(have, want):
                got = spark.read.schema(T.StructType([T.StructField(f"c{i}", want)])).parquet(f"{tmp_path}/t").first()[0]
                assert got == row.select(F.col(f"c{i}").cast(want)).first()[0], (have, want)


def test_listing(spark, tmp_path):
    root = str(tmp_path)
    for p in ("a/x.parquet", "a/y z+%.parquet", "a/deep/er/z.parquet", "b/x.parquet", "loose.parquet", "a/_temporary/q.parquet", ".hidden/h.parquet",
              "c=1/_d=2/k.parquet"):
        put(f"{root}/{p}", v=[1])
    open(f"{root}/a/empty.parquet", "w").close()
    open(f"{root}/a/readme.txt", "w").close()
    every = [("a/deep/er/z.parquet", 1), ("a/empty.parquet", 3), ("a/x.parquet", 3), ("a/y z+%.parquet", 3), ("b/x.parquet", 1),
             ("c=1/_d=2/k.parquet", 1), ("loose.parquet", 1)]
    assert names(spark, root, root) == names(spark, f"file://{root}/", root) == every
    assert names(spark, f"{root}/*/x.parquet", root) == [("a/x.parquet", 1), ("b/x.parquet", 1)]
    assert [n for n, _ in names(spark, f"{root}/{{a,loose*}}", root)] == [n for n, _ in every if n.startswith(("a", "loose"))]
    assert [n for n, _ in names(spark, f"{root}/b/x.parquet", root)] == ["b/x.parquet"]
    assert names(spark, f"{root}/nowhere", root) == []


def test_widths_differ(spark, tmp_path):
    root, day = str(tmp_path), "recorded_year=2024/recorded_month=01/recorded_day=1"
    put(f"{root}/{day}/a.parquet", id=pa.array([1], pa.int32()), v=pa.array([0.5], pa.float32()), d=pa.array([dt.date(2024, 1, 1)]), t=["x"])
    put(f"{root}/{day}/b.parquet", id=pa.array([2], pa.int64()), v=pa.array([0.1], pa.float64()), more=[True],
        d=pa.array([dt.datetime(2024, 1, 1, 5)], pa.timestamp("us")), t=pa.array(["y"]).dictionary_encode())
    put(f"{root}/{day}/c.parquet", id=pa.array([3], pa.int16()), d=pa.array([dt.datetime(2024, 1, 1, 6)], pa.timestamp("ns")), t=["z"])
    files, probed = opened(spark, root)
    df = reader.read_partitions(spark, files, probed)
    types = dict(df.drop("_part", "_part_date").dtypes)
    assert types == {"id": "bigint", "v": "double", "d": "timestamp_ntz", "t": "string", "more": "boolean"}
    assert sorted((r["id"], r["v"], r["t"], r["d"].hour, r[PART]) for r in df.collect()) == [
        (1, 0.5, "x", 0, "2024-01-01"), (2, 0.1, "y", 5, "2024-01-01"), (3, None, "z", 6, "2024-01-01")]
    c = parse_contract("k", {"kolom": [{"nama": "t"}, {"nama": "id", "tipe": "integer"}]})
    assert {r["status"] for r in schema_diff_by_file(probed, c).where("column IN ('t', 'id')").collect()} == {"ok"}
    assert reader.shapes(files, probed).select("shape").distinct().count() == 1


def test_every_layout_is_read_with_its_partition(spark, tmp_path):
    root = str(tmp_path)
    where = {"recorded_year=2024/recorded_month=02/recorded_day=03/x.parquet": "2024-02-03", "y_20240105.parquet": "2024-01-05",
             "recorded_year=2024/recorded_month=02/recorded_week=W2/x.parquet": "2024-02-08", "snapshot_date=2024-03-01/x.parquet": "2024-03-01",
             "recorded_year=2024/recorded_month=13/recorded_day=03/x.parquet": None, "k=v/odd [1] {a}*+%.parquet": None,
             "recorded_year=2024/recorded_month=02/recorded_day=04/hour=3/x.parquet": "2024-02-04",
             "recorded_year=2024/recorded_month=02/recorded_day=04/sub/y.parquet": "2024-02-04", "snapshot_date=2024-03-02/text.parquet": "2024-03-02"}
    for i, p in enumerate(where):
        put(f"{root}/{p}", n=pa.array([i], pa.int32() if i % 2 else pa.int64()) if "text" not in p else ["8"], k=["inside"])
    files, probed = opened(spark, root)
    got = {r["n"]: r for r in reader.read_partitions(spark, files, probed).collect()}
    assert {n: r[PART] for n, r in got.items()} == {str(i): day or f"{root}/{p}" for i, (p, day) in enumerate(where.items())}
    assert {r["k"] for r in got.values()} == {"inside"}
    day = files.where("part = '2024-02-04'")
    assert reader.read_partitions(spark, day, probed).count() == 2
    plan = reader.read_partitions(spark, day, probed)._jdf.queryExecution().executedPlan().toString().lower()
    assert "regexp" not in plan and "rlike" not in plan


def test_only_parse_errors_are_findings(spark, tmp_path):
    root = str(tmp_path)
    put(f"{root}/good.parquet", v=[1])
    for name, data in (("empty", b""), ("garbage", b"no parquet file at all"), ("short", b"PAR1"), ("cut", open(f"{root}/good.parquet", "rb").read()[:-9])):
        with open(f"{root}/{name}.parquet", "wb") as f:
            f.write(data)
    _, probed = opened(spark, root)
    assert {r["path"].split("/")[-1]: r["readable"] for r in probed.collect()} == {
        "good.parquet": True, "empty.parquet": False, "garbage.parquet": False, "short.parquet": False, "cut.parquet": False}
    gone = spark.createDataFrame([(f"{root}/gone.parquet", 10)], "path string, length long")
    with pytest.raises(Exception, match="gone.parquet"):
        reader.footers(gone).collect()
