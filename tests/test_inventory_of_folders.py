"""The inventory of tables that are folders of files."""

import pyarrow as pa
import pyarrow.parquet as pq

from lakegauge import suite

suite.load_all()


def test_a_table_of_many_files_is_one_table(spark, tmp_path):
    (tmp_path / "documents.parquet").mkdir()
    for i, n in enumerate((3, 4, 0)):
        pq.write_table(pa.table({"x": list(range(n))}, schema=pa.schema([("x", pa.int64())])), tmp_path / "documents.parquet" / f"part-{i}.parquet")
    pq.write_table(pa.table({"x": [1, 2]}), tmp_path / "nation.parquet")
    pq.write_table(pa.table({"x": [1]}), tmp_path / "other.parquet")
    (tmp_path / "labels.parquet").mkdir()
    pq.write_table(pa.table({"x": [1]}), tmp_path / "labels.parquet" / "part-0.parquet")
    (tmp_path / "labels.parquet" / "part-1.parquet").write_bytes(b"")
    got = {tuple(r) for r in suite.QUERIES["file_inventory"](spark, str(tmp_path)).collect()}
    assert got == {("documents.parquet", True, True, 7), ("nation.parquet", True, True, 2), ("labels.parquet", False, False, 1)}
