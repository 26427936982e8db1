"""The source of truth behind a landed table, and snapshot ingest from it."""

from __future__ import annotations

import datetime as dt

import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from lakegauge.session import small_table


def jdbc_table(spark: SparkSession, url: str, table: str, *, split_column: str | None = None, lower=None, upper=None,
               splits: int = 1, **options) -> DataFrame:
    """A relation over JDBC; with a split column the read is spread over the executors."""
    r = spark.read.format("jdbc").option("url", url).option("dbtable", table).options(**options)
    if split_column:
        r = (r.option("partitionColumn", split_column).option("lowerBound", lower).option("upperBound", upper)
             .option("numPartitions", splits))
    return r.load()


def in_window(source: DataFrame, time_column: str, day: dt.date, offset_hours: float = 0.0) -> DataFrame:
    """Rows of the half-open window of a day.

    The bounds are literals on the bare column, so the filter reaches the source.
    """
    lo = dt.datetime.combine(day, dt.time()) + dt.timedelta(hours=offset_hours)
    hi = lo + dt.timedelta(days=1)
    t, kind = F.col(time_column), source.schema[time_column].dataType
    return source.filter((t >= F.lit(lo.isoformat(sep=" ")).cast(kind)) & (t < F.lit(hi.isoformat(sep=" ")).cast(kind)))


def window_count(source: DataFrame, time_column: str | None = None, day: dt.date | None = None,
                 offset_hours: float = 0.0) -> DataFrame:
    """Rows of the source, in the window of a day if a time column and a day are known."""
    if time_column and day is not None:
        source = in_window(source, time_column, day, offset_hours)
    return source.agg(F.count(F.lit(1)).alias("source_rows"))


def column_names(source: DataFrame) -> list[str]:
    """Column names without reading a row."""
    return source.schema.names


_INFO = pa.schema([("ordinal", pa.int64()), ("column", pa.string()), ("data_type", pa.string()),
                   ("nullable", pa.bool_()), ("max_length", pa.int64())])


def schema_info(source: DataFrame) -> DataFrame:
    """Name, type, nullability and declared length of every source column."""
    rows = []
    for i, f in enumerate(source.schema, 1):
        size = getattr(f.dataType, "length", None) or (f.metadata or {}).get("maxlength")
        rows.append({"ordinal": i, "column": f.name, "data_type": f.dataType.simpleString(), "nullable": f.nullable,
                     "max_length": size})
    return small_table(source.sparkSession, rows, _INFO)


def sample_rows(source: DataFrame, n: int = 1000) -> DataFrame:
    """Any n rows, as a preview."""
    return source.limit(n)


_INGEST = pa.schema([("snapshot_date", pa.string()), ("status", pa.string()), ("source_rows", pa.int64()),
                     ("landed_rows", pa.int64()), ("counts_match", pa.bool_()), ("path", pa.string())])


def ingest_snapshot(source: DataFrame, root: str, snapshot_date: str) -> DataFrame:
    """Land a full extract as ``snapshot_date=D`` and check the count of what was written.

    Re-running a date replaces that date only. An empty source writes nothing.
    """
    spark = source.sparkSession
    path = f"{root.rstrip('/')}/snapshot_date={snapshot_date}"
    n = source.count()
    row = {"snapshot_date": snapshot_date, "source_rows": n, "path": path, "landed_rows": 0}
    if n == 0:
        return small_table(spark, [{**row, "status": "completed_empty", "counts_match": True}], _INGEST)
    source.write.mode("overwrite").option("compression", "snappy").parquet(path)
    landed = spark.read.parquet(path).count()
    status = "completed" if landed == n else "failed"
    return small_table(spark, [{**row, "landed_rows": landed, "counts_match": landed == n, "status": status}], _INGEST)
