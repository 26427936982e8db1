"""Tables in commits: readers see a write whole or not at all, and the newest write of a key replaces the others."""

from __future__ import annotations

import uuid

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F


def commit(table: DataFrame, root: str, name: str, keys: list[str], covers: DataFrame | None = None) -> str:
    """Write a table below ``root/name`` so that readers see it whole or not at all.

    Rows are staged in a folder of their own; then a manifest says for which values of ``keys`` that folder now holds
    the rows. Committing the same keys again replaces what they had, and a write that stopped before its manifest is never
    read. ``covers`` has the keys of a commit where some of them may have no rows.
    """
    spark, base, ident = table.sparkSession, f"{root.rstrip('/')}/{name}", f"c{uuid.uuid4().hex}"
    staged = f"{base}/data/commit={ident}"
    table.write.mode("errorifexists").parquet(staged)
    written = spark.read.schema(table.schema).parquet(staged).groupBy(*keys).agg(F.count("*").alias("rows"))
    if covers is not None:
        written = covers.select(*keys).distinct().withColumn("rows", F.lit(0).cast("bigint")).unionByName(written).groupBy(*keys).agg(
            F.sum("rows").alias("rows"))
    written.withColumns({"commit": F.lit(ident), "committed_at": F.current_timestamp()}).coalesce(1).write.mode("append").parquet(
        f"{base}/commits")
    return ident


def committed(spark: SparkSession, root: str, name: str, keys: list[str]) -> DataFrame:
    """What the newest commit of every key holds; commits that were replaced are not even scanned."""
    base = f"{root.rstrip('/')}/{name}"
    newest = spark.read.parquet(f"{base}/commits").groupBy(*keys).agg(
        F.max_by("commit", F.struct("committed_at", "commit")).alias("_commit"))
    newest = newest.withColumnsRenamed({k: f"_{k}" for k in keys})
    rows = spark.read.parquet(f"{base}/data")
    same = F.col("commit") == F.col("_commit")
    for k in keys:
        same = same & F.col(k).eqNullSafe(F.col(f"_{k}"))
    return rows.join(newest, same, "left_semi").drop("commit")


def any_commit(spark: SparkSession, root: str, name: str) -> bool:
    p = spark._jvm.org.apache.hadoop.fs.Path(f"{root.rstrip('/')}/{name}/commits")
    return p.getFileSystem(spark._jsc.hadoopConfiguration()).exists(p)
