"""Session construction, scratch storage and small driver-made tables."""

from __future__ import annotations

import tempfile
import uuid
from collections.abc import Callable
from concurrent.futures import ThreadPoolExecutor

import pyarrow as pa
from pyspark import inheritable_thread_target
from pyspark.sql import DataFrame, SparkSession

_LOCAL_SCRATCH: dict[str, str] = {}


def build_session(app: str = "lakegauge", master: str | None = None, **conf) -> SparkSession:
    """A session with the settings the library relies on.

    On a cluster pass no master: shuffle partitions start high and AQE coalesces them.
    """
    b = SparkSession.builder.appName(app)
    if master:
        b = b.master(master)
    base = {
        "spark.sql.session.timeZone": "UTC",
        "spark.sql.adaptive.enabled": "true",
        "spark.sql.adaptive.skewJoin.enabled": "true",
        "spark.sql.execution.arrow.pyspark.enabled": "true",
        "spark.python.sql.dataFrameDebugging.enabled": "false",
        "spark.ui.enabled": "false",
        "spark.scheduler.mode": "FAIR",
    }
    base.update(conf)
    for k, v in base.items():
        b = b.config(k, v)
    return b.getOrCreate()


def _conf(spark: SparkSession, key: str) -> str | None:
    return spark.conf.get(key, None) or spark.sparkContext.getConf().get(key, None)


def scratch_dir(spark: SparkSession) -> str:
    """Shared folder for intermediate tables: ``spark.checkpoint.dir``.

    Only a local session may fall back to a folder of this machine.
    """
    shared = _conf(spark, "spark.checkpoint.dir")
    if shared:
        return shared.rstrip("/")
    if not spark.sparkContext.master.startswith("local"):
        raise RuntimeError("set spark.checkpoint.dir to a folder every executor can reach")
    app = spark.sparkContext.applicationId
    if app not in _LOCAL_SCRATCH:
        _LOCAL_SCRATCH[app] = tempfile.mkdtemp(prefix="lakegauge-")
    return _LOCAL_SCRATCH[app]


def scratch_path(spark: SparkSession, tag: str) -> str:
    return f"{scratch_dir(spark)}/lakegauge/{tag}-{uuid.uuid4().hex[:12]}"


def materialise(df: DataFrame, tag: str) -> DataFrame:
    """Write an intermediate table to the shared scratch folder and read it back.

    It cuts the lineage in a way that survives lost executors, and it gives the planner the
    true size, so whether a later join broadcasts this side is decided by
    ``spark.sql.autoBroadcastJoinThreshold`` against a measured number, not by a hint.
    """
    spark = df.sparkSession
    path = scratch_path(spark, tag)
    df.write.mode("errorifexists").parquet(path)
    return spark.read.schema(df.schema).parquet(path)


def small_table(spark: SparkSession, rows: list[dict], schema: pa.Schema) -> DataFrame:
    """A driver-made table (rules, layers, file names); through Arrow it becomes a local relation of known size."""
    cols = [pa.array([r.get(f.name) for r in rows], type=f.type) for f in schema]
    return spark.createDataFrame(pa.Table.from_arrays(cols, schema=schema))


def together(**actions: Callable) -> dict:
    """Run independent actions as concurrent Spark jobs, so that the tail of one overlaps with the others.

    They keep the caller's scheduler pool and job tags.
    """
    inherited = inheritable_thread_target(SparkSession.active())
    with ThreadPoolExecutor(max_workers=8) as pool:
        running = {k: pool.submit(inherited(f)) for k, f in actions.items()}
        return {k: f.result() for k, f in running.items()}
