"""Result tables across runs, contract catalogue, and the findings report."""

from __future__ import annotations

import datetime as dt
import time
import uuid
from collections.abc import Callable
from concurrent.futures import FIRST_COMPLETED, Future, ThreadPoolExecutor, wait
from contextlib import suppress
from threading import Thread

import pyarrow as pa
from pyspark import inheritable_thread_target
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from lakegauge.contract import Contract
from lakegauge.plans import baseline as bl
from lakegauge.plans import summary
from lakegauge.plans.catalog import BLOCKING, CATEGORIES, FIT, UNFIT
from lakegauge.session import materialise, small_table
from lakegauge.sources.commits import commit, committed


RUN_KEYS = ["run_id", "dataset"]


def append(results: DataFrame, root: str) -> str:
    """Commit check results to the history; a run that is repeated replaces its results, per dataset."""
    commit(results, root, "check_results", RUN_KEYS)
    return f"{root.rstrip('/')}/check_results"


_RESET = pa.schema([("dataset", pa.string()), ("reset_at", pa.string())])


def reset(spark: SparkSession, root: str, at: dt.datetime, dataset: str | None = None) -> None:
    """Start the history afresh, for one dataset or for all, without deleting files other readers may hold."""
    row = small_table(spark, [{"dataset": dataset, "reset_at": at.isoformat(sep=" ")}], _RESET)
    row.coalesce(1).write.mode("append").parquet(f"{root.rstrip('/')}/resets")


def read(spark: SparkSession, root: str) -> DataFrame:
    """Committed results since the last reset."""
    h = committed(spark, root, "check_results", RUN_KEYS)
    p = spark._jvm.org.apache.hadoop.fs.Path(f"{root.rstrip('/')}/resets")
    if not p.getFileSystem(spark._jsc.hadoopConfiguration()).exists(p):
        return h
    r = spark.read.parquet(f"{root.rstrip('/')}/resets").withColumn("reset_at", F.col("reset_at").cast("timestamp_ntz"))
    every = r.filter("dataset IS NULL").agg(F.max("reset_at")).first()[0]
    own = r.filter("dataset IS NOT NULL").groupBy("dataset").agg(F.max("reset_at").alias("_own"))
    h = h.join(own, "dataset", "left").filter("_own IS NULL OR run_at > _own").drop("_own")
    return h if every is None else h.filter(F.col("run_at") > F.lit(every.isoformat(sep=" ")).cast("timestamp_ntz"))


def append_sweep(results: DataFrame, root: str) -> None:
    """Commit the sweep tables of a run: verdict per partition, and the blocking failures (none is a result, too)."""
    commit(summary.sweep(results, ("run_id",)), root, "sweep_verdicts", RUN_KEYS, results)
    commit(summary.blocking_failures(results, by=("run_id",)), root, "sweep_failures", RUN_KEYS, results)


def read_sweep(spark: SparkSession, root: str) -> tuple[DataFrame, DataFrame]:
    """Verdicts and blocking failures of all committed runs."""
    return tuple(committed(spark, root, n, RUN_KEYS) for n in ("sweep_verdicts", "sweep_failures"))


def append_layer_summary(layered: DataFrame, root: str, day: str) -> None:
    """Commit the summary table of all layers of a day; running the day again replaces it."""
    dated = lambda d: d.withColumn("run_date", F.lit(day).cast("date"))
    commit(dated(summary.layer_summary(layered)), root, "layer_summary", ["run_date"], dated(layered.select()))


def read_layer_summary(spark: SparkSession, root: str) -> DataFrame:
    return committed(spark, root, "layer_summary", ["run_date"])


def write_json(results: DataFrame, path: str) -> None:
    results.write.mode("overwrite").json(path)


_CATALOGUE = pa.schema([("dataset", pa.string()), ("description", pa.string()), ("columns", pa.int64()),
                        ("grain", pa.string()), ("partitioning", pa.string()), ("local", pa.string()),
                        ("remote", pa.string()), ("baseline", pa.bool_()), ("warnings", pa.int64())])


def catalogue(spark: SparkSession, contracts: dict[str, Contract], baselines: str | None = None) -> DataFrame:
    """Listed datasets and whether each has a baseline."""
    rows = [{"dataset": c.name, "description": c.description, "columns": len(c.columns), "grain": c.grain,
             "partitioning": c.partitioning, "local": c.local, "remote": c.remote, "warnings": len(c.warnings),
             "baseline": bool(baselines and bl.exists(spark, baselines, c.name))} for c in contracts.values()]
    return small_table(spark, rows, _CATALOGUE)


_RUN = pa.schema([("dataset", pa.string()), ("error", pa.string())])


def run_all(spark: SparkSession, jobs: dict[str, Callable[[], DataFrame]], limits: dict[str, float] | None = None,
            parallel: int = 4) -> tuple[DataFrame | None, DataFrame]:
    """Run every dataset to its end, ``parallel`` at a time, each in a scheduler pool of its own.

    One that fails, while it is planned or while it runs, or takes longer than its limit in seconds becomes an error row and holds
    no other: its Spark jobs carry a tag and are cancelled, those it starts later as well, until it has ended. Results are written
    tables; ``limits`` counts from a dataset's start.
    """
    results, failed = None, []
    late: dict[Future, str] = {}
    sc, run = spark.sparkContext, uuid.uuid4().hex[:12]
    started: dict[str, float] = {}

    def one(name: str, job: Callable[[], DataFrame]):
        def go() -> DataFrame:
            sc.addJobTag(f"{run}-{name}")
            sc.setLocalProperty("spark.scheduler.pool", name)
            started[name] = time.monotonic()
            return materialise(job(), "dataset")
        return go

    def cancel_late() -> bool:
        """One round over datasets past their limit; whether any has not ended."""
        running = [n for f, n in late.items() if not f.done()]
        for n in running:
            sc.cancelJobsWithTag(f"{run}-{n}")
        return bool(running)

    def cancel_rest() -> None:
        with suppress(Exception):                           # the session may stop first
            while cancel_late():
                time.sleep(0.2)

    pool = ThreadPoolExecutor(max_workers=max(1, parallel))
    waiting = {pool.submit(inheritable_thread_target(spark)(one(n, j))): n for n, j in jobs.items()}
    try:
        while waiting:
            for f in wait(waiting, timeout=0.2, return_when=FIRST_COMPLETED).done:
                name = waiting.pop(f)
                try:
                    df = f.result()
                    results = df if results is None else results.unionByName(df)
                except Exception as exc:
                    failed.append({"dataset": name, "error": f"{type(exc).__name__}: {exc}"[:500]})
            for f, name in list(waiting.items()):
                limit = (limits or {}).get(name)
                if limit is not None and name in started and time.monotonic() - started[name] > limit:
                    late[f] = waiting.pop(f)
                    failed.append({"dataset": name, "error": f"took longer than {limit:g} seconds"})
            cancel_late()
    finally:
        pool.shutdown(wait=False, cancel_futures=True)
        Thread(target=cancel_rest, daemon=True).start()
    return results, small_table(spark, failed, _RUN)


def markdown(results: DataFrame, title: str) -> str:
    """Findings of one partition as a document; its rows are as many as the contract has rules."""
    rows = results.orderBy("dim", "rule_id").collect()
    failed = [r for r in rows if r["success"] is False]
    blocking = [r for r in failed if r["severity"] == BLOCKING]
    skipped = [r for r in rows if r["success"] is None]
    out = [f"# {title}", "", f"**{UNFIT if blocking else FIT}**: {len(rows)} checks, {len(failed)} failed "
           f"({len(blocking)} blocking), {len(skipped)} skipped.", "",
           "| dimension | checks | failed | skipped |", "|---|---:|---:|---:|"]
    for dim, label in CATEGORIES.items():
        mine = [r for r in rows if r["dim"] == dim]
        if mine:
            out.append(f"| {label} | {len(mine)} | {sum(r['success'] is False for r in mine)} | "
                       f"{sum(r['success'] is None for r in mine)} |")

    def seen(r) -> str:
        v = r["error"] or r["observed_text"] or r["observed_num"]
        if v is None and r["unexpected_count"] is not None:
            v = f"{r['unexpected_count']} of {r['element_count']} rows"
        s = "-" if v is None else str(v).replace("|", "\\|")
        return s if len(s) <= 90 else s[:90] + "..."
    if failed:
        out += ["", "## Findings", ""]
        for r in failed:
            out.append(f"- **[{r['severity']}] {r['rule_id']}** {seen(r)}"
                       + (f", e.g. {list(r['sample'])[:10]}" if r["sample"] else ""))
    if skipped:
        out += ["", "## Skipped", ""] + [f"- {r['rule_id']}: {r['note'] or 'does not apply'}" for r in skipped]
    out += ["", "## All checks", "", "| status | rule | observed |", "|---|---|---|"]
    for r in rows:
        status = "skip" if r["success"] is None else "ok" if r["success"] else r["severity"]
        out.append(f"| {status} | {r['rule_id']} | {seen(r)} |")
    return "\n".join(out) + "\n"
