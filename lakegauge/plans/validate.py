"""Whole jobs: build a baseline, validate one partition or all, for contracts that name files."""

from __future__ import annotations

import datetime as dt
import uuid
from collections.abc import Callable
from functools import reduce

from py4j.protocol import Py4JError
from pyspark.errors import PySparkException
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from lakegauge.contract import Contract
from lakegauge.operators import reconcile
from lakegauge.plans import baseline as bl
from lakegauge.plans import evaluate as ev
from lakegauge.session import materialise, together
from lakegauge.sources import external, inventory, reader


def open_dataset(spark: SparkSession, c: Contract, where: str = "lokal"):
    """Files, logical partitions, footers and broken partitions of a dataset."""
    path = inventory.location(c, where)
    prefix = path if where == "s3" else None
    files = materialise(inventory.dated(inventory.list_files(spark, path), prefix), "files")
    probed = materialise(reader.footers(files), "footers")      # every file is opened once
    return files, inventory.partitions(files), probed, reader.unreadable_parts(files, probed)


def build_baseline(spark: SparkSession, c: Contract, root: str, where: str = "lokal",
                   exclude: list[str] | None = None) -> bl.Baseline:
    """Learn and store the baseline; ``exclude`` names partitions by label.

    What was learned of partitions whose files are still the same is remembered below ``root``: only new or changed ones are read.
    """
    files, parts, probed, broken = open_dataset(spark, c, where)
    names = [r["part"] for r in parts.filter(F.col("label").isin(exclude)).collect()] if exclude else None
    columns = probed.filter("readable").select("path", F.xxhash64(F.to_json("columns")).alias("schema"))
    mark = F.sum(F.xxhash64("path", "length", "schema", F.lit(c.fingerprint())) % (1 << 31)).alias("fingerprint")
    known = files.join(columns, "path").join(broken, "part", "left_anti").groupBy("part", "part_date").agg(mark)
    read = lambda new: reader.read_partitions(spark, files.join(new, "part", "left_semi"), probed)
    b = bl.relearn(spark, c, root, materialise(known, "fingerprints"), read, exclude=names)
    bl.save(b, root, spark)
    return bl.load(spark, root, c.name)


def jdbc_source(spark: SparkSession, c: Contract, url: str, **options) -> Callable[[], DataFrame]:
    """The relation that the contract names behind its landed table, opened when it is needed."""
    return lambda: external.jdbc_table(spark, url, c.source_table, **options)


def _count_source(c: Contract, table: DataFrame | Callable[[], DataFrame] | None, day: dt.date | None):
    """Counts of the source, or why there are none: a source that fails is a skip with its reason, not an abort."""
    if table is None or not c.source_table:
        return None, None
    try:
        return reconcile.count_source(table() if callable(table) else table, c.source_time, c.source_offset_hours, day), None
    except (PySparkException, Py4JError) as failed:
        return None, f"the source failed: {type(failed).__name__}: {failed}"[:500]


def validate(spark: SparkSession, c: Contract, baseline: bl.Baseline, *, where: str = "lokal", day: str | None = None,
             name: str | None = None, sweep: bool = False, fallback_latest: bool = False,
             source_table: DataFrame | Callable[[], DataFrame] | None = None, **options) -> DataFrame:
    """check_results of one selected partition, or of every partition with ``sweep``.

    ``where`` is 'lokal' or 's3'. ``source_table`` is the relation behind the landed table, or a function that opens it
    (``jdbc_source``); validating one dated partition reads only its day there, and a sweep also reports days that never
    landed. Rules are compiled per shape, the set of schemas of a partition's files, so every partition is judged by its own
    columns whatever the others look like; there are as many rounds as shapes, which may run at the same time.
    """
    files, parts, probed, broken = open_dataset(spark, c, where)
    only = None
    if not sweep:
        chosen = inventory.select(parts, c.partitioning, day, name, fallback_latest).collect()
        pick = F.col("part").isin([r["part"] for r in chosen])
        files, parts, broken = files.filter(pick), parts.filter(pick), broken.filter(pick)
        probed = probed.join(files.select("path"), "path", "left_semi")
        only = chosen[0]["part_date"] if len(chosen) == 1 else None
    options.setdefault("now", dt.datetime.now(dt.timezone.utc))
    run_id = options.setdefault("run_id", None) or uuid.uuid4().hex
    counts, reason = _count_source(c, source_table, only)
    options |= {"run_id": run_id, "source": counts, "source_reason": reason}

    shapes = materialise(reader.shapes(files, probed), "shapes")
    found = sorted(r["shape"] for r in shapes.select("shape").distinct().collect())       # one per combination of schemas

    def judged(shape: int, with_broken: bool):
        mine = shapes.filter(F.col("shape") == shape).select("part")
        known = mine.unionByName(broken.select("part")) if with_broken else mine
        frame = reader.read_partitions(spark, files.join(mine, "part", "left_semi"), probed)
        return lambda: ev.evaluate(frame, c, baseline, partitions=parts.join(known, "part", "left_semi"),
                                   unreadable=broken if with_broken else None, **options)

    if found:
        rounds = together(**{str(s): judged(s, i == 0) for i, s in enumerate(found)})
        out = reduce(DataFrame.unionByName, rounds.values())
    else:
        # nothing is readable: the broken files are the whole result
        schema = ", ".join(f"`{k.name}` string" for k in c.columns)
        frame = spark.createDataFrame([], f"{schema}, {ev.PART} string, {ev.PART_DATE} date")
        out = ev.evaluate(frame, c, baseline, partitions=parts, unreadable=broken, **options)
    if sweep and counts is not None and counts.days is not None:
        out = out.unionByName(ev.never_landed(counts, parts, c, now=options["now"], run_id=run_id))
    return out
