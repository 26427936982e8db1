"""Footer probe and drift-tolerant reading of many files."""

from __future__ import annotations

import json
import re
from collections.abc import Iterator

import pandas as pd
import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from lakegauge.functions import times
from lakegauge.operators.prepare import PART, PART_DATE
from lakegauge.session import materialise, small_table
from lakegauge.sources import lattice
from lakegauge.sources.inventory import SourceError, filesystem, plain_path

FOOTER = "path string, readable boolean, error string, num_rows bigint, columns array<struct<name:string,type:string>>"


def _footer(path: str):
    """The footer of a file as a small file of its own; whatever fails here is a matter of access, not of content."""
    f, inner, _ = filesystem(path)
    with f.open_input_file(inner) as file:
        size = file.size()
        tail = file.read_at(min(size, 8), max(0, size - 8))
        wanted = int.from_bytes(tail[:4], "little") + 8 if len(tail) == 8 else 0
        return file.read_at(wanted, size - wanted) if 8 < wanted <= size else tail


def _probe(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
    import pyarrow.parquet as pq
    for batch in batches:
        out = []
        for path, length in zip(batch["path"], batch["length"]):
            footer = _footer(path) if length else b""
            try:
                if length == 0:
                    raise ValueError("file is empty (0 bytes)")
                with pq.ParquetFile(pa.BufferReader(b"PAR1" + footer)) as f:
                    cols = [{"name": c.name, "type": str(c.type)} for c in f.schema_arrow]
                    out.append((path, True, None, f.metadata.num_rows, cols))
            except Exception as exc:        # the bytes are here: a failure to parse them is the finding itself
                out.append((path, False, f"{type(exc).__name__}: {exc}"[:500], None, None))
        yield pd.DataFrame(out, columns=["path", "readable", "error", "num_rows", "columns"])


def footers(listing: DataFrame) -> DataFrame:
    """Read only the footer of every file, spread over the cluster.

    Files that can't be parsed become rows, not failures. Files that can't be fetched (rights, credentials, connections) say nothing
    about the data and end the job.
    """
    n = max(1, listing.sparkSession.sparkContext.defaultParallelism)
    return listing.select("path", "length").repartition(n, "path").mapInPandas(_probe, FOOTER)


def unreadable_parts(files: DataFrame, probed: DataFrame) -> DataFrame:
    """Partitions with at least one file that cannot be opened, with one message each."""
    bad = probed.filter(~F.col("readable")).select("path", "error")
    return files.join(bad, "path").groupBy("part", "part_date").agg(
        F.count(F.lit(1)).alias("bad_files"), F.min("error").alias("error"))


def _schema_id() -> Column:
    return F.xxhash64(F.to_json(F.array_sort("columns")))


def _stored(spark: SparkSession, example: str) -> T.StructType:
    """Types of a file's columns as a scan sees them; nanoseconds count as whole numbers there."""
    return spark.read.option("recursiveFileLookup", "true").parquet(re.sub(r"([\[\]{}*?\\])", r"\\\1", example)).schema


def _exact(spark: SparkSession) -> SparkSession:
    """A session of its own that reads nanoseconds, which the scan can't as times."""
    other = spark.newSession()
    other.conf.set("spark.sql.legacy.parquet.nanosAsLong", "true")
    return other


def _schemas(spark: SparkSession, probed: DataFrame) -> dict[int, tuple[T.StructType, list[str]]]:
    """Per distinct schema of the readable files (few, whatever the number of files) its stored types and nanosecond columns."""
    rows = probed.where("readable").groupBy(_schema_id().alias("sid")).agg(
        F.min("path").alias("path"), F.first("columns").alias("columns")).collect()
    out, exact = {}, None
    for r in rows:
        nanos = [c["name"] for c in r["columns"] if c["type"].startswith("timestamp[ns")]
        exact = exact or (_exact(spark) if nanos else None)
        out[r["sid"]] = (_stored(exact if nanos else spark, r["path"]), nanos)
    return out


def _times(schema: T.StructType, nanos: list[str]) -> T.StructType:
    return T.StructType([T.StructField(f.name, T.TimestampNTZType() if f.name in nanos else f.dataType) for f in schema])


def shapes(files: DataFrame, probed: DataFrame) -> DataFrame:
    """(part, shape) of every readable partition.

    A partition's shape is the joined schema of its files, widths aside: partitions of one shape can be read and judged together.
    """
    spark = files.sparkSession
    known = {sid: _times(*s) for sid, s in _schemas(spark, probed).items()}
    bad = unreadable_parts(files, probed).select("part")
    of_part = (files.select("path", "part").join(probed.where("readable").select("path", _schema_id().alias("sid")), "path")
               .join(bad, "part", "left_anti").groupBy("part").agg(F.sort_array(F.collect_set("sid")).alias("sids")))
    of_part = materialise(of_part, "schemas")
    rows = []
    for r in of_part.select("sids").distinct().collect():               # one per combination of schemas
        whole = lattice.joined([known[s] for s in r["sids"]])
        rows.append({"sids": r["sids"], "shape": json.dumps(sorted((f.name, lattice.family(f.dataType)) for f in whole))})
    found = small_table(spark, rows, pa.schema([("sids", pa.list_(pa.int64())), ("shape", pa.string())]))
    return of_part.join(found, "sids").select("part", F.xxhash64("shape").alias("shape"))


def _located(files: DataFrame) -> DataFrame:
    """Adds folder, layout (which folders name the partition's date, if they do), base (what lies above them) and their keys."""
    folder = F.regexp_extract("path", r"^(.*)/[^/]*$", 1)
    dirs = F.split(folder, "/")
    keyed = F.filter(dirs, lambda d: F.contains(d, F.lit("=")))
    keys = F.transform(keyed, lambda d: F.split_part(d, F.lit("="), F.lit(1)))
    plain = F.size(F.array_distinct(keys)) == F.size(keys)
    out = files.withColumn("folder", folder).withColumn(
        "layout", F.when(F.col("part_date").isNotNull() & plain, times.layout_of(F.col("path"))))
    first = F.array_position(dirs, F.get(keyed, F.lit(0)))
    base = F.array_join(F.slice(dirs, F.lit(1), F.greatest(first.cast("int") - 1, F.lit(0))), "/")
    return out.withColumns({"base": F.when(F.col("layout").isNotNull(), base),
                            "keys": F.when(F.col("layout").isNotNull(), F.array_join(keys, ","))})


def _read(spark: SparkSession, schema: T.StructType, targets: list[str], layout: str | None, base: str, keys: str,
          mine: DataFrame) -> DataFrame:
    """Rows of files that one schema can read, marked with their partition."""
    if layout:                                    # the date's folders are constant columns of the scan
        folders = [T.StructField(k, T.StringType()) for k in keys.split(",")]
        df = spark.read.option("basePath", base or "/").schema(T.StructType([*schema, *folders])).parquet(*targets)
        df = df.withColumn(PART_DATE, times.date_from_folders(layout)).withColumn(PART, F.col(PART_DATE).cast("string"))
        return df.select(*[f"`{f.name}`" for f in schema], PART_DATE, PART)
    df = spark.read.option("recursiveFileLookup", "true").schema(schema).parquet(*targets)
    of_file = materialise(mine.select(F.col("path").alias("_path"), F.col("part_date").alias(PART_DATE), F.col("part").alias(PART)), "file-map")
    return df.withColumn("_path", plain_path(F.col("_metadata.file_path"))).join(of_file, "_path").select(
        *[f"`{f.name}`" for f in schema], PART_DATE, PART)


def read_partitions(spark: SparkSession, files: DataFrame, probed: DataFrame) -> DataFrame:
    """All readable files of the given inventory as one frame; columns that files lack are null there.

    A column has the least type above those of its files: widths differ without harm, only types with nothing in common become
    text. Where the scan can widen by itself, files of many schemas are one scan; the others are scanned per stored type and
    converted. A partition's date comes from its folders, or from a table of files where no folder names it. Folders whose
    files all belong together are read as folders; names are only used for files of folders that hold several kinds, or
    others than those asked for. A partition with a broken file is left out as a whole: it is reported, not half-validated.
    """
    broken = unreadable_parts(files, probed).select("part")
    good = files.join(broken, "part", "left_anti").join(probed.select("path", "columns"), "path").withColumn("sid", _schema_id())
    good = materialise(_located(good).drop("columns", "label", "length"), "readable")
    here = probed.join(good.select("path"), "path", "left_semi")
    stored = _schemas(spark, here)
    if not stored:
        raise SourceError("no readable partition")
    whole = lattice.joined([_times(*stored[s]) for s in sorted(stored)])
    groups, group_of = [], []
    for sid in sorted(stored):
        schema, nanos = stored[sid]
        has = {f.name: f.dataType for f in schema}
        as_read = T.StructType([
            T.StructField(f.name, has[f.name] if f.name in has and (f.name in nanos or not lattice.scan_widens(has[f.name], f.dataType))
                          else f.dataType) for f in whole])
        kind = (as_read, tuple(sorted(nanos)))
        if kind not in groups:
            groups.append(kind)
        group_of.append({"sid": sid, "kind": groups.index(kind)})
    kinds = small_table(spark, group_of, pa.schema([("sid", pa.int64()), ("kind", pa.int32())]))
    good = good.join(kinds, "sid")
    clash = F.lit(False)
    for f in whole:                               # a data column with the name of a folder's key would be hidden by it
        clash = clash | F.array_contains(F.split("keys", ","), f.name)
    layout = F.when(~clash, F.col("layout"))
    good = materialise(good.withColumns({"layout": layout, "base": F.when(layout.isNotNull(), F.col("base")),
                                         "keys": F.when(layout.isNotNull(), F.col("keys"))}), "grouped")
    by = ["kind", "layout", "base", "keys"]
    siblings = F.max("siblings") if "siblings" in good.columns else F.lit(-1)
    per_folder = good.groupBy(*by, "folder").agg(F.count("*").alias("n"), siblings.alias("siblings"), F.collect_list("path").alias("paths"))
    literal = lambda p: F.regexp_replace(p, r"([\[\]{}*?\\])", r"\\$1")
    target = per_folder.select(*by, F.explode(F.when(F.col("n") == F.col("siblings"), F.array(F.concat(literal(F.col("folder")), F.lit(
        "/*.parquet")))).otherwise(F.transform("paths", literal))).alias("at"))
    targets: dict[tuple, list[str]] = {}
    for r in target.collect():
        targets.setdefault(tuple(r[k] for k in by), []).append(r["at"])
    out, exact = None, None
    for key in sorted(targets, key=str):
        kind, layout, base, keys = key
        as_read, nanos = groups[kind]
        exact = exact or (_exact(spark) if nanos else None)
        mine = good.where((F.col("kind") == kind) & F.col("layout").isNull())
        df = _read(exact if nanos else spark, as_read, sorted(targets[key]), layout, base, keys, mine)
        cols = [(times.from_epoch(F.col(f"`{f.name}`"), "nanodetik") if f.name in nanos else F.col(f"`{f.name}`"),
                 T.TimestampNTZType() if f.name in nanos else f.dataType, w) for f, w in zip(as_read, whole)]
        df = df.select(*[lattice.convert(c, have, w.dataType).alias(w.name) for c, have, w in cols], PART_DATE, PART)
        out = df if out is None else out.unionByName(df)
    return out
