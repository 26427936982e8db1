"""File inventory: which files exist, which logical partition each belongs to."""

from __future__ import annotations

import datetime as dt
import os
import re
from fnmatch import fnmatchcase
from functools import reduce
from itertools import takewhile

import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.window import Window

from lakegauge.contract import Contract, unresolved_variables
from lakegauge.functions import times
from lakegauge.session import materialise, small_table


class SourceError(Exception):
    """No usable location or partition."""


def location(c: Contract, source: str) -> str:
    """Where a dataset lives, for ``source`` 'lokal' or 's3'."""
    path = c.remote if source == "s3" else c.local
    if not path:
        raise SourceError(f"{c.name}: the contract names no location for source '{source}'")
    missing = unresolved_variables(path)
    if missing:
        raise SourceError(f"{c.name}: environment variables not set: {', '.join(missing)}")
    return path.replace("s3://", "s3a://", 1)


def plain_path(uri: Column) -> Column:
    """A file's URI as the inventory spells it: decoded, and local files without scheme."""
    name = F.url_decode(F.replace(uri, F.lit("+"), F.lit("%2B")))
    return F.when(F.startswith(name, F.lit("file:")), F.concat(F.lit("/"), F.ltrim(F.substring(name, 6, 2**31 - 1), F.lit("/")))).otherwise(name)


_LISTED = "path string, folder boolean, length bigint, siblings bigint"


def filesystem(path: str):
    """File system, path inside it and the part before that path, for a local path or a URI."""
    from pyarrow import fs
    if "://" not in path:
        return fs.LocalFileSystem(), path, ""
    f, inner = fs.FileSystem.from_uri(path.replace("s3a://", "s3://", 1))
    return f, inner, path[:len(path) - len(inner)] if path.endswith(inner) else path.split("://")[0] + "://"


def _wanted(path: str, pattern: list[str]) -> bool:
    """Whether a path agrees with a glob, folder by folder, as far as both go."""
    return all(any(fnmatchcase(p, g) for g in _choices(q)) for p, q in zip(path.split("/"), pattern))


def _choices(part: str) -> list[str]:
    """A glob without its braces: one per alternative."""
    m = re.search(r"\{([^{}]*)\}", part)
    return [c for a in m[1].split(",") for c in _choices(part[:m.start()] + a + part[m.end():])] if m else [part]


def _lister(pattern: str, deep: bool):
    """Contents of each folder of a batch, all levels with ``deep``: files that end in .parquet, and folders to go on with."""
    parts = pattern.split("/")

    def run(batches):
        for b in batches:
            out = {"path": [], "folder": [], "length": [], "siblings": []}
            for top in b.column("path").to_pylist():
                f, inner, before = filesystem(top)
                from pyarrow import fs
                here: dict[str, list] = {}
                for x in f.get_file_info(fs.FileSelector(inner, recursive=deep)):
                    name, below = before + x.path, x.path[len(inner):].split("/")
                    if any(k.startswith(".") or k.startswith("_") and "=" not in k for k in below if k) or not _wanted(name, parts):
                        continue
                    if x.type == fs.FileType.Directory:
                        if not deep:
                            here.setdefault("", []).append((name, True, 0))
                    elif name.endswith(".parquet") and name.count("/") >= len(parts) - 1:
                        here.setdefault(name.rpartition("/")[0], []).append((name, False, x.size))
                for rows in here.values():
                    files = sum(not d for _, d, _ in rows)
                    for name, is_folder, size in rows:
                        for k, v in zip(out, (name, is_folder, size, files)):
                            out[k].append(v)
            yield pa.RecordBatch.from_arrays([pa.array(v, t) for v, t in zip(
                out.values(), (pa.string(), pa.bool_(), pa.int64(), pa.int64()))], names=list(out))
    return run


def spelled(path: str) -> str:
    """A folder as ``list_files`` spells it in the names of its files."""
    if path.startswith("file:"):
        path = "/" + path.removeprefix("file:").lstrip("/")
    if "://" not in path:
        path = os.path.abspath(path)
    return path.rstrip("/")


def list_files(spark: SparkSession, path: str) -> DataFrame:
    """(path, length, siblings) of every parquet file under a prefix or glob, empty files included, a written table.

    Folders are listed by tasks, one level after the other until every core has one, then each to its end. Names stay in the
    tables. ``siblings`` counts the parquet files of a file's folder. Names that begin with a dot or an underscore are no data. A folder
    that can't be listed is an error, one that doesn't exist is empty.
    """
    path = spelled(path)
    fixed = "/".join(takewhile(lambda p: not re.search(r"[*?\[{]", p), path.split("/")))
    level = small_table(spark, [{"path": fixed}], pa.schema([("path", pa.string())]))
    f, inner, _ = filesystem(fixed)
    info = f.get_file_info(inner)
    if not info.type.value:                                 # nothing there
        return spark.createDataFrame([], "path string, length bigint, siblings bigint")
    if info.is_file:                                        # a single file
        return level.select("path", F.lit(info.size).cast("bigint").alias("length"), F.lit(0).cast("bigint").alias("siblings"))
    found, folders = [], 1
    while folders:
        deep = folders >= spark.sparkContext.defaultParallelism
        got = materialise(level.repartition(folders, "path").mapInArrow(_lister(path, deep), _LISTED), "listing")
        found.append(got.where("NOT folder").drop("folder"))
        level = got.where("folder").select("path")
        folders = 0 if deep else level.count()
    return reduce(DataFrame.unionByName, found)


def label_of(path: Column, prefix: str | None) -> Column:
    """Short name of a file: below the prefix if there is one, else the base name."""
    base = F.regexp_extract(path, r"([^/]*)$", 1)
    if not prefix:
        return base
    p = prefix.removeprefix("file:").rstrip("/") + "/"
    return F.when(F.startswith(path, F.lit(p)), F.substring(path, len(p) + 1, 2**31 - 1)).otherwise(base)


def dated(listing: DataFrame, prefix: str | None = None) -> DataFrame:
    """Add part_date (from the path), label, and part: the date, or the path where there is none."""
    d = listing.withColumn("part_date", times.date_from_path(F.col("path")))
    return (d.withColumn("label", label_of(F.col("path"), prefix))
            .withColumn("part", F.coalesce(F.col("part_date").cast("string"), F.col("path"))))


def partitions(files: DataFrame) -> DataFrame:
    """Files of one date form one logical partition; undated files stay apart.

    Output: part, part_date, label, bytes, files, first_path.
    """
    g = files.groupBy("part", "part_date").agg(
        F.sum("length").cast("bigint").alias("bytes"), F.count(F.lit(1)).alias("files"),
        F.min("path").alias("first_path"), F.min_by("label", "path").alias("first_label"))
    folder = F.regexp_extract("first_label", r"^(.*)/[^/]*$", 1)
    folder = F.when(folder == "", F.col("first_label")).otherwise(folder)
    label = F.when(F.col("files") == 1, F.col("first_label")).otherwise(
        F.concat(folder, F.lit(" ("), F.col("files").cast("string"), F.lit(" file)")))
    return g.select("part", "part_date", label.alias("label"), "bytes", "files", "first_path")


def ordered(parts: DataFrame) -> DataFrame:
    """Oldest first, undated before all dates."""
    return parts.orderBy(F.col("part_date").asc_nulls_first(), "label")


def first_n(parts: DataFrame, n: int = 10) -> DataFrame:
    """The first n partitions in order, as read for contract inference."""
    return ordered(parts).limit(n)


def latest(parts: DataFrame) -> DataFrame:
    newest = F.struct(F.coalesce("part_date", F.lit("0001-01-01").cast("date")), F.col("label"))
    cols = parts.columns
    return parts.agg(F.max_by(F.struct(*cols), newest).alias("p")).filter("p IS NOT NULL").select("p.*")


def on_date(parts: DataFrame, day: str | dt.date) -> DataFrame:
    return parts.filter(F.col("part_date") == F.lit(str(day)).cast("date"))


def in_week_of(parts: DataFrame, day: str | dt.date) -> DataFrame:
    """The week-of-month partition that holds the date."""
    return parts.filter(F.col("part_date") == times.week_start(F.lit(str(day)).cast("date")))


def named(parts: DataFrame, name: str) -> DataFrame:
    """By first path, label or base name."""
    base = F.regexp_extract("first_path", r"([^/]*)$", 1)
    return parts.filter((F.col("first_path") == name) | (F.col("label") == name) | (base == name))


def select(parts: DataFrame, kind: str, day: str | None = None, name: str | None = None,
           fallback_latest: bool = False) -> DataFrame:
    """The one partition to validate; a missing weekly partition never falls back."""
    if name:
        hit = named(parts, name).orderBy("part_date", "label").limit(1)
    elif day is None:
        hit = latest(parts)
    elif kind == "mingguan":
        hit = in_week_of(parts, day).limit(1)
    else:
        hit = latest(on_date(parts, day))
    if hit.take(1):
        return hit
    if day and fallback_latest and kind != "mingguan":
        return latest(parts)
    raise SourceError(f"no partition for {name or day or 'any date'}")


def yesterday(now: dt.datetime) -> str:
    """Default date of a batch run."""
    return (now - dt.timedelta(days=1)).date().isoformat()


def small_files(files: DataFrame, limit_bytes: int) -> DataFrame:
    """Per partition: file count, total, exact median size and share of files under the limit."""
    per_size = files.groupBy("part", "part_date", "length").agg(F.count(F.lit(1)).alias("n"))
    w = Window.partitionBy("part", "part_date")
    run = F.sum("n").over(w.orderBy("length"))
    total = F.sum("n").over(w)
    t = per_size.withColumn("_run", run).withColumn("_total", total)
    low, high = F.floor((F.col("_total") - 1) / 2), F.floor(F.col("_total") / 2)
    return t.groupBy("part", "part_date").agg(
        F.sum("n").alias("files"), F.sum(F.col("n") * F.col("length")).cast("bigint").alias("bytes"),
        ((F.min(F.when(F.col("_run") > low, F.col("length")))
          + F.min(F.when(F.col("_run") > high, F.col("length")))) / 2.0).alias("median_bytes"),
        (F.sum(F.when(F.col("length") < limit_bytes, F.col("n")).otherwise(0)) / F.sum("n")).alias("small_share"))
