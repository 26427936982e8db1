"""Exact deduplication through an extendible-hash index on shared files.

Normalised texts are hashed to 64 bits. A directory of 2^depth slots over the leading bits leads to buckets; while a bucket
holds more keys than its capacity the directory doubles and that bucket splits by one more bit. Copies are combined before the
shuffle, so a text with very many copies costs one row per map task, and go through the directory to their bucket, a key range
with one owner task. The owner chains entries with equal hashes. Documents look up slot, bucket and hash: where a hash has one
entry that is their group, where it has several they are compared with the chain's texts byte by byte.
"""

from __future__ import annotations

from collections.abc import Callable
from decimal import Decimal
from math import ceil, log2

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from lakegauge.llm.common import packed, squeezed, whole
from lakegauge.session import materialise

#: keys that fit into a bucket
CAPACITY = 16384
_TOP, _SHIFT = Decimal((1 << 63) - 1), Decimal(1 << 64)


def _slot(h: str | Column, depth: int) -> Column:
    """Leading ``depth`` bits of a 64-bit hash."""
    return F.shiftrightunsigned(h, 64 - depth) if depth else F.lit(0).cast("long")


def directory(keys: DataFrame, capacity: int = CAPACITY) -> tuple[DataFrame, int]:
    """Directory (slot, bucket) over the hashes in ``keys.h``, and its depth.

    The depth starts where hashes spread evenly would just fit, and doubles while some slot holds more than the capacity (equal
    hashes can't be split: 40 bits end it). A bucket is the shortest prefix that fits, so slots next to each other share one.
    The table has about four slots per full bucket, all others are without keys and left out.
    """
    total = keys.count()
    depth = max(0, ceil(log2(total / capacity))) if total > capacity else 0
    while True:
        filled = materialise(keys.groupBy(_slot("h", depth).alias("slot")).agg(F.count("*").alias("n")), "slots")
        if depth >= 40 or (filled.agg(F.max("n")).first()[0] or 0) <= capacity:
            break
        depth += 1
    ladder = filled.select("slot", "n", F.explode(F.sequence(F.lit(0), F.lit(depth))).alias("depth")).withColumn(
        "prefix", F.expr(f"shiftrightunsigned(slot, {depth} - depth)"))
    fits = ladder.groupBy("depth", "prefix").agg(F.sum("n").alias("n")).where(
        (F.col("n") <= capacity) | (F.col("depth") == depth)).drop("n")
    local = ladder.join(fits, ["depth", "prefix"]).groupBy("slot").agg(F.min("depth").alias("local"))
    bucket = F.expr(f"concat(local, '-', shiftrightunsigned(slot, {depth} - local))")
    return materialise(local.select("slot", bucket.alias("bucket")), "directory"), depth


def _best(n_chars: Column, key: Column) -> Column:
    """Length and key in one number that is largest for the longest text, then the smallest key; a null key comes last."""
    return n_chars.cast("decimal(18,0)") * _SHIFT + (F.lit(_TOP) - F.coalesce(key.cast("decimal(20,0)"), F.lit(_TOP)))


def _entry(group: list[str]):
    """Counts and the row that stays of each group of a frame with id and chars."""
    rest = F.col("best") % _SHIFT
    return lambda d: d.groupBy(*group).agg(F.count("*").alias("n"), F.max(_best(F.col("chars"), F.col("id"))).alias("best")).select(
        *group, "n", F.when(rest > 0, F.lit(_TOP) - rest).cast("long").alias("keep"),
        ((F.col("best") - rest) / _SHIFT).cast("long").alias("keep_chars"))


def _groups(rows: DataFrame, capacity: int, hashed: Callable[[Column], Column]) -> DataFrame:
    """Group (bucket, h, chain), its size n, keep and keep_chars of each of ``rows`` (id and text)."""
    norm = squeezed(whole("text"))
    base = rows.select("id", F.length(whole("text")).cast("long").alias("chars"), norm.alias("norm")).withColumn(
        "h", hashed(F.col("norm")))
    light = materialise(base.select("id", "chars", "h", F.unhex(F.sha2("norm", 256)).alias("sha")), "texts")
    slots, depth = directory(light.select("h").distinct(), capacity)
    found = lambda d: d.join(slots, _slot("h", depth) == F.col("slot")).drop("slot")
    same = Window.partitionBy("bucket", "h")
    owned = found(_entry(["h", "norm"])(base).drop("norm")).repartition("bucket").sortWithinPartitions("bucket", "h")
    index = materialise(owned.withColumns({"chain": F.row_number().over(same.orderBy("keep_chars", "keep", "n")),
                                           "chained": F.count("*").over(same)}), "index")
    at = ["bucket", "h"]
    copies = index.where("chained = 1 AND n > 1").select(*at, "chain", "n", "keep", "keep_chars")
    clash = materialise(index.where("chained > 1").select(*at).distinct(), "clashes")
    clear = found(light).join(clash, at, "left_anti").join(copies, at, "left")
    out = ["id", "chars", "h", "sha", "bucket", "chain", "n", "keep", "keep_chars"]
    if clash.isEmpty():
        return clear.select(*out)
    met = found(base.withColumn("sha", F.unhex(F.sha2("norm", 256)))).join(clash, at, "left_semi")
    chains = materialise(_entry([*at, "norm"])(met).withColumn("chain", F.row_number().over(same.orderBy("norm"))), "chains")
    return clear.select(*out).unionByName(met.join(chains, [*at, "norm"]).select(*out))


def exact_groups(docs: DataFrame, key: str = "doc_id", text: str = "text", capacity: int = CAPACITY,
                 hashed: Callable[[Column], Column] = F.xxhash64) -> DataFrame:
    """One row per document: (key, keep_id, group_size, kept, chars, h, text_sha256).

    Of texts that are equal without white space the row with the most code points, then the smallest key stays. Null texts
    are empty and equal each other. Keys are whole numbers; a null key counts as larger than any other. Rows that repeat key
    and text are all marked kept if their key stays (``deduplicate`` leaves one). Other columns are ignored, an empty table
    gives no rows. Only entries with copies are joined back, and a text with very many copies meets its single entry in a
    join that Spark may split. ``hashed`` gives the 64-bit hash; results don't depend on it.
    """
    rows = docs.select(F.col(f"`{key}`").alias("id"), F.col(f"`{text}`").alias("text"))
    own = F.coalesce(F.col("n"), F.lit(1)) == 1
    return _groups(rows, capacity, hashed).select(
        F.col("id").alias(key), F.when(own, F.col("id")).otherwise(F.col("keep")).alias("keep_id"),
        F.coalesce("n", F.lit(1).cast("long")).alias("group_size"),
        (own | (F.col("id").eqNullSafe(F.col("keep")) & (F.col("chars") == F.col("keep_chars")))).alias("kept"),
        "chars", "h", F.lower(F.hex("sha")).alias("text_sha256"))


def deduplicate(docs: DataFrame, key: str = "doc_id", text: str = "text", capacity: int = CAPACITY,
                hashed: Callable[[Column], Column] = F.xxhash64) -> DataFrame:
    """The documents that stay, with their columns, of any names: exactly one row of each group of equal texts.

    It is the row that ``exact_groups`` keeps, any one of rows that repeat its key and length. An empty table gives no rows.
    The documents are read again to leave out what goes, they aren't written in between.
    """
    doc = F.struct(*[F.col(f"`{c}`") for c in docs.columns]).alias("doc")
    rows = docs.select(doc).select("doc", F.col(f"doc.`{key}`").alias("id"), F.col(f"doc.`{text}`").alias("text"))
    at = ["id", "chars", "sha"]
    copies = materialise(_groups(rows.select("id", "text"), capacity, hashed).where("n > 1").select(
        *at, (F.col("id").eqNullSafe(F.col("keep")) & (F.col("chars") == F.col("keep_chars"))).alias("kept")).groupBy(*at).agg(
        F.first("kept").alias("kept"), F.count("*").alias("rows")), "copies")
    named = rows.select("doc", "id", F.length(whole("text")).cast("long").alias("chars"),
                        F.unhex(F.sha2(squeezed(whole("text")), 256)).alias("sha"))
    leave = copies.where("NOT kept OR rows > 1")
    match = (named["id"].eqNullSafe(leave["id"])) & (named["chars"] == leave["chars"]) & (named["sha"] == leave["sha"])
    stay = named.join(leave, match, "left_anti").select("doc.*")
    twins = copies.where("kept AND rows > 1")
    if twins.isEmpty():
        return stay
    match = (named["id"].eqNullSafe(twins["id"])) & (named["chars"] == twins["chars"]) & (named["sha"] == twins["sha"])
    one = named.join(twins, match, "left_semi").groupBy(*at).agg(F.first("doc").alias("doc"))
    return stay.unionByName(one.select("doc.*"))
