"""Merkle manifest of a table: a postorder append log per source, and proofs addressed by closed-form positions.

Rows are leaves of their source's tree in the order of their keys; runs of 16 nodes have one parent, the last run may be shorter.
Aligned builders each own 16^3 consecutive leaves and append every node to their log the moment it is complete, that is in
postorder. Subtrees therefore have known sizes, and a node's place in the log follows from its level and index alone
(``position``): proofs read siblings at computed places and search nothing. The tops of the builders are the leaves of the next
stage of builders, so a source of any size is shared out evenly; the subroots of all sources are the leaves of one more tree.

Logs are written tables in the shared folder, one row per builder: a lost executor repeats its builders only.
"""

from __future__ import annotations

from dataclasses import dataclass
from hashlib import sha256

import pyarrow as pa
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from lakegauge.session import materialise

FAN, HEIGHT = 16, 3
_PATH = "array<struct<left: string, right: string>>"


def _h(text: str) -> str:
    return sha256(text.encode()).hexdigest()


def levels(n: int, limit: int) -> int:
    """Levels above ``n`` leaves until one node remains, ``limit`` at most."""
    h = 0
    while h < limit and FAN ** h < n:
        h += 1
    return h


def position(level: int, index: int, n: int, height: int) -> int:
    """Place of a node in the log of a builder of ``n`` leaves.

    A full node is complete with its last leaf, before which all smaller subtrees to the left are; nodes over the short
    last runs follow after the last leaf, from the lowest level up.
    """
    last = (index + 1) * FAN ** level - 1
    if last < n:
        return sum(last // FAN ** t for t in range(height + 1)) + level
    return sum(n // FAN ** t for t in range(height + 1)) + sum(n % FAN ** t > 0 for t in range(1, level))


def append_log(leaves: list[str], height: int) -> list[str]:
    """All nodes over ``leaves`` in completion order."""
    log, waiting = [], [[] for _ in range(height + 1)]

    def close(level):
        run, waiting[level] = waiting[level], []
        complete(level + 1, _h("".join(run)))

    def complete(level, digest):
        log.append(digest)
        waiting[level].append(digest)
        if level < height and len(waiting[level]) == FAN:
            close(level)

    for d in leaves:
        complete(0, d)
    for level in range(height):
        if waiting[level]:
            close(level)
    return log


class Siblings:
    """Siblings of a builder's leaves, read from its log at computed places."""

    def __init__(self, log: bytes, n: int, height: int):
        self.log, self.n, self.height, self.runs = log, n, height, {}

    def _run(self, level: int, run: int) -> list[str]:
        if (level, run) not in self.runs:
            end = min((run + 1) * FAN, -(-self.n // FAN ** level))
            at = (position(level, k, self.n, self.height) * 32 for k in range(run * FAN, end))
            self.runs[level, run] = [self.log[a:a + 32].hex() for a in at]
        return self.runs[level, run]

    def of(self, leaf: int) -> list[tuple[str, str]]:
        """Digests to the left and to the right of the path from a leaf, level by level."""
        out = []
        for level in range(self.height):
            index = leaf // FAN ** level
            run, own = self._run(level, index // FAN), index % FAN
            out.append(("".join(run[:own]), "".join(run[own + 1:])))
        return out


def fold(digest: str, path: list[tuple[str, str]]) -> str:
    """Root that a digest and its siblings give."""
    for left, right in path:
        digest = _h(left + digest + right)
    return digest


def _field(value: Column) -> Column:
    s = value.cast("string")
    return F.coalesce(F.concat(F.octet_length(s).cast("string"), F.lit(":"), s), F.lit("-"))


def digest_of(columns: list[str], **instead: Column) -> Column:
    """SHA-256 of the columns, each by length and value, so that no two rows share an input."""
    return F.sha2(F.concat(*[_field(instead.get(c, F.col(c))) for c in columns]), 256)


def _ranked(rows: DataFrame, order: list[str]) -> DataFrame:
    """Adds ``rank`` within ``grp`` and ``n``, the rows of it: ranges of the order, sorted apart, and sums of their counts."""
    parts = materialise(rows.repartitionByRange("grp", *order).withColumn("part", F.spark_partition_id()), "ranges")
    count = materialise(parts.groupBy("grp", "part").agg(F.count("*").alias("rows")), "counts")
    before = Window.partitionBy("grp").orderBy("part").rowsBetween(Window.unboundedPreceding, -1)
    base = count.select("grp", "part", F.coalesce(F.sum("rows").over(before), F.lit(0)).alias("base"),
                        F.sum("rows").over(Window.partitionBy("grp")).alias("n"))
    own = F.row_number().over(Window.partitionBy("grp", "part").orderBy(*order)) - 1
    return parts.withColumn("own", own).join(base, ["grp", "part"]).withColumn("rank", F.col("base") + F.col("own")).drop(
        "own", "base", "part")


def _builder(height: int):
    def build(table: pa.Table) -> pa.Table:
        t = table.sort_by("rank")
        log = append_log([d.hex() for d in t["digest"].to_pylist()], levels(t["n"][0].as_py(), height))
        return pa.table({"grp": t["grp"][:1], "block": t["block"][:1], "total": t["n"][:1],
                         "leaves": pa.array([len(t)], pa.int64()), "log": pa.array([bytes.fromhex("".join(log))], pa.binary())})
    return build


@dataclass
class Tower:
    """Logs of all stages (grp, block, total, leaves, log), lowest first, and the root (grp, digest) of each group."""
    stages: list[DataFrame]
    roots: DataFrame


def tower(leaves: DataFrame, height: int) -> Tower:
    """Builds the trees of ``leaves`` (grp, rank, n, digest), one per group, by stages of builders of ``height`` levels."""
    stages, roots, own = [], [], FAN ** height
    while True:
        logs = materialise(leaves.select("grp", "rank", "n", "digest", F.expr(f"rank div {own}").alias("block")).groupBy(
            "grp", "block").applyInArrow(_builder(height), "grp string, block long, total long, leaves long, log binary"), "log")
        tops = logs.select("grp", F.col("block").alias("rank"), "total", F.expr("substring(log, -32, 32)").alias("digest"))
        stages.append(logs)
        roots.append(tops.where(F.col("total") <= own).select("grp", "digest"))
        more = tops.where(F.col("total") > own)
        if more.isEmpty():
            break
        leaves = more.select("grp", "rank", F.expr(f"(total + {own - 1}) div {own}").alias("n"), "digest")
    every = roots[0]
    for r in roots[1:]:
        every = every.unionByName(r)
    return Tower(stages, materialise(every, "roots"))


def _paths(rows: DataFrame, logs: DataFrame, above: DataFrame, result: str, make, height: int) -> DataFrame:
    """``make(row, path, builder)`` for all ``rows`` (grp, rank, ...).

    A row's path has its siblings in ``logs`` and then those in ``above`` (grp, block, path, ...).
    """
    fields = [f.split() for f in result.replace(_PATH, "path").split(", ")]
    arrow = {"string": pa.string(), "long": pa.int64(), "boolean": pa.bool_(),
             "path": pa.list_(pa.struct([("left", pa.string()), ("right", pa.string())]))}

    def run(left: pa.Table, right: pa.Table) -> pa.Table:
        (seg,) = right.to_pylist()
        siblings = Siblings(seg["log"], seg["leaves"], levels(seg["total"], height))
        top = [(p["left"], p["right"]) for p in seg["path"]]
        made = [make(r, siblings.of(r["rank"] % FAN ** height) + top, seg) for r in left.to_pylist()]
        return pa.table({k: pa.array([m[k] for m in made], arrow[t]) for k, t in fields})

    segments = logs.join(above, ["grp", "block"])
    block = F.expr(f"rank div {FAN ** height}").alias("block")
    return rows.select("*", block).groupBy("grp", "block").cogroup(segments.groupBy("grp", "block")).applyInArrow(run, result)


def _above(t: Tower, ends: DataFrame, height: int) -> DataFrame:
    """Paths (grp, block, path) from the tops of the lowest builders upwards; ``ends`` (grp, path) are those of the roots."""
    path, own = None, FAN ** height
    for logs, lower in reversed(list(zip(t.stages, [None, *t.stages]))):
        single = logs.where(F.col("total") <= own).select("grp", "block").join(ends, "grp")
        path = single if path is None else path.unionByName(single)
        if lower is None:
            return path
        path = materialise(_paths(lower.where(F.col("total") > own).select("grp", F.col("block").alias("rank")), logs, path,
                                  f"grp string, block long, path {_PATH}",
                                  lambda r, p, _: {"grp": r["grp"], "block": r["rank"], "path": [
                                      {"left": a, "right": b} for a, b in p]}, height), "paths")


def manifest(docs: DataFrame, key: str = "doc_id", group: str = "source",
             columns: tuple[str, ...] = ("doc_id", "source", "lang", "n_chars", "text"), tamper: dict[str, Column] | None = None,
             tampered: Column | None = None, height: int = HEIGHT) -> DataFrame:
    """One row per row of ``docs``: (key, leaf, subroot, root, proof_sha256, folded_root, verified).

    A leaf hashes ``columns``, each ``-`` if null, else byte length, ``:`` and value. ``tamper`` gives changed values of columns
    for the rows where ``tampered`` holds; their ``folded_root`` is folded from the changed leaf and the original siblings.
    Keys that are null come first, as does the null group; rows with equal keys are ordered by their leaves, so equal rows
    share all that doesn't depend on their places. Other columns are ignored; an empty table gives no rows. Texts are
    hashed where they are read, only digests are shuffled. A builder owns
    16^``height`` leaves.
    """
    grp = F.coalesce(F.concat(F.lit("="), F.col(group).cast("string")), F.lit(""))
    forged = F.when(tampered, F.unhex(digest_of(list(columns), **(tamper or {})))) if tampered is not None else F.lit(None).cast("binary")
    leaves = materialise(docs.select(grp.alias("grp"), F.col(key).alias("key"), F.unhex(digest_of(list(columns))).alias("digest"),
                                     forged.alias("forged"), F.monotonically_increasing_id().alias("row")), "leaves")
    ranked = materialise(_ranked(leaves, ["key", "digest", "row"]).drop("row"), "ranked")
    trees = tower(ranked.select("grp", "rank", "n", "digest"), height)
    tops = materialise(_ranked(trees.roots.withColumn("name", F.col("grp")).withColumn("grp", F.lit("")), ["name"]), "subroots")
    whole = tower(tops.select("grp", "rank", "n", "digest"), height)
    root = [bytes(r["digest"]).hex() for r in whole.roots.take(1)] or [None]
    start = _above(whole, whole.roots.select("grp", F.array().cast(_PATH).alias("path")), height)
    ends = materialise(_paths(tops.select("grp", "rank", "name"), whole.stages[0], start, f"grp string, path {_PATH}",
                              lambda r, p, _: {"grp": r["name"], "path": [{"left": a, "right": b} for a, b in p]}, height), "ends")
    above = _above(trees, ends, height)

    def prove(r, path, builder):
        leaf = r["digest"].hex()
        folded = fold(r["forged"].hex() if r["forged"] else leaf, path)
        return {"key": r["key"], "leaf": leaf, "subroot": bytes(builder["subroot"]).hex(), "proof_sha256": _h("".join(a + b for a, b in path)),
                "folded_root": folded, "verified": folded == root[0]}

    subroots = trees.roots.select("grp", F.col("digest").alias("subroot"))
    return _paths(ranked.select("grp", "rank", F.col("key").cast("long"), "digest", "forged"), trees.stages[0],
                  above.join(subroots, "grp"), "key long, leaf string, subroot string, proof_sha256 string, folded_root string, "
                  "verified boolean", prove, height).select(
        F.col("key").alias(key), "leaf", "subroot", F.lit(root[0]).alias("root"), "proof_sha256", "folded_root", "verified")
