"""Near-duplicate vectors through randomly rotated binary codes.

A unit vector is rotated at random and coded by the signs of its coordinates; the code's own inner product with the vector is
stored as its correction factor. The product of one vector's code with another's rotated coordinates (kept in four bits each),
divided by the factor, is an unbiased estimate of their cosine, with an error whose spread is known. Only pairs whose confidence
bound reaches the threshold are computed exactly, from the vectors in double precision, and only these can link.

Pairs meet in buckets: bands of the sign bits of as many rotations as the number of rows asks for, so that a pair at the
threshold misses all bands with probability ``MISS`` at most. A pair counts in the first band it shares. Buckets are judged by
one task each, first on codes alone; vectors are only fetched for rows that have an open pair there. Tasks emit
one row per member, links counted and a local component, never pairs.

A bucket that outgrows a task is dealt out in blocks, and every two blocks meet in a task of their own. Before that, dense groups
are taken out of the square: vectors within half the threshold's angle of a common centre are all linked by the triangle
inequality, so members of such a ball are counted by its size and never compared. What stays costly is a dense group
that is wider than that. Equal vectors are one class from the start and count by their number.
"""

from __future__ import annotations

from collections.abc import Iterator
from hashlib import blake2b
from math import ceil, log, log2

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from lakegauge.llm.common import bounded_batches
from lakegauge.llm.minhash import components
from lakegauge.session import materialise

#: rows a task compares with each other, rows a bucket of unrelated vectors holds on average, at most
BLOCK, FILL = 2048, 1024
#: probability that a pair right at the threshold meets in no band; spreads an estimate may be off before a pair is ruled out
MISS, SPREADS = 1e-3, 5.0
_SEED = 20240229
_SKETCH = "id long, c binary, d int, code binary, q binary, f float, step float, keys array<bigint>"


def bands(rows: int, threshold: float, fill: int = FILL, miss: float = MISS) -> tuple[int, int]:
    """Bits per band and number of bands for a table of ``rows``."""
    bits = max(0, ceil(log2(rows / fill))) if rows > fill else 0
    meet = (1 - np.arccos(threshold) / np.pi) ** bits
    return bits, 1 if bits == 0 else ceil(log(miss) / log(1 - meet))


def rotation(dims: int, turn: int) -> np.ndarray:
    """A random orthogonal matrix, the same in every task."""
    q, r = np.linalg.qr(np.random.default_rng([_SEED, dims, turn]).standard_normal((dims, dims)))
    return q * np.sign(np.diag(r))


class Coder:
    """Codes of unit vectors of one length: sign bits of all rotations, correction factors, coordinates in four bits."""

    def __init__(self, dims: int, bits: int, count: int):
        self.dims, self.bits, self.count = dims, bits, count
        self.wide = 64 * ceil(dims / 64)                   # short vectors are padded: the error falls with the length
        turns = max(1, ceil(bits * count / self.wide))
        self.turns = [rotation(self.wide, t)[:dims] for t in range(turns)]

    def __call__(self, unit: np.ndarray):
        turned = [unit @ t for t in self.turns]
        signs = np.concatenate([t >= 0 for t in turned], axis=1)
        factor = np.abs(turned[0]).sum(axis=1) / self.wide ** 0.5
        step = np.maximum(np.abs(turned[0]).max(axis=1), 1e-30) / 7
        four = (np.rint(turned[0] / step[:, None]) + 8).astype(np.uint8)
        return signs, factor, four, step

    def keys(self, signs: np.ndarray) -> np.ndarray:
        """One key per band: the band's number and its bits."""
        own = signs[:, :self.bits * self.count].reshape(len(signs), self.count, self.bits).astype(np.int64)
        return (np.arange(self.count) << 40) + own @ (1 << np.arange(self.bits, dtype=np.int64))


def _vectors(column: pa.Array) -> Iterator[tuple[int, np.ndarray, np.ndarray]]:
    """(length, rows, unit-free values) of the usable vectors: not null or empty, finite, not zero."""
    if isinstance(column, pa.ChunkedArray):
        column = column.combine_chunks()
    size = np.where(column.is_valid().to_numpy(zero_copy_only=False), np.diff(column.offsets.to_numpy()), 0)
    values = column.values
    flat = values.to_numpy(zero_copy_only=False).astype(np.float64) if len(values) else np.empty(0)
    if values.null_count:
        flat = np.where(values.is_valid().to_numpy(zero_copy_only=False), flat, np.nan)
    first = column.offsets.to_numpy()[:-1]
    for w in np.unique(size[size > 0]).tolist():
        rows = np.flatnonzero(size == w)
        v = flat[first[rows][:, None] + np.arange(w)]
        good = np.isfinite(v).all(axis=1) & (v != 0).any(axis=1)
        if good.any():
            yield w, rows[good], v[good] + 0.0             # -0.0 equals 0.0


def unit(v: np.ndarray) -> np.ndarray:
    """Rows of length one; scaled by their largest component first, so that no square overflows."""
    v = v / np.abs(v).max(axis=1, keepdims=True)
    return v / np.sqrt((v * v).sum(axis=1, keepdims=True))


def _names(v: np.ndarray) -> list[bytes]:
    return [blake2b(r.tobytes(), digest_size=16).digest() for r in v]


def _sketches(bits: int, count: int):
    def run(batches: Iterator[pa.RecordBatch]):
        coders = {}
        for b in batches:
            out = {k: [None] * b.num_rows for k in ("c", "d", "code", "q", "f", "step", "keys")}
            for w, rows, v in _vectors(b.column(1)):
                coder = coders.setdefault(w, Coder(w, bits, count))
                signs, factor, four, step = coder(unit(v))
                code = np.packbits(signs, axis=1)
                cells = zip(_names(v), [w] * len(v), [r.tobytes() for r in code],
                            [r.tobytes() for r in four[:, ::2] << 4 | four[:, 1::2]], factor.tolist(), step.tolist(),
                            coder.keys(signs).tolist())
                for i, row in zip(rows.tolist(), cells):
                    for k, x in zip(out, row):
                        out[k][i] = x
            types = (pa.binary(), pa.int32(), pa.binary(), pa.binary(), pa.float32(), pa.float32(), pa.list_(pa.int64()))
            yield pa.RecordBatch.from_arrays([b.column(0), *[pa.array(x, t) for x, t in zip(out.values(), types)]],
                                             names=["id", *out])
    return run


def _of_classes(batches: Iterator[pa.RecordBatch]):
    """(c, v) of the usable rows of a column of vectors."""
    for b in batches:
        for _, _, v in _vectors(b.column(0)):
            yield pa.RecordBatch.from_arrays([pa.array(_names(v), pa.binary()), pa.array(list(v), pa.list_(pa.float64()))],
                                             names=["c", "v"])


def _bits(column, n: int) -> np.ndarray:
    return np.unpackbits(np.frombuffer(b"".join(column.to_pylist()), np.uint8).reshape(n, -1), axis=1)


class Judge:
    """Open pairs of one task: members of two blocks, or of one."""

    def __init__(self, t: pa.Table, bits: int, count: int, threshold: float):
        self.bits, self.count, self.t = bits, count, threshold
        n = len(t)
        self.side = t["side"].to_numpy()
        self.ball = t["ball"].to_numpy(zero_copy_only=False)
        self.d, self.band = t["d"][0].as_py(), int(t["k"][0].as_py() >> 40)
        wide = 64 * ceil(self.d / 64)
        signs = _bits(t["code"], n)
        four = np.frombuffer(b"".join(t["q"].to_pylist()), np.uint8).reshape(n, -1)
        levels = np.stack([four >> 4, four & 15], axis=2).reshape(n, wide).astype(np.float32) - 8
        self.turned = levels * t["step"].to_numpy()[:, None]
        self.f = t["f"].to_numpy().astype(np.float32)
        self.signs = (signs[:, :wide].astype(np.float32) * 2 - 1) / np.float32(wide ** 0.5)
        self.keys = np.stack([signs[:, i * bits:(i + 1) * bits] @ (1 << np.arange(bits)) for i in range(self.band)],
                             axis=1) if bits and self.band else np.empty((n, 0), int)
        # the estimate's spread at the threshold: the code's share, and that of rounding to four bits
        code = (1 - threshold ** 2) * np.maximum(1 - self.f ** 2, 0) / self.f ** 2 / (wide - 1)
        rounding = float(t["step"].to_numpy().max()) ** 2 / 12 / self.f ** 2
        self.least = threshold - SPREADS * np.sqrt(code + rounding)

    def rows(self) -> Iterator[tuple[int, np.ndarray]]:
        """Per member (with it as the coded side), the members it has an open pair with."""
        two = self.side.max() > 0
        others = np.flatnonzero(self.side == 1) if two else np.arange(len(self.side))
        ours = np.flatnonzero(self.side == 0)
        for at in range(0, len(ours), 256):
            a = ours[at:at + 256]
            estimate = self.signs[a] @ self.turned[others].T / self.f[a][:, None]
            ok = estimate >= self.least[a][:, None]
            for i, row in zip(a.tolist(), ok):
                j = others[row]
                if not two:
                    j = j[j > i]
                if self.ball[i] >= 0:
                    j = j[self.ball[j] != self.ball[i]]
                if len(j) and self.keys.shape[1]:              # a pair counts in the first band it shares
                    j = j[~(self.keys[j] == self.keys[i]).any(axis=1)]
                if len(j):
                    yield i, j


def _open(bits: int, count: int, threshold: float):
    """Members (d, k, p, side, c) that have an open pair."""
    def run(t: pa.Table) -> pa.Table:
        t = t.sort_by([("side", "ascending"), ("c", "ascending")])
        hit = np.zeros(len(t), bool)
        for i, j in Judge(t, bits, count, threshold).rows() if len(t) > 1 else ():
            hit[i] = hit[j] = True
        return t.filter(pa.array(hit)).select(["d", "k", "p", "side", "c", "ball"])
    return run


def _settle(bits: int, count: int, threshold: float):
    """Links of each member (c, links) and a local component (c, root), from exact cosines of the open pairs."""
    def run(t: pa.Table) -> pa.Table:
        t = t.sort_by([("side", "ascending"), ("c", "ascending")])
        n = len(t)
        v = unit(t["v"].combine_chunks().flatten().to_numpy().reshape(n, -1))
        coder = Coder(v.shape[1], bits, count)
        signs, factor, four, step = coder(v)
        code = [r.tobytes() for r in np.packbits(signs, axis=1)]
        cells = {"code": pa.array(code, pa.binary()), "q": pa.array([r.tobytes() for r in four[:, ::2] << 4 | four[:, 1::2]]),
                 "f": pa.array(factor, pa.float32()), "step": pa.array(step, pa.float32())}
        for k, x in cells.items():
            t = t.append_column(k, x)
        copies, links, root = t["copies"].to_numpy(), np.zeros(n, np.int64), np.arange(n)

        def top(i):
            while root[i] != i:
                root[i] = root[root[i]]
                i = root[i]
            return i

        for i, j in Judge(t, bits, count, threshold).rows():
            j = j[v[j] @ v[i] >= threshold]
            if len(j):
                links[i] += copies[j].sum()
                links[j] += copies[i]
                tops = {top(i), *(top(x) for x in np.unique(root[j]).tolist())}
                least = min(tops)
                for x in tops:
                    root[x] = least
                root[j] = least
        names = t["c"].to_pylist()
        rows = np.flatnonzero(links)
        return pa.table({"c": pa.array([names[i] for i in rows], pa.binary()), "links": pa.array(links[rows]),
                         "root": pa.array([names[top(i)] for i in rows], pa.binary())})
    return run


def _means(entries: DataFrame, near: float | None) -> DataFrame:
    """Unit mean (k, centre) of the vectors (k, v) of each key; with ``near``, of those that close to ``centre`` only."""
    def batch(total):
        return pa.RecordBatch.from_arrays([
            pa.array([d for d, _ in total], pa.int32()), pa.array([k for _, k in total], pa.int64()),
            pa.array(list(total.values()), pa.list_(pa.float64()))], names=["d", "k", "sum"])

    def part(batches: Iterator[pa.RecordBatch]):
        total = {}
        for b in batches:
            for r in b.to_pylist():
                u = unit(np.array([r["v"]]))[0]
                if near is None or u @ np.array(r["centre"]) >= near:
                    total[r["d"], r["k"]] = total.get((r["d"], r["k"]), 0) + u
            if len(total) > 4096:                          # partial sums, so a task holds few at a time
                yield batch(total)
                total = {}
        yield batch(total)

    def whole(t: pa.Table) -> pa.Table:
        s = np.array(t["sum"].to_pylist()).sum(axis=0)
        keep = t.slice(0, 1 if np.any(s != 0) else 0).select(["d", "k"])
        return keep.append_column("centre", pa.array([unit(s[None])[0]] * len(keep), pa.list_(pa.float64())))

    return entries.mapInArrow(part, "d int, k long, sum array<double>").groupBy("d", "k").applyInArrow(
        whole, "d int, k long, centre array<double>")


def _balls(heavy: DataFrame, entries: DataFrame, vectors: DataFrame, bits: int, count: int, threshold: float) -> DataFrame:
    """(c, ball) of the classes in ``heavy`` buckets (d, k, n) that lie within half the threshold's angle of a common centre.

    Each heavy bucket offers the mean of its dense part, found from its plain mean in two more steps. Centres are coded as vectors
    are, and a class takes, of the centres that share a bucket with it and are close enough, the one of the largest bucket:
    all buckets of one dense group so agree on one centre.
    """
    member = materialise(entries.select("d", "k", "c").join(heavy, ["d", "k"]), "heavy")
    chosen = member.groupBy("c").agg(F.max_by(F.struct("d", "k"), F.struct("n", "k")).alias("b")).select("c", "b.d", "b.k")
    v = materialise(vectors.join(member.select("c").distinct(), "c"), "heavy-vectors")
    own = materialise(chosen.join(v, "c"), "chosen")
    centre = materialise(_means(own, None), "centres")
    for near in (0.5 * threshold, threshold):
        centre = materialise(_means(own.join(centre, ["d", "k"]), near), "centres")

    def code(batches: Iterator[pa.RecordBatch]):
        for b in batches:
            rows = []
            for r in b.to_pylist():
                c = np.array([r["centre"]])
                coder = Coder(c.shape[1], bits, count)
                rows += [{"d": r["d"], "k": k, "own": r["k"]} for k in coder.keys(coder(c)[0])[0].tolist()]
            yield pa.RecordBatch.from_pylist(rows, schema=pa.schema([("d", pa.int32()), ("k", pa.int64()), ("own", pa.int64())]))

    close = float(np.cos(np.arccos(threshold) / 2)) + 1e-9

    def inside(batches: Iterator[pa.RecordBatch]):
        for b in batches:
            rows = b.to_pylist()
            hit = [i for i, r in enumerate(rows) if unit(np.array([r["v"]]))[0] @ np.array(r["centre"]) >= close]
            yield b.select(["c", "own", "size"]).take(pa.array(hit, pa.int64()))

    offered = centre.mapInArrow(code, "d int, k long, own long").join(
        heavy.select("d", F.col("k").alias("own"), F.col("n").alias("size")), ["d", "own"])
    seen = member.select("d", "k", "c").join(offered, ["d", "k"]).select("d", "c", "own", "size").distinct()
    asked = seen.join(centre.withColumnRenamed("k", "own"), ["d", "own"]).join(v, "c").select("c", "own", "size", "centre", "v")
    return materialise(asked.mapInArrow(inside, "c binary, own long, size long").groupBy("c").agg(
        F.max_by("own", F.struct("size", "own")).alias("ball")), "balls")


def _dealt(entries: DataFrame, heavy: DataFrame, block: int) -> DataFrame:
    """Members of heavy buckets once per pair of blocks (p) they take part in; blocks of one ball don't meet each other."""
    own = entries.join(heavy.select("d", "k"), ["d", "k"])
    size = materialise(own.groupBy("d", "k", "ball").agg(F.ceil(F.count("*") / block).cast("long").alias("blocks")), "blocks")
    one, two = (size.select("d", "k", F.col("ball").alias(f"b{s}"), F.col("blocks").alias(f"n{s}")) for s in (1, 2))
    pairs = one.join(two, ["d", "k"]).where("b1 < b2 OR (b1 = b2 AND b1 < 0)").withColumn(
        "i", F.explode(F.sequence(F.lit(0).cast("long"), F.col("n1") - 1))).withColumn(
        "j", F.explode(F.sequence(F.when(F.col("b1") == F.col("b2"), F.col("i")).otherwise(F.lit(0).cast("long")), F.col("n2") - 1)))
    pairs = materialise(pairs.select("d", "k", "b1", "i", "b2", "j", F.monotonically_increasing_id().alias("p")), "block-pairs")
    placed = own.join(size, ["d", "k", "ball"]).withColumn("i", F.pmod(F.xxhash64("c"), "blocks"))
    first = placed.join(pairs.select("d", "k", F.col("b1").alias("ball"), "i", "p"), ["d", "k", "ball", "i"])
    other = placed.join(pairs.where("b1 <> b2 OR i <> j").select("d", "k", F.col("b2").alias("ball"), F.col("j").alias("i"), "p"),
                        ["d", "k", "ball", "i"])
    return first.withColumn("side", F.lit(0)).unionByName(other.withColumn("side", F.lit(1))).drop("blocks", "i")


def near_vectors(vectors: DataFrame, key: str = "vec_id", vector: str = "embedding", threshold: float = 0.95, fill: int = FILL,
                 block: int = BLOCK) -> DataFrame:
    """One row per row of ``vectors``: (key, n_links, component_id, kept).

    Two vectors link if their cosine, from exact double precision, is ``threshold`` or more; a pair right at it is
    missed with probability ``MISS`` at most, one at 0.97 less than 1e-4. ``n_links`` counts the other rows linked directly, equal
    vectors included, ``component_id`` is the smallest key of the component and ``kept`` tells whether it is the row's own. Vectors
    that are null, empty, zero or hold null or non-finite components link with nothing, nor do vectors of different
    lengths. Rows that repeat a key are vectors of their own, all kept if their key is the smallest. A null key counts as larger than
    any other: a component without keys has a null id, and its rows are all kept. Keys are whole numbers; other columns are
    ignored; an empty table gives no rows.
    """
    if not 0 < threshold < 1:
        raise ValueError("the threshold is a cosine above 0 and below 1")
    bounded_batches(vectors.sparkSession, 4096)
    bits, count = bands(vectors.count(), threshold, fill)
    raw = F.col(vector).cast("array<double>").alias("v")
    rows = materialise(vectors.select(F.col(key).cast("long").alias("id"), raw).mapInArrow(_sketches(bits, count), _SKETCH), "codes")
    twice = materialise(rows.where("c IS NOT NULL").groupBy("c").agg(F.count("*").alias("copies")).where("copies > 1"), "copies")
    usable = rows.where("c IS NOT NULL").drop("id")
    once = usable.join(twice, "c", "left_anti").unionByName(usable.join(twice, "c", "left_semi").dropDuplicates(["c"]))
    entries = once.select("c", "d", "code", "q", "f", "step", F.explode("keys").alias("k"))
    heavy = materialise(entries.groupBy("d", "k").agg(F.count("*").alias("n")).where(F.col("n") > 2 * block), "heavy")
    classes = vectors.select(raw).mapInArrow(_of_classes, "c binary, v array<double>")
    alone = F.lit(-1).cast("long")
    apart = not heavy.isEmpty()
    if apart:
        balls = _balls(heavy, entries, classes.dropDuplicates(["c"]), bits, count, threshold)
        entries = entries.join(balls, "c", "left").withColumn("ball", F.coalesce("ball", alone))
        dealt = _dealt(entries, heavy, block)
        light = entries.join(heavy, ["d", "k"], "left_anti").select("*", alone.alias("p"), F.lit(0).alias("side"))
        tasks = light.unionByName(dealt)
    else:
        tasks = entries.select("*", alone.alias("ball"), alone.alias("p"), F.lit(0).alias("side"))
    open_rows = materialise(tasks.groupBy("d", "k", "p").applyInArrow(
        _open(bits, count, threshold), "d int, k long, p long, side int, c binary, ball long"), "open")
    wanted = classes.join(open_rows.select("c").distinct(), "c").dropDuplicates(["c"])
    full = open_rows.join(wanted, "c").join(twice, "c", "left").withColumn("copies", F.coalesce("copies", F.lit(1).cast("long")))
    found = materialise(full.groupBy("d", "k", "p").applyInArrow(_settle(bits, count, threshold),
                                                                "c binary, links long, root binary"), "links")
    edges, counted = found.select(F.col("c").alias("a"), F.col("root").alias("b")), found.select("c", "links")
    if apart:
        size = balls.join(twice, "c", "left").groupBy("ball").agg(
            F.sum(F.coalesce("copies", F.lit(1))).alias("size"), F.min("c").alias("first"))
        inner = balls.join(size, "ball").join(twice, "c", "left")
        edges = edges.unionByName(inner.select(F.col("c").alias("a"), F.col("first").alias("b")))
        counted = counted.unionByName(inner.select("c", (F.col("size") - F.coalesce("copies", F.lit(1))).alias("links")))
    links = counted.groupBy("c").agg(F.sum("links").alias("links"))
    label = components(edges)
    named = rows.select("id", "c").join(label.withColumnRenamed("node", "c"), "c", "left").join(links, "c", "left").join(
        twice, "c", "left").withColumn("group", F.coalesce("label", "c"))
    named = materialise(named.select("id", "group", (F.coalesce("links", F.lit(0)) + F.coalesce("copies", F.lit(1)) - 1)
                                     .cast("long").alias("n"), (F.col("label").isNotNull() | F.col("copies").isNotNull()).alias("many")), "named")
    least = named.where("many").groupBy("group").agg(F.min("id").alias("least"))
    out = named.join(least, "group", "left").withColumn("component", F.when(F.col("many"), F.col("least")).otherwise(F.col("id")))
    return out.select(F.col("id").alias(key), F.col("n").alias("n_links"), F.col("component").alias("component_id"),
                      F.col("id").eqNullSafe(F.col("component")).alias("kept"))
