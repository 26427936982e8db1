"""Vector codes: each part of a vector is named by the nearest entry of a learned codebook.

Codebooks are learned in rounds of exact integer arithmetic. After the first round most distances are never computed: entries
lie in a few groups, and a scan of a group leaves, per part, the least distance to it (the assigned entry aside) as a lower
bound, and the round it was taken in, its stamp. All codebooks since the first are kept, so in a later round a bound loses what
the group's entries have moved *in sum* since its stamp: the norm of one net displacement, never more than the norms of the
single moves added up. Groups whose bound stays above the distance to the assigned entry can't hold a nearer one; only the
others are scanned again, exactly.

Codebooks are as large as the model (entries x dimensions) and travel with the tasks; the rows' bounds are written tables.
"""

from __future__ import annotations

from collections.abc import Iterator
from hashlib import sha256

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from lakegauge.llm.common import bounded_batches
from lakegauge.session import materialise

PARTS, ENTRIES, ROUNDS, SCALE, GROUPS = 16, 64, 2, 256, 8
#: components from here on count as not finite, so that squared distances stay within doubles; no 32-bit number gets there
LARGEST = 1e100
#: relative slack that covers the rounding of bounds in double precision
_SLACK = 1e-9
_STATE = pa.schema([("id", pa.int64()), ("label", pa.string()), ("x", pa.binary()), ("code", pa.binary()), ("low", pa.binary()),
                    ("stamp", pa.binary())])
_STATE_SQL = "id long, label string, x binary, code binary, low binary, stamp binary"


def _packed(x: np.ndarray) -> list[bytes]:
    """Each row as whole numbers of the fewest bytes that hold it; beyond 64 bits as text."""
    if x.dtype == object:
        return [b"t" + ",".join(map(str, r)).encode() for r in x]
    size = np.abs(x).max(axis=1, initial=0)
    return [b"s" + r.astype("<i2").tobytes() if m < 1 << 15 else b"i" + r.astype("<i4").tobytes() if m < 1 << 31 else
            b"l" + r.astype("<i8").tobytes() for r, m in zip(x, size.tolist())]


def _unpacked(column: pa.Array) -> np.ndarray:
    """Rows of whole numbers, exact: 64-bit numbers where no squared distance can exceed them, else Python's."""
    rows = column.to_pylist()
    kinds = {r[:1] for r in rows}
    if kinds == {b"s"}:
        return np.frombuffer(b"".join(r[1:] for r in rows), "<i2").reshape(len(rows), -1).astype(np.int64)
    out = [[int(v) for v in r[1:].split(b",")] if r[:1] == b"t" else
           np.frombuffer(r[1:], {b"s": "<i2", b"i": "<i4", b"l": "<i8"}[r[:1]]).tolist() for r in rows]
    big = max((abs(v) for r in out for v in r), default=0)
    return np.array(out, np.int64 if big < 1 << 24 else object)


def _squares(x: np.ndarray, book: np.ndarray) -> np.ndarray:
    """Exact squared distances (rows, entries); as a matrix product where doubles hold every sum of it."""
    if x.dtype != object and book.dtype != object:
        top = max(int(np.abs(x).max(initial=0)), int(np.abs(book).max(initial=0)))
        if 4 * top * top * x.shape[1] < 1 << 52:
            a, b = x.astype(np.float64), book.astype(np.float64)
            return (a * a).sum(axis=1)[:, None] - 2 * (a @ b.T) + (b * b).sum(axis=1)
    return ((x[:, None, :] - book[None]) ** 2).sum(axis=2)


def groups_of(book: np.ndarray, count: int) -> list[np.ndarray]:
    """Entries in at most ``count`` groups of neighbours: the largest group is halved along its widest coordinate."""
    groups = [np.arange(len(book))]
    while len(groups) < min(count, len(book)):
        groups.sort(key=len)
        g = groups.pop()
        spread = book[g].max(axis=0) - book[g].min(axis=0)
        order = g[np.argsort(book[g][:, int(np.argmax(spread))], kind="stable")]
        groups += [np.sort(order[:len(g) // 2]), np.sort(order[len(g) // 2:])]
    return sorted(groups, key=lambda g: int(g[0]))


def _below(distance: np.ndarray) -> np.ndarray:
    """Distances rounded down to 16 bits."""
    d = np.minimum(np.asarray(distance, np.float64) * (1 - _SLACK), 65504.0)
    out = d.astype(np.float16)
    return np.where(out > d, np.nextafter(out, np.float16(-1)), out)


def _root(squares: np.ndarray) -> np.ndarray:
    return np.sqrt(squares.astype(np.float64))


def _drift(books: list[np.ndarray], part: int, groups: list[np.ndarray]) -> np.ndarray:
    """(stamp, group): the farthest that any entry of the group has moved since, as one net displacement."""
    moved = np.stack([_root(((books[-1][part] - old[part]) ** 2).sum(axis=1)) for old in books]) * (1 + _SLACK)
    return np.stack([moved[:, g].max(axis=1) for g in groups], axis=1)


class Bounds:
    """Codes (rows, parts), and per part and group the lower bounds and their stamps (rows, parts, groups)."""

    def __init__(self, code: np.ndarray, low: np.ndarray, stamp: np.ndarray):
        self.code, self.low, self.stamp = code, low, stamp


def _first(v: np.ndarray, book: np.ndarray, groups: list[np.ndarray]):
    d = _squares(v, book)
    code = d.argmin(axis=1)
    rows = np.arange(len(v))
    best = d[rows, code]
    d = _root(d)
    d[rows, code] = np.inf
    return code, best, np.stack([d[:, g].min(axis=1) for g in groups], axis=1)


def assign(x: np.ndarray, books: list[np.ndarray], groups: list[list[np.ndarray]], old: Bounds | None = None):
    """Bounds and squared distances of rows ``x`` under the last of ``books``, and the number of groups that were scanned."""
    n, parts, now = len(x), len(books[-1]), len(books) - 1
    cut, size = x.reshape(n, parts, -1), len(groups[0])
    error = np.zeros((n, parts), np.result_type(x, books[-1]))
    if old is None:
        new = Bounds(np.zeros((n, parts), np.uint8), np.zeros((n, parts, size), np.float16), np.zeros((n, parts, size), np.uint8))
    else:
        new = Bounds(old.code.copy(), old.low.copy(), old.stamp.copy())
    step, scanned = max(1, (1 << 22) // books[-1][0].size), 0
    for p in range(parts):
        book = books[-1][p]
        drift = _drift(books, p, groups[p])
        for at in range(0, n, step):
            rows = slice(at, at + step)
            v, code = cut[rows, p], new.code[rows, p]
            if old is None:
                new.code[rows, p], error[rows, p], low = _first(v, book, groups[p])
                new.low[rows, p] = _below(low)
                scanned += low.size
                continue
            own = ((v - book[code]) ** 2).sum(axis=1)
            low = new.low[rows, p].astype(np.float64) - drift[new.stamp[rows, p], np.arange(size)]
            todo = ~(_root(own)[:, None] * (1 + _SLACK) < low)
            best, near = own.copy(), code.astype(np.int64)
            least = {}
            for g, members in enumerate(groups[p]):
                hit = np.flatnonzero(todo[:, g])
                if not len(hit):
                    continue
                d = least[g] = _squares(v[hit], book[members])
                at_g = d.argmin(axis=1)
                found, entry = d[np.arange(len(hit)), at_g], members[at_g]
                better = (found < best[hit]) | ((found == best[hit]) & (entry < near[hit]))
                best[hit[better]], near[hit[better]] = found[better], entry[better]
            for g, members in enumerate(groups[p]):
                hit = np.flatnonzero(todo[:, g])
                if len(hit):
                    d = _root(least[g])
                    d[near[hit][:, None] == members[None]] = np.inf
                    new.low[rows, p][hit, g], new.stamp[rows, p][hit, g] = _below(d.min(axis=1)), now
                left = np.flatnonzero(~todo[:, g] & (near != code) & np.isin(code, members))
                if len(left):                         # the entry left behind joins its group's bound
                    new.low[rows, p][left, g] = _below(np.maximum(np.minimum(low[left, g], _root(own[left])), 0))
                    new.stamp[rows, p][left, g] = now
            new.code[rows, p], error[rows, p] = near, best
            scanned += int(todo.sum())
    return new, error, scanned


def whole_numbers(vectors: DataFrame, key: str, vector: str, label: str) -> DataFrame:
    """(id, label, x): floor(256 * component) of each usable vector; written with all that follows in one table."""
    bounded_batches(vectors.sparkSession, 4096)
    v = F.col(vector).cast("array<double>")
    usable = v.isNotNull() & (F.size(v) > 0) & (F.size(v) % PARTS == 0) & F.forall(
        v, lambda c: c.isNotNull() & ~F.isnan(c) & (F.abs(c) < LARGEST))
    kept = vectors.select(F.col(key).cast("long").alias("id"), F.col(label).cast("string").alias("label"), v.alias("v")).where(usable)

    def run(batches: Iterator[pa.RecordBatch]):
        for b in batches:
            ids, labels = b.column(0), b.column(1)
            lists = b.column(2)
            size = np.diff(lists.offsets.to_numpy())
            flat = lists.flatten().to_numpy(zero_copy_only=False)
            at = np.concatenate([[0], np.cumsum(size)])
            x = [None] * len(size)
            for w in np.unique(size).tolist():
                rows = np.flatnonzero(size == w)
                block = np.floor(SCALE * flat[at[rows][:, None] + np.arange(w)])
                exact = block.astype(np.int64) if np.abs(block).max() < 2.0 ** 62 else np.array(
                    [[int(c) for c in r] for r in block], object)
                for i, p in zip(rows.tolist(), _packed(exact)):
                    x[i] = p
            yield pa.RecordBatch.from_arrays([ids, labels, pa.array(x, pa.binary()), pa.array(size, pa.int32())],
                                             names=["id", "label", "x", "width"])

    return kept.mapInArrow(run, "id long, label string, x binary, width int")


def _bounds(b: pa.RecordBatch, parts: int) -> Bounds | None:
    """What the round before left for the rows of a batch, nothing before the first."""
    if b.column("code").null_count:
        return None
    code, low, stamp = (np.frombuffer(b"".join(b.column(c).to_pylist()), t)
                        for c, t in (("code", np.uint8), ("low", np.float16), ("stamp", np.uint8)))
    return Bounds(code.reshape(b.num_rows, parts), *(a.reshape(b.num_rows, parts, -1) for a in (low, stamp)))


def _steps(books: list[np.ndarray], groups: list[list[np.ndarray]]):
    """One assignment round over state rows, in Arrow batches."""
    def run(batches: Iterator[pa.RecordBatch]):
        for b in batches:
            if not b.num_rows:
                continue
            new, _, _ = assign(_unpacked(b.column("x")), books, groups, _bounds(b, PARTS))
            cells = [pa.array([r.tobytes() for r in a], pa.binary()) for a in (new.code, new.low, new.stamp)]
            yield pa.RecordBatch.from_arrays([b.column("id"), b.column("label"), b.column("x"), *cells], schema=_STATE)
    return run


def _sums(entries: int, width: int):
    """Per task: (slot, total) of the counts and component sums of all entries that have parts."""
    def run(batches: Iterator[pa.RecordBatch]):
        total = {}
        for b in batches:
            if not b.num_rows:
                continue
            x = _unpacked(b.column("x"))
            code = np.frombuffer(b"".join(b.column("code").to_pylist()), np.uint8).reshape(len(x), -1)
            v = np.concatenate([np.ones((len(x), code.shape[1], 1), x.dtype), x.reshape(len(x), code.shape[1], width)], axis=2)
            slot = code + entries * np.arange(code.shape[1])
            order = np.argsort(slot, axis=None, kind="stable")
            flat, start = slot.ravel()[order], np.flatnonzero(np.diff(slot.ravel()[order], prepend=-1))
            added = np.add.reduceat(v.reshape(-1, width + 1)[order], start, axis=0)
            for s, row in zip(flat[start].tolist(), added.tolist()):
                total[s] = [a + c for a, c in zip(total[s], row)] if s in total else row
        rows = [(s * (width + 1) + i, limb, v) for s, row in total.items() for i, t in enumerate(row) for limb, v in _limbs(t)]
        yield pa.RecordBatch.from_arrays([pa.array(c, pa.int64()) for c in (zip(*rows) if rows else ([], [], []))],
                                         names=["slot", "limb", "total"])
    return run


def _limbs(number: int):
    """A whole number as digits of 48 bits, the last one signed: they can be added up apart without overflow."""
    limb = 0
    while not -(1 << 47) <= number < 1 << 47:
        yield limb, number & ((1 << 48) - 1)
        number, limb = number >> 48, limb + 1
    yield limb, number


def _moved(book: np.ndarray, totals: dict[int, int]) -> np.ndarray:
    """The next codebook: floored means, entries without parts as they were."""
    parts, entries, width = book.shape
    out = book.astype(object)
    for p in range(parts):
        for e in range(entries):
            first = (p * entries + e) * (width + 1)
            if n := totals.get(first, 0):
                out[p, e] = [totals[first + 1 + i] // n for i in range(width)]
    big = max(map(abs, out.ravel().tolist()))
    return out.astype(np.int64) if big < 1 << 24 else out


def _finish(books: list[np.ndarray], groups: list[list[np.ndarray]]):
    def run(batches: Iterator[pa.RecordBatch]):
        for b in batches:
            if not b.num_rows:
                continue
            new, error, _ = assign(_unpacked(b.column("x")), books, groups, _bounds(b, PARTS))
            sums = [s if abs(s) < 1 << 63 else None for s in map(int, error.sum(axis=1))]
            yield pa.RecordBatch.from_arrays([b.column("id"), b.column("label"), pa.array([r.tobytes().hex() for r in new.code]),
                                              pa.array(sums, pa.int64())], names=["id", "label", "code", "error"])
    return run


def compress(vectors: DataFrame, key: str = "vec_id", vector: str = "embedding", label: str = "label", entries: int = ENTRIES,
             rounds: int = ROUNDS) -> tuple[DataFrame, list[np.ndarray]]:
    """Codes of all usable vectors, (key, label, code, error), and the codebooks of all rounds (parts, entries, width).

    Null vectors and vectors with null or non-finite components (``LARGEST``) are left out, as are empty ones, those that cannot be cut into
    16 equal parts and those of another length than the vector with the smallest key; rows that repeat are vectors of their
    own. The first codebook has the vectors of the ``entries`` smallest keys (nulls last, equal keys in a fixed order), fewer if there
    are fewer. ``code`` is a hex string of two digits per part, ``error`` the squared distances summed over parts. Labels come
    back as text. An empty table gives no rows and no codebooks. Numbers are exact at any size, but an error or sum of errors beyond
    64 bits is null. Other columns are ignored.
    """
    if not (1 <= entries <= 256 and 0 <= rounds < 256):
        raise ValueError("codes and stamps are bytes: 1 to 256 entries, fewer than 256 rounds")
    start = materialise(whole_numbers(vectors, key, vector, label), "numbers")
    head = lambda rows, n: rows.orderBy(F.col("id").asc_nulls_last(), "x").limit(n).collect()
    first = head(start, 1)
    if not first:
        return start.select(F.col("id").alias(key), "label", F.lit("").alias("code"), F.lit(0).cast("long").alias("error")), []
    width = first[0]["width"]
    start = start.where(F.col("width") == width)
    seeds = _unpacked(pa.array([r["x"] for r in head(start, entries)], pa.binary()))
    books = [seeds.reshape(len(seeds), PARTS, -1).transpose(1, 0, 2)]
    groups = [groups_of(b, GROUPS) for b in books[0]]
    none = F.lit(None).cast("binary")
    state = start.select("id", "label", "x", none.alias("code"), none.alias("low"), none.alias("stamp"))
    for r in range(rounds):
        state = materialise(state.mapInArrow(_steps(list(books), groups), _STATE_SQL), f"codes-{r}")
        sums = state.mapInArrow(_sums(len(seeds), width // PARTS), "slot long, limb long, total long").groupBy(
            "slot", "limb").agg(F.sum("total").alias("total"))
        totals: dict[int, int] = {}
        for slot, limb, total in sums.collect():
            totals[slot] = totals.get(slot, 0) + (total << 48 * limb)
        books.append(_moved(books[-1], totals))
    return state.mapInArrow(_finish(books, groups), "id long, label string, code string, error long").withColumnRenamed("id", key), books


def book_digest(book: np.ndarray | None) -> str:
    """SHA-256 of a codebook's whole numbers by part, entry and place, joined by commas."""
    return sha256(",".join(map(str, book.ravel().tolist() if book is not None else [])).encode()).hexdigest()


def coded(vectors: DataFrame, key: str = "vec_id", vector: str = "embedding", label: str = "label", entries: int = ENTRIES,
          rounds: int = ROUNDS) -> DataFrame:
    """As ``compress``, with the errors of each label added up (null labels together) and the last codebook's digest."""
    rows, books = compress(vectors, key, vector, label, entries, rounds)
    rows = materialise(rows, "coded")
    per = rows.groupBy(F.col("label").alias("_label")).agg(
        F.when(F.count("error") == F.count("*"), F.try_sum("error")).alias("label_error"))
    return rows.join(materialise(per, "label-errors"), F.col("label").eqNullSafe(F.col("_label"))).select(
        key, "label", "code", "error", "label_error", F.lit(book_digest(books[-1] if books else None)).alias("codebooks_sha256"))
