"""Vector codes against a plain quantiser that computes every distance."""

from hashlib import sha256

import numpy as np
import pytest

from lakegauge.llm import codes


def plain(rows, entries=64, rounds=2):
    """(id, label, vector of whole numbers) -> codes and errors by id order, last codebook; whole numbers of Python only."""
    rows = sorted(rows, key=lambda r: r[0])
    cut = [[r[2][p * len(r[2]) // 16:(p + 1) * len(r[2]) // 16] for p in range(16)] for r in rows]
    books = [[cut[i][p] for i in range(min(entries, len(rows)))] for p in range(16)]
    for step in range(rounds + 1):
        near = [[min((sum((a - b) ** 2 for a, b in zip(c[p], e)), i) for i, e in enumerate(books[p])) for p in range(16)] for c in cut]
        if step == rounds:
            break
        for p in range(16):
            for e in range(len(books[p])):
                of = [c[p] for c, n in zip(cut, near) if n[p][1] == e]
                if of:
                    books[p][e] = [sum(x) // len(of) for x in zip(*of)]
    per = {}
    for r, n in zip(rows, near):
        per[r[1]] = per.get(r[1], 0) + sum(d for d, _ in n)
    digest = sha256(",".join(str(x) for p in books for e in p for x in e).encode()).hexdigest()
    return sorted((r[0], "".join(f"{i:02x}" for _, i in n), sum(d for d, _ in n), per[r[1]], digest) for r, n in zip(rows, near))


def fit(rows):
    """Numbers beyond 64 bits as null."""
    return [tuple(None if isinstance(v, int) and v >= 1 << 63 else v for v in r) for r in rows]


def numbers(v):
    return [int(np.floor(256 * x)) for x in v]


def coded(frame, **kw):
    return sorted(map(tuple, codes.coded(frame, **kw).drop("label").collect()))


def test_sf_table_against_every_distance(spark):
    frame = spark.read.parquet("/root/testdata/sf0.001/embeddings.parquet").where("vec_id < 200")
    rows = [(r["vec_id"], r["label"], numbers(r["embedding"])) for r in frame.collect()]
    assert coded(frame) == plain(rows)
    assert coded(frame, entries=5, rounds=4) == plain(rows, 5, 4)


def test_ties_repeats_nulls_and_clashing_columns(spark):
    r = np.random.default_rng(1)
    vectors = r.integers(-2, 3, (150, 32)) / 256
    rows = [(i, vectors[i % 90].tolist(), None if i % 4 == 0 else i % 3, "x", i) for i in range(150)]
    odd = [(900, None, 1, "x", 0), (901, [0.5] * 31 + [None], 1, "x", 0), (902, [0.5] * 31 + [float("nan")], 1, "x", 0),
           (903, [0.5] * 31 + [float("inf")], 1, "x", 0), (904, [], 1, "x", 0), (905, [0.5] * 16, 1, "x", 0), (906, [0.5] * 7, 1, "x", 0)]
    frame = spark.createDataFrame(rows + odd, "vec_id long, embedding array<double>, label int, code string, x int")
    assert coded(frame) == plain([(i, l, numbers(v)) for i, v, l, *_ in rows])


def test_empty_single_and_huge(spark):
    schema = "vec_id long, embedding array<double>, label int"
    assert coded(spark.createDataFrame([], schema)) == []
    one = [(7, [0.1 * i for i in range(16)], None)]
    assert coded(spark.createDataFrame(one, schema)) == plain([(7, None, numbers(one[0][1]))])
    huge = [(i, [(-1) ** i * 3e5 * i + j * 1e4 for j in range(16)], 0) for i in range(70)] + [(99, [1e3] * 16, 0)]
    assert coded(spark.createDataFrame(huge, schema), entries=8) == fit(plain([(i, l, numbers(v)) for i, v, l in huge], 8))
    beyond = [(i, [1e30 * (i + j) for j in range(16)], 0) for i in range(9)]
    assert coded(spark.createDataFrame(beyond, schema), entries=4) == fit(plain([(i, l, numbers(v)) for i, v, l in beyond], 4))


@pytest.mark.parametrize("size", [1, 3, 64])
def test_bounds_skip_groups_and_change_nothing(size):
    r = np.random.default_rng(size)
    x = (r.integers(0, 40, (400, 1, 1)) * 37 % 41 * 5 + r.integers(-3, 4, (400, 16, 4))).reshape(400, 64)
    books = [x[:size].reshape(size, 16, 4).transpose(1, 0, 2)]
    groups = [codes.groups_of(b, 8) for b in books[0]]
    bounds, total, scanned = None, 0, 0
    for _ in range(6):
        bounds, error, n = codes.assign(x, books, groups, bounds)
        fresh, exact, every = codes.assign(x, books, groups)
        assert (bounds.code == fresh.code).all() and (error == exact).all()
        scanned, total = scanned + n, total + every
        cut, moved = x.reshape(400, 16, 4), books[-1].copy()
        for p in range(16):
            for e in range(size):
                if (bounds.code[:, p] == e).any():
                    moved[p, e] = cut[bounds.code[:, p] == e, p].sum(axis=0) // (bounds.code[:, p] == e).sum()
        books.append(moved)
    assert size < 64 or scanned < 0.5 * total


def test_net_displacement_is_what_bounds_lose():
    there_and_back = [np.zeros((1, 2, 1), int), np.full((1, 2, 1), 50), np.ones((1, 2, 1), int)]
    assert codes._drift(there_and_back, 0, [np.array([0, 1])])[:, 0] == pytest.approx([1, 49, 0])
