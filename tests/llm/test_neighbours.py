"""Near-duplicate vectors against all pairs."""

import numpy as np
import pytest

from lakegauge.llm import neighbours

SCHEMA = "vec_id long, embedding array<double>, c binary, label int"


def plain(rows, threshold=0.95):
    """Links and smallest reachable key of every row (key, vector), by all pairs."""
    n, links, root = len(rows), [0] * len(rows), list(range(len(rows)))
    units = []
    for _, v in rows:
        ok = v is not None and len(v) and all(x is not None and np.isfinite(x) for x in v) and any(v)
        a = np.array(v, float) / np.abs(np.array(v, float)).max() if ok else None
        units.append(a / np.linalg.norm(a) if ok else None)

    def top(i):
        while root[i] != i:
            i = root[i]
        return i

    for i in range(n):
        for j in range(i):
            if units[i] is not None and units[j] is not None and len(units[i]) == len(units[j]) and units[i] @ units[j] >= threshold:
                links[i], links[j] = links[i] + 1, links[j] + 1
                root[max(top(i), top(j))] = min(top(i), top(j))
    groups = {}
    for i, (k, _) in enumerate(rows):
        groups.setdefault(top(i), []).append(k)
    out = []
    for i, (k, _) in enumerate(rows):
        ids = [x for x in groups[top(i)] if x is not None]
        least = min(ids) if ids else None
        out.append((k, links[i], least, k == least))
    return sorted(out, key=str)


def found(spark, rows, **kw):
    frame = spark.createDataFrame([(k, v, b"x", 1) for k, v in rows], SCHEMA)
    return sorted(map(tuple, neighbours.near_vectors(frame, **kw).collect()), key=str)


def clouds(seed=3, dims=32):
    """Random vectors, tight clouds of several sizes, one wide cloud, copies and opposites."""
    r = np.random.default_rng(seed)
    out = [v for v in r.standard_normal((150, dims))]
    for size, width in ((120, 0.02), (60, 0.05), (80, 0.15), (5, 0.01)):
        centre = r.standard_normal(dims)
        out += [centre + width * np.linalg.norm(centre) / dims ** 0.5 * r.standard_normal(dims) for _ in range(size)]
    out += [out[3]] * 40 + [-out[3], 5 * out[3], 1e200 * out[4], 1e-200 * out[4]]
    return [(int(k), v.tolist()) for k, v in zip(r.permutation(len(out)), out)]


@pytest.mark.parametrize("fill,block", [(1024, 2048), (32, 2048), (32, 16)])
def test_against_all_pairs(spark, fill, block):
    rows = clouds()
    assert found(spark, rows, fill=fill, block=block) == plain(rows)


def test_unusable_vectors_repeated_and_null_keys(spark):
    rows = [(1, None), (2, []), (3, [0.0, 0.0]), (4, [1.0, None]), (5, [1.0, float("nan")]), (6, [float("inf"), 1.0]),
            (7, [1.0, 2.0]), (7, [1.0, 2.0]), (8, [2.0, 4.0]), (8, [-1.0, 5.0]), (None, [1.0, 2.1]), (None, [9.0, -1.0]), (None, None),
            (9, [1.0]), (10, [3.0]), (11, [-0.0, 1.0]), (12, [0.0, 1.0]), (13, [1.0, 2.0, 0.0])]
    assert found(spark, rows) == plain(rows)
    assert found(spark, rows[:1]) == [(1, 0, 1, True)]
    assert found(spark, []) == []


def test_given_table(spark):
    frame = spark.read.parquet("/root/testdata/sf0.001/embeddings.parquet")
    rows = [(r["vec_id"], r["embedding"]) for r in frame.collect()]
    got = sorted(map(tuple, neighbours.near_vectors(frame, threshold=0.4, fill=64).collect()), key=str)
    want = plain(rows, 0.4)
    seen, every = sum(t[1] for t in got), sum(t[1] for t in want)
    assert all(a[0] == b[0] and a[1] <= b[1] for a, b in zip(got, want)) and seen >= 0.99 * every > 0


def test_pairs_right_at_the_threshold_meet(spark):
    r = np.random.default_rng(5)
    a, b = r.standard_normal((2, 1500, 64))
    a /= np.linalg.norm(a, axis=1, keepdims=True)
    b -= (a * b).sum(axis=1, keepdims=True) * a
    b /= np.linalg.norm(b, axis=1, keepdims=True)
    c = 0.950001 * a + (1 - 0.950001 ** 2) ** 0.5 * b
    rows = [(2 * i, x.tolist()) for i, x in enumerate(a)] + [(2 * i + 1, x.tolist()) for i, x in enumerate(c)]
    got = found(spark, rows, fill=16)
    assert sum(t[1] for t in got) >= 2 * 1500 * 0.995 and all(t[1] <= 1 for t in got)


def test_estimates_are_unbiased_and_bounded():
    r = np.random.default_rng(6)
    a, b = r.standard_normal((2, 4000, 64))
    b = a + 0.3 * b
    a, b = neighbours.unit(a), neighbours.unit(b)
    signs, factor, _, _ = neighbours.Coder(64, 0, 1)(a)
    estimate = ((signs[:, :64] * 2.0 - 1) / 8 * (b @ neighbours.rotation(64, 0))).sum(axis=1) / factor
    cosine = (a * b).sum(axis=1)
    assert abs((estimate - cosine).mean()) < 0.002
    spread = np.sqrt((1 - cosine ** 2) * (1 - factor ** 2) / factor ** 2 / 63)
    assert 0.9 < ((estimate - cosine) / spread).std() < 1.1
    assert (np.abs(estimate - cosine) < neighbours.SPREADS * spread).all()
