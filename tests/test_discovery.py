"""Dependencies and equal columns among many columns, against brute force."""

import random
from itertools import permutations

from lakegauge.plans import infer


def brute(rows, a, b):
    seen = {}
    for r in rows:
        if r[a] is not None and r[b] is not None:
            seen.setdefault(r[a], set()).add(r[b])
    return len(seen) > 1 and all(len(v) == 1 for v in seen.values())


def equal(rows, a, b):
    both = [(r[a], r[b]) for r in rows if r[a] is not None and r[b] is not None]
    return bool(both) and all(x == y for x, y in both)


def test_discover(spark):
    rng = random.Random(5)
    rows = []
    for _ in range(3000):
        z = rng.randrange(150)
        rows.append((f"z{z}", f"r{z // 10}", f"c{z // 50}", rng.choice(["x", "y", None]), f"z{z}" if rng.random() < 0.5 else None,
                     f"z{z}" if z else rng.choice(["z0", "other"]), "one", None, rng.choice("ab") if z == 3 else f"r{z // 10}", f"{rng.randrange(200)}"))
    names = ["zone", "region", "country", "noise", "some_zone", "nearly_zone", "constant", "empty", "nearly_region", "random"]
    found = infer.discover(spark.createDataFrame(rows, ", ".join(f"{n} string" for n in names)), names)
    at = {n: i for i, n in enumerate(names)}
    for a, b in permutations(names, 2):
        assert found.determines[a, b] == brute(rows, at[a], at[b]), (a, b)
        if at[a] < at[b]:
            assert ((a, b) in found.equal) == equal(rows, at[a], at[b]), (a, b)
    assert found.tried < len(names) * (len(names) - 1) / 2       # sketches ruled the others out


def test_forty_columns_without_row_explosion(spark):
    df = spark.range(2000).selectExpr(*[f"CAST(pmod(hash(id, {i // 4}), 20 + {i // 4}) AS STRING) AS c{i}" for i in range(40)])
    found = infer.discover(df, df.columns)
    same = {(f"c{i}", f"c{j}") for i in range(40) for j in range(i + 1, 40) if i // 4 == j // 4}
    assert found.equal == same
    assert {p for p, d in found.determines.items() if d} == same | {p[::-1] for p in same}
    plan = infer.confirm(df, [("c0", "c1"), ("c1", "c0")])._jdf.queryExecution().optimizedPlan().toString()
    assert plan.count("Generate inline") <= 2 and "Expand" not in plan       # only the result rows are laid out


def test_discover_edges(spark):
    df = spark.createDataFrame([], "a string, b string")
    assert infer.discover(df, ["a", "b"]) == infer.Relations({("a", "b"): False, ("b", "a"): False}, set(), 0)
    assert infer.discover(df, ["a"]) == infer.Relations({}, set(), 0)


def test_repeated_rows_are_folded_before_the_sketches(spark, monkeypatch):
    df = spark.range(20_000).selectExpr("CAST(id % 6 AS STRING) AS a", "CAST(id % 3 AS INT) AS b", "CAST(id % 2 AS STRING) AS c", "CAST(id AS STRING) AS other")
    read = []
    for name in ("pair_sketches", "confirm", "equal_columns"):
        monkeypatch.setattr(infer, name, lambda df, pairs, run=getattr(infer, name): (read.append(df.count()), run(df, pairs))[1])
    found = infer.discover(df, ["a", "b", "c"])
    assert {p for p, d in found.determines.items() if d} == {("a", "b"), ("a", "c")} and found.equal == set()
    assert read and max(read) == 6
