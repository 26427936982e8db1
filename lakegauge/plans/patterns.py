"""Text patterns learned from the values of a history."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from lakegauge.functions import text
from lakegauge.session import materialise

# The sketch below is exact to within one or two at this size, so the cut never drops a column with few shapes.
_SHAPES_WORTH_COUNTING = 64
_VALUES_WORTH_FOLDING = 1_000_000


def long_text(df: DataFrame, columns: list[str]) -> DataFrame:
    """(column, value) of all non-empty text."""
    items = F.array(*[F.struct(F.lit(c).alias("column"), F.col(c).cast("string").alias("value")) for c in columns])
    return df.select(F.inline(items)).filter(F.length("value") > 0)


def _estimates(df: DataFrame, columns: list[str]) -> dict[str, tuple[int, int, int]]:
    """Per column: rows, and estimated numbers of values and of symbol skeletons.

    The skeleton is the value without letters and digits. Values of one shape share it, so many
    skeletons prove many shapes without computing the shapes.
    """
    aggs = []
    for i, c in enumerate(columns):
        col = F.col(c).cast("string")
        aggs += [F.count(col).alias(f"n{i}"), F.approx_count_distinct(col).alias(f"d{i}"),
                 F.approx_count_distinct(F.regexp_replace(col, text.ALNUM_RUN, "")).alias(f"s{i}")]
    row = df.agg(*aggs).first()
    return {c: (row[f"n{i}"], row[f"d{i}"], row[f"s{i}"]) for i, c in enumerate(columns)}


def text_values(df: DataFrame, columns: list[str], known: dict[str, tuple[int, int, int]]) -> DataFrame:
    """Text to learn from: columns of repeating values as their distinct values, stored; the others row by row.

    The estimate only decides how a column is read; either way every value is seen.
    """
    few = [c for c in columns if known[c][1] <= _VALUES_WORTH_FOLDING and known[c][1] * 4 <= known[c][0]]
    many = [c for c in columns if c not in few]
    out = long_text(df, many) if many else None
    if few:
        folded = materialise(long_text(df, few).distinct(), "text_values")
        out = folded if out is None else folded.unionByName(out)
    return out


def column_shapes(values: DataFrame) -> DataFrame:
    """Rows per value shape and column."""
    v = values.withColumn("shape", text.shape(F.col("value")))
    return v.groupBy("column", "shape").agg(F.count(F.lit(1)).alias("rows"))


def shape_positions(values: DataFrame) -> DataFrame:
    """Shortest and longest run at each position of each shape. Min and max fold on the map side."""
    v = values.withColumn("shape", text.shape(F.col("value")))
    return (v.select("column", "shape", F.posexplode(text.segment_lengths(F.col("value"))).alias("pos", "len"))
            .groupBy("column", "shape", "pos").agg(F.min("len").alias("lo"), F.max("len").alias("hi")))


def text_profile(values: DataFrame, shaped: list[str]) -> DataFrame:
    """Per column: length range, character classes, and for the given columns the estimated number of shapes."""
    v = F.col("value")
    shape = F.when(F.col("column").isin(*shaped), text.shape(v)) if shaped else F.lit(None).cast("string")
    return values.groupBy("column").agg(
        F.min(F.length(v)).alias("len_min"), F.max(F.length(v)).alias("len_max"),
        F.max(v.rlike(r"\p{Lu}")).alias("upper"), F.max(v.rlike(r"\p{Ll}")).alias("lower"),
        F.max(v.rlike(r"\p{Nd}")).alias("digit"), F.approx_count_distinct(shape).alias("shapes"))


def other_characters(values: DataFrame) -> DataFrame:
    """Distinct characters beyond ASCII letters and digits, per column."""
    rest = F.regexp_replace("value", "[A-Za-z0-9]+", "")
    return values.select("column", F.explode(F.array_distinct(F.split(rest, ""))).alias("ch")).filter("ch <> ''").distinct()


def unmatched(values: DataFrame, patterns: dict[str, list[str]]) -> dict[str, int]:
    """Values per column that none of its patterns finds."""
    v, miss = F.col("value"), F.lit(False)
    for c, p in patterns.items():
        miss = F.when(F.col("column") == c, ~text.finds_any(v, p)).otherwise(miss)
    rows = values.filter(F.col("column").isin(*patterns)).groupBy("column").agg(F.count_if(miss).alias("n")).collect()
    return {**dict.fromkeys(patterns, 0), **{r["column"]: r["n"] for r in rows}}


def derive(df: DataFrame, columns: list[str]) -> dict[str, list[str]]:
    """Patterns for each text column, checked against every value they came from.

    A column with at most twelve shapes gets one pattern per shape; any other gets one general
    pattern. What reaches the driver is bounded by shapes and characters, not by rows.
    """
    if not columns:
        return {}
    df = df.select(*columns)
    known = _estimates(df, columns)
    return _derived(text_values(df, columns, known), columns, {c: known[c][2] for c in columns})


def derive_from_values(values: DataFrame, columns: list[str]) -> dict[str, list[str]]:
    """As ``derive``, from a table of the distinct non-empty values (column, value)."""
    if not columns:
        return {}
    found = values.groupBy("column").agg(F.approx_count_distinct(F.regexp_replace("value", text.ALNUM_RUN, "")).alias("n")).collect()
    return _derived(values, columns, {**dict.fromkeys(columns, 0), **{r["column"]: r["n"] for r in found}})


def _derived(values: DataFrame, columns: list[str], skeletons: dict[str, int]) -> dict[str, list[str]]:
    shaped = [c for c in columns if skeletons[c] <= _SHAPES_WORTH_COUNTING]
    info = {r["column"]: r for r in text_profile(values, shaped).collect()}
    out = {c: ["^.*$"] for c in columns if c not in info}
    few = [c for c in info if c in shaped and info[c]["shapes"] <= _SHAPES_WORTH_COUNTING]
    found: dict[str, dict[str, list]] = {}
    if few:
        for r in shape_positions(values.filter(F.col("column").isin(*few))).collect():
            found.setdefault(r["column"], {}).setdefault(r["shape"], []).append((r["pos"], r["lo"], r["hi"]))
    tried = {}
    for c, shapes in found.items():
        if len(shapes) <= text.MAX_SHAPES:
            tried[c] = sorted({text.assemble_pattern(s, [lo for _, lo, _ in sorted(p)], [hi for *_, hi in sorted(p)])
                               for s, p in shapes.items()})
    misses = unmatched(values, tried) if tried else {}
    out.update({c: p for c, p in tried.items() if misses[c] == 0})

    wide = [c for c in info if c not in out]
    if wide:
        rest = values.filter(F.col("column").isin(*wide))
        chars: dict[str, list[str]] = {c: [] for c in wide}
        for r in other_characters(rest).collect():
            chars[r["column"]].append(r["ch"])

        def general(c: str, letters: bool) -> list[str]:
            i = info[c]
            extra = [ch for ch in chars[c] if letters or not ch.isalnum()]
            return [text.general_pattern(i["upper"], i["lower"], i["digit"], extra, i["len_min"], i["len_max"])]
        plain = {c: general(c, False) for c in wide}
        left = unmatched(rest, plain)
        # letters outside ASCII that the class form cannot express are listed one by one
        out.update({c: p if left[c] == 0 else general(c, True) for c, p in plain.items()})
    return out
