"""Quality rules whose cutoffs are certified on labelled documents.

Per stratum, every (rule, cutoff) pair is a hypothesis "this cutoff rejects more than ``alpha`` of the good documents". An
exact binomial tail, evaluated on the labelled documents of the stratum, rejects the hypothesis; Bonferroni over all
strata, rules and cutoffs makes all accepted statements hold together with probability ``1 - delta``. Each rule gets an
equal part of the stratum's budget, so the union of the rules rejects at most ``budget`` of the good documents.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from lakegauge.llm.common import let, squeezed, whole, words
from lakegauge.session import materialise

#: rule -> (measure in per cent, cutoffs tried); a document above the cutoff is rejected
RULES: dict[str, tuple[str, tuple[float, ...]]] = {
    "symbols": ("100D * n_symbols / word_chars", (1, 2, 4, 6, 8, 12, 16, 24)),
    "capitals": ("100D * n_capitals / word_chars", (10, 15, 20, 30, 40, 50, 60, 80)),
    "duplicate_lines": ("100D * n_dup_lines / n_lines", (5, 10, 20, 30, 40, 50, 60, 80)),
    "repeated_words": ("100D * n_repeat_words / n_words", (2, 5, 10, 15, 20, 30, 40, 45)),
}


def _repeated(hashes: Column) -> Column:
    """Number of words inside 3-word windows that occur at least twice."""
    def covered(keys):
        placed = F.array_sort(F.transform(keys, lambda k, i: F.struct(k.alias("k"), i.alias("i"))))
        def twice(s):
            same = lambda x, at: F.coalesce(F.get(s, at)["k"] == x["k"], F.lit(False))
            hit = F.filter(s, lambda x, j: same(x, j - 1) | same(x, j + 1))
            return F.size(F.array_distinct(F.flatten(F.transform(
                hit, lambda x: F.array(x["i"], x["i"] + 1, x["i"] + 2)))))
        return let(placed, twice)
    windows = F.transform(F.sequence(F.lit(0), F.size(hashes) - 3),
                          lambda i: F.xxhash64(F.get(hashes, i), F.get(hashes, i + 1), F.get(hashes, i + 2)))
    repeated = let(windows, lambda keys: F.when(F.size(F.array_distinct(keys)) < F.size(keys), covered(keys)).otherwise(0))
    return F.when(F.size(hashes) > 3, repeated).otherwise(0).cast("long")


def measures(text: Column) -> Column:
    """Struct of counts of one text. Windows and words are compared by 64-bit hashes within the text."""
    def of(w):
        return F.struct(
            F.size(w).cast("long").alias("n_words"),
            let(F.transform(w, lambda x: F.xxhash64(x)), _repeated).alias("n_repeat_words"))
    def of_lines(lines):
        return F.struct(F.size(lines).cast("long").alias("n_lines"),
                        (F.size(lines) - F.size(F.array_distinct(lines))).cast("long").alias("n_dup_lines"))
    lines = F.filter(F.split(text, "\n"), lambda x: x.rlike("[^ \\t-\\r]"))
    return F.struct(let(words(text), of).alias("w"), let(lines, of_lines).alias("l"),
                    F.length(squeezed(text)).cast("long").alias("word_chars"),
                    F.length(F.regexp_replace(text, "[^#*$%&|<>]+", "")).cast("long").alias("n_symbols"),
                    F.length(F.regexp_replace(text, "[^A-Z]+", "")).cast("long").alias("n_capitals"))


def with_measures(docs: DataFrame, text: str = "text") -> DataFrame:
    """One row per document, null text as empty: counts, and whether the fixed base rule fails it."""
    m = docs.withColumn("_m", measures(whole(text)))
    return (m.withColumns({
        "n_words": F.col("_m.w.n_words"), "word_chars": F.col("_m.word_chars"), "n_symbols": F.col("_m.n_symbols"),
        "n_dup_lines": F.col("_m.l.n_dup_lines"), "n_repeat_words": F.col("_m.w.n_repeat_words"),
        "n_lines": F.col("_m.l.n_lines"), "n_capitals": F.col("_m.n_capitals")}).drop("_m")
        .withColumn("base_failed", F.expr("n_words < 50 OR 100 * n_repeat_words > 50 * n_words")))


def _log_gamma(x: Column) -> Column:
    """Logarithm of the gamma function for x >= 1: Stirling's series at x + 8."""
    z = x + 8
    series = 1 / (12 * z) - 1 / (360 * z ** 3) + 1 / (1260 * z ** 5) - 1 / (1680 * z ** 7)
    down = sum((F.log(x + i) for i in range(8)), F.lit(0.0))
    return (z - 0.5) * F.log(z) - z + 0.9189385332046727 + series - down


def binomial_tail(n: Column, k: Column, p: float) -> Column:
    """P(X <= k) for X ~ Binomial(n, p), summed downwards from k; 1 where k reaches the mean, as no bound can hold there."""
    top = F.exp(_log_gamma(n + 1.0) - _log_gamma(k + 1.0) - _log_gamma(n - k + 1.0)
                + k * F.log(F.lit(p)) + (n - k) * F.log(F.lit(1 - p)))
    def step(acc, i):
        term = acc["t"] * i / (n - i + 1) * ((1 - p) / p)
        return F.struct(term.alias("t"), (acc["s"] + term).alias("s"))
    down = F.when(k > 0, F.sequence(k.cast("long"), F.lit(1).cast("long"), F.lit(-1).cast("long"))).otherwise(
        F.array().cast("array<bigint>"))
    total = F.aggregate(down, F.struct(top.alias("t"), top.alias("s")), step, lambda a: a["s"])
    return F.when(k >= n * p, F.lit(1.0)).otherwise(total)


def certify(measured: DataFrame, labels: DataFrame, stratum: str, key: str = "doc_id", good: str = "quality",
            budget: float = 0.04, delta: float = 0.05) -> DataFrame:
    """Certified cutoffs (stratum, rule, cutoff), at most one per stratum and rule.

    Only documents that pass the base rule count. A document with several labels is good if all of them say so; labels that
    are null or belong to no document are ignored. Among the certified cutoffs the one with the largest gap between rejected
    bad and rejected good documents wins, the laxer one on a tie; rules that reject no bad document are left out. A stratum
    with too few labelled documents gets no cutoff.
    """
    alpha = budget / len(RULES)
    judged = labels.where(F.col(good).isNotNull() & F.col(key).isNotNull()).groupBy(F.col(key).alias("_id")).agg(
        F.min(good).alias("_good"))
    held = measured.where("NOT base_failed").join(judged, F.col(key) == F.col("_id")).withColumns(
        {f"_v_{r}": F.expr(m) for r, (m, _) in RULES.items()})
    tests = [(r, float(c)) for r, (_, cuts) in RULES.items() for c in cuts]
    counts = [F.count_if((F.col(f"_v_{r}") > c) & (F.col("_good") == g)).alias(f"_{g}_{i}")
              for i, (r, c) in enumerate(tests) for g in (1, 0)]
    by = materialise(held.groupBy(F.col(stratum).alias("stratum")).agg(
        F.count_if(F.col("_good") == 1).alias("n_good"), F.count_if(F.col("_good") == 0).alias("n_bad"), *counts), "strata")
    n_tests = by.count() * len(tests)
    rows = F.explode(F.array(*[F.struct(F.lit(r).alias("rule"), F.lit(c).alias("cutoff"), F.col(f"_1_{i}").alias("good"),
                                        F.col(f"_0_{i}").alias("bad")) for i, (r, c) in enumerate(tests)]))
    p = binomial_tail(F.col("n_good").cast("double"), F.col("good").cast("double"), alpha)
    passed = (by.select("stratum", "n_good", "n_bad", rows.alias("t")).select("stratum", "n_good", "n_bad", "t.*")
              .where("bad > 0 AND n_good > 0").withColumn("p", p)
              .where(F.col("p") * n_tests <= delta))
    gap = F.col("bad") / F.col("n_bad") - F.col("good") / F.col("n_good")
    return passed.groupBy("stratum", "rule").agg(F.max_by("cutoff", F.struct(gap, F.col("cutoff"))).alias("cutoff"))


def judge(measured: DataFrame, cutoffs: DataFrame, stratum: str) -> DataFrame:
    """Adds ``kept``: not failed by the base rule, and at or below every certified cutoff of its stratum."""
    wide = cutoffs.groupBy(F.col("stratum").alias("_stratum")).agg(
        *[F.max(F.when(F.col("rule") == r, F.col("cutoff"))).alias(f"_c_{r}") for r in RULES])
    over = F.lit(False)
    for r, (m, _) in RULES.items():
        over = over | F.coalesce(F.expr(m) > F.col(f"_c_{r}"), F.lit(False))
    joined = measured.join(wide, F.col(stratum).eqNullSafe(F.col("_stratum")), "left")
    return joined.withColumn("kept", F.when(F.col("base_failed"), F.lit(False)).otherwise(~over)).drop(
        "_stratum", *[f"_c_{r}" for r in RULES])


def quality(docs: DataFrame, labels: DataFrame, key: str = "doc_id", text: str = "text", stratum: str = "lang",
            good: str = "quality", budget: float = 0.04, delta: float = 0.05) -> DataFrame:
    """Counts and verdict per document: key, stratum and the columns of ``with_measures``, plus ``kept``.

    Null and empty texts have no words and fail the base rule. Repeated rows are judged alike. Documents with a null stratum
    form a stratum of their own. Other columns are dropped. An empty table gives an empty result.
    """
    named = docs.select(F.col(key), F.col(stratum).alias("stratum_of"), F.col(text).alias("_text"))
    measured = materialise(with_measures(named, "_text").drop("_text"), "quality")
    cut = materialise(certify(measured, labels, "stratum_of", key, good, budget, delta), "cutoffs")
    return judge(measured, cut, "stratum_of")
