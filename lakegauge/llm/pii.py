"""Personal data: wide generators propose spans, boosted trees judge them, thresholds from held-out counts select.

Strict patterns give the base spans, which always stay. Two wide generators (mail-like and number-like strings) propose
candidates; those that overlap no base span may be added. What the trees learn and are calibrated on is evidence that the
strict patterns don't give (``_shown``): a disguised address that reads as a strict one when '(at)' and '(dot)' are undone, an
area code in parentheses, a checksum in card layout, or a cue word before the candidate. Cue words are no feature, so what
cued candidates have in common also finds those without a cue. A candidate's features are a few small whole numbers about its
format and surroundings, so all candidates of the corpus fold into one table of bounded size (the product of the features'
levels): documents held out or not, features, candidates, and how many of them the evidence shows to be personal. Trees are
boosted on the fold's training part, each generator's threshold comes from its held-out part, and scores are computed as
column expressions.
"""

from __future__ import annotations

from math import exp, log, sqrt

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from lakegauge.llm.common import let, whole
from lakegauge.session import materialise

#: kinds of base spans in the order of equal starts, then the generators; possessive forms of the same languages, so that no
#: text makes the search go back and forth
KINDS = ("email", "ip", "card", "phone", "mail", "number")
_LOCAL = "[A-Za-z0-9._%+-]"
PATTERNS = {
    "email": rf"(?:(?<!{_LOCAL})|\G){_LOCAL}++@[A-Za-z0-9-]++(?:\.[A-Za-z0-9-]++)++",
    "ip": r"(?<![0-9])[0-9]++(?:\.[0-9]++){3}+",
    "card": r"[0-9](?:[ -]?[0-9])++",
    "phone": r"\+[0-9][ ().0-9-]+[0-9]",
    "mail": rf"(?:(?<!{_LOCAL})|\G){_LOCAL}++ ?(?:@|\(at\)|\[at\]) ?[A-Za-z0-9-]++(?:(?:\.| \. ?| ?\(dot\) ?| ?\[dot\] ?)[A-Za-z0-9-]++)*+",
    "number": r"(?<![0-9])[+(]{0,2}[0-9](?:[ ()./:-]{0,2}[0-9]){6,}+",
}
_HINTS = {"email": "@", "ip": r"[0-9]\.[0-9]", "card": "[0-9][ -]?[0-9]", "phone": r"\+[0-9]", "mail": r"@|[(\[]at[)\]]",
          "number": "[0-9][ ()./:-]{0,2}[0-9]"}
#: words before a candidate that say what it is; up to two small words may stand between
_JOIN = r"\W*(?:(?:me|us|at|on|is|to|no|nr|number|address|my|our|under)\W+){0,2}$"
_CUES = {"mail": rf"(?i)\b(?:e-?mail|mail|contact|write|reach){_JOIN}", "card": rf"(?i)\b(?:card|visa|mastercard|amex){_JOIN}",
         "phone": rf"(?i)\b(?:call|phone|telephone|tel|telefon|fax|mobile|cell){_JOIN}"}
_ADDRESS = rf"^{_LOCAL}++@(?:[A-Za-z0-9-]++\.)++[A-Za-z]{{2,}}$"
_AREA = r"^\((?:0[0-9]{1,4}|[2-9][0-9]{2})\)[ ./-]{0,2}[0-9]{3,4}[ .-]?[0-9]{3,5}$"
_FOURS = r"^[3-6][0-9]{3}([ ./-]{1,2})[0-9]{4}\1[0-9]{4}\1[0-9]{1,7}$"
_DATE = r"^(?:[0-9]{1,2}[./-][0-9]{1,2}[./-][0-9]{4}|[0-9]{4}[./-][0-9]{1,2}[./-][0-9]{1,2})(?:[ .:/-]|$)"
#: feature: (expression over m (match), b (text before), a (text after), d (digits of m), number of levels); no cue words
FEATURES = {
    "digits": ("CASE WHEN length(d) < 9 THEN 0 WHEN length(d) < 12 THEN 1 WHEN length(d) < 16 THEN 2 WHEN length(d) < 20 THEN 3 ELSE 4 END", 5),
    "marks": (r"CASE WHEN m RLIKE '[()\\[\\]]' THEN 3 WHEN m RLIKE '[ /:-]' THEN 2 WHEN m LIKE '%.%' THEN 1 ELSE 0 END", 4),
    "sign": ("CASE WHEN m LIKE '+%' THEN 2 WHEN m LIKE '%@%' THEN 1 ELSE 0 END", 3),
    "before": (r"CASE WHEN b = '' OR b RLIKE '\\s$' THEN 0 WHEN b RLIKE '[\\p{L}0-9]$' THEN 2 ELSE 1 END", 3),
    "after": (r"CASE WHEN a = '' OR a RLIKE '^\\s' THEN 0 WHEN a RLIKE '^[\\p{L}0-9]' THEN 2 ELSE 1 END", 3),
    "groups": ("least(3, length(regexp_replace(m, '[0-9A-Za-z]+', '')) )", 4),
    "ending": (r"CASE WHEN m RLIKE '(\\.|[(\\[]dot[)\\]]) ?[A-Za-z]{2,}$' THEN 2 WHEN m RLIKE '\\.[0-9]{1,3}$' THEN 1 ELSE 0 END", 3),
}
ROUNDS, RATE, PRECISION = 24, 0.4, 0.95


def _spans(text: Column, kind: str) -> Column:
    """Leftmost non-overlapping matches as structs (start, end, m, b, a), in code points, with some text around."""
    pattern = PATTERNS[kind]

    def place(s):
        def step(acc, i):
            start = acc["at"] + F.length(F.get(s["gaps"], i))
            m = F.get(s["hits"], i)
            end = start + F.length(m)
            one = F.struct(start.alias("start"), end.alias("end"), m.alias("m"), F.right(F.get(s["gaps"], i), F.lit(32)).alias("b"),
                           F.left(F.get(s["gaps"], i + 1), F.lit(2)).alias("a"))
            return F.struct(end.alias("at"), F.concat(acc["out"], F.array(one)).alias("out"))
        none = F.array().cast("array<struct<start:int,end:int,m:string,b:string,a:string>>")
        return F.when(F.size(s["hits"]) > 0, F.aggregate(
            F.sequence(F.lit(0), F.size(s["hits"]) - 1), F.struct(F.lit(0).alias("at"), none.alias("out")), step,
            lambda acc: acc["out"])).otherwise(none)

    found = let(F.struct(F.split(text, pattern, -1).alias("gaps"),
                         F.regexp_extract_all(text, F.lit(pattern), F.lit(0)).alias("hits")), place)
    return F.when(text.rlike(_HINTS[kind]), found).otherwise(
        F.array().cast("array<struct<start:int,end:int,m:string,b:string,a:string>>"))


def _digits(m: Column) -> Column:
    return F.regexp_replace(m, "[^0-9]", "")


def _valid(kind: str, m: Column) -> Column:
    if kind == "ip":
        return F.forall(F.split(m, r"\."), lambda p: p.rlike("^0*(?:[0-9]{1,2}|1[0-9]{2}|2[0-4][0-9]|25[0-5])$"))
    if kind == "card":
        return F.length(_digits(m)).between(12, 19) & F.call_function("luhn_check", _digits(m))
    if kind == "phone":
        return F.length(_digits(m)).between(9, 15)
    return F.lit(True)


def _shown(kind: str, m: Column, b: Column) -> Column:
    """Whether format, checksum or a cue word shows that a candidate of a wide generator is personal."""
    if kind == "mail":
        plain = F.regexp_replace(F.regexp_replace(m, r" ?[(\[]at[)\]] ?", "@"), r" ?[(\[]dot[)\]] ?", ".")
        return F.when(b.rlike(_CUES["mail"]), F.regexp_replace(plain, " ", "")).otherwise(plain).rlike(_ADDRESS)
    size = F.length(_digits(m))
    phone = size.between(7, 15) & (m.rlike(_AREA) | b.rlike(_CUES["phone"]) & ~m.rlike(_DATE))
    card = size.between(12, 19) & (m.rlike(_FOURS) | b.rlike(_CUES["card"])) & F.call_function("luhn_check", _digits(m))
    return phone | card


def candidates(docs: DataFrame, key: str = "doc_id", text: str = "text") -> DataFrame:
    """(key, base, wide): base spans (start, rank, end), and wide spans with ``confirmed`` (a base span overlaps), ``shown`` (evidence that
    the base patterns don't give) and what features need."""
    rank = {k: i for i, k in enumerate(KINDS)}

    def strict(kind):
        ok = F.filter(F.col(f"_{kind}"), lambda s: _valid(kind, s["m"]))
        return F.transform(ok, lambda s: F.struct(s["start"].alias("start"), F.lit(rank[kind]).alias("rank"), s["end"].alias("end")))

    def loose(kind):
        return F.transform(F.col(f"_{kind}"), lambda s: F.struct(
            s["start"].alias("start"), F.lit(rank[kind]).alias("rank"), s["end"].alias("end"),
            F.exists("base", lambda b: (b["start"] < s["end"]) & (s["start"] < b["end"])).alias("confirmed"),
            s["m"].alias("m"), s["b"].alias("b"), s["a"].alias("a"), _digits(s["m"]).alias("d"), _shown(kind, s["m"], s["b"]).alias("shown")))

    t = docs.select(F.col(key), whole(text).alias("_t"))
    found = t.select(key, *[_spans(F.col("_t"), k).alias(f"_{k}") for k in KINDS])
    base = found.withColumn("base", F.array_sort(F.concat(*[strict(k) for k in KINDS[:4]])))
    return base.select(key, "base", F.concat(loose("mail"), loose("number")).alias("wide"))


def _features(x: str) -> dict[str, str]:
    """Feature expressions of a candidate that is the lambda variable ``x``."""
    import re
    return {name: re.sub(r"\b(m|b|a|d)\b(?! *\()", rf"{x}.\1", e) if name != "ending" else e.replace("m RLIKE", f"{x}.m RLIKE")
            for name, (e, _) in FEATURES.items()}


def boost(rows: list[tuple[tuple[int, ...], int, int]], rounds: int = ROUNDS, rate: float = RATE) -> tuple[float, list]:
    """Boosted trees of depth 2 for (features, candidates, shown to be personal): first score, and trees (f, t, (f, t, lo, hi), (..)).

    A split ``(f, t)`` sends values up to ``t`` to its first side. Leaves are Newton steps of the logistic loss.
    """
    n, pos = sum(r[1] for r in rows), sum(r[2] for r in rows)
    start = log((pos + 1) / (n - pos + 1))
    score = [start] * len(rows)

    def best(ids):
        g = [rows[i][2] - rows[i][1] * p[i] for i in ids]
        h = [rows[i][1] * p[i] * (1 - p[i]) for i in ids]
        gain, found = -1.0, (0, 0, 0.0, 0.0)
        for f in range(len(FEATURES)):
            for t in range(list(FEATURES.values())[f][1] - 1):
                left = [j for j, i in enumerate(ids) if rows[i][0][f] <= t]
                gl, hl = sum(g[j] for j in left), sum(h[j] for j in left)
                gr, hr = sum(g) - gl, sum(h) - hl
                made = gl * gl / (hl + 1) + gr * gr / (hr + 1)
                if made > gain + 1e-12:
                    gain, found = made, (f, t, rate * gl / (hl + 1), rate * gr / (hr + 1))
        return found

    trees = []
    for _ in range(rounds):
        p = [1 / (1 + exp(-s)) for s in score]
        f, t, _, _ = best(range(len(rows)))
        low, high = best([i for i in range(len(rows)) if rows[i][0][f] <= t]), best([i for i in range(len(rows)) if rows[i][0][f] > t])
        trees.append((f, t, low, high))
        score = [s + _leaf(trees[-1], r[0]) for s, r in zip(score, rows)]
    return start, trees


def _leaf(tree, x) -> float:
    f, t, low, high = tree
    f, t, a, b = low if x[f] <= t else high
    return a if x[f] <= t else b


def _score_sql(model, features: list[str]) -> str:
    start, trees = model
    side = lambda s: f"IF({features[s[0]]} <= {s[1]}, {s[2]!r}D, {s[3]!r}D)"
    return " + ".join([f"{start!r}D", *(f"IF({features[f]} <= {t}, {side(low)}, {side(high)})" for f, t, low, high in trees)])


def threshold(rows: list[tuple[tuple[int, ...], int, int]], model, precision: float = PRECISION) -> float | None:
    """Least score at and above which the lower Wilson bound (95 %) of the share shown to be personal reaches ``precision``."""
    start, trees = model
    by: dict[float, list[int]] = {}
    for x, n, pos in rows:
        s = round(start + sum(_leaf(t, x) for t in trees), 9)
        got = by.setdefault(s, [0, 0])
        got[0] += n
        got[1] += pos
    n = pos = 0
    found = None
    for s in sorted(by, reverse=True):
        n, pos = n + by[s][0], pos + by[s][1]
        share, z = pos / n, 1.96
        bound = (share + z * z / (2 * n) - z * sqrt(share * (1 - share) / n + z * z / (4 * n * n))) / (1 + z * z / n)
        if bound >= precision:
            found = s
    return found


def private(docs: DataFrame, key: str = "doc_id", text: str = "text", precision: float = PRECISION) -> DataFrame:
    """Personal data of every whole text: key, ``base`` and ``spans``, arrays of (start, rank, end), rank in ``KINDS``.

    ``spans`` has the base spans and the selected candidates that overlap none of them, by start, then kind. Null and empty
    texts have none; repeated rows give equal results; other columns are dropped. Where too few candidates were held out to
    calibrate a generator, it adds nothing.
    """
    made = materialise(candidates(docs, key, text), "candidates")
    fold = made.select((F.pmod(F.xxhash64(key), F.lit(3)) == 0).alias("held"),
                       F.explode(F.filter("wide", lambda s: ~s["confirmed"])).alias("x"))     # those that may be added
    named = _features("x")
    table = fold.groupBy("held", F.col("x.rank").alias("rank"), *[F.expr(e).alias(n) for n, e in named.items()]).agg(
        F.count("*").alias("n"), F.count_if("x.shown").alias("pos"))
    rows = sorted(table.collect(), key=lambda r: tuple(r))      # at most two times the product of the levels per generator
    chosen = []
    for kind in KINDS[4:]:
        part = {h: [(tuple(r[n] for n in FEATURES), r["n"], r["pos"]) for r in rows if r["rank"] == KINDS.index(kind) and r["held"] == h]
                for h in (False, True)}
        if part[False] and part[True]:
            model = boost(part[False])
            least = threshold(part[True], model, precision)
            if least is not None:
                chosen.append(f"(x.rank = {KINDS.index(kind)} AND {_score_sql(model, list(named.values()))} >= {least - 1e-6!r}D)")
    test = " OR ".join(chosen) or "false"
    extra = F.expr(f"transform(filter(wide, x -> NOT x.confirmed AND ({test})), x -> struct(x.start, x.rank, x.end))")
    return made.select(key, "base", F.array_sort(F.array_union("base", extra)).alias("spans"))
