"""Regex dialect, value shapes and pattern assembly."""

from __future__ import annotations

import re

from pyspark.sql import Column
from pyspark.sql import functions as F

# Text that must not occur in any text column (pattern, label, severity).
DIRTY_TEXT = (
    ("padding", r"^\s|\s$", "blocking"),
    ("blank", r"^\s*$", "blocking"),
    ("control", r"[\x00-\x1F\x7F]", "blocking"),
    ("markup", r"[<>]|&#|&lt;|&gt;", "warning"),
    ("null_literal", r"\bnull\b|\bNULL\b|\bNone\b|^nan$|^NaN$", "warning"),
)
PRINTABLE_ASCII = r"^[\x20-\x7E]+$"
# Regex class per run kind, most shapes before the general pattern, runs before a chunk merges.
SHAPE_CLASS = {"U": "[A-Z]", "L": "[a-z]", "D": r"\d", "X": "[A-Z0-9]", "M": "[A-Za-z0-9]"}
MAX_SHAPES = 12
MERGE_RUNS = 4

_ALNUM = r"\p{Lu}\p{Ll}\p{Nd}"
ALNUM_RUN = rf"[{_ALNUM}]+"
_RUN = r"(?:\p{Lu}++|\p{Ll}++|\p{Nd}++)"
_CHUNK = rf"(?<![{_ALNUM}]){_RUN}{{{MERGE_RUNS},}}"
_SEGMENT = rf"({_CHUNK}|\p{{Lu}}+|\p{{Ll}}+|\p{{Nd}}+|[^{_ALNUM}])"
# one private-use code point per run kind stands for the run inside a shape
TOKENS = {"M": chr(0xE001), "X": chr(0xE002), "U": chr(0xE003), "L": chr(0xE004), "D": chr(0xE005)}
KIND_OF = {t: k for k, t in TOKENS.items()}


def java_regex(pattern: str) -> str:
    """A pattern written for Python's ``re`` as a Java pattern of the same meaning.

    ``U`` makes the classes Unicode-aware, ``d`` lets only \\n end a line before ``$``.
    """
    return "(?Ud)" + pattern.replace("(?P<", "(?<").replace(r"\Z", r"\z")


def finds(col: Column, pattern: str) -> Column:
    """True when the pattern occurs anywhere in the text (search, not full match)."""
    return col.rlike(java_regex(pattern))


def finds_any(col: Column, patterns: list[str]) -> Column:
    hit = finds(col, patterns[0])
    for p in patterns[1:]:
        hit = hit | finds(col, p)
    return hit


def shape(col: Column) -> Column:
    """Value shape: runs of upper, lower and digits become tokens, everything else stays literal.

    Four or more neighbouring runs merge into one token. Only ``regexp_replace``, so the
    expression stays inside whole-stage codegen; possessive runs keep the count of runs exact.
    """
    merged = F.regexp_replace(col, rf"(?<![{_ALNUM}])(?=[\p{{Lu}}\p{{Nd}}]*\p{{Ll}}){_RUN}{{{MERGE_RUNS},}}",
                              TOKENS["M"])
    merged = F.regexp_replace(merged, _CHUNK, TOKENS["X"])
    for kind, cls in (("U", r"\p{Lu}+"), ("L", r"\p{Ll}+"), ("D", r"\p{Nd}+")):
        merged = F.regexp_replace(merged, cls, TOKENS[kind])
    return merged


def readable_shape(col: Column) -> Column:
    """The shape with tokens printed as U L D X M in braces, for reports."""
    out = col
    for kind, token in TOKENS.items():
        out = F.regexp_replace(out, token, "{" + kind + "}")
    return out


def segment_lengths(col: Column) -> Column:
    """Length of every element of the shape, in order."""
    return F.transform(F.regexp_extract_all(col, F.lit(_SEGMENT), F.lit(1)), F.length)


def assemble_pattern(shape_text: str, lows: list[int], highs: list[int]) -> str:
    """Regex of one shape from the length range seen at each position."""
    out = []
    for token, lo, hi in zip(shape_text, lows, highs):
        kind = KIND_OF.get(token)
        if kind is None:
            out.append(re.escape(token))
        elif lo == hi:
            out.append(SHAPE_CLASS[kind] + ("" if lo == 1 else f"{{{lo}}}"))
        else:
            out.append(f"{SHAPE_CLASS[kind]}{{{lo},{hi}}}")
    return "^" + "".join(out) + "$"


def general_pattern(upper: bool, lower: bool, digit: bool, symbols: list[str], lo: int, hi: int) -> str:
    """One character class and a length range that cover a whole column."""
    cls = ("A-Z" if upper else "") + ("a-z" if lower else "") + ("0-9" if digit else "")
    return f"^[{cls}{re.escape(''.join(sorted(symbols)))}]{{{lo},{hi}}}$"
