"""Secret scanning: an Aho-Corasick automaton finds keywords, anchored expressions run only at hits, checksums decide.

A rule's expression starts at its keyword, so it is only matched where the automaton reports one; a rule without keyword
(runs of hexadecimal digits) is searched for. Matches of a rule are taken leftmost first without overlap. Rules whose tokens
carry a checksum or a decodable part drop what does not verify.
"""

from __future__ import annotations

import base64
import binascii
import hashlib
import json
import re
import zlib
from collections.abc import Callable
from typing import NamedTuple

import ahocorasick
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from lakegauge.llm.common import per_text

#: characters of the longest header that is decoded; key ids and certificate chains fit, and nesting stays shallow
HEADER = 16384
_BASE62 = "0123456789ABCDEFGHIJKLMNOPQRSTUVWXYZabcdefghijklmnopqrstuvwxyz"


def _crc_ok(token: str) -> bool:
    """The last six characters are the CRC-32 of the part between the prefix and them, in base 62."""
    body = token[token.index("_") + 1:]
    n, digits = zlib.crc32(body[:-6].encode()), ""
    while n:
        n, r = divmod(n, 62)
        digits = _BASE62[r] + digits
    return digits.rjust(6, "0") == body[-6:]


def _jwt_ok(token: str) -> bool:
    """The header decodes to a JSON object that names an algorithm; headers are short, longer ones are none."""
    head = token.split(".")[0]
    if len(head) > HEADER:
        return False
    try:
        found = json.loads(base64.urlsafe_b64decode(head + "=" * (-len(head) % 4)))
    except (binascii.Error, ValueError, RecursionError):
        return False
    return isinstance(found, dict) and isinstance(found.get("alg"), str)


_BECH32 = "qpzry9x8gf2tvdw0s3jn54khce6mua7l"
_BASE58 = "123456789ABCDEFGHJKLMNPQRSTUVWXYZabcdefghijkmnopqrstuvwxyz"


def _bech32_ok(token: str) -> bool:
    """The six characters at the end are the BCH checksum of the name before the last '1' and the data behind it."""
    name, data = token.lower().rsplit("1", 1)
    left = [ord(c) >> 5 for c in name] + [0] + [ord(c) & 31 for c in name] + [_BECH32.index(c) for c in data]
    state = 1
    for v in left:
        top, state = state >> 25, (state & 0x1FFFFFF) << 5 ^ v
        for i, g in enumerate((0x3B6A57B2, 0x26508E6D, 0x1EA119FA, 0x3D4233DD, 0x2A1462B3)):
            state ^= g if top >> i & 1 else 0
    return state == 1


def _base58_ok(token: str) -> bool:
    """The last four bytes are the start of the double SHA-256 of the bytes before them."""
    n = 0
    for c in token:
        n = n * 58 + _BASE58.index(c)
    raw = n.to_bytes((n.bit_length() + 7) // 8, "big")
    return hashlib.sha256(hashlib.sha256(raw[:-4]).digest()).digest()[:4] == raw[-4:]


def _bytes_ok(part: str, size: int) -> bool:
    """URL-safe base64 of exactly so many bytes: the bits beyond them are zero."""
    raw = base64.urlsafe_b64decode(part + "=" * (-len(part) % 4))
    return len(raw) == size and base64.urlsafe_b64encode(raw).rstrip(b"=").decode() == part


def _macaroon_ok(part: str) -> bool:
    """A binary macaroon: version 2, then a location and an identifier with their lengths, inside the token."""
    if len(part) > HEADER or len(part) % 4 == 1:
        return False
    raw = base64.urlsafe_b64decode(part + "=" * (-len(part) % 4))
    at = 1
    for kind in (1, 2):
        if raw[:1] != b"\x02" or len(raw) < at + 2 or raw[at] != kind:
            return False
        size, at = raw[at + 1], at + 2
        if size > 127:                             # the length has a second byte
            if len(raw) <= at:
                return False
            size, at = (size & 127) + (raw[at] << 7), at + 1
        at += size
    return at < len(raw)


class Rule(NamedTuple):
    kind: str
    keywords: tuple[str, ...]                     # lower case; empty: the expression is searched for
    pattern: str
    verify: Callable[[re.Match], bool] | None = None


#: the first three are the base kinds; the order is the order of kinds at equal starts
RULES = (
    Rule("assign", ("password", "passwd", "secret", "token", "apikey", "api_key"),
         r"""(?ai:(password|passwd|secret|token|api_?key))["']?\x20*[:=]\x20*["']?([A-Za-z0-9+/_.=-]+)""",
         lambda m: len(m[2]) >= 8),
    Rule("access", ("akia",), r"AKIA[A-Z0-9]+", lambda m: len(m[0]) >= 16),
    Rule("hex", (), r"[0-9a-f]{32,}"),
    Rule("git_token", ("ghp_", "gho_", "ghu_", "ghs_", "ghr_"), r"gh[pousr]_[A-Za-z0-9]{36}(?![A-Za-z0-9])",
         lambda m: _crc_ok(m[0])),
    Rule("package_token", ("npm_",), r"npm_[A-Za-z0-9]{36}(?![A-Za-z0-9])", lambda m: _crc_ok(m[0])),
    Rule("web_token", ("eyj",), r"eyJ[A-Za-z0-9_-]{8,}\.eyJ[A-Za-z0-9_-]{8,}\.[A-Za-z0-9_-]{16,}", lambda m: _jwt_ok(m[0])),
    Rule("private_key", ("-----begin ",), r"-----BEGIN (?:[A-Z]{2,12} ){0,3}PRIVATE KEY(?: BLOCK)?-----"),
    Rule("chat_token", ("xoxa-", "xoxb-", "xoxp-", "xoxr-", "xoxs-"), r"xox[abprs]-[0-9]{8,}-[A-Za-z0-9-]{16,}"),
    Rule("map_key", ("aiza",), r"AIza[A-Za-z0-9_-]{35}(?![A-Za-z0-9_-])"),
    Rule("pay_key", ("sk_live_", "rk_live_"), r"[sr]k_live_[A-Za-z0-9]{24,}"),
    Rule("lab_token", ("glpat-",), r"glpat-[A-Za-z0-9_-]{20}(?![A-Za-z0-9_-])"),
    Rule("age_key", ("age-secret-key-1",), r"AGE-SECRET-KEY-1[QPZRY9X8GF2TVDW0S3JN54KHCE6MUA7L]{58}(?![A-Z0-9])",
         lambda m: _bech32_ok(m[0])),
    Rule("note_key", ("nsec1",), r"nsec1[qpzry9x8gf2tvdw0s3jn54khce6mua7l]{58}(?![a-z0-9])", lambda m: _bech32_ok(m[0])),
    Rule("wallet_key", ("xprv", "yprv", "zprv", "tprv"), r"[xyzt]prv[1-9A-HJ-NP-Za-km-z]{107}(?![A-Za-z0-9])", lambda m: _base58_ok(m[0])),
    Rule("mail_key", ("sg.",), r"SG\.([A-Za-z0-9_-]{22})\.([A-Za-z0-9_-]{43})(?![A-Za-z0-9_-])",
         lambda m: _bytes_ok(m[1], 16) and _bytes_ok(m[2], 32)),
    Rule("index_token", ("pypi-ag",), r"pypi-(Ag[A-Za-z0-9_-]{50,})", lambda m: _macaroon_ok(m[1])),
    Rule("model_token", ("hf_",), r"hf_[A-Za-z]{34}(?![A-Za-z0-9])"),
    Rule("vault_token", ("hvs.", "hvb."), r"hv[sb]\.[A-Za-z0-9_-]{24,}"),
    Rule("shop_token", ("shpat_", "shpca_", "shppa_", "shpss_"), r"shp(?:at|ca|pa|ss)_[A-Fa-f0-9]{32}(?![A-Za-z0-9])"),
    Rule("droplet_token", ("dop_v1_", "doo_v1_", "dor_v1_"), r"do[opr]_v1_[a-f0-9]{64}(?![A-Za-z0-9])"),
    Rule("image_token", ("dckr_pat_",), r"dckr_pat_[A-Za-z0-9_-]{27}(?![A-Za-z0-9_-])"),
    Rule("git_fine_token", ("github_pat_",), r"github_pat_[A-Za-z0-9]{22}_[A-Za-z0-9]{59}(?![A-Za-z0-9])"),
    Rule("hook_address", ("https://hooks.slack.com/services/",),
         r"https://hooks\.slack\.com/services/T[A-Z0-9]{8,}/B[A-Z0-9]{8,}/[A-Za-z0-9]{24}(?![A-Za-z0-9])"),
)
BASE = ("assign", "access", "hex")


def scanner(rules: tuple[Rule, ...] = RULES) -> Callable[[str], list[tuple[int, int, str]]]:
    """A function from a text to its spans (start, end, kind), by start, then rule order."""
    automaton, owners = ahocorasick.Automaton(), {}
    for i, r in enumerate(rules):
        for k in r.keywords:
            owners.setdefault(k, []).append(i)
    for k, who in owners.items():
        automaton.add_word(k, (len(k), who))
    automaton.make_automaton()
    compiled = [re.compile(r.pattern) for r in rules]

    def scan(text: str) -> list[tuple[int, int, str]]:
        found = []
        def take(i: int, m: re.Match) -> None:
            if rules[i].verify is None or rules[i].verify(m):
                found.append((m.start(), i, m.end()))
        upto = [0] * len(rules)
        hits = []
        lower = text.encode("utf-8", "surrogatepass").lower().decode("utf-8", "surrogatepass")   # A-Z only
        for end, (n, who) in automaton.iter(lower):
            hits += [(end - n + 1, i) for i in who]
        for start, i in sorted(hits):
            if start >= upto[i] and (m := compiled[i].match(text, start)):
                upto[i] = m.end()
                take(i, m)
        for i, r in enumerate(rules):
            if not r.keywords:
                for m in compiled[i].finditer(text):
                    take(i, m)
        return [(s, e, rules[i].kind) for s, i, e in sorted(found)]

    return scan


def secrets(docs: DataFrame, key: str = "doc_id", text: str = "text") -> DataFrame:
    """Secrets of every whole text: key, ``spans`` as array of (kind, start, end) in code points, end exclusive.

    Null and empty texts have none; equal rows give equal results; other columns are dropped.
    """
    def make():
        scan = scanner()
        return lambda t: ([{"kind": k, "start": s, "end": e} for s, e, k in scan(t)],)
    return per_text(docs, key, text, make, "spans array<struct<kind:string,start:bigint,end:bigint>>")


def digests(found: DataFrame, base: tuple[str, ...], key: str = "doc_id") -> DataFrame:
    """Counts per base kind, SHA-256 over the base spans, and all spans as text."""
    line = lambda a: F.array_join(F.transform(a, lambda x: F.concat_ws(":", x["kind"], x["start"], x["end"])), ",")
    own = F.filter("spans", lambda x: x["kind"].isin(*base))
    of_kind = lambda k: F.size(F.filter("spans", lambda x: x["kind"] == k)).cast("long").alias(f"n_{k}")
    counts = [of_kind(k) for k in base]
    return found.select(key, *counts, F.sha2(line(own), 256).alias("base_sha256"), line(F.col("spans")).alias("spans"))

