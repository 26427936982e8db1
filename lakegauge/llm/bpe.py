"""Byte-level BPE with overlapping chunks.

Texts up to one chunk are encoded as they are. Longer ones are cut into chunks that overlap; all chunks are pre-tokenised in
parallel, and where two neighbours have a pre-token boundary in common inside their overlap, the later one has fallen into
step with the earlier: from there on both would go on alike. The text is cut at these places, the pieces are encoded in
parallel, and their ids are joined in order. Only boundaries behind a character that is not white space count, as the pattern
looks ahead behind white space. If any pair of neighbours of a text does not fall into step (a run of letters longer than the
overlap), that text is encoded in one piece.
"""

from __future__ import annotations

import base64
import hashlib
import sys
from array import array
from functools import lru_cache

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from lakegauge.llm.common import bounded_batches, per_text, per_value, whole

CHUNK, OVERLAP = 1 << 15, 512


@lru_cache(maxsize=4)
def _encoding(path: str, pattern: str):
    import tiktoken
    with open(path, "rb") as f:
        ranks = {base64.b64decode(a): int(b) for a, b in map(bytes.split, f)}
    return tiktoken.Encoding("ranks", pat_str=pattern, mergeable_ranks=ranks, special_tokens={})


def _packed(ids: list[int]) -> bytes:
    """Ids as little-endian unsigned 32-bit numbers."""
    a = array("I", ids)
    if sys.byteorder == "big":
        a.byteswap()
    return a.tobytes()


def _unpacked(raw: bytes) -> list[int]:
    a = array("I")
    a.frombytes(raw)
    if sys.byteorder == "big":
        a.byteswap()
    return a.tolist()


def _digest(enc, ids: list[int]) -> tuple[int, str, str]:
    decimal = str(ids)[1:-1].replace(" ", "")
    return len(ids), hashlib.sha256(decimal.encode()).hexdigest(), hashlib.sha256(enc.decode_bytes(ids)).hexdigest()


_DIGEST = "n_tokens bigint, ids_sha256 string, decoded_sha256 string"


def _boundaries(docs: DataFrame, pattern: str, chunk: int, overlap: int) -> DataFrame:
    """Chunks of long texts with the boundaries in their head and in the part that the next chunk repeats."""
    def make():
        import regex
        tokens = regex.compile(pattern)
        def one(t: str):
            head, tail = [], []
            for m in tokens.finditer(t):
                e = m.end()
                if e < len(t) and not t[e - 1].isspace():
                    if e <= overlap:
                        head.append(e)
                    elif e > chunk:
                        tail.append(e - chunk)
            return t, head, tail
        return one
    n = F.ceil((F.length("text") - overlap) / chunk).cast("int")
    cut = docs.select("uid", "id", F.col("text").alias("whole"), F.explode(F.sequence(F.lit(0), n - 1)).alias("k")).select(
        F.struct("uid", "id", "k").alias("at"), F.expr(f"substring(whole, k * {chunk} + 1, {chunk + overlap})").alias("text"))
    return per_text(cut.repartition("at"), "at", "text", make, "text string, head array<int>, tail array<int>").select(
        "at.*", "text", "head", "tail")


def _pieces(docs: DataFrame, pattern: str, chunk: int, overlap: int) -> DataFrame:
    """Pieces (uid, id, k, text) of long texts that can be encoded on their own."""
    w = Window.partitionBy("uid").orderBy("k")
    b = _boundaries(docs, pattern, chunk, overlap)
    b = b.withColumn("cut", F.array_min(F.array_intersect("tail", F.lead("head").over(w)))).withColumns({
        "last": F.lead("k").over(w).isNull(), "start": F.coalesce(F.lag("cut").over(w), F.lit(0))})
    b = b.withColumn("bad", F.max(~F.col("last") & F.col("cut").isNull()).over(Window.partitionBy("uid")))
    size = F.when(F.col("last"), F.length("text")).otherwise(F.lit(chunk) + F.col("cut")) - F.col("start")
    good = b.where("NOT bad").select("uid", "id", "k", F.substring("text", F.col("start") + 1, size).alias("text"))
    part = F.when(F.col("last"), F.col("text")).otherwise(F.substring("text", 1, chunk))
    joined = b.where("bad").groupBy("uid", "id").agg(F.array_sort(F.collect_list(F.struct("k", part.alias("t")))).alias("p"))
    return good.unionByName(joined.select("uid", "id", F.lit(0).alias("k"), F.array_join("p.t", "").alias("text")))


def encode(docs: DataFrame, ranks: str, pattern: str, key: str = "doc_id", text: str = "text", digest: bool = False,
           chunk: int = CHUNK, overlap: int = OVERLAP) -> DataFrame:
    """Token ids of every whole text: key and ``ids``, little-endian unsigned 32-bit numbers in one binary value.

    With ``digest`` the ids are not returned but, per document, their number, the SHA-256 of the decimal ids joined by commas
    and the SHA-256 of the decoded bytes. Null and empty texts have no ids; equal rows give equal results; other columns are
    dropped. ``ranks`` is a file in tiktoken's format that every executor can open.
    """
    bounded_batches(docs.sparkSession)
    rows = docs.select(F.col(key).alias("id"), whole(text).alias("text"))
    long = F.length("text") > chunk + overlap

    def short():
        enc = _encoding(ranks, pattern)
        return (lambda t: _digest(enc, enc.encode_ordinary(t))) if digest else (lambda t: (_packed(enc.encode_ordinary(t)),))

    def piece():
        enc = _encoding(ranks, pattern)
        return lambda t: (_packed(enc.encode_ordinary(t)),)

    out = _DIGEST if digest else "ids binary"
    done = per_text(rows.where(~long), "id", "text", short, out)
    pieces = _pieces(rows.where(long).withColumn("uid", F.monotonically_increasing_id()), pattern, chunk, overlap)
    at = pieces.select(F.struct("uid", "id", "k").alias("at"), "text").repartition("at")
    coded = per_text(at, "at", "text", piece, "ids binary").select("at.*", "ids")
    joined = coded.groupBy("uid", "id").agg(F.array_sort(F.collect_list(F.struct("k", "ids"))).alias("p")).select(
        "id", F.aggregate("p.ids", F.lit(b"").cast("binary"), lambda a, x: F.concat(a, x)).alias("ids"))
    if digest:
        joined = digests(joined, ranks, pattern, "id")
    return done.unionByName(joined).withColumnRenamed("id", key)


def _on_ids(make):
    def made():
        one = make()
        return lambda raw: one(_unpacked(raw or b""))
    return made


def digests(encoded: DataFrame, ranks: str, pattern: str, key: str = "doc_id") -> DataFrame:
    def one():
        enc = _encoding(ranks, pattern)
        return lambda ids: _digest(enc, ids)
    return per_value(encoded.select(key, "ids"), _on_ids(one), _DIGEST)


def decode(encoded: DataFrame, ranks: str, pattern: str, key: str = "doc_id") -> DataFrame:
    """Raw bytes of every row of ids: key and ``bytes``. Ids outside the ranks fail; no ids give no bytes."""
    def one():
        enc = _encoding(ranks, pattern)
        return lambda ids: (enc.decode_bytes(ids),)
    return per_value(encoded.select(key, "ids"), _on_ids(one), "bytes binary")
