"""Language identification by nearest centroid.

Texts become normalised TF-IDF vectors over hashed byte n-grams of letters. Each language has several centroids, found by
spherical k-means on a bounded sample of its labelled texts, which document frequencies and the distances for rejection come
from as well. A text gets the language of the centroid with the largest cosine and is rejected if its distance to it is larger
than what the centroid's language shows on that sample for texts of its length.
"""

from __future__ import annotations

import re
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from lakegauge.llm.common import per_text
from lakegauge.session import materialise

#: dimensions of the hashed vectors; labelled texts per language that the model is fitted on, at most; centroids per language
DIMS, SAMPLE, CENTROIDS, ROUNDS = 4096, 2000, 4, 8
_FOLD = np.arange(256, dtype=np.uint32)
_FOLD[65:91] += 32
_FOLD[:65] = _FOLD[91:97] = _FOLD[123:128] = 32   # ASCII that is no letter separates words


def counts(text: str, dims: int = DIMS) -> np.ndarray:
    """Counts of hashed byte 1- to 3-grams of a whole text, lower-cased, other ASCII than letters as one blank each."""
    b = _FOLD[np.frombuffer(f" {text} ".encode("utf-8", "replace"), np.uint8)]
    b = b[np.concatenate([[True], (b[1:] != 32) | (b[:-1] != 32)])]
    two = b[:-1] * np.uint32(0x9E3779B1) + b[1:]
    three = two[:-1] * np.uint32(0x85EBCA6B) + b[2:]
    shift = np.uint32(32 - int(dims).bit_length() + 1)
    out = np.zeros(dims, np.float32)
    for g, salt in ((b, 1), (two, 2), (three, 3)):
        h = ((g + np.uint32(salt)) * np.uint32(0xC2B2AE35)) >> shift
        out += np.bincount(h, minlength=dims)
    return out


@dataclass
class Model:
    langs: list[str]                              # of each centroid
    centroids: np.ndarray                         # (centroids, dims), unit length
    idf: np.ndarray
    floor: dict[str, list[float]]                 # per language: least cosine by length class


def _classes(n: int) -> int:
    """Length class of a text: its number of letters in powers of four, eight classes."""
    return min(7, max(0, n.bit_length() - 1) // 2)


def vector(count: np.ndarray, idf: np.ndarray) -> np.ndarray:
    v = np.log1p(count) * idf
    n = float(np.linalg.norm(v))
    return v / n if n else v


def _packed(count: np.ndarray) -> bytes:
    """The dimensions that occur, and their counts."""
    at = np.flatnonzero(count)
    return at.astype("<u4").tobytes() + count[at].astype("<f4").tobytes()


def _unpacked(b: bytes) -> tuple[np.ndarray, np.ndarray]:
    n = len(b) // 8
    return np.frombuffer(b, "<u4", n), np.frombuffer(b, "<f4", n, 4 * n)


def _fit_language(texts: pa.Table, idf: np.ndarray, k: int, rounds: int) -> pa.Table:
    """Spherical k-means on the vectors of one language: centroids, and the least cosine per length class."""
    texts = texts.sort_by("rank")
    x = np.zeros((len(texts), len(idf)), np.float32)
    for row, packed in zip(x, texts.column("counts")):
        at, n = _unpacked(packed.as_py())
        row[at] = vector(n, idf[at])
    c = x[np.linspace(0, len(x) - 1, min(k, len(x))).astype(int)]
    for _ in range(rounds):
        near = (x @ c.T).argmax(1)
        member = (near == np.arange(len(c))[:, None]).astype(np.float32)
        c = np.where(member.any(1, keepdims=True), member @ x, c)
        c /= np.maximum(np.linalg.norm(c, axis=1, keepdims=True), 1e-9)
    own, size = (x @ c.T).max(1), texts.column("size").to_numpy()
    held = np.unique(size)                        # a class without texts takes the floor of the nearest one that has some
    floor = [float(own[size == held[np.abs(held - i).argmin()]].min()) for i in range(8)]
    return pa.table({"lang": [texts.column("lang")[0].as_py()] * len(c), "centroid": [row.astype("<f4").tobytes() for row in c],
                     "floor": [floor] * len(c)})


_ASCII = re.compile(r"[\x00-\x7f]+")
_NO_LETTERS = bytes(b for b in range(256) if not (65 <= b <= 90 or 97 <= b <= 122))


def _letters(t: str) -> int:
    """Letters of the whole text."""
    n = len(t.encode("ascii", "ignore").translate(None, _NO_LETTERS))
    return n if t.isascii() else n + sum(map(str.isalpha, _ASCII.sub("", t)))


def fit(docs: DataFrame, key: str = "doc_id", text: str = "text", lang: str = "lang", sample: int = SAMPLE,
        dims: int = DIMS, k: int = CENTROIDS, slack: float = 0.5) -> Model:
    """Fit on at most ``sample`` labelled texts per language, those first in a hash order of keys and texts; equal rows count once.

    Rows without language or without a letter are no training rows. Without any, the model knows no language. Only vectors of
    fixed size leave the tasks that read the texts. A text is later rejected below ``slack`` times the least cosine that its language's
    sample shows in its length class.
    """
    rank = F.row_number().over(Window.partitionBy("lang").orderBy("order", "id", "h"))
    # keys and hashes of texts first, so that no text is sorted; then the texts of the chosen ones. Equal rows are one.
    usable = docs.where(F.col(lang).isNotNull() & has_letter(F.col(text)))
    of_row = [F.col(lang).alias("lang"), F.col(key).alias("id"), F.xxhash64(F.col(text)).alias("h")]
    ids = usable.select(*of_row).withColumn("order", F.xxhash64("id", "h"))
    # only about twice the sample of each language, those with small hashes, meet in the window that ranks them
    rows = {r["lang"]: r["n"] for r in ids.groupBy("lang").agg(F.count("*").alias("n")).collect()}    # one per language
    part = F.create_map(*[F.lit(x) for lang_, n in rows.items() for x in (lang_, 2.0 * sample / n)]) if rows else None
    near = ids.where(F.col("order") / F.lit(2.0 ** 64) + 0.5 < part[F.col("lang")]) if rows else ids
    chosen = materialise(near.distinct().withColumn("rank", rank).where(F.col("rank") <= sample).drop("order"), "sampled")
    texts = usable.select(F.struct(*of_row).alias("at"), F.col(text).alias("text"))
    drawn = texts.join(chosen.select(F.struct("lang", "id", "h").alias("at"), "rank"), "at").select(
        F.struct("at.lang", "rank").alias("at"), "text").dropDuplicates(["at"])
    train = materialise(per_text(drawn.repartition("at"), "at", "text", lambda: lambda t: (
        _packed(counts(t, dims)), _classes(_letters(t))), "counts binary, size int").select(
        "at.*", "counts", "size"), "training")

    def seen(batches):                            # documents per dimension: one row of sums per task
        n, df = 0, np.zeros(dims, np.int64)
        for b in batches:
            for t in b.column(0).to_pylist():
                n += 1
                df[_unpacked(t)[0]] += 1
        yield pa.RecordBatch.from_pydict({"n": [n], "df": [df.tolist()]}, schema=pa.schema(
            [("n", pa.int64()), ("df", pa.list_(pa.int64()))]))

    parts = train.select("counts").mapInArrow(seen, "n long, df array<long>")
    total = parts.select("n", F.posexplode("df").alias("i", "c")).groupBy("i").agg(F.sum("n").alias("n"), F.sum("c").alias("c"))
    idf = np.zeros(dims, np.float32)
    for r in total.collect():                     # dims rows
        idf[r["i"]] = np.log((1 + r["n"]) / (1 + r["c"])) + 1

    def clusters(texts: pa.Table) -> pa.Table:
        return _fit_language(texts, idf, k, ROUNDS)

    got = train.groupBy("lang").applyInArrow(clusters, "lang string, centroid binary, floor array<double>").collect()
    got.sort(key=lambda r: (r["lang"], bytes(r["centroid"])))
    return Model([r["lang"] for r in got],
                 np.stack([np.frombuffer(r["centroid"], "<f4") for r in got]) if got else np.zeros((0, dims), np.float32),
                 idf, {r["lang"]: [x * slack for x in r["floor"]] for r in got})


def has_letter(text: Column) -> Column:
    return F.coalesce(text.rlike(r"\p{L}"), F.lit(False))


def _judge(shared):
    """Function of one text that returns (language, cosine, rejected), made once per task from the broadcast model."""
    def make():
        m = shared.value
        def one(t: str):
            letters = _letters(t)
            if not letters or not m.langs:
                return "und", 0.0, True
            near = m.centroids @ vector(counts(t, len(m.idf)), m.idf)
            i = int(near.argmax())
            score = min(1.0, max(0.0, float(near[i])))
            return m.langs[i], score, score < m.floor[m.langs[i]][_classes(letters)]
        return one
    return make


def predict(docs: DataFrame, model: Model, key: str = "doc_id", text: str = "text") -> DataFrame:
    """Language of every whole text: key, lang_pred, score (cosine to the nearest centroid, 0 to 1), rejected.

    Null texts and texts without a letter get ``und`` with score 0 and are rejected; so does every text if the model knows no
    language. Equal texts get equal results; other columns are dropped.
    """
    shared = docs.sparkSession.sparkContext.broadcast(model)      # languages x centroids x dims numbers
    clean = F.when(has_letter(F.col(text)), F.col(text)).otherwise("").alias(text)
    return per_text(docs.select(F.col(key), clean), key, text, _judge(shared), "lang_pred string, score double, rejected boolean")


def split(key: Column) -> Column:
    """Held out where the CRC-32 of the key as text leaves 1 when divided by 3."""
    return F.coalesce(F.crc32(F.coalesce(key.cast("string"), F.lit("")).cast("binary")) % 3 == 1, F.lit(False))


def accepted(docs: DataFrame, model: Model, text: str = "text") -> DataFrame:
    """The rows whose text the model does not reject, with their columns, of any names, in one pass over the rows.

    Null texts and texts without a letter go; equal texts share one decision; an empty table gives no rows.
    """
    one_pass = _judge(docs.sparkSession.sparkContext.broadcast(model))

    def make():
        one = one_pass()
        return lambda t: (t, one(t)[2])
    others = [c for c in docs.columns if c != text]
    row = F.struct(*[F.col(f"`{c}`").alias(f"f{i}") for i, c in enumerate(others)], F.lit(0).alias("end")).alias("row")
    shown = docs.select(row, F.when(has_letter(F.col(f"`{text}`")), F.col(f"`{text}`")).otherwise("").alias("text"))
    kept = per_text(shown, "row", "text", make, "text string, rejected boolean").where("NOT rejected")
    return kept.select(*[F.col("text").alias(c) if c == text else F.col(f"row.f{others.index(c)}").alias(c) for c in docs.columns])
