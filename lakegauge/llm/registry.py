"""Registered queries of this package, and their SQL twins."""

from __future__ import annotations

from collections.abc import Callable

import public_tokenizers
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from lakegauge.llm import binary, bpe, codes, dedup, langid, licenses, merkle, minhash, mixing, neighbours, pii, quality, secrets

QUERIES: dict[str, Callable[[SparkSession, str], DataFrame]] = {}
ORACLE: dict[str, str] = {}


def _table(spark: SparkSession, sf: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf}/{name}.parquet")


def _query(sql: str | None = None):
    def register(fn):
        QUERIES[fn.__name__] = fn
        if sql:
            ORACLE[fn.__name__] = sql
        return fn
    return register


_WORDS = "regexp_extract_all(coalesce(text, ''), '[^ \\x09-\\x0D]+')"
_TESTS = "\nUNION ALL BY NAME\n".join(
    f"SELECT stratum, q, '{r}' AS rule, CAST({c} AS DOUBLE) AS cutoff, coalesce({m.replace('100D', '100.0::DOUBLE')} > {c}, false) AS over FROM held"
    for r, (m, cuts) in quality.RULES.items() for c in cuts)
_OVER = " OR ".join(
    f"coalesce({m.replace('100D', '100.0::DOUBLE')} > (SELECT cutoff FROM cut c WHERE c.rule = '{r}' AND c.stratum IS NOT DISTINCT FROM m.stratum), false)"
    for r, (m, _) in quality.RULES.items())


@_query(f"""
WITH w AS (SELECT doc_id, lang AS stratum, coalesce(text, '') AS t, {_WORDS} AS w FROM documents),
 win AS (SELECT doc_id, i, w[i] AS a, w[i + 1] AS b, w[i + 2] AS c
         FROM (SELECT doc_id, w, unnest(range(1, len(w) - 1)) AS i FROM w)),
 rep AS (SELECT doc_id, i FROM (SELECT *, count(*) OVER (PARTITION BY doc_id, a, b, c) AS n FROM win) WHERE n > 1),
 cov AS (SELECT doc_id, count(DISTINCT i + o) AS n FROM rep, range(3) r(o) GROUP BY 1),
 lines AS (SELECT doc_id, list_filter(string_split(t, chr(10)), lambda x: regexp_matches(x, '[^ \\x09-\\x0D]')) AS l FROM w),
 m AS (SELECT doc_id, stratum, CAST(len(w) AS BIGINT) AS n_words,
   CAST(length(regexp_replace(t, '[ \\x09-\\x0D]+', '', 'g')) AS BIGINT) AS word_chars,
   CAST(length(regexp_replace(t, '[^#*$%&|<>]+', '', 'g')) AS BIGINT) AS n_symbols,
   CAST(length(regexp_replace(t, '[^A-Z]+', '', 'g')) AS BIGINT) AS n_capitals,
   CAST(len(l) AS BIGINT) AS n_lines, CAST(len(l) - len(list_distinct(l)) AS BIGINT) AS n_dup_lines,
   CAST(coalesce(cov.n, 0) AS BIGINT) AS n_repeat_words FROM w JOIN lines USING (doc_id) LEFT JOIN cov USING (doc_id)),
 f AS (SELECT *, n_words < 50 OR 100 * n_repeat_words > 50 * n_words AS base_failed FROM m),
 held AS (SELECT f.*, q FROM f JOIN (SELECT doc_id, min(quality) AS q FROM labels WHERE quality IS NOT NULL GROUP BY 1) USING (doc_id)
          WHERE NOT base_failed),
 tests AS ({_TESTS}),
 c AS (SELECT stratum, rule, cutoff, count(*) FILTER (WHERE q = 1) AS n, count(*) FILTER (WHERE q = 0) AS n_bad,
   count(*) FILTER (WHERE q = 1 AND over) AS k, count(*) FILTER (WHERE q = 0 AND over) AS bad FROM tests GROUP BY ALL),
 ok AS (SELECT *, CASE WHEN k >= n * 0.01 THEN 1.0 ELSE list_sum(list_transform(range(0, k + 1), lambda i:
   exp(lgamma(n + 1.0) - lgamma(i + 1.0) - lgamma(n - i + 1.0) + i * ln(0.01) + (n - i) * ln(0.99)))) END
   * {sum(len(c) for _, c in quality.RULES.values())} * (SELECT count(DISTINCT coalesce(stratum, '')) FROM held) AS p FROM c WHERE bad > 0 AND n > 0),
 cut AS (SELECT stratum, rule, max_by(cutoff, (bad / n_bad - k / n, cutoff)) AS cutoff FROM ok WHERE p <= 0.05 GROUP BY 1, 2)
SELECT doc_id, n_words, word_chars, n_symbols, n_dup_lines, n_repeat_words, base_failed,
  NOT base_failed AND NOT ({_OVER}) AS kept FROM f m""")
def op1_quality_rules(spark: SparkSession, sf: str) -> DataFrame:
    """Counts and verdict of every document; cutoffs certified per language on the labelled documents."""
    return quality.quality(_table(spark, sf, "documents"), _table(spark, sf, "labels")).select(
        "doc_id", "n_words", "word_chars", "n_symbols", "n_dup_lines", "n_repeat_words", "base_failed", "kept")


_TARGETS = """
 s AS (SELECT source, CAST(sum(size) AS BIGINT) AS source_size FROM d GROUP BY 1),
 w AS (SELECT *, [3, 1, 2][(row_number() OVER (ORDER BY source NULLS LAST) - 1) % 3 + 1] AS weight,
   2.0::DOUBLE * source_size AS cap FROM s),
 l AS (SELECT *, (sum(source_size) OVER () * 1.5::DOUBLE
   - coalesce(sum(cap) OVER (ORDER BY cap / weight, source NULLS LAST ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING), 0))
   / sum(weight) OVER (ORDER BY cap / weight, source NULLS LAST ROWS BETWEEN CURRENT ROW AND UNBOUNDED FOLLOWING) AS level,
   row_number() OVER (ORDER BY cap / weight, source NULLS LAST) AS place FROM w),
 t AS (SELECT source, source_size, least(cap, weight * coalesce(
   (SELECT arg_min(level, place) FROM l WHERE level * weight < cap), 'infinity'::DOUBLE)) AS target FROM l)"""


@_query(f"""
WITH d AS (SELECT doc_id, source, CAST(len({_WORDS}) AS BIGINT) AS size FROM documents), {_TARGETS},
 b AS (SELECT *, CASE WHEN source_size > 0 THEN CAST(floor(target / source_size) AS BIGINT) ELSE 0 END AS epochs FROM t),
 r AS (SELECT *, CAST(floor(target) AS BIGINT) - epochs * source_size AS rest FROM b),
 o AS (SELECT d.*, r.* EXCLUDE (source), sum(size) OVER (PARTITION BY d.source
   ORDER BY md5(concat(coalesce(CAST(doc_id AS VARCHAR), '-'), ':')), doc_id, size ROWS UNBOUNDED PRECEDING) - size AS start
   FROM d JOIN r ON d.source IS NOT DISTINCT FROM r.source)
SELECT doc_id, size, source_size, target,
  CAST(epochs * size + least(size, greatest(0, rest - start)) AS BIGINT) AS taken FROM o""")
def op6_mix_sources(spark: SparkSession, sf: str) -> DataFrame:
    """Words that the mix takes of every document."""
    return mixing.shares(_table(spark, sf, "documents")).select("doc_id", "size", "source_size", "target", "taken")


@_query("""
WITH n AS (SELECT doc_id, length(coalesce(text, '')) AS chars, regexp_replace(coalesce(text, ''), '[ \\x09-\\x0D]+', '', 'g') AS t
           FROM documents),
 g AS (SELECT t, count(*) AS n, arg_min(doc_id, (-chars, doc_id)) AS keep_id FROM n GROUP BY 1)
SELECT doc_id, keep_id, CAST(g.n AS BIGINT) AS group_size, doc_id = keep_id AS kept, sha256(t) AS text_sha256
FROM n JOIN g USING (t)""")
def op8_exact_dedup(spark: SparkSession, sf: str) -> DataFrame:
    """Group of equal texts of every document, and the row that stays."""
    return dedup.exact_groups(_table(spark, sf, "documents")).select(
        "doc_id", "keep_id", "group_size", "kept", "text_sha256")


@_query()
def op2_license_scan(spark: SparkSession, sf: str) -> DataFrame:
    """License phrases and labels of every document."""
    labels = lambda a: F.array_join(F.array_sort(F.array_distinct(a)), ",")
    found = licenses.licenses(_table(spark, sf, "documents"))
    return found.select("doc_id", "n_words", F.size("base").cast("long").alias("n_base"),
                        F.array_min("base.first").alias("first_word"), F.array_max("base.first").alias("last_word"),
                        labels(F.col("base.label")).alias("base_labels"),
                        labels(F.concat("base.label", "found.label")).alias("labels"),
                        F.coalesce(F.array_max("found.score"), F.lit(0.0)).alias("score"))


@_query()
def op5_secret_scan(spark: SparkSession, sf: str) -> DataFrame:
    """Secrets of every document."""
    return secrets.digests(secrets.secrets(_table(spark, sf, "documents")), secrets.BASE)


@_query()
def op7_byte_bpe(spark: SparkSession, sf: str) -> DataFrame:
    """Token digests of every document."""
    return bpe.encode(_table(spark, sf, "documents"), public_tokenizers.path("byte_bpe_multi_50k.tiktoken"),
                      public_tokenizers.PATTERN, digest=True)


@_query()
def op10_token_files(spark: SparkSession, sf: str) -> DataFrame:
    """Token files of all documents, read back."""
    manifest = binary.write_ids(_table(spark, sf, "documents"), public_tokenizers.path("word_bpe_49k.json"), 2,
                                binary.new_folder(spark))
    return binary.read_ids(manifest)


@_query()
def op9_language_id(spark: SparkSession, sf: str) -> DataFrame:
    """Predicted language of every document; the model is fitted on the documents that are not held out."""
    docs = _table(spark, sf, "documents")
    model = langid.fit(docs.where(~langid.split(F.col("doc_id"))))
    return langid.predict(docs, model).select("doc_id", langid.split(F.col("doc_id")).alias("held_out"), "lang_pred", "score",
                                              "rejected")


@_query()
def op4_near_dedup(spark: SparkSession, sf: str) -> DataFrame:
    """Component of near-duplicates of every document."""
    return minhash.near_groups(_table(spark, sf, "documents"))


@_query()
def op3_personal_data(spark: SparkSession, sf: str) -> DataFrame:
    """Personal data of every document."""
    kinds = F.array(*map(F.lit, pii.KINDS))
    named = lambda a: F.transform(a, lambda s: F.struct(
        F.get(kinds, s["rank"]).alias("kind"), s["start"].alias("start"), s["end"].alias("end")))
    found = pii.private(_table(spark, sf, "documents"))
    line = lambda a: F.array_join(F.transform(named(a), lambda x: F.concat_ws(":", x["kind"], x["start"], x["end"])), ",")
    counts = lambda k: F.size(F.filter("base", lambda s: s["rank"] == pii.KINDS.index(k))).cast("long").alias(f"n_{k}")
    return found.select("doc_id", *[counts(k) for k in pii.KINDS[:4]], F.sha2(line(F.col("base")), 256).alias("base_sha256"),
                        line(F.col("spans")).alias("spans"))


_LEVELS = 6                                              # trees of up to 16^6 leaves
_FIELDS = lambda text: " || ".join(
    f"coalesce(strlen(CAST({c} AS VARCHAR)) || ':' || CAST({c} AS VARCHAR), '-')" for c in ("doc_id", "source", "lang", "n_chars", text))
_LOWER = "translate(text, 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz')"
_CRC = """xor(list_reduce(list_concat([4294967295::UBIGINT], list_transform(string_split(CAST(doc_id AS VARCHAR), ''),
  lambda c: CAST(ascii(c) AS UBIGINT))), lambda a, b: list_reduce(list_concat([xor(a, b)], list_transform(range(8),
  lambda i: CAST(i AS UBIGINT))), lambda x, i: xor(x >> 1, 3988292384::UBIGINT * (x & 1)))), 4294967295::UBIGINT)"""


def _climb(nodes: str, group: str, tag: str) -> str:
    """CTEs of all levels over ``nodes`` (group, i, d, n); a tree that has one node stays as it is."""
    out = f"{tag}0 AS (SELECT {group} AS g, i, d, n FROM {nodes})"
    for k in range(_LEVELS):
        out += f""", {tag}{k + 1} AS (SELECT g, i // 16 AS i, CASE WHEN any_value(n) > 1 THEN sha256(string_agg(d, '' ORDER BY i))
          ELSE any_value(d) END AS d, (any_value(n) + 15) // 16 AS n FROM {tag}{k} GROUP BY g, i // 16)"""
    return out


def _fold(start: str, tree: str, tag: str, group: str) -> str:
    """CTEs that carry (doc_id, ..., f, proof) of ``start`` through the levels of a tree along ``gi``."""
    out, last = "", start
    for k in range(_LEVELS):
        out += f""", {tag}{k} AS (SELECT p.doc_id, any_value(p.{group}) AS {group}, p.gi // 16 AS gi,
          CASE WHEN any_value(t.n) > 1 THEN sha256(string_agg(CASE WHEN t.i = p.gi THEN p.f ELSE t.d END, '' ORDER BY t.i))
            ELSE any_value(p.f) END AS f,
          any_value(p.proof) || coalesce(string_agg(t.d, '' ORDER BY t.i) FILTER (WHERE t.i <> p.gi), '') AS proof
          FROM {last} p JOIN {tree}{k} t ON t.g = p.{group} AND t.i // 16 = p.gi // 16 GROUP BY p.doc_id, p.gi // 16)"""
        last = f"{tag}{k}"
    return out


@_query(f"""
WITH l AS (SELECT doc_id, coalesce('=' || source, '') AS g, sha256({_FIELDS("text")}) AS leaf,
   CASE WHEN {_CRC} % 5 = 0 THEN sha256({_FIELDS(_LOWER)}) END AS forged FROM documents),
 r AS (SELECT *, row_number() OVER (PARTITION BY g ORDER BY doc_id, leaf) - 1 AS i, count(*) OVER (PARTITION BY g) AS n FROM l),
 leaves AS (SELECT g, i, leaf AS d, n FROM r), {_climb("leaves", "g", "a")},
 s AS (SELECT g AS src, d, row_number() OVER (ORDER BY g) - 1 AS i, count(*) OVER () AS n FROM a{_LEVELS}), {_climb("s", "0", "b")},
 start AS (SELECT doc_id, g, i AS gi, coalesce(forged, leaf) AS f, '' AS proof FROM r)
 {_fold("start", "a", "x", "g")},
 up AS (SELECT doc_id, 0 AS top, s.i AS gi, f, proof, d AS subroot FROM x{_LEVELS - 1} JOIN s ON src = x{_LEVELS - 1}.g)
 {_fold("up", "b", "y", "top")}
SELECT doc_id, leaf, subroot, b{_LEVELS}.d AS root, sha256(y{_LEVELS - 1}.proof) AS proof_sha256, y{_LEVELS - 1}.f AS folded_root,
  y{_LEVELS - 1}.f = b{_LEVELS}.d AS verified
FROM y{_LEVELS - 1} JOIN r USING (doc_id) JOIN up USING (doc_id), b{_LEVELS}""")
def op13_merkle_manifest(spark: SparkSession, sf: str) -> DataFrame:
    """Leaf, proof and folded root of every document; every fifth key's text is tampered with before folding."""
    lower = F.translate("text", "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz")
    fifth = F.coalesce(F.crc32(F.col("doc_id").cast("string").cast("binary")) % 5 == 0, F.lit(False))
    return merkle.manifest(_table(spark, sf, "documents"), tamper={"text": lower}, tampered=fifth)


def _book(distances: str) -> str:
    """Nearest entries under a table (id, p, e, d)."""
    return f"SELECT id, p, arg_min(e, (d, e)) AS e, min(d) AS d FROM {distances} GROUP BY id, p"


def _distances(book: str) -> str:
    return (f"SELECT v.id, v.p, b.e, CAST(list_sum(list_transform(list_zip(v.x, b.x), lambda z: (z[1] - z[2]) * (z[1] - z[2]))) AS BIGINT) AS d "
            f"FROM v JOIN {book} b ON b.p = v.p")


def _means(codes: str, book: str) -> str:
    return f"""SELECT b.p, b.e, coalesce(m.x, b.x) AS x FROM {book} b LEFT JOIN (
      SELECT p, e, list(CAST(floor(s / n) AS BIGINT) ORDER BY i) AS x FROM (
        SELECT c.p, c.e, i, sum(v.x[i]) AS s, count(*) AS n FROM {codes} c JOIN v USING (id, p), range(1, 1000) r(i)
        WHERE i <= len(v.x) GROUP BY ALL) GROUP BY p, e) m ON m.p = b.p AND m.e = b.e"""


@_query(f"""
WITH k AS (SELECT vec_id AS id, label, list_transform(embedding, lambda c: CAST(floor(256 * CAST(c AS DOUBLE)) AS BIGINT)) AS x
   FROM embeddings WHERE embedding IS NOT NULL AND len(list_filter(embedding, lambda c: c IS NULL OR NOT isfinite(c))) = 0),
 v AS MATERIALIZED (SELECT id, p, x[p * len(x) // 16 + 1 : (p + 1) * len(x) // 16] AS x FROM k, range(16) r(p)),
 s AS (SELECT id, row_number() OVER (ORDER BY id) - 1 AS e FROM k ORDER BY id LIMIT 64),
 b0 AS MATERIALIZED (SELECT p, e, x FROM v JOIN s USING (id)),
 d0 AS ({_distances("b0")}), c0 AS MATERIALIZED ({_book("d0")}), b1 AS MATERIALIZED ({_means("c0", "b0")}),
 d1 AS ({_distances("b1")}), c1 AS MATERIALIZED ({_book("d1")}), b2 AS MATERIALIZED ({_means("c1", "b1")}),
 d2 AS ({_distances("b2")}), c2 AS MATERIALIZED ({_book("d2")}),
 e AS (SELECT id AS vec_id, label, string_agg(printf('%02x', e), '' ORDER BY p) AS code, CAST(sum(d) AS BIGINT) AS error
       FROM c2 JOIN k USING (id) GROUP BY ALL)
SELECT vec_id, code, error, CAST(sum(error) OVER (PARTITION BY label) AS BIGINT) AS label_error,
  (SELECT sha256(string_agg(array_to_string(x, ','), ',' ORDER BY p, e)) FROM b2) AS codebooks_sha256 FROM e""")
def op11_vector_codes(spark: SparkSession, sf: str) -> DataFrame:
    """Code and error of every vector."""
    return codes.coded(_table(spark, sf, "embeddings")).drop("label")


@_query("""
WITH RECURSIVE k AS (SELECT vec_id, embedding::DOUBLE[] AS x FROM embeddings WHERE embedding IS NOT NULL
   AND len(list_filter(embedding, lambda c: c IS NULL OR NOT isfinite(c))) = 0 AND len(list_filter(embedding, lambda c: c <> 0)) > 0),
 l AS MATERIALIZED (SELECT a.vec_id AS a, b.vec_id AS b FROM k a JOIN k b ON a.vec_id <> b.vec_id AND len(a.x) = len(b.x)
   WHERE list_cosine_similarity(a.x, b.x) >= 0.95),
 r AS (SELECT vec_id AS a, vec_id AS b FROM embeddings UNION SELECT r.a, l.b FROM r JOIN l ON l.a = r.b),
 g AS (SELECT a AS vec_id, min(b) AS component_id FROM r GROUP BY 1),
 n AS (SELECT a AS vec_id, count(*) AS n FROM l GROUP BY 1)
SELECT vec_id, CAST(coalesce(n.n, 0) AS BIGINT) AS n_links, component_id, vec_id = component_id AS kept
FROM g LEFT JOIN n USING (vec_id)""")
def op12_near_vectors(spark: SparkSession, sf: str) -> DataFrame:
    """Links and component of every vector."""
    return neighbours.near_vectors(_table(spark, sf, "embeddings"))
