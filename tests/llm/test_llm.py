"""The operators against brute force on small difficult inputs."""

import base64
import hashlib
import math
import random
import re
import zlib

import numpy as np
import public_tokenizers
import pytest
from pyspark.sql import functions as F

import corpus_pipeline
from lakegauge.llm import (binary, bpe, dedup, langid, licenses, minhash, mixing, pii, quality, registry, secrets)

WORD = re.compile(r"[^\x20\x09-\x0D]+")
HARD = [None, "", " \n\t ", "one", "two words", "the same text", "the same text", "the  same\ntext", "é ß 漢字 🙂 end",
        "a b c a b c a b", "x" * 5000, "1.2.3.4 +1 (487) 555-7209 a.b@c.de", "token = 'abcdefgh12345678' AKIAABCDEFGHIJKL"]
RANKS = public_tokenizers.path("byte_bpe_multi_50k.tiktoken")


def rows_of(df, key="doc_id"):
    return {r[key]: r for r in df.collect()}


def empty(spark):
    return spark.createDataFrame([], "doc_id long, text string, lang string, source string")


# --- quality ------------------------------------------------------------------------------------

def test_quality_counts(table):
    texts = [*HARD, "l\nl\nm\n\nl", " ".join(["w"] * 60)]
    got = rows_of(quality.with_measures(table(texts)))
    for i, t in enumerate(texts):
        w = WORD.findall(t or "")
        win = [tuple(w[j:j + 3]) for j in range(len(w) - 2)]
        cover = {j + o for j, x in enumerate(win) if win.count(x) > 1 for o in range(3)}
        lines = [x for x in (t or "").split("\n") if WORD.search(x)]
        assert (got[i]["n_words"], got[i]["word_chars"], got[i]["n_repeat_words"], got[i]["n_dup_lines"]) == (
            len(w), sum(map(len, w)), len(cover), len(lines) - len(set(lines))), t


@pytest.mark.parametrize("n,k,p", [(500, 0, 0.01), (2000, 5, 0.01), (90000, 700, 0.01), (50, 3, 0.2)])
def test_binomial_tail(spark, n, k, p):
    got = spark.range(1).select(quality.binomial_tail(F.lit(float(n)), F.lit(float(k)), p).alias("p")).first()["p"]
    lg = math.lgamma
    want = sum(math.exp(lg(n + 1) - lg(i + 1) - lg(n - i + 1) + i * math.log(p) + (n - i) * math.log(1 - p)) for i in range(k + 1))
    assert got == pytest.approx(want, rel=1e-9)


def test_quality_certifies_only_with_enough_labels(spark, prose):
    def docs(n):
        return spark.createDataFrame([(i, " ".join(w + "&&&" * (i % 4 == 0) for w in prose(60, i)), "en") for i in range(n)],
                                     "doc_id long, text string, lang string")
    def kept(n):
        labels = spark.createDataFrame([(i, int(i % 4 != 0)) for i in range(n)], "doc_id long, quality int")
        return {r["doc_id"] for r in quality.quality(docs(n), labels).where("kept").collect()}
    assert kept(40) == set(range(40))
    assert kept(1400) == {i for i in range(1400) if i % 4}


# --- licenses, secrets, personal data -----------------------------------------------------------

def test_licenses():
    detect = licenses.detector()
    n, base, found = detect("Released UNDER the MIT\nLicense, not the GNU General Public License v3 or any later version.")
    assert n == 16 and [(b.first, b.label) for b in base] == [(1, "mit")]
    assert [(d.label, d.form) for d in found] == [("mit", "notice"), ("gpl-3", "later")]
    assert detect("permit licensed") == (2, [], []) and len(licenses.RULES) > 200
    inner = licenses.Detection(2, 4, "a", "name", 1, 0.5)
    assert licenses.suppress([inner, licenses.Detection(1, 5, "b", "notice", 4, 0.9), inner._replace(first=8, last=9)]) == [
        licenses.Detection(1, 5, "b", "notice", 4, 0.9), inner._replace(first=8, last=9)]


def test_license_rows(table):
    got = rows_of(licenses.licenses(table([*HARD, "cc-by-nc and CC BY NC"])))
    assert got[0]["n_words"] == 0 and [b["first"] for b in got[len(HARD)]["base"]] == [0, 4]


def test_secret_base_spans():
    want = [("assign", r"""(?ai)(?:password|passwd|secret|token|api_?key)["']?\x20*[:=]\x20*["']?([A-Za-z0-9+/_.=-]+)"""),
            ("access", r"AKIA[A-Z0-9]+"), ("hex", r"[0-9a-f]+")]
    ok = {"assign": lambda m: len(m[1]) >= 8, "access": lambda m: len(m[0]) >= 16, "hex": lambda m: len(m[0]) >= 32}
    r = random.Random(5)
    bits = ["token", "ToKeN", "password", "=", ":", " ", "'", "AKIA", "ABCDEFGH1234", "abcdefgh", "0" * 33, "ſecret", "é", "api_key", "short"]
    scan = secrets.scanner()
    for _ in range(400):
        t = "".join(r.choice(bits) for _ in range(30))
        brute = sorted((m.start(), i, m.end(), k) for i, (k, p) in enumerate(want) for m in re.finditer(p, t) if ok[k](m))
        assert [(s, e, k) for s, e, k in scan(t) if k in secrets.BASE] == [(s, e, k) for s, _, e, k in brute]


def test_secret_checksums():
    body = "abcdefghijABCDEFGHIJ0123456789"
    n, tail = zlib.crc32(body.encode()), ""
    while n:
        n, d = divmod(n, 62)
        tail = "0123456789ABCDEFGHIJKLMNOPQRSTUVWXYZabcdefghijklmnopqrstuvwxyz"[d] + tail
    good = "ghp_" + body + tail.rjust(6, "0")
    assert [k for *_, k in secrets.scanner()(f"x {good} {good[:-1]}{'A' if good[-1] != 'A' else 'B'}")] == ["git_token"]


def luhn(d):
    return sum(sum(divmod(int(c) * (1 + i % 2), 10)) for i, c in enumerate(reversed(d))) % 10 == 0


def test_personal_data_base_spans(table):
    pats = {"email": r"[A-Za-z0-9._%+-]+@[A-Za-z0-9-]+(\.[A-Za-z0-9-]+)+", "ip": r"[0-9]+(\.[0-9]+)(\.[0-9]+)(\.[0-9]+)",
            "card": r"[0-9]([\x20-]?[0-9])+", "phone": r"\+[0-9][\x20().0-9-]+[0-9]"}
    def ok(k, m):
        d = re.sub("[^0-9]", "", m)
        return {"email": True, "ip": k == "ip" and all(int(x) <= 255 for x in m.split(".")),
                "card": 12 <= len(d) <= 19 and luhn(d), "phone": 9 <= len(d) <= 15}[k]
    r = random.Random(3)
    bits = ["a", "b@c.de", ".x", "@", "-", "12.3.4.5", "4111 1111 1111 1111", "+1 (222) 333-4444", " ", "999", "é🙂", "_", "+"]
    texts = [*HARD, *("".join(r.choice(bits) for _ in range(12)) for _ in range(150)), "0" * 20000, "a" * 20000]
    got = rows_of(pii.private(table(texts)))
    for i, t in enumerate(texts):
        want = sorted((m.start(), j, m.end()) for j, (k, p) in enumerate(pats.items()) if len(t or "") < 9999
                      for m in re.finditer(p, t or "") if ok(k, m[0]))
        assert [tuple(s) for s in got[i]["base"]] == want, t
        assert {tuple(s) for s in got[i]["base"]} <= {tuple(s) for s in got[i]["spans"]}


def test_boosting_finds_an_interaction():
    n = len(pii.FEATURES)
    rows = [((a, b, *[0] * (n - 2)), 100, 95 if a == b else 5) for a in (0, 1) for b in (0, 1)]
    model = pii.boost(rows)
    score = lambda x: model[0] + sum(pii._leaf(t, x) for t in model[1])
    assert min(score(x) for x, _, p in rows if p > 50) > max(score(x) for x, _, p in rows if p < 50)
    assert pii.threshold(rows, model, 0.8) is not None and pii.threshold(rows, model, 0.99) is None


# --- deduplication ------------------------------------------------------------------------------

def test_exact_groups(table):
    got = rows_of(dedup.exact_groups(table(HARD), capacity=2))
    assert {got[i]["keep_id"] for i in (5, 6, 7)} == {7}            # the longest of the equal texts
    assert {got[i]["keep_id"] for i in (0, 1, 2)} == {2} and got[0]["group_size"] == 3
    assert got[8]["text_sha256"] == hashlib.sha256("éß漢字🙂end".encode()).hexdigest()


def test_deduplicate_leaves_one_row(table, spark):
    d = table(HARD)
    assert sorted(r["doc_id"] for r in dedup.deduplicate(d.unionByName(d)).collect()) == [2, 3, 4, 7, 8, 9, 10, 11, 12]
    assert dedup.deduplicate(empty(spark)).count() == 0
    null_key = spark.createDataFrame([(None, "a"), (None, "a"), (4, "b")], "doc_id long, text string")
    assert dedup.deduplicate(null_key).count() == 2


def brute_components(texts, size, threshold):
    sets = []
    for t in texts:
        w = [x.lower() for x in WORD.findall(t or "")]
        sets.append({tuple(w[i:i + size]) for i in range(len(w) - size + 1)} or ({tuple(w)} if w else set()))
    label = list(range(len(texts)))
    for _ in texts:
        before = list(label)
        for i, a in enumerate(sets):
            for j, b in enumerate(sets[:i]):
                if a and b and 100 * len(a & b) >= threshold * len(a | b):
                    label[i] = label[j] = min(label[i], label[j])
        if label == before:
            break
    return label, [len(s) for s in sets]


def test_near_groups(table, prose):
    base = prose(120, 1)
    r, texts = random.Random(2), [*HARD]
    for i in range(60):                            # one family at many distances from its centre, some only linked in chains
        w = list(base if i < 40 or i % 2 else texts[-1].split())
        for _ in range(r.randint(0, 7)):
            w[r.randrange(len(w))] = f"new{r.randrange(50)}"
        texts.append(" ".join(w[:r.choice([120, 120, 110, 95])]).upper() if i % 3 else " ".join(w))
    texts += [" ".join(prose(30, 100 + i)) for i in range(10)]
    label, sizes = brute_components(texts, 3, 85)
    got = rows_of(minhash.near_groups(table(texts)))
    assert [got[i]["component_id"] for i in range(len(texts))] == label
    assert [got[i]["n_shingles"] for i in range(len(texts))] == sizes
    assert all(got[i]["kept"] == (label[i] == i) for i in range(len(texts)))


def test_near_groups_edges(spark):
    assert minhash.near_groups(empty(spark)).count() == 0
    d = spark.createDataFrame([(None, "a b c d"), (7, "a b c d"), (7, "e f g h"), (9, "e f g h")], "doc_id long, text string")
    got = sorted(((r["doc_id"] or 0, r["component_id"]) for r in minhash.near_groups(d).collect()))
    assert got == [(0, 7), (7, 7), (7, 7), (9, 7)]


# --- mixing -------------------------------------------------------------------------------------

def test_targets_by_repeated_sharing(spark):
    r = random.Random(1)
    for _ in range(3):
        sizes = {f"s{i}": r.choice([0, 1, 10, 1000, 50000]) for i in range(7)} | {None: 77}
        order = sorted(sizes, key=lambda s: (s is None, s or ""))
        weight = {s: (3, 1, 2)[i % 3] for i, s in enumerate(order)}
        full, free, left = {}, set(order), 1.5 * sum(sizes.values())
        while True:
            part = {s: left * weight[s] / sum(weight[x] for x in free) for s in free}
            over = {s for s in free if part[s] >= 2 * sizes[s]}
            if not over:
                break
            full |= {s: 2.0 * sizes[s] for s in over}
            free, left = free - over, 1.5 * sum(sizes.values()) - sum(full.values())
            if not free:
                break
        want = full | ({s: part[s] for s in free} if free else {})
        got = mixing.targets(spark.createDataFrame(list(sizes.items()), "source string, source_size long"))
        assert {r["source"]: pytest.approx(r["target"]) for r in got.collect()} == want


def test_mixture_matches_shares(table, prose):
    d = table([*HARD, *(" ".join(prose(5 + i % 40, i)) for i in range(200))])
    taken = rows_of(mixing.shares(d))
    by = {}
    for r in taken.values():
        assert r["taken"] <= 2 * r["size"]
        by.setdefault(r["source"], [0, r["target"]])[0] += r["taken"]
    assert all(t == math.floor(goal) for t, goal in by.values())
    words = {}
    for r in mixing.mixture(d).collect():
        words[r["doc_id"]] = words.get(r["doc_id"], 0) + len(WORD.findall(r["text"]))
    assert words == {k: r["taken"] for k, r in taken.items() if r["taken"]}


# --- tokens -------------------------------------------------------------------------------------

@pytest.mark.parametrize("chunk,overlap", [(1 << 15, 512), (64, 16)])
def test_bpe_round_trip(table, prose, chunk, overlap):
    import tiktoken
    with open(RANKS, "rb") as f:
        ranks = {base64.b64decode(a): int(b) for a, b in map(bytes.split, f)}
    enc = tiktoken.Encoding("own", pat_str=public_tokenizers.PATTERN, mergeable_ranks=ranks, special_tokens={})
    texts = [*HARD, " ".join(prose(300, 1)), "a  b \n\n c's  " * 40, " " * 400 + "end", "it's'll " * 50]
    coded = bpe.encode(table(texts), RANKS, public_tokenizers.PATTERN, chunk=chunk, overlap=overlap)
    ids, raw = rows_of(coded), rows_of(bpe.decode(coded, RANKS, public_tokenizers.PATTERN))
    for i, t in enumerate(texts):
        assert np.frombuffer(ids[i]["ids"], "<u4").tolist() == enc.encode_ordinary(t or ""), t
        assert bytes(raw[i]["bytes"]) == (t or "").encode()


def test_token_files(table, spark):
    from tokenizers import Tokenizer
    path = public_tokenizers.path("word_bpe_49k.json")
    tok, texts = Tokenizer.from_file(path), [*HARD, "It's ĀB İs, Σας don't. a b\x1cc <|endoftext|> x²,", "Straße!? 'sound n'T"]
    m = binary.write_ids(table(texts), path, 2, binary.new_folder(spark))
    start = 0
    for r in sorted(binary.read_ids(m).collect()):
        ids = tok.encode(texts[r["doc_id"]] or "", add_special_tokens=False).ids + [2]
        assert (r["start"], r["n_tokens"], r["ids_crc32"]) == (start, len(ids), zlib.crc32(np.array(ids, "<u4").tobytes()))
        start += len(ids)
    assert binary.read_ids(binary.write_ids(empty(spark), path, 2, binary.new_folder(spark))).count() == 0


# --- language and pipeline ----------------------------------------------------------------------

SF = "/root/testdata/sf0.01"


def test_language_held_out_accuracy(spark):
    docs = spark.read.parquet(f"{SF}/documents.parquet")
    got = registry.op9_language_id(spark, SF).join(docs.select("doc_id", "lang"), "doc_id").where("held_out").toPandas()
    assert (got.lang == got.lang_pred).mean() > 0.97
    assert got.score.between(0, 1).all()


def test_language_edges(table, spark):
    texts = [*HARD, "12 34"]
    model = langid.fit(table(texts), sample=5)
    got = rows_of(langid.predict(table(texts), model))
    assert {i for i in got if got[i]["lang_pred"] == "und"} == {0, 1, 2, len(HARD)}
    assert {r["lang_pred"] for r in langid.predict(table(texts), langid.fit(empty(spark))).collect()} == {"und"}


def test_pipeline_stages(spark):
    docs = spark.read.parquet("/root/testdata/sf0.001/documents.parquet")
    for name, stage in corpus_pipeline.STAGES[:-1]:
        kept = stage(spark, docs, "/root/testdata/sf0.001")
        assert kept.columns == docs.columns, name
    assert corpus_pipeline.STAGES[-1][1](spark, docs, "").count() == docs.count()
