"""Stages under clashing column names, hash collisions, repeated rows and crafted texts."""

import base64
import random

import pytest
from pyspark.sql import functions as F

from lakegauge.llm import dedup, langid, minhash, mixing, secrets

NAMES = "row _row _h _k _c _h0 _c0 _n _key _of _size _taken _epoch bucket chain h sha n id text_ doc at f0 end component".split()
SCHEMA = "doc_id long, text string, lang string, source string, " + ", ".join(f"`{n}` int" for n in NAMES)


@pytest.fixture
def docs(spark, prose):
    texts = [" ".join(prose(60, i % 9)) for i in range(14)] + [None, "", " ", "ähnlich wie", "x"]
    rows = [(i if i % 6 else None, t, "en", f"s{i % 2}", *range(len(NAMES))) for i, t in enumerate(texts)]
    return spark.createDataFrame(rows + rows[:2], SCHEMA)


def test_columns_of_any_name_pass_through(spark, docs):
    model = langid.fit(docs, sample=5)
    for stage in (lambda d: langid.accepted(d, model), dedup.deduplicate, minhash.deduplicate, mixing.mixture):
        got = stage(docs)
        assert got.columns == docs.columns and dict(got.dtypes) == dict(docs.dtypes)
        rows = got.collect()
        assert rows and all([r[n] for n in NAMES] == list(range(len(NAMES))) for r in rows)
        assert stage(docs.where("false")).count() == 0


@pytest.mark.parametrize("hashed,capacity", [
    (F.xxhash64, 16384), (F.xxhash64, 1), (lambda t: F.length(t).cast("long"), 1), (lambda t: F.xxhash64(F.substring(t, 1, 1)), 2),
    (lambda t: F.lit(7).cast("long"), 1)])
def test_groups_do_not_depend_on_the_hash(spark, hashed, capacity):
    r = random.Random(4)
    texts = [r.choice(["a b", "ab", "a  b ", "ba", "b a", "c", "cc", "C", None, "", "\t", "a b", "d" * 40, "d" * 39 + " d"]) for _ in range(90)]
    rows = [(i if i % 11 else None, t) for i, t in enumerate(texts)]
    groups = {}
    for i, t in rows:
        groups.setdefault("".join(c for c in t or "" if c not in " \t\n\v\f\r"), []).append((-len(t or ""), i is None, i or 0, i))
    df = spark.createDataFrame(rows, "doc_id long, text string")
    got = dedup.exact_groups(df, capacity=capacity, hashed=hashed).collect()
    keep = {r["text_sha256"]: (r["keep_id"], r["group_size"]) for r in got}
    from hashlib import sha256
    assert keep == {sha256(k.encode()).hexdigest(): (min(g)[3], len(g)) for k, g in groups.items()} and len(got) == len(rows)
    left = dedup.deduplicate(df, capacity=capacity, hashed=hashed).collect()
    assert sorted(r["doc_id"] if r["doc_id"] is not None else -1 for r in left) == sorted(-1 if min(g)[3] is None else min(g)[3] for g in groups.values())


def test_the_directory_decides(spark, monkeypatch):
    df = spark.createDataFrame([(i, f"t{i % 20}") for i in range(60)], "doc_id long, text string")
    slots, depth = dedup.directory(df.select(F.xxhash64("text").alias("h")).distinct(), 3)
    assert depth > 1 and slots.select("bucket").distinct().count() > 5
    assert dedup.exact_groups(df, capacity=3).where("group_size = 3").count() == 60
    monkeypatch.setattr(dedup, "directory", lambda keys, capacity: (slots.where("false"), depth))
    assert dedup.exact_groups(df, capacity=3).count() == 0


def test_sample_bound_holds_for_repeated_keys_and_rows(spark, prose, monkeypatch):
    rows = [(1, " ".join(prose(8, i)), "en") for i in range(40)] + [(2, "same text again", "en")] * 40
    seen = []
    monkeypatch.setattr(langid, "_fit_language", lambda t, *a: (_ for _ in ()).throw(ValueError(len(t))))
    docs = spark.createDataFrame(rows, "doc_id long, text string, lang string")
    with pytest.raises(Exception) as found:
        langid.fit(docs, sample=10)
    seen = [int(x) for x in str(found.value).split("ValueError: ")[1].split()[:1]]
    assert seen and 0 < seen[0] <= 10


def test_letters_of_long_texts_and_floors_of_empty_classes():
    for t in ("", "ab1", "é ß漢字🙂", "a1 " * 3000, "é1 " * 3000):
        assert langid._letters(t) == sum(map(str.isalpha, t))


def test_crafted_headers_do_not_end_the_job():
    scan = secrets.scanner()
    part = lambda s: base64.urlsafe_b64encode(s.encode()).decode().rstrip("=")
    tail = ".eyJ" + "a" * 20 + "." + "b" * 30
    deep = part('{"alg":' + "[" * 12000)
    assert not [k for *_, k in scan(deep + tail) if k == "web_token"]
    assert not [k for *_, k in scan(part('{"alg":' + "[" * 200000) + tail) if k == "web_token"]
    assert not [k for *_, k in scan(part('{"alx":"HS256"}') + tail) if k == "web_token"]
    assert [k for *_, k in scan(part('{"alg":"HS256","typ":"JWT"}') + tail) if k == "web_token"]
