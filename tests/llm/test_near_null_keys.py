"""Rows without a key, and different texts of one key, are documents of their own."""

from lakegauge.llm import minhash

A, B, C = "a b c d e f g", "m n o p q r s", "t u v w x y z"


def frame(spark, rows):
    return spark.createDataFrame(rows, "doc_id long, text string")


def test_null_keys_do_not_link(spark):
    d = frame(spark, [(None, A), (None, B), (5, A.upper()), (9, B.upper()), (None, C), (None, C.upper()), (None, ""), (None, None)])
    got = [(r["doc_id"], r["n_shingles"], r["component_id"], r["kept"]) for r in minhash.near_groups(d).collect()]
    count = lambda *x: got.count(x)
    assert count(5, 5, 5, True) == count(9, 5, 9, True) == 1
    assert count(None, 5, 5, False) == count(None, 5, 9, False) == 1
    assert count(None, 5, None, True) == count(None, 5, None, False) == 1       # one of the two copies of C
    assert count(None, 0, None, True) == 2 and len(got) == 8


def test_one_document_of_each_group_stays(spark):
    d = frame(spark, [(None, A), (None, B), (5, A.upper()), (9, B.upper()), (None, C), (None, C.upper()), (None, "")])
    kept = [(r["doc_id"], r["text"].lower()) for r in minhash.deduplicate(d).collect()]
    assert sorted(kept, key=str) == sorted([(5, A), (9, B), (None, C), (None, "")], key=str)


def test_texts_of_a_repeated_key_stay_apart(spark):
    d = frame(spark, [(7, A), (7, B), (9, B.upper()), (7, C), (3, C)])
    assert sorted((r["doc_id"], r["text"]) for r in minhash.deduplicate(d).collect()) == [(3, C), (7, A), (7, B)]


def test_largest_key_is_not_null(spark):
    top = (1 << 63) - 1
    got = [(r["doc_id"], r["component_id"], r["kept"]) for r in minhash.near_groups(frame(spark, [(top, A), (None, B), (None, A)])).collect()]
    assert sorted(got, key=str) == sorted([(top, top, True), (None, None, True), (None, top, False)], key=str)
