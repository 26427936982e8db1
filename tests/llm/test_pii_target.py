"""Candidates that no strict pattern confirms are learned from evidence of their own."""

from lakegauge.llm import pii


def test_forms_beyond_the_strict_patterns(table):
    texts = []
    for i in range(2400):
        phone, user = f"({200 + i % 700}) {100 + i % 800}-{1000 + i}", f"user{i}"
        texts.append([f"reach us: {phone} today", f"the address {user} (at) example{i} (dot) com is new", f"lunch (at) noon{i} was fine",
                      f"built on 20{10 + i % 20}-0{1 + i % 9}-1{i % 9} 12 times", f"order 7{i:04d}-{i:05d} shipped",
                      f"plain {user}@example.org and 10.0.0.{i % 250}"][i % 6])
    got = {r["doc_id"]: r for r in pii.private(table(texts)).collect()}
    for i, t in enumerate(texts):
        base, spans = ([t[s["start"]:s["end"]] for s in got[i][k]] for k in ("base", "spans"))
        added = [x for x in spans if x not in base]
        want = {0: t[len("reach us: "):-len(" today")], 1: t[len("the address "):-len(" is new")]}.get(i % 6)
        assert added == ([want] if want else []), t


def test_evidence(spark):
    cases = [("mail", "", "john (at) example (dot) com", True), ("mail", "", "lunch (at) noon", False), ("mail", "", "a @ b.com", False),
             ("mail", "write to ", "a @ b.com", True), ("number", "", "(555) 123-4567", True), ("number", "", "555 1234567", False),
             ("number", "call me at ", "555 1234567", True), ("number", "call at ", "2024-01-31 10", False),
             ("number", "", "4111.1111.1111.1111", True), ("number", "", "4111.1111.1111.1112", False),
             ("number", "card: ", "4111.11111111.1111", True)]
    for kind, before, m, want in cases:
        d = spark.createDataFrame([(m, before)], "m string, b string")
        assert d.select(pii._shown(kind, d["m"], d["b"])).first()[0] is want, (before, m)


def test_a_sentence_ends_an_address(table):
    texts = ["send it to ann (at) example (dot) com. Then wait", "ann @ example . com now"]
    got = pii.candidates(table(texts)).collect()
    assert [[s["m"] for s in r["wide"]] for r in sorted(got, key=lambda r: r["doc_id"])] == [
        ["ann (at) example (dot) com"], ["ann @ example . com"]]
