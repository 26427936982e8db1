"""Merkle manifest: places in the log, proofs and roots against a plain tree in Python."""

import zlib
from hashlib import sha256

import pytest
from pyspark.sql import functions as F

from lakegauge.llm import merkle

CAPITALS, SMALL = "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz"


def h(text):
    return sha256(text.encode()).hexdigest()


def leaf(row, text):
    return h("".join("-" if v is None else f"{len(str(v).encode())}:{v}"
                     for v in (row["doc_id"], row["source"], row["lang"], row["n_chars"], text)))


def tree(nodes):
    grown = [nodes]
    while len(grown[-1]) > 1:
        grown.append([h("".join(grown[-1][i:i + 16])) for i in range(0, len(grown[-1]), 16)])
    return grown


def path(grown, i):
    out = []
    for nodes in grown[:-1]:
        first = i // 16 * 16
        out.append(("".join(nodes[first:i]), "".join(nodes[i + 1:first + 16])))
        i //= 16
    return out


def plain(rows):
    by = {}
    for r in rows:
        by.setdefault(r["source"], []).append(r)
    order = sorted(by, key=lambda s: (s is not None, (s or "").encode()))
    trees = {}
    for s in order:
        by[s].sort(key=lambda r: (r["doc_id"] is not None, r["doc_id"] or 0, leaf(r, r["text"])))
        trees[s] = tree([leaf(r, r["text"]) for r in by[s]])
    top = tree([trees[s][-1][0] for s in order])
    out = []
    for k, s in enumerate(order):
        for i, r in enumerate(by[s]):
            fold, siblings = trees[s][0][i], path(trees[s], i) + path(top, k)
            if r["doc_id"] is not None and zlib.crc32(str(r["doc_id"]).encode()) % 5 == 0 and r["text"] is not None:
                fold = leaf(r, r["text"].translate(str.maketrans(CAPITALS, SMALL)))
            for a, b in siblings:
                fold = h(a + fold + b)
            out.append((r["doc_id"], trees[s][0][i], trees[s][-1][0], top[-1][0], h("".join(a + b for a, b in siblings)), fold,
                        fold == top[-1][0]))
    return sorted(out, key=str)


def built(docs, height):
    fifth = F.coalesce(F.crc32(F.col("doc_id").cast("string").cast("binary")) % 5 == 0, F.lit(False))
    got = merkle.manifest(docs, tamper={"text": F.translate("text", CAPITALS, SMALL)}, tampered=fifth, height=height)
    return sorted(map(tuple, got.collect()), key=str)


@pytest.mark.parametrize("n", [1, 2, 15, 16, 17, 255, 256, 257, 300, 512, 4095, 4096])
def test_positions_are_those_of_the_log(n):
    leaves = [h(str(i)) for i in range(n)]
    height = merkle.levels(n, 3)
    log = merkle.append_log(leaves, height)
    grown = tree(leaves)
    assert len(log) == sum(map(len, grown)) and log[-1] == grown[-1][0]
    for level, nodes in enumerate(grown):
        assert [log[merkle.position(level, i, n, height)] for i in range(len(nodes))] == nodes


@pytest.mark.parametrize("height", [1, 3])
def test_manifest_against_plain_tree(spark, height):
    docs = spark.read.parquet("/root/testdata/sf0.01/documents.parquet")
    assert built(docs, height) == plain([r.asDict() for r in docs.collect()])


def test_nulls_repeated_rows_many_sources_and_clashing_columns(spark):
    rows = [(i // 2 if i % 9 else None, "Some TEXT" * (i % 4) if i % 5 else None, None if i % 7 == 3 else "en",
             None if i % 11 == 4 else f"s{i * i % 40}", i % 3 or None, "x", i, 0) for i in range(700)]
    rows += [(5, "Again", "en", "hot", 1, "x", 0, 0)] * 300
    docs = spark.createDataFrame(rows, "doc_id long, text string, lang string, source string, n_chars long, grp string, rank long, "
                                       "digest int")
    assert built(docs, 1) == plain([r.asDict() for r in docs.collect()])
    assert built(docs.where("doc_id = 7").limit(1), 3) == plain([r.asDict() for r in docs.where("doc_id = 7").limit(1).collect()])
    assert built(docs.where("false"), 3) == []


def test_changed_texts_are_found(spark):
    docs = spark.createDataFrame([(i, f"Text {i}", "en", "a", 6) for i in range(40)],
                                 "doc_id long, text string, lang string, source string, n_chars long")
    got = {r["doc_id"]: r["verified"] for r in merkle.manifest(
        docs, tamper={"text": F.upper("text")}, tampered=F.col("doc_id") % 3 == 0).collect()}
    assert got == {i: i % 3 != 0 for i in range(40)}
