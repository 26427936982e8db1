"""Near-duplicates by min-max hashing, with every link confirmed on full shingle sets.

Each permutation is evaluated once per shingle and gives two signature values, its minimum and its maximum. Documents with
equal sets are one class from the start. Bands of signature values put classes into buckets; no bucket's pairs are listed:

1. In each bucket the class that meets most others over all its buckets is the hub, and every member is compared with its hub
   on full sets. That is one comparison per member, and it links copies of one original however many there are.
2. What a hub does not link could still be linked with another member. Their overlap is at most what both share with the hub
   plus what they share outside it, so a link needs either enough overlap with the hub on both sides, or common shingles
   outside it. The first are found by size, the second by an index over the shingles outside the hub, of which only the
   rarest (as many as a link could not do without) are looked at. All other pairs are ruled out without being formed.

Components of the confirmed links come from label propagation with pointer jumping over written tables.
"""

from __future__ import annotations

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from lakegauge.llm import shingles
from lakegauge.llm.common import bounded_batches, packed, whole
from lakegauge.session import materialise

PERMUTATIONS = 32


def band_rows(threshold: int, values: int = 2 * PERMUTATIONS, miss: float = 1e-5) -> int:
    """Most signature values per band with which a pair at the threshold misses all bands with probability ``miss`` at most."""
    t = threshold / 100
    return max(r for r in range(1, values + 1) if r == 1 or (1 - t ** r) ** (values // r) <= miss)


def _slices(texts: pa.Array, limit: int = 4 << 20):
    """Parts of a string array of about ``limit`` bytes each, one text at least."""
    size = np.cumsum([0, *(len(t) for t in texts.to_pylist())])
    at = 0
    while at < len(texts):
        to = max(at + 1, int(np.searchsorted(size, size[at] + limit, "right")) - 1)
        yield at, texts.slice(at, to - at)
        at = to


def _names(sets: np.ndarray, ends: np.ndarray) -> list[bytes]:
    """128-bit names of sets: sums of two independent hashes of their members, and so without order."""
    one, two = shingles.mix(sets ^ np.uint64(0xA5A5A5A5A5A5A5A5)), shingles.mix(sets + np.uint64(0x1234567890ABCDEF))
    cut = np.stack([np.add.reduceat(x, ends[:-1]) for x in (one, two)], axis=1)
    return [r.tobytes() for r in cut.astype("<u8")]


def _node(key: str, row: Column, always: bool) -> Column:
    """Node of a row, in the order of keys with null keys last; with ``always`` or without a key, each row is its own node."""
    k, none = F.col(key).cast("long"), F.col(key).isNull()
    return F.struct(none.cast("int").alias("nokey"), F.coalesce(k, F.lit(0)).alias("key"),
                    (row if always else F.when(none, row).otherwise(F.lit(0))).alias("row"))


def _sketches(size: int, permutations: int, rows: int):
    fields = [pa.field("n", pa.int64()), pa.field("c", pa.binary()), pa.field("bands", pa.list_(pa.int64()))]

    def run(batches):
        for b in batches:
            schema = pa.schema([b.schema.field(0), *fields])
            for at, texts in _slices(b.column(1)):
                sets, ends = shingles.shingle_sets(texts, size)
                n = np.diff(ends)
                full = np.flatnonzero(n)
                names, keys = [None] * len(n), [[]] * len(n)
                if len(full):
                    cut = np.concatenate([ends[:-1][full], ends[-1:]])
                    band = shingles.bands(shingles.signatures(sets, cut, permutations), rows).view(np.int64).tolist()
                    for i, name, k in zip(full.tolist(), _names(sets, cut), band):
                        names[i], keys[i] = name, k
                yield pa.RecordBatch.from_arrays([b.column(0).slice(at, len(n)), pa.array(n), pa.array(names, pa.binary()),
                                                  pa.array(keys, schema.field(3).type)], schema=schema)
    return run


def _sets_of(docs: DataFrame, wanted: DataFrame, size: int) -> DataFrame:
    """Full sets (c, set) of the wanted classes (c, rep), from the texts of their representatives."""
    def run(batches):
        schema = pa.schema([("c", pa.binary()), ("set", pa.list_(pa.int64()))])
        for b in batches:
            for at, texts in _slices(b.column(1)):
                sets, ends = shingles.shingle_sets(texts, size)
                full = np.flatnonzero(np.diff(ends))
                if not len(full):
                    continue
                cut = np.concatenate([ends[:-1][full], ends[-1:]])
                named = dict(zip(full.tolist(), _names(sets, cut)))
                asked = b.column(0).slice(at, len(texts)).to_pylist()
                hit = [i for i in full.tolist() if named[i] == asked[i]]
                if hit:
                    yield pa.RecordBatch.from_arrays([
                        pa.array([named[i] for i in hit], pa.binary()),
                        pa.array([sets[ends[i]:ends[i + 1]].view(np.int64) for i in hit], schema.field(1).type)], schema=schema)
    # the wanted keys grow with the documents: one plan at every size, texts meet them in a shuffle
    j = docs.join(wanted.withColumnsRenamed({"rep": "id"}).hint("merge"), "id").select("c", "text")
    return j.mapInArrow(run, "c binary, set array<bigint>").dropDuplicates(["c"])


def components(edges: DataFrame) -> DataFrame:
    """Smallest reachable node (node, label) of every node in ``edges`` (a, b); each round is a written table."""
    both = materialise(edges.select("a", "b").unionByName(edges.select(F.col("b").alias("a"), F.col("a").alias("b")))
                       .where("a <> b").distinct(), "edges")
    labels = materialise(both.groupBy(F.col("a").alias("node")).agg(F.least(F.min("b"), F.first("a")).alias("label")), "labels")
    while True:
        near = both.join(labels.select(F.col("node").alias("b"), "label"), "b").groupBy(F.col("a").alias("node")).agg(
            F.min("label").alias("near"))
        low = labels.join(near, "node").select("node", "label", F.least("label", "near").alias("low"))
        up = low.select(F.col("node").alias("low"), F.col("low").alias("top"))
        after = materialise(low.join(up, "low").select("node", F.col("label").alias("old"), F.col("top").alias("label")), "labels")
        if after.where("label <> old").isEmpty():
            return after.drop("old")
        labels = after.drop("old")


def _linked(inter: Column, n: Column, m: Column, threshold: int) -> Column:
    return 100 * inter >= threshold * (n + m - inter)


def _confirm(pairs: DataFrame, sets: DataFrame) -> DataFrame:
    """Adds the full sets ``sa`` and ``sb`` of both sides ``ca`` and ``cb``."""
    one = lambda x: sets.select(F.col("c").alias(f"c{x}"), F.col("set").alias(f"s{x}"))
    return pairs.join(one("a"), "ca").join(one("b"), "cb")


def _labelled(frame: DataFrame, labels: DataFrame, node: str, name: str) -> DataFrame:
    got = labels.select(F.col("node").alias("_node"), F.col("label").alias("_label"))
    return frame.join(got, F.col(node) == F.col("_node"), "left").withColumn(name, F.coalesce("_label", node)).drop(
        "_node", "_label")


def _residual(star: DataFrame, labels: DataFrame, threshold: int) -> DataFrame:
    """Pairs (ca, a, na, cb, b, nb) that may be linked although their hub does not link them."""
    t = threshold
    v = _labelled(_labelled(star, labels, "a", "la"), labels, "b", "lb").withColumn("off", F.col("la") != F.col("lb"))
    odd = v.where("off").select(F.col("cb").alias("_h")).distinct()
    v = materialise(v.join(odd, F.col("cb") == F.col("_h"), "left_semi").select(
        F.col("cb").alias("h"), F.col("ca").alias("c"), F.col("a").alias("id"), F.col("na").alias("n"), "inter", "la", "off",
        "extra"), "grouped")
    one = lambda d, x: d.select("h", *[F.col(k).alias(f"{k}{x}") for k in ("c", "id", "n", "inter", "la", "off")],
                                *[k for k in ("e",) if k in d.columns])
    open_pair = (F.col("off1") & (F.col("la1") != F.col("la2")) & (~F.col("off2") | (F.col("c1") < F.col("c2")))
                 & (100 * F.least("n1", "n2") >= t * F.greatest("n1", "n2")))
    # both overlap enough with the hub
    near = v.where((100 + t) * F.col("inter") * 100 >= t * (100 + t) * F.col("n")).drop("extra")
    need = t * (F.col("n1") + F.col("n2"))
    by_hub = one(near, "1").join(one(near, "2"), "h").where(
        open_pair & ((100 + t) * F.least("inter1", "inter2") >= need))
    # common shingles outside the hub
    e = v.select("h", "c", "id", "n", "inter", "la", "off", F.size("extra").alias("size"), F.explode("extra").alias("e"))
    df = e.groupBy("h", "e").agg(F.count("*").alias("df")).where("df > 1")
    common = e.join(df, ["h", "e"])
    few = F.greatest(F.lit(1), F.ceil(t * F.col("n") / 100) - F.col("inter"))
    rare = common.groupBy("h", "c", "id", "n", "inter", "la", "off", "size").agg(
        F.array_sort(F.collect_list(F.struct("df", "e"))).alias("es"))
    take = F.greatest(F.lit(0), F.col("size") - few + 1 - (F.col("size") - F.size("es"))).cast("int")
    prefix = materialise(rare.withColumn("e", F.explode(F.slice("es", F.lit(1), take)["e"])).drop("es", "size"), "outside")
    by_index = one(prefix, "1").join(one(prefix, "2"), ["h", "e"]).where(open_pair)
    cols = [F.col(f"{k}{x}").alias(f"{n}") for x, s in (("1", "a"), ("2", "b")) for k, n in (
        ("c", f"c{s}"), ("id", s), ("n", f"n{s}"))]
    return by_hub.select(*cols).unionByName(by_index.select(*cols)).distinct()


def _grouped(light: DataFrame, size: int, threshold: int, permutations: int) -> DataFrame:
    """(id, n, component) of every row of ``light`` (id, text), a written table; ids are nodes, a component is its smallest."""
    rows = band_rows(threshold, 2 * permutations)
    node = light.schema["id"].dataType.simpleString()
    sketch = materialise(light.mapInArrow(_sketches(size, permutations, rows), f"id {node}, n long, c binary, bands array<bigint>"),
                         "sketches")
    classes = materialise(sketch.where("n > 0").groupBy("c").agg(
        F.min("id").alias("rep"), F.first("n").alias("n"), F.count("*").alias("copies"), F.first("bands").alias("bands")),
        "classes")
    entries = classes.select("c", F.col("rep").alias("id"), "n", F.explode("bands").alias("key"))
    filled = entries.groupBy("key").agg(F.count("*").alias("members")).where("members > 1")
    shared = materialise(entries.join(filled, "key"), "buckets")
    scored = shared.join(shared.groupBy("c").agg(F.sum("members").alias("score")), "c")
    hubs = scored.groupBy("key").agg(F.min_by(F.struct("c", "id", "n"), F.struct(-F.col("score"), "id")).alias("h"))
    star = scored.join(hubs, "key").where(F.col("c") != F.col("h.c")).select(
        F.col("c").alias("ca"), F.col("id").alias("a"), F.col("n").alias("na"),
        F.col("h.c").alias("cb"), F.col("h.id").alias("b"), F.col("h.n").alias("nb")).distinct()
    star = materialise(star, "stars")
    wanted = star.select(F.col("ca").alias("c"), F.col("a").alias("rep")).unionByName(
        star.select(F.col("cb").alias("c"), F.col("b").alias("rep"))).distinct()
    sets = materialise(_sets_of(light, wanted, size), "sets")
    group = star.groupBy(F.col("cb").alias("_h")).agg(F.count("*").alias("others"))
    judged = _confirm(star.join(group, F.col("cb") == F.col("_h")).drop("_h"), sets).select(
        "ca", "a", "na", "cb", "b", "nb", F.size(F.array_intersect("sa", "sb")).alias("inter"),
        F.when(F.col("others") > 1, F.array_except("sa", "sb")).alias("extra"))
    judged = materialise(judged, "judged")
    mixed = sketch.where("n > 0").groupBy("id").agg(F.min("c").alias("lo"), F.max("c").alias("hi")).where("lo <> hi")
    twice = sketch.where("n > 0").join(mixed.select("id"), "id").select("id", "c").distinct().join(
        classes.select("c", "rep"), "c").select(F.col("id").alias("a"), F.col("rep").alias("b"))
    edges = judged.where(_linked(F.col("inter"), F.col("na"), F.col("nb"), threshold)).select("a", "b").unionByName(twice)
    first = components(edges)
    more = materialise(_residual(judged.where("extra IS NOT NULL"), first, threshold), "residual")
    found = _confirm(more, sets).where(_linked(F.size(F.array_intersect("sa", "sb")), F.col("na"), F.col("nb"), threshold))
    second = components(_labelled(_labelled(found.select("a", "b"), first, "a", "la"), first, "b", "lb").select(
        F.col("la").alias("a"), F.col("lb").alias("b")))
    named = _labelled(_labelled(classes.select("c", "rep", "copies"), first, "rep", "l1"), second, "l1", "component")
    named = named.where("copies > 1 OR component <> rep").select(F.col("c").alias("_c"), "component")
    out = sketch.join(named, F.col("c") == F.col("_c"), "left")
    return out.select("id", "n", F.coalesce("component", "id").alias("component"))


def near_groups(docs: DataFrame, key: str = "doc_id", text: str = "text", size: int = 3, threshold: int = 85,
                permutations: int = PERMUTATIONS) -> DataFrame:
    """One row per document: (key, n_shingles, component_id, kept).

    Words are separated by white space, A-Z count as a-z; a document's set has its distinct shingles of ``size`` words, or
    its whole sequence if it is shorter. Documents link at ``threshold`` per cent of intersection over union; a component's
    id is its smallest key and that document is kept. Null and empty texts have no set and link with nothing. Rows that share
    a key belong together whatever their texts. A row with a null key is a document of its own and comes after all keys; a
    component of such rows has no id and keeps one of them. Keys are whole numbers. Other columns are ignored; an empty table
    gives no rows.
    """
    bounded_batches(docs.sparkSession)
    light = materialise(docs.select(_node(key, F.monotonically_increasing_id(), False).alias("id"), whole(text).alias("text")),
                        "texts")                          # written, as it is read twice and row numbers must stay
    named = lambda x: F.when(F.col(x)["nokey"] == 0, F.col(x)["key"])
    return _grouped(light, size, threshold, permutations).select(
        named("id").alias(key), F.col("n").alias("n_shingles"), named("component").alias("component_id"),
        (F.col("id") == F.col("component")).alias("kept"))


def deduplicate(docs: DataFrame, key: str = "doc_id", text: str = "text", size: int = 5, threshold: int = 80) -> DataFrame:
    """One document of each component with its columns, of any names: that of the smallest key, null keys last.

    Only similar texts link, never equal keys; null and empty texts link with nothing and stay, as does a text that is
    shorter than a shingle unless another equals it. An empty table gives no rows.
    """
    bounded_batches(docs.sparkSession)
    rows = materialise(packed(docs), "rows")
    light = rows.select(_node(f"doc.`{key}`", F.col("row"), True).alias("id"), whole(F.col(f"doc.`{text}`")).alias("text"))
    gone = materialise(_grouped(light, size, threshold, PERMUTATIONS).where("id <> component").select("id.row"), "near")
    return rows.join(gone, "row", "left_anti").select("doc.*")
