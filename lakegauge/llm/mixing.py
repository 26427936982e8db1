"""Mixing sources to target weights by hash-random order and distributed prefix sums.

Every document gets a hash-random key. The key's leading bits name a range of its source's order; the sizes are summed per
(source, range), those sums are accumulated per source, and only the one range in which a source's budget ends is sorted.
Ranges before it are taken whole, ranges behind it not at all. No group larger than a range is ever sorted in one task.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from lakegauge.llm.common import BLANK, packed, whole, word_count
from lakegauge.session import materialise

#: weights by rank of the source in code-point order, repeating
WEIGHTS = (3, 1, 2)
#: documents meant to fall into one range of a source
RANGE_ROWS = 2048


def targets(sizes: DataFrame, share: float = 1.5, most: float = 2.0, weights: tuple = WEIGHTS) -> DataFrame:
    """Budget per source: weighted parts of ``share`` of all words, stopped at ``most`` times the source's own.

    ``sizes`` has (source, source_size). Stopping and handing the excess to the others by weight until nobody is above is
    the same as raising one common level: the sources that stop are those with the smallest capacity per weight. Sources
    without words get 0. One row per source passes through one task here, no documents.
    """
    rank = F.row_number().over(Window.orderBy(F.col("source").asc_nulls_last()))
    w = sizes.withColumn("weight", F.element_at(F.array(*map(F.lit, weights)), ((rank - 1) % len(weights) + 1).cast("int")))
    w = w.withColumn("cap", F.col("source_size") * F.lit(float(most)))
    by_fill = Window.orderBy(F.col("cap") / F.col("weight"), F.col("source").asc_nulls_last())
    upto, after = by_fill.rowsBetween(Window.unboundedPreceding, -1), by_fill.rowsBetween(0, Window.unboundedFollowing)
    every = Window.rowsBetween(Window.unboundedPreceding, Window.unboundedFollowing)
    level = (F.sum("source_size").over(every) * F.lit(share) - F.coalesce(F.sum("cap").over(upto), F.lit(0.0))
             ) / F.sum("weight").over(after)
    leveled = w.withColumns({"level": level, "place": F.row_number().over(by_fill)}).withColumn(
        "open", F.col("level") * F.col("weight") < F.col("cap"))
    common = F.min(F.when(F.col("open"), F.struct("place", "level"))).over(every)["level"]
    target = F.when(F.col("cap") <= F.coalesce(common, F.lit(float("inf"))) * F.col("weight"), F.col("cap")).otherwise(
        common * F.col("weight"))
    return leveled.select("source", "source_size", target.alias("target"))


def _range(key: Column, bits: int) -> Column:
    """The first ``bits`` bits of a hexadecimal key."""
    return F.shiftright(F.conv(F.substring(key, 1, 8), 16, 10).cast("long"), 32 - bits)


def shares(docs: DataFrame, key: str = "doc_id", text: str = "text", source: str = "source", seed: str = "",
           share: float = 1.5, most: float = 2.0) -> DataFrame:
    """Words that the mix takes of each document: (key, source, size, source_size, target, taken).

    The whole number of epochs of a source is taken of every document; the rest of the budget is a prefix of its hash-random
    order, cut inside the document where the budget ends, so that each source gives exactly the whole part of its target.
    Null texts have size 0 and give nothing; a null source is a source of its own; equal rows are taken one after the
    other. The order depends on the key, the seed and the size only, so reruns agree. Empty tables give empty results.
    """
    order = F.md5(F.concat(F.coalesce(F.col(key).cast("string"), F.lit("-")), F.lit(":" + seed)))
    light = materialise(docs.select(F.col(key).alias(key), F.col(source).alias("source"),
                                    word_count(whole(text)).alias("size")), "sizes").withColumn("at", order)
    totals = light.groupBy("source").agg(F.sum("size").alias("source_size"), F.count("*").alias("n"))
    totals = materialise(totals, "sources")
    budget = targets(totals.select("source", "source_size"), share, most).withColumns({
        "epochs": F.when(F.col("source_size") > 0, F.floor(F.col("target") / F.col("source_size"))).otherwise(0).cast("long")})
    budget = materialise(budget.withColumn("rest", F.floor(F.col("target")).cast("long")
                                           - F.col("epochs") * F.col("source_size")), "targets")
    largest = totals.agg(F.max("n")).first()[0] or 0
    bits = min(30, max(1, (largest // RANGE_ROWS).bit_length()))      # ranges grow with the data, their size does not
    ranged = light.withColumn("range", _range(F.col("at"), bits))
    sums = ranged.groupBy("source", "range").agg(F.sum("size").alias("sum"))
    before = F.sum("sum").over(Window.partitionBy("source").orderBy("range")) - F.col("sum")
    b = budget.withColumnRenamed("source", "_source")
    placed = sums.withColumn("base", before).join(b, F.col("source").eqNullSafe(F.col("_source"))).drop("_source")
    state = F.when(F.col("base") + F.col("sum") <= F.col("rest"), "whole").when(
        F.col("base") >= F.col("rest"), "none").otherwise("cut")
    edge = materialise(placed.where(state == "cut").select(
        F.col("source").alias("_source"), F.col("range").alias("edge"), F.col("base").alias("edge_base")), "edges")
    plan = b.join(edge.withColumnRenamed("_source", "_s"), F.col("_source").eqNullSafe(F.col("_s")), "left").drop("_s")
    j = ranged.join(plan, F.col("source").eqNullSafe(F.col("_source"))).drop("_source")
    # a source whose rest ends on the border of a range has no edge: then all ranges are whole (rest is the total) or
    # the border itself decides, which is kept as the end of the last whole range
    border = materialise(placed.where(state == "whole").groupBy(F.col("source").alias("_w")).agg(
        F.max("range").alias("last_whole")), "borders")
    j = j.join(border, F.col("source").eqNullSafe(F.col("_w")), "left").drop("_w")
    inside = j.where(F.col("range") == F.col("edge"))
    run = Window.partitionBy("source").orderBy("at", key, "size").rowsBetween(Window.unboundedPreceding, Window.currentRow)
    start = F.col("edge_base") + F.sum("size").over(run) - F.col("size")
    part = F.least(F.col("size"), F.greatest(F.lit(0).cast("long"), F.col("rest") - start))
    rest = F.when(F.coalesce(F.col("range") <= F.col("last_whole"), F.lit(False)), F.col("size")).otherwise(0)
    cols = [key, "source", "size", "source_size", "target"]
    taken = lambda extra: (F.col("epochs") * F.col("size") + extra).cast("long").alias("taken")
    return inside.select(*cols, taken(part)).unionByName(
        j.where(~F.coalesce(F.col("range") == F.col("edge"), F.lit(False))).select(*cols, taken(rest)))


def mixture(docs: DataFrame, key: str = "doc_id", text: str = "text", source: str = "source", seed: str = "",
            share: float = 1.5, most: float = 2.0) -> DataFrame:
    """The mixed rows themselves, with the columns of ``docs``, of any names: one row per epoch, the last one cut where the budget ends.

    Documents of which nothing is taken, null and empty ones too, are left out. Rows with equal keys and sizes share one
    decision. An empty table gives no rows.
    """
    got = shares(docs, key, text, source, seed, share, most).where("taken > 0").groupBy(
        F.col(f"`{key}`").alias("_key"), F.col("source").alias("_of"), F.col("size").alias("_size")).agg(F.max("taken").alias("_taken"))
    field = lambda name: F.col(f"doc.`{name}`")
    sized = packed(docs).drop("row").withColumn("_n", word_count(whole(field(text))))
    j = sized.join(got, field(key).eqNullSafe(F.col("_key")) & field(source).eqNullSafe(F.col("_of")) & (F.col("_n") == F.col("_size")))
    j = j.withColumn("_epoch", F.explode(F.sequence(F.lit(1).cast("long"), F.ceil(F.col("_taken") / F.col("_n")))))
    left = F.col("_taken") - (F.col("_epoch") - 1) * F.col("_n")
    first = F.concat(F.lit(f"^(?:{BLANK}*+[^ \\t-\\r]++){{"), left.cast("string"), F.lit("}+"))
    cut = F.call_function("regexp_extract", field(text), first, F.lit(0))
    return j.select(*[(F.when(left < F.col("_n"), cut).otherwise(field(c)) if c == text else field(c)).alias(c) for c in docs.columns])
