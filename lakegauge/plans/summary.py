"""Roll-ups of check results: per category, partition, dataset, layer and run."""

from __future__ import annotations

import datetime as dt

import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.window import Window

from lakegauge.plans.catalog import BLOCKING, ERROR, FAILED, FIT, LAYER_DIMENSIONS, PASSED, UNFIT, layer_dimensions
from lakegauge.session import small_table

COUNTS = ("pass", "fail", "skip", "fail_blocking", "fail_warning")


def _counts() -> list[Column]:
    s, blocking = F.col("success"), F.col("severity") == BLOCKING
    return [F.count_if(s).alias("pass"), F.count_if(~s).alias("fail"), F.count_if(s.isNull()).alias("skip"),
            F.count_if(~s & blocking).alias("fail_blocking"), F.count_if(~s & ~blocking).alias("fail_warning"),
            F.count(F.lit(1)).alias("checks")]


def summarise(results: DataFrame, by: tuple[str, ...] = ("dataset", "partition")) -> DataFrame:
    """Counts per category and, with a null category, the total of each partition."""
    cols = [F.col(c) for c in (*by, "category")]
    return results.groupingSets([cols, cols[:-1]], *cols).agg(*_counts())


def verdict_of(fail_blocking: Column) -> Column:
    return F.when(fail_blocking == 0, FIT).otherwise(UNFIT)


def verdicts(results: DataFrame, by: tuple[str, ...] = ("dataset", "partition")) -> DataFrame:
    """One row per partition: counts and whether it is fit for use (no blocking failure)."""
    return results.groupBy(*by).agg(*_counts()).withColumn("verdict", verdict_of(F.col("fail_blocking")))


def sweep(results: DataFrame, by: tuple[str, ...] = ()) -> DataFrame:
    """Verdict per partition with its row count; ``by`` keeps runs apart."""
    rows = F.max(F.when(F.col("rule_id") == "2.not_empty", F.col("observed_num"))).cast("bigint").alias("rows")
    return (results.groupBy(*by, "dataset", "part_date", "partition").agg(rows, *_counts())
            .withColumn("verdict", verdict_of(F.col("fail_blocking"))))


def sweep_totals(swept: DataFrame) -> DataFrame:
    return swept.groupBy("dataset").agg(F.count(F.lit(1)).alias("partitions"),
                                        F.count_if(F.col("verdict") == FIT).alias("fit"),
                                        F.count_if(F.col("verdict") != FIT).alias("unfit"))


def blocking_failures(results: DataFrame, shown: int = 5, by: tuple[str, ...] = ()) -> DataFrame:
    return results.filter((F.col("success") == F.lit(False)) & (F.col("severity") == BLOCKING)).select(
        *by, "dataset", "partition", "rule_id", "observed_num", "observed_text", "unexpected_count",
        F.slice("sample", 1, shown).alias("sample"), "error")


_LAYERS = pa.schema([("layer", pa.string()), ("dim", pa.int32())])


def layer_table(spark: SparkSession, layers: list[str] | None = None) -> DataFrame:
    rows = [{"layer": n, "dim": d} for n in (layers or LAYER_DIMENSIONS) for d in layer_dimensions(n)]
    return small_table(spark, rows, _LAYERS)


def for_layer(results: DataFrame, layer: str) -> DataFrame:
    """Only the dimensions that count in a layer."""
    return results.filter(F.col("dim").isin(*layer_dimensions(layer)))


def with_layers(results: DataFrame, membership: DataFrame) -> DataFrame:
    """Results of datasets listed in ``membership(layer, dataset)``, cut to each layer's dimensions."""
    layers = [r["layer"] for r in membership.select("layer").distinct().collect()]
    dims = layer_table(results.sparkSession, layers)
    return results.join(membership.select("layer", "dataset"), "dataset").join(dims, ["layer", "dim"])


def status_of(checks: Column, fail_blocking: Column) -> Column:
    return (F.when(F.coalesce(fail_blocking, F.lit(0)) > 0, FAILED)
            .when(F.coalesce(checks, F.lit(0)) == 0, ERROR).otherwise(PASSED))


def dataset_status(layered: DataFrame, membership: DataFrame) -> DataFrame:
    """Counts and status per layer and dataset; a dataset without any check is an error."""
    counts = layered.groupBy("layer", "dataset").agg(*_counts())
    out = membership.select("layer", "dataset").distinct().join(counts, ["layer", "dataset"], "left")
    out = out.withColumns({c: F.coalesce(c, F.lit(0)) for c in (*COUNTS, "checks")})
    return out.withColumn("status", status_of(F.col("checks"), F.col("fail_blocking")))


def layer_summary(layered: DataFrame) -> DataFrame:
    """Counts per layer, per dataset in it and per category in that; nulls mark the wider totals."""
    cols = [F.col(c) for c in ("layer", "dataset", "category")]
    return layered.groupingSets([cols, cols[:2], cols[:1]], *cols).agg(*_counts())


_EXITS = pa.schema([("layer", pa.string()), ("exit_code", pa.int32())])


def cross_layer(statuses: DataFrame, exit_codes: dict[str, int]) -> DataFrame:
    """Passed, failed and broken datasets over all layers.

    A layer that left no summary counts as one entry with the status its exit code tells.
    """
    spark = statuses.sparkSession
    expected = small_table(spark, [{"layer": k, "exit_code": v} for k, v in exit_codes.items()], _EXITS)
    lost = expected.join(statuses.select("layer").distinct(), "layer", "left_anti").select(
        "layer", F.col("layer").alias("dataset"),
        F.when(F.col("exit_code") == 0, PASSED).when(F.col("exit_code") == 1, FAILED).otherwise(ERROR).alias("status"))
    every = statuses.select("layer", "dataset", "status").unionByName(lost)
    return every.agg(F.count(F.lit(1)).alias("total"), F.count_if(F.col("status") == PASSED).alias("passed"),
                     F.count_if(F.col("status") == FAILED).alias("failed"),
                     F.count_if(F.col("status") == ERROR).alias("errors"))


def gate(results: DataFrame) -> DataFrame:
    """1 when any blocking check failed, else 0."""
    bad = (F.col("success") == F.lit(False)) & (F.col("severity") == BLOCKING)
    return results.agg(F.coalesce(F.max(F.when(bad, 1).otherwise(0)), F.lit(0)).alias("exit_code"))


def layer_gate(statuses: DataFrame) -> DataFrame:
    """1 when any dataset of the layer failed or is broken."""
    return statuses.agg(F.coalesce(F.max(F.when(F.col("status") != PASSED, 1).otherwise(0)), F.lit(0)).alias("exit_code"))


def trend(history: DataFrame) -> DataFrame:
    """Each rule's outcome against the run before: new, fixed, persistent, or steady."""
    w = Window.partitionBy("dataset", "partition", "rule_id").orderBy("run_at", "run_id")
    h = history.select("dataset", "partition", "rule_id", "run_id", "run_at", "success").withColumn(
        "before", F.lag("success").over(w))
    now, was = F.col("success"), F.col("before")
    change = (F.when(now.isNull(), "skipped").when(~now & F.coalesce(was, F.lit(True)), "new")
              .when(now & (was == F.lit(False)), "fixed").when(~now, "persistent").otherwise("steady"))
    return h.withColumn("change", change)


def recent(history: DataFrame, run_start: dt.datetime, grace_seconds: int = 3600, most: int | None = None) -> DataFrame:
    """Latest results per dataset not older than the run start minus a grace, for all datasets or the first so many by name."""
    floor = F.lit((run_start - dt.timedelta(seconds=grace_seconds)).isoformat(sep=" ")).cast("timestamp_ntz")
    fresh = history.filter(F.col("run_at") >= floor)
    last = fresh.groupBy("dataset").agg(F.max_by("run_id", F.struct("run_at", "run_id")).alias("run_id"))
    last = last if most is None else last.orderBy("dataset").limit(most)
    return fresh.join(last, ["dataset", "run_id"], "left_semi")


def top_findings(results: DataFrame, n: int = 15) -> DataFrame:
    """First n failures per dataset and severity in dimension order, with the number left out."""
    by = ("dataset", "severity")
    bad = results.filter(F.col("success") == F.lit(False))
    rank = F.row_number().over(Window.partitionBy(*by).orderBy("dim", "rule_id", "partition"))
    shown = bad.withColumn("position", rank).filter(F.col("position") <= n)
    totals = bad.groupBy(*by).agg(F.count(F.lit(1)).alias("found"))
    return shown.join(totals, list(by)).select(
        *by, "position", "dim", "rule_id", "partition", "unexpected_count",
        F.greatest(F.col("found") - n, F.lit(0)).alias("left_out"))
