"""Files, partitions, reading, ingest."""

from __future__ import annotations

import datetime as dt

from pyspark.sql import functions as F

from lakegauge.contract import parse_contract
from lakegauge.functions import times
from lakegauge.operators import schema
from lakegauge.operators.prepare import PART, PART_DATE, with_partition
from lakegauge.plans import baseline as bl
from lakegauge.plans import history, validate
from lakegauge.session import scratch_path
from lakegauge.sources import external, inventory, reader
from lakegauge.suite import query
from lakegauge.suite.common import table

DAY = "CAST(CAST(ts AS DATE) AS VARCHAR)"
_TABLES = ("region", "nation", "customer", "supplier", "part", "orders", "lineitem", "events", "documents", "embeddings", "pages",
           "benchmark", "labels", "conversations")
_LAKES: dict[tuple[str, str, bool], str] = {}


def lake(spark, sf: str, broken: bool = False) -> str:
    """Events as a lake of daily folders, two files a day: the second has ``value`` as text and no ``props``.

    The broken copy also has a 0-byte file on the first day and a file of garbage on the last.
    """
    key = (spark.sparkContext.applicationId, sf, broken)
    if key not in _LAKES:
        root = scratch_path(spark, "lake")
        e = table(spark, sf, "events").withColumns({"recorded_year": F.date_format("ts", "yyyy"),
                                                    "recorded_month": F.date_format("ts", "MM"),
                                                    "recorded_day": F.date_format("ts", "dd")})
        by = ["recorded_year", "recorded_month", "recorded_day"]
        e.filter("event_type <> 'click'").repartition(*by).write.partitionBy(*by).parquet(root)
        late = e.filter("event_type = 'click'").drop("props").withColumn("value", F.col("value").cast("string"))
        late.repartition(*by).write.mode("append").partitionBy(*by).parquet(root)
        if broken:
            days = e.agg(F.min(F.struct(*by)).alias("a"), F.max(F.struct(*by)).alias("z")).first()
            for d, name, data in ((days["a"], "empty.parquet", b""), (days["z"], "garbage.parquet", b"not a parquet file")):
                folder = "/".join(f"{k}={v}" for k, v in d.asDict().items())
                path = spark._jvm.org.apache.hadoop.fs.Path(f"{root}/{folder}/{name}")
                out = path.getFileSystem(spark._jsc.hadoopConfiguration()).create(path)
                out.write(bytearray(data))
                out.close()
        _LAKES[key] = root
    return _LAKES[key]


def opened(spark, sf, broken=False):
    root = lake(spark, sf, broken)
    files = inventory.dated(inventory.list_files(spark, root), root)
    return files, reader.footers(files)


@query("file_inventory", " UNION ALL ".join(
    f"""SELECT '{t}.parquet' AS label, true AS has_bytes, true AS readable, CAST(count(*) AS BIGINT) AS num_rows FROM {t}""" for t in _TABLES))
def file_inventory(spark, sf):
    """The files of every table, whether it is one file or a folder of them."""
    table_of = F.substring_index("label", "/", 1)
    files = inventory.dated(inventory.list_files(spark, sf), inventory.spelled(sf)).withColumn("label", table_of).filter(
        F.col("label").isin(*[f"{t}.parquet" for t in _TABLES]))
    return files.join(reader.footers(files).select("path", "readable", "num_rows"), "path").groupBy("label").agg(
        F.bool_and(F.col("length") > 0).alias("has_bytes"), F.bool_and("readable").alias("readable"),
        F.sum("num_rows").alias("num_rows"))


# paths of the four layouts, good and bad, one per order
_PATHS = r"""(SELECT o_orderkey, o_orderpriority AS p, o_orderdate AS d, CASE o_orderpriority
  WHEN '1-URGENT' THEN strftime(o_orderdate, 'lake/recorded_year=%Y/recorded_month=%m/recorded_day=%-d/part-0.parquet')
  WHEN '2-HIGH' THEN strftime(o_orderdate, 'lake/recorded_year=%Y/recorded_month=%m/recorded_week=W') || CAST((day(o_orderdate) - 1) // 5 AS VARCHAR) || '/part-0.parquet'
  WHEN '3-MEDIUM' THEN strftime(o_orderdate, 'lake\snapshot_date=%Y-%m-%d\part-0.parquet')
  WHEN '4-NOT SPECIFIED' THEN strftime(o_orderdate, 'lake/table_%Y%m%d.parquet')
  ELSE strftime(o_orderdate, 'lake/%Y/table_%Y') || '1' || strftime(o_orderdate, '%d2.parquet') END AS path FROM orders) o"""


@query("partition_date_from_path", rf"""
SELECT path, CAST(CASE p WHEN '1-URGENT' THEN CAST(d AS DATE)
  WHEN '2-HIGH' THEN CASE WHEN (day(d) - 1) // 5 BETWEEN 1 AND 5 AND NOT (month(d) = 2 AND (day(d) - 1) // 5 = 5 AND year(d) % 4 <> 0)
    THEN make_date(year(d), month(d), 1 + 7 * ((day(d) - 1) // 5 - 1)) END
  WHEN '3-MEDIUM' THEN CAST(d AS DATE) WHEN '4-NOT SPECIFIED' THEN CAST(d AS DATE)
  ELSE TRY_CAST(strftime(d, '%Y-1') || left(strftime(d, '%d'), 1) || '-' || right(strftime(d, '%d'), 1) || '2' AS DATE) END AS VARCHAR) AS day,
  CAST(count(*) AS BIGINT) AS files FROM {_PATHS} GROUP BY 1, 2""")
def partition_date_from_path(spark, sf):
    o = table(spark, sf, "orders")
    d, p = F.col("o_orderdate"), F.col("o_orderpriority")
    ymd = F.date_format(d, "yyyy"), F.date_format(d, "MM"), F.date_format(d, "dd")
    folder = F.concat(F.lit("lake/recorded_year="), ymd[0], F.lit("/recorded_month="), ymd[1])
    week = F.floor((F.dayofmonth(d) - 1) / 5).cast("string")
    path = (F.when(p == "1-URGENT", F.concat(folder, F.lit("/recorded_day="), F.dayofmonth(d).cast("string"), F.lit("/part-0.parquet")))
            .when(p == "2-HIGH", F.concat(folder, F.lit("/recorded_week=W"), week, F.lit("/part-0.parquet")))
            .when(p == "3-MEDIUM", F.concat(F.lit("lake\\snapshot_date="), F.concat_ws("-", *ymd), F.lit("\\part-0.parquet")))
            .when(p == "4-NOT SPECIFIED", F.concat(F.lit("lake/table_"), *ymd, F.lit(".parquet")))
            .otherwise(F.concat(F.lit("lake/"), ymd[0], F.lit("/table_"), ymd[0], F.lit("1"), ymd[2], F.lit("2.parquet"))))
    out = o.select(path.alias("path")).withColumn("day", times.date_from_path(F.col("path")).cast("string"))
    return out.groupBy("path", "day").agg(F.count(F.lit(1)).alias("files"))


def _order_files(spark, sf):
    """A listing derived from orders: one file per order day and priority, its size the order value in cents."""
    o = table(spark, sf, "orders")
    d = F.col("o_orderdate")
    path = F.concat(F.lit("/lake/orders/recorded_year="), F.date_format(d, "yyyy"), F.lit("/recorded_month="), F.date_format(d, "MM"),
                    F.lit("/recorded_week="), times.week_of_month(d).cast("string"), F.lit("/part-"), F.substring("o_orderpriority", 1, 1),
                    F.lit(".parquet"))
    files = o.groupBy(path.alias("path")).agg(F.sum(F.round(F.col("o_totalprice") * 100).cast("bigint")).alias("length"))
    return inventory.dated(files, "/lake/orders")


_WEEKS = """(SELECT CAST(make_date(year(o_orderdate), month(o_orderdate), 1 + 7 * ((day(o_orderdate) - 1) // 7)) AS VARCHAR) AS day,
  left(o_orderpriority, 1) AS file, CAST(round(o_totalprice * 100) AS BIGINT) AS cents,
  strftime(o_orderdate, 'recorded_year=%Y/recorded_month=%m/recorded_week=') || CAST((day(o_orderdate) - 1) // 7 + 1 AS VARCHAR) AS folder FROM orders) o"""
_FILES = f"(SELECT day, folder, file, CAST(sum(cents) AS BIGINT) AS length FROM {_WEEKS} GROUP BY 1, 2, 3) f"
_PARTS = f"""(SELECT day, CASE WHEN count(*) = 1 THEN min(folder) || '/part-' || min(file) || '.parquet' ELSE min(folder) || ' (' || count(*) || ' file)' END AS label,
  CAST(sum(length) AS BIGINT) AS bytes, CAST(count(*) AS BIGINT) AS files FROM {_FILES} GROUP BY day) p"""


def _shown(parts):
    return parts.select(F.col("part_date").cast("string").alias("day"), "label", "bytes", "files")


@query("merge_files_of_a_date", f"SELECT day, label, bytes, files FROM {_PARTS}")
def merge_files_of_a_date(spark, sf):
    return _shown(inventory.partitions(_order_files(spark, sf)))


@query("partition_order", f"SELECT day, label, bytes, files FROM {_PARTS} ORDER BY day, label LIMIT 10")
def partition_order(spark, sf):
    """The first ten partitions, oldest first."""
    return _shown(inventory.first_n(inventory.partitions(_order_files(spark, sf)), 10))


@query("partition_latest", f"SELECT day, label, bytes, files FROM {_PARTS} ORDER BY day DESC LIMIT 1")
def partition_latest(spark, sf):
    return _shown(inventory.latest(inventory.partitions(_order_files(spark, sf))))


@query("partition_of_week", f"SELECT day, label, bytes, files FROM {_PARTS} WHERE day = '1998-10-15'")
def partition_of_week(spark, sf):
    return _shown(inventory.select(inventory.partitions(_order_files(spark, sf)), "mingguan", "1998-10-20"))


@query("partition_on_date", f"SELECT day, label, bytes, files FROM {_PARTS} WHERE day = '1998-10-08'")
def partition_on_date(spark, sf):
    return _shown(inventory.select(inventory.partitions(_order_files(spark, sf)), "harian", "1998-10-08"))


@query("partition_by_label", f"SELECT day, label, bytes, files FROM {_PARTS} WHERE label = 'recorded_year=1999/recorded_month=05/recorded_week=2 (5 file)'")
def partition_by_label(spark, sf):
    return _shown(inventory.named(inventory.partitions(_order_files(spark, sf)), "recorded_year=1999/recorded_month=05/recorded_week=2 (5 file)"))


@query("partition_fallback", f"SELECT day, label, bytes, files FROM {_PARTS} ORDER BY day DESC LIMIT 1")
def partition_fallback(spark, sf):
    """The date has no partition: a daily dataset falls back to the newest one."""
    return _shown(inventory.select(inventory.partitions(_order_files(spark, sf)), "harian", inventory.yesterday(dt.datetime(2030, 1, 1)),
                                   fallback_latest=True))


@query("partition_size_in_range", f"""SELECT day, bytes, bytes BETWEEN 100000000 AND 2000000000 AS success FROM {_PARTS}""")
def partition_size_in_range(spark, sf):
    p = inventory.partitions(_order_files(spark, sf))
    return p.select(F.col("part_date").cast("string").alias("day"), "bytes", F.col("bytes").between(100_000_000, 2_000_000_000).alias("success"))


@query("small_files", f"""
SELECT day, CAST(count(*) AS BIGINT) AS files, CAST(sum(length) AS BIGINT) AS bytes, median(length) AS median_bytes,
  round(avg(CASE WHEN length < 50000000 THEN 1.0 ELSE 0.0 END), 6) AS small_share FROM {_FILES} GROUP BY 1""")
def small_files(spark, sf):
    s = inventory.small_files(_order_files(spark, sf), 50_000_000)
    return s.select(F.col("part_date").cast("string").alias("day"), "files", "bytes", "median_bytes",
                    F.round("small_share", 6).alias("small_share"))


@query("lake_partitions", f"""
SELECT day, strftime(CAST(day AS DATE), 'recorded_year=%Y/recorded_month=%m/recorded_day=%d') AS folder, CAST(count(DISTINCT kind) AS BIGINT) AS files,
  CAST(count(*) AS BIGINT) AS num_rows FROM (SELECT {DAY} AS day, event_type = 'click' AS kind FROM events) e GROUP BY 1""")
def lake_partitions(spark, sf):
    files, probed = opened(spark, sf)
    rows = files.join(probed, "path").groupBy("part").agg(F.sum("num_rows").alias("num_rows"))
    return inventory.partitions(files).join(rows, "part").select(
        F.col("part").alias("day"), F.regexp_extract("label", r"^(.*?recorded_day=\d+)", 1).alias("folder"), "files", "num_rows")


@query("read_drifting_files", f"""
SELECT day, CAST(count(*) AS BIGINT) AS "rows", CAST(count(value) AS BIGINT) AS values_present, CAST(count(*) FILTER (WHERE event_type = 'click') AS BIGINT) AS without_props,
  round(sum(value), 4) AS total FROM (SELECT *, {DAY} AS day FROM events) e GROUP BY 1""")
def read_drifting_files(spark, sf):
    """Files of one day with different columns and types are read together by name."""
    files, probed = opened(spark, sf)
    df = reader.read_partitions(spark, files, probed)
    return df.groupBy(F.col(PART).alias("day")).agg(
        F.count(F.lit(1)).alias("rows"), F.count("value").alias("values_present"), F.count_if(F.col("props").isNull()).alias("without_props"),
        F.round(F.sum(F.col("value").try_cast("double")), 4).alias("total"))


_WIDENING = {"kolom": [{"nama": "event_id", "tipe": "integer"}, {"nama": "value", "tipe": "float"}, {"nama": "amount", "tipe": "decimal"},
                       {"nama": "at", "tipe": "datetime"}, {"nama": "code", "tipe": "integer"}]}


@query("read_widening_files", f"""
SELECT {DAY} AS day, CAST(count(*) AS BIGINT) AS "rows", CAST(sum(event_id) AS BIGINT) AS ids,
  round(sum(CASE WHEN event_type = 'click' THEN CAST(CAST(value AS FLOAT) AS DOUBLE) ELSE value END), 3) AS total,
  CAST(sum(CASE WHEN event_type = 'click' THEN CAST(value AS DECIMAL(10, 2)) ELSE CAST(value AS DECIMAL(18, 4)) END) AS VARCHAR) AS amounts,
  strftime(max(CASE WHEN event_type = 'click' THEN CAST(CAST(ts AS DATE) AS TIMESTAMP) ELSE ts END), '%Y-%m-%d %H:%M:%S') AS last,
  string_agg(DISTINCT CASE WHEN event_type = 'click' THEN 'c' || user_id WHEN user_id % 2 = 0 THEN CAST(user_id AS VARCHAR) END, ',' ORDER BY
    CASE WHEN event_type = 'click' THEN 'c' || user_id WHEN user_id % 2 = 0 THEN CAST(user_id AS VARCHAR) END) AS codes,
  'code' AS failed, 4 AS passed FROM events GROUP BY 1""")
def read_widening_files(spark, sf):
    """Files of one day whose columns differ in width only are one scan of the wider types, and pass their type rules.

    Clicks have whole numbers of 32 bits, floats, short decimals and dates; only ``code``, text there, can't be widened.
    """
    root = scratch_path(spark, "widening")
    e = table(spark, sf, "events").withColumn("snapshot_date", F.to_date("ts"))
    click, v = F.col("event_type") == "click", F.col("value")
    narrow = e.where(click).select(F.col("event_id").cast("int").alias("event_id"), v.cast("float").alias("value"),
                                   v.cast("decimal(10,2)").alias("amount"), F.to_date("ts").alias("at"),
                                   F.concat(F.lit("c"), "user_id").alias("code"), "snapshot_date")
    wide = e.where(~click).select("event_id", "value", v.cast("decimal(18,4)").alias("amount"), F.col("ts").alias("at"),
                                  F.when(F.col("user_id") % 2 == 0, F.col("user_id")).alias("code"), "snapshot_date")
    for part in (narrow, wide):
        part.repartition("snapshot_date").write.mode("append").partitionBy("snapshot_date").parquet(root)
    files = inventory.dated(inventory.list_files(spark, root), root)
    df = reader.read_partitions(spark, files, reader.footers(files))
    types = schema.schema_diff(df.drop(PART, PART_DATE), parse_contract("events", _WIDENING)).agg(
        F.array_join(F.sort_array(F.collect_list(F.when(F.col("status") != "ok", F.col("column")))), ",").alias("failed"),
        F.count_if(F.col("status") == "ok").cast("int").alias("passed")).first()
    return df.groupBy(F.col(PART).alias("day")).agg(
        F.count(F.lit(1)).alias("rows"), F.sum("event_id").alias("ids"), F.round(F.sum("value"), 3).alias("total"),
        F.sum("amount").cast("string").alias("amounts"), F.date_format(F.max("at"), "yyyy-MM-dd HH:mm:ss").alias("last"),
        F.array_join(F.sort_array(F.collect_set("code")), ",").alias("codes"),
        F.lit(types["failed"]).alias("failed"), F.lit(types["passed"]).alias("passed"))


@query("unreadable_files", f"""
SELECT day, CAST(count(*) AS BIGINT) AS good_rows, CASE WHEN day IN ((SELECT min({DAY}) FROM events), (SELECT max({DAY}) FROM events)) THEN 1 ELSE 0 END AS bad_files
FROM (SELECT *, {DAY} AS day FROM events) e GROUP BY 1""")
def unreadable_files(spark, sf):
    """An empty and a garbage file become findings of their partitions; every other file is probed as usual."""
    files, probed = opened(spark, sf, broken=True)
    bad = reader.unreadable_parts(files, probed).select("part", "bad_files")
    good = files.join(probed, "path").groupBy("part").agg(F.sum("num_rows").alias("good_rows"))
    return good.join(bad, "part", "left").select(F.col("part").alias("day"), "good_rows",
                                                F.coalesce("bad_files", F.lit(0)).cast("int").alias("bad_files"))


@query("file_schema_drift", f"""
WITH k AS (SELECT {DAY} AS day, event_type = 'click' AS late FROM events GROUP BY 1, 2)
SELECT day, c AS "column", status FROM k, (VALUES
  ('event_id', 'ok', 'ok'), ('ts', 'ok', 'ok'), ('user_id', 'ok', 'ok'), ('event_type', 'ok', 'ok'), ('value', 'ok', 'drift'),
  ('props', 'ok', 'missing'), ('audit', 'missing', 'missing')) v(c, early_status, late_status), LATERAL (SELECT CASE WHEN late THEN late_status ELSE early_status END AS status)""")
def file_schema_drift(spark, sf):
    c = parse_contract("events", {"kolom": [
        {"nama": "event_id", "tipe": "integer"}, {"nama": "ts", "tipe": "datetime"}, {"nama": "user_id", "tipe": "integer"},
        {"nama": "event_type"}, {"nama": "value", "tipe": "float"}, {"nama": "props"}, {"nama": "audit", "tipe": "datetime"}]})
    files, probed = opened(spark, sf)
    d = schema.schema_diff_by_file(probed, c).join(files.select("path", "part"), "path")
    return d.select(F.col("part").alias("day"), "column", "status")


@query("snapshot_ingest", """
SELECT '2024-03-01' AS snapshot_date, 'completed' AS status, CAST(count(*) AS BIGINT) AS source_rows, CAST(count(*) AS BIGINT) AS landed_rows, true AS counts_match FROM customer
UNION ALL SELECT '2024-03-02', 'completed_empty', 0, 0, true""")
def snapshot_ingest(spark, sf):
    root, c = scratch_path(spark, "snapshots"), table(spark, sf, "customer")
    first = external.ingest_snapshot(c, root, "2024-03-01")
    again = external.ingest_snapshot(c, root, "2024-03-01")          # the same date once more: replaced, not doubled
    empty = external.ingest_snapshot(c.filter("c_custkey < 0"), root, "2024-03-02")
    return again.intersect(first).unionByName(empty).drop("path")


@query("snapshot_read_back", """
SELECT c_mktsegment AS segment, CAST(count(*) AS BIGINT) AS "rows", '2024-03-01' AS day FROM customer GROUP BY 1""")
def snapshot_read_back(spark, sf):
    root, c = scratch_path(spark, "snapshots"), table(spark, sf, "customer")
    external.ingest_snapshot(c, root, "2024-03-01").collect()
    files = inventory.dated(inventory.list_files(spark, root), root)
    df = reader.read_partitions(spark, files, reader.footers(files))
    return df.groupBy(F.col("c_mktsegment").alias("segment"), F.col(PART).alias("day")).agg(F.count(F.lit(1)).alias("rows"))


@query("contract_catalogue", """
SELECT 'events' AS dataset, 2::BIGINT AS columns, 'jam' AS grain, 'harian' AS partitioning, CAST(count(*) AS BIGINT) AS "rows" FROM events
UNION ALL SELECT 'orders', 1, '-', 'mingguan', count(*) FROM orders""")
def contract_catalogue(spark, sf):
    specs = {"events": {"sumber": {"partisi": "harian"}, "kunci": {"waktu": "ts", "granularitas": "jam"},
                        "kolom": [{"nama": "ts", "tipe": "datetime"}, "event_type"]},
             "orders": {"sumber": {"partisi": "mingguan"}, "kolom": [{"nama": "o_orderkey", "tipe": "integer"}]}}
    c = history.catalogue(spark, {n: parse_contract(n, s) for n, s in specs.items()})
    n = None
    for name in specs:
        r = table(spark, sf, name).agg(F.lit(name).alias("dataset"), F.count(F.lit(1)).alias("rows"))
        n = r if n is None else n.unionByName(r)
    return c.join(n, "dataset").select("dataset", "columns", F.coalesce("grain", F.lit("-")).alias("grain"), "partitioning", "rows")


_WIDE = {"kolom": [{"nama": "event_id", "tipe": "integer"}, {"nama": "ts", "tipe": "datetime"},
                   {"nama": "value", "tipe": "float", "wajib": False}, {"nama": "filed_at", "tipe": "datetime"}],
         "kunci": {"surrogate": "event_id", "waktu": "ts"}, "meta_audit": {"wajib": ["filed_at"]}}


@query("lake_sweep_schema", f"""
WITH d AS (SELECT {DAY} AS day, day(ts) AS n, count(*) FILTER (WHERE day(ts) = 20 AND event_type = 'click') AS lost FROM events GROUP BY ALL)
SELECT day, r AS rule_id, CASE r WHEN '1.column_set' THEN n > 10 WHEN '1.type.filed_at' THEN n > 10 WHEN '1.type.value' THEN n <> 25
  WHEN '12.audit_columns' THEN n > 10 WHEN '9.source_columns' THEN n > 10 WHEN '9.row_count.events' THEN lost = 0 ELSE true END AS success
FROM d, (VALUES ('1.column_count'), ('1.column_set'), ('1.type.event_id'), ('1.type.ts'), ('1.type.value'), ('1.type.filed_at'),
  ('12.audit_columns'), ('9.source_columns'), ('9.row_count.events')) v(r) WHERE n <> 15
UNION ALL SELECT DISTINCT day, '9.row_count.events', false FROM d WHERE n = 15""")
def lake_sweep_schema(spark, sf):
    """All days of a lake with a history, each judged by its own files, and by what the source has of it.

    Up to the tenth day of a month the audit column has an older name, on the 25th a number is text, the 15th never landed and
    the 20th lacks a kind of event.
    """
    root = scratch_path(spark, "drifting")
    e = table(spark, sf, "events").select("event_id", "ts", "event_type", "value", (F.col("ts") + F.expr("INTERVAL 3 HOURS")).alias("filed_at"))
    source = e.drop("event_type")
    n = F.dayofmonth("ts")
    days = e.filter(~((n == 20) & (F.col("event_type") == "click"))).drop("event_type").withColumn("snapshot_date", F.to_date("ts"))
    for part in (days.filter(n <= 10).withColumnRenamed("filed_at", "stored_at"), days.filter((n > 10) & ~n.isin(15, 25)),
                 days.filter(n == 25).withColumn("value", F.col("value").cast("string"))):
        part.repartition("snapshot_date").write.mode("append").partitionBy("snapshot_date").parquet(root)
    c = parse_contract("events", {**_WIDE, "sumber": {"s3": root, "sql_server": {"tabel": "events", "kolom_waktu": "ts"}}})
    learned = bl.learn(with_partition(source, F.to_date("ts")), c)
    r = validate.validate(spark, c, learned, where="s3", sweep=True, source_table=source)
    shown = F.col("dim").isin(1, 9) | (F.col("rule_id") == "12.audit_columns")
    return r.filter(shown).select(F.col("part_date").cast("string").alias("day"), "rule_id", "success")
