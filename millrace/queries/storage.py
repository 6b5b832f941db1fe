"""Sources and sinks: tables written to the scratch folder by a sink and read back by a source."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ..functions import convert as cv
from ..operators import aggregates as ag
from ..operators import windows as wn
from ..scratch import scratch_path
from ..sources import readers, sinks
from .registry import Tables, query


@query("src03_daily_users", "SELECT user_id, ts::DATE AS day, count(*) AS total FROM events WHERE ts::DATE BETWEEN DATE '2024-01-09' AND DATE '2024-01-12' GROUP BY 1, 2")
def _(t: Tables) -> DataFrame:
    at = scratch_path(t.spark, "lake")
    daily = t.events.groupBy("user_id", F.to_date("ts").alias("d")).agg(F.count("*").alias("total"))
    sinks.write_lake_days(daily.select("user_id", "total", "d"), at, F.col("d"))
    rows = readers.read_daily_users(t.spark, at, "2024-01-12", 3, "user_id LONG, total LONG")
    return rows.select("user_id", F.make_date("year", "month", "day").alias("day"), "total")


@query("src04_market_csv", "SELECT p_partkey, p_name, p_brand, p_retailprice::DECIMAL(12, 2)::DOUBLE AS price FROM part")
def _(t):
    at = scratch_path(t.spark, "csv")
    rows = t.part.select("p_partkey", "p_name", "p_brand", F.col("p_retailprice").cast("decimal(12,2)").alias("price"))
    sinks.export_csv(rows, at, rows.columns)
    back = readers.read_market_csv(t.spark, at, "p_partkey LONG, p_name STRING, p_brand STRING, price DECIMAL(12,2)")
    return back.withColumn("price", F.col("price").cast("double"))


@query("src05_fixed_width", "SELECT o_orderkey, o_orderstatus AS status, (o_totalprice * 100)::BIGINT AS cents FROM orders")
def _(t):
    """Orders as 18-byte records: a binary key, a letter, a packed amount and a filler."""
    at = scratch_path(t.spark, "records")
    cents = F.lpad(F.round(F.col("o_totalprice") * 100).cast("long").cast("string"), 15, "0")
    record = F.concat(F.unhex(F.lpad(F.hex("o_orderkey"), 16, "0")), F.encode("o_orderstatus", "US-ASCII"), F.unhex(F.concat(cents, F.lit("C"))))
    # Text is written byte by byte as it is; the filler ends a record as a line end does a line.
    t.orders.select(record.cast("string").alias("value")).write.option("lineSep", "Z").text(at)
    rows = readers.read_fixed_width(t.spark, at, 18, [("key", 0, 8), ("status", 8, 1), ("cents", 9, 8)], expected=t.orders.count())
    return rows.select(cv.unpack_int(F.col("key")).alias("o_orderkey"), F.decode("status", "US-ASCII").alias("status"), (cv.unpack_decimal(F.col("cents"), 2) * 100).cast("long").alias("cents"))


@query("src06_jdbc_range", "SELECT o_orderkey, o_orderstatus FROM orders WHERE o_orderstatus <> 'P'")
def _(t):
    """The predicates of a range read, on the table that stands in for the database; eight ranges whatever its size."""
    n = max(1, -(-t.orders.count() // 8))
    ranges = [(r.from_key, r.to_key) for r in wn.key_ranges(t.orders, "o_orderkey", n).collect()]
    out = t.orders.limit(0)
    for p in readers.range_predicates("o_orderkey", ranges, "o_orderstatus <> 'P'"):
        out = out.unionByName(t.orders.where(p))
    return out.select("o_orderkey", "o_orderstatus")


@query("src07_inventory", "SELECT DISTINCT c_mktsegment AS segment, true AS filled FROM customer")
def _(t):
    at = scratch_path(t.spark, "objects")
    t.customer.write.partitionBy("c_mktsegment").parquet(at)
    rows = readers.read_object_inventory(t.spark, at, "*.parquet")
    return rows.groupBy(F.regexp_extract("key", "c_mktsegment=([^/]+)/", 1).alias("segment")).agg((F.min("size") > 0).alias("filled"))


@query("src07_inventory_bytes", "SELECT c_mktsegment AS segment, count(*) AS objects, sum(bytes)::BIGINT AS bytes FROM (SELECT c_mktsegment, c_nationkey, sum(strlen(c_name) + 1) AS bytes FROM customer GROUP BY 1, 2) GROUP BY 1")
def _(t):
    """An object of lines for each segment and nation, so that objects and bytes are known."""
    at = scratch_path(t.spark, "objects")
    t.customer.select("c_mktsegment", "c_nationkey", "c_name").repartition("c_mktsegment", "c_nationkey").write.partitionBy("c_mktsegment", "c_nationkey").text(at)
    rows = readers.read_object_inventory(t.spark, at, "*.txt")
    return rows.groupBy(F.regexp_extract("key", "c_mktsegment=([^/]+)/", 1).alias("segment")).agg(F.count("*").alias("objects"), F.sum("size").alias("bytes"))


@query("snk01_lake_partition", "SELECT day(ts)::INT AS day, event_type, count(*) AS n FROM events WHERE ts::DATE IN (DATE '2024-01-10', DATE '2024-01-11') GROUP BY 1, 2")
def _(t):
    """Two days, the first of them written twice: the rerun leaves the other day alone."""
    at = scratch_path(t.spark, "lake")
    for d in ("2024-01-10", "2024-01-11", "2024-01-10"):
        rows = t.events.where(F.to_date("ts") == F.lit(d).cast("date"))
        sinks.write_lake_partition(rows.groupBy("event_type").agg(F.count("*").alias("n")), at, d)
    return t.spark.read.schema("event_type STRING, n LONG, year INT, month INT, day INT").json(at).select("day", "event_type", "n")


@query("snk05_export_json", """SELECT 'rows' AS part, event_type AS name, count(*) AS n FROM events GROUP BY 2 UNION ALL SELECT 'header', 'json 2024-01', count(*) FROM events""")
def _(t):
    at = scratch_path(t.spark, "export")
    sinks.export_json(t.events.select("event_id", "event_type", "value"), at, "2024-01", "2024-02-01")
    rows = t.spark.read.schema("event_id LONG, event_type STRING, value DOUBLE").json(f"{at}/rows")
    head = t.spark.read.schema("format STRING, period STRING, generated_at STRING, record_count LONG").json(f"{at}/header")
    counts = rows.groupBy(F.lit("rows").alias("part"), F.col("event_type").alias("name")).agg(F.count("*").alias("n"))
    return counts.unionByName(head.select(F.lit("header").alias("part"), F.concat_ws(" ", "format", "period").alias("name"), F.col("record_count").alias("n")))


@query("snk06_archive", "SELECT year(ts)::INT AS year, week(ts)::INT AS week, count(*) AS n, sum(event_id)::BIGINT AS ids FROM events WHERE ts < TIMESTAMP '2024-01-20' GROUP BY 1, 2")
def _(t):
    at = scratch_path(t.spark, "archive")
    sinks.archive_jsonl(t.events.where("ts < TIMESTAMP_NTZ'2024-01-20 00:00:00'").select("event_id", "ts"), at, "ts")
    rows = t.spark.read.schema("event_id LONG, ts TIMESTAMP_NTZ, year INT, week INT").json(at)
    return rows.groupBy("year", "week").agg(F.count("*").alias("n"), F.sum("event_id").alias("ids"))


@query("snk07_publish_latest", "SELECT '2024-01-11' AS report, event_type, count(*) AS n FROM events WHERE ts::DATE = DATE '2024-01-11' GROUP BY 2 UNION ALL SELECT '2024-01-10', event_type, count(*) FROM events WHERE ts::DATE = DATE '2024-01-10' GROUP BY 2")
def _(t):
    """The latest report is the second day's; the first day's stays under its date."""
    at = scratch_path(t.spark, "reports")
    for d in ("2024-01-10", "2024-01-11"):
        rows = t.events.where(F.to_date("ts") == F.lit(d).cast("date")).groupBy("event_type").agg(F.count("*").alias("n"))
        sinks.publish_latest(rows.select(F.lit(d).alias("report"), "event_type", "n"), at, d)
    read = lambda name: t.spark.read.schema("report STRING, event_type STRING, n LONG").json(f"{at}/{name}")
    return read("latest").unionByName(read("2024-01-10"))


@query("snk08_report_rows", "SELECT 'body' AS part, count(*) AS n, count(*) FILTER (WHERE o_orderkey % 3 = 0) AS empty FROM orders UNION ALL SELECT 'orders 1998', count(*), 0 FROM orders")
def _(t):
    at = scratch_path(t.spark, "report")
    rows = t.orders.select("o_orderkey", F.when(F.col("o_orderkey") % 3 > 0, F.col("o_orderstatus")).alias("status"))
    sinks.write_report_rows(rows, at, "orders", "1998")
    body = t.spark.read.option("header", True).option("nullValue", "-").option("emptyValue", "").csv(f"{at}/body")
    meta = t.spark.read.schema("name STRING, period STRING, row_count LONG").json(f"{at}/meta")
    counts = body.agg(F.lit("body").alias("part"), F.count("*").alias("n"), F.count_if(F.coalesce("status", F.lit("")) == "").alias("empty"))
    return counts.unionByName(meta.select(F.concat_ws(" ", "name", "period").alias("part"), F.col("row_count").alias("n"), F.lit(0).cast("long").alias("empty")))


@query("snk09_report", """SELECT 'total ' || o_orderpriority AS part, sum(o_totalprice::DECIMAL(31, 8))::DECIMAL(38, 8)::VARCHAR AS value FROM orders GROUP BY o_orderpriority
UNION ALL SELECT 'ledger orders', count(*)::VARCHAR FROM orders UNION ALL SELECT 'reject ' || o_orderkey, 'HASH_MISMATCH' FROM orders WHERE o_orderkey % 1000 = 0""")
def _(t):
    at = scratch_path(t.spark, "reconciliation")
    ledger = t.orders.agg(F.lit("orders").alias("table_name"), F.count("*").alias("extracted"))
    rejects = t.orders.where("o_orderkey % 1000 = 0").select(F.lit("orders").alias("table_name"), F.col("o_orderkey").alias("key"), F.lit("HASH_MISMATCH").alias("rule"))
    totals = ag.class_totals(t.orders, "o_orderpriority", ["o_totalprice"])
    sinks.reconciliation_report(ledger, rejects, totals, at)
    csv = lambda name, schema: t.spark.read.schema(schema).option("header", True).csv(f"{at}/{name}")
    a = csv("class_totals", "o_orderpriority STRING, n LONG, sum_o_totalprice STRING").select(F.concat(F.lit("total "), "o_orderpriority").alias("part"), F.col("sum_o_totalprice").alias("value"))
    b = t.spark.read.schema("table_name STRING, extracted LONG").json(f"{at}/ledger").select(F.concat(F.lit("ledger "), "table_name").alias("part"), F.col("extracted").cast("string").alias("value"))
    c = csv("rejects", "table_name STRING, key LONG, rule STRING").select(F.concat(F.lit("reject "), F.col("key").cast("string")).alias("part"), F.col("rule").alias("value"))
    return a.unionByName(b).unionByName(c)
