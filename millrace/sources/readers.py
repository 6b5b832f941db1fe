"""Scans: event files, lakes, CSV, fixed-width records, JDBC ranges, inventories and logs."""

from __future__ import annotations

from collections.abc import Sequence
from decimal import Decimal

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

EVENT = "eventId STRING, eventType STRING, userId STRING, resourceId STRING, resourceType STRING, metadata MAP<STRING,STRING>, timestamp STRING"
LOG = "timestamp STRING, level STRING, service STRING, message STRING, trace_id STRING, span_id STRING, user_id STRING, request_id STRING, duration_ms DOUBLE, status INT, path STRING, error STRUCT<type: STRING, message: STRING, stack: STRING>"


def event_time(text: Column) -> Column:
    """ISO-8601 text or a number of milliseconds."""
    return F.coalesce(F.timestamp_millis(text.try_cast("long")), F.try_to_timestamp(text))


def parse_events(lines: DataFrame, line: str = "value") -> DataFrame:
    """Events of JSON lines; blank lines and lines that begin with # are dropped."""
    text = F.trim(line)
    rows = lines.where((text != "") & ~text.startswith("#")).select(F.from_json(text, EVENT).alias("e")).select("e.*")
    return rows.withColumn("timestamp", event_time(F.col("timestamp")))


def read_events_ndjson(spark: SparkSession, path: str) -> DataFrame:
    return parse_events(spark.read.text(path))


def read_event_store(events: DataFrame, day: str, column: str = "event_date") -> DataFrame:
    """Rows whose text date begins with the day: the filter reaches the scan."""
    return events.where(F.col(column).startswith(day))


def read_daily_users(spark: SparkSession, root: str, day: str, lookback: int, schema: str) -> DataFrame:
    """The last days of a lake partitioned by year, month and day; missing days are just not there."""
    at = F.make_date(F.col("year").cast("int"), F.col("month").cast("int"), F.col("day").cast("int"))
    end = F.lit(day).cast("date")
    df = spark.read.schema(f"{schema}, year INT, month INT, day INT").json(root)
    return df.where(at.between(F.date_sub(end, lookback), end))


def read_market_csv(spark: SparkSession, path: str, schema: str) -> DataFrame:
    return spark.read.schema(schema).option("header", True).csv(path)


def read_fixed_width(spark: SparkSession, path: str, length: int, layout: Sequence[tuple[str, int, int]], expected: int | None = None) -> DataFrame:
    """Raw bytes of each field of fixed-length records: (name, offset from 0, length). Splits fall on record borders.

    Files must hold whole records, and ``expected`` of them if it is given.
    """
    sizes = read_object_inventory(spark, path).agg(F.coalesce(F.sum("size"), F.lit(0)), F.count_if(F.col("size") % length > 0)).first()
    if sizes[1]:
        raise ValueError(f"{sizes[1]} files do not hold whole records of {length} bytes")
    if expected is not None and sizes[0] != expected * length:
        raise ValueError(f"{sizes[0] // length} records where {expected} were recorded")
    # Records stay in the JVM from the split to the fields.
    records = spark.sparkContext._jsc.binaryRecords(path, length)
    df = DataFrame(spark._jsparkSession.createDataset(records.rdd(), spark._jvm.org.apache.spark.sql.Encoders.BINARY()).toDF(), spark)
    return df.select(F.col("value").alias("record"), *[F.substring("value", at + 1, n).alias(name) for name, at, n in layout])


def read_jdbc_range(spark: SparkSession, url: str, name: str, key: str, ranges: Sequence[tuple], selection: str = "1 = 1", options: dict[str, str] | None = None) -> DataFrame:
    """One task for each planned key range, sorted by the key inside it."""
    return spark.read.jdbc(url, name, predicates=range_predicates(key, ranges, selection), properties=options or {}).sortWithinPartitions(key)


def range_predicates(key: str, ranges: Sequence[tuple], selection: str = "1 = 1") -> list[str]:
    """A condition for each range; numbers stand as they are, other keys as quoted text."""
    quoted = lambda v: str(v) if isinstance(v, (int, float, Decimal)) else "'" + str(v).replace("'", "''") + "'"
    return [f"({selection}) AND {key} BETWEEN {quoted(a)} AND {quoted(b)}" for a, b in ranges]


def read_object_inventory(spark: SparkSession, path: str, pattern: str = "*") -> DataFrame:
    """Key, size and time of objects under a path; their content is not read."""
    df = spark.read.format("binaryFile").option("recursiveFileLookup", True).option("pathGlobFilter", pattern).load(path)
    return df.select(F.col("path").alias("key"), F.col("length").alias("size"), F.col("modificationTime").alias("last_modified"))


def paged_extract(df: DataFrame, names: dict[str, tuple[Sequence[str], object]]) -> DataFrame:
    """Each field from the first of its columns that is there, else its default. Paging falls away in a scan."""
    return df.select(*[F.coalesce(*[F.col(c) for c in cs if c in df.columns], F.lit(d)).alias(n) for n, (cs, d) in names.items()])


def parse_logs(lines: DataFrame, line: str = "value") -> tuple[DataFrame, DataFrame]:
    """Good log rows and lines that lack JSON or one of the four required fields."""
    rows = lines.select(F.col(line).alias("_line"), F.from_json(line, LOG).alias("l"))
    ok = F.col("l").isNotNull()
    for f in ("timestamp", "level", "service", "message"):
        ok = ok & F.col(f"l.{f}").isNotNull()
    return rows.where(ok).select("l.*"), rows.where(~F.coalesce(ok, F.lit(False))).select("_line")


def read_structured_logs(spark: SparkSession, path: str) -> DataFrame:
    return parse_logs(spark.read.text(path))[0]
