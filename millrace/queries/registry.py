"""Names, callables and SQL of queries; tables and the views that adapt them."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

QUERIES: dict[str, Callable[[SparkSession, str], DataFrame]] = {}
ORACLE: dict[str, str] = {}


class Tables:
    """The tables of a folder as attributes; ``e`` is ``events`` as platform events."""

    def __init__(self, spark: SparkSession, sf_dir: str):
        self.spark, self.sf_dir = spark, sf_dir

    def __getattr__(self, name: str) -> DataFrame:
        return self.spark.read.parquet(f"{self.sf_dir}/{name}.parquet")

    @property
    def e(self) -> DataFrame:
        return self.events.select(
            "event_id", "ts", F.col("user_id").cast("string").alias("user_id"), "event_type", F.floor("value").cast("long").alias("bytes"),
            F.get_json_object("props", "$.k").alias("resource_id"), "value",
        )


#: The same view in SQL.
E = "e AS (SELECT event_id, ts, user_id::VARCHAR AS user_id, event_type, floor(value)::BIGINT AS bytes, json_extract_string(props, '$.k') AS resource_id, value FROM events)"


def query(name: str, sql: str | None = None):
    def add(f: Callable[[Tables], DataFrame]):
        QUERIES[name] = lambda spark, sf_dir: f(Tables(spark, sf_dir))
        if sql:
            ORACLE[name] = sql
        return f

    return add
