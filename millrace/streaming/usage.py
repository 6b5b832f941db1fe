"""The daily usage rollup kept up by a stream, exact distinct users included."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from ..operators.aggregates import daily_usage_rollup
from .merged import MergedTable, added


class UsageRollup:
    """Two merged tables under ``path``: a day's counts, and a day's users as bitmaps over their numbers.

    A batch brings its own counts and bitmaps, which are added to and united
    with what is there, so no state is kept between batches and days never
    close. ``number`` gives a user's number (LONG); a bitmap covers 32,768 of
    them, so a day has a row for each block of numbers that it has users of.
    """

    def __init__(self, path: str, names: dict[str, str], number: Column, ts: str = "ts"):
        self.names, self.number, self.ts = names, number, ts
        self.counts = MergedTable(f"{path}/counts", added(["day"]))
        self.users = MergedTable(f"{path}/users", added(["day", "block"], bitmaps=["users"]))

    def parts(self, events: DataFrame) -> tuple[DataFrame, DataFrame]:
        """Counts and bitmaps of some events."""
        counts = daily_usage_rollup(events, self.names, self.ts).drop("users")
        rows = events.select(F.to_date(self.ts).alias("day"), self.number.alias("_n")).where("_n IS NOT NULL")
        users = rows.groupBy("day", F.bitmap_bucket_number("_n").alias("block")).agg(F.bitmap_construct_agg(F.bitmap_bit_position("_n")).alias("users"))
        return counts, users

    @property
    def write(self) -> Callable[[DataFrame, int], None]:
        """What ``foreachBatch`` calls with events."""

        def batch(events: DataFrame, n: int) -> None:
            events.persist()
            try:
                counts, users = self.parts(events)
                self.users.write(users, n)
                self.counts.write(counts, n)
            finally:
                events.unpersist()

        return batch

    def read(self, spark: SparkSession, events: DataFrame) -> DataFrame:
        """The rollup as ``daily_usage_rollup`` gives it; ``events`` gives the columns' types alone."""
        counts, users = self.parts(events)
        per_day = self.users.read(spark, users.schema).groupBy("day").agg(F.sum(F.bitmap_count("users")).alias("users"))
        out = self.counts.read(spark, counts.schema).join(per_day, "day", "left")
        return out.withColumn("users", F.coalesce("users", F.lit(0))).select(daily_usage_rollup(events, self.names, self.ts).columns)
