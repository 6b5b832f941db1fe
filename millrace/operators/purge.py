"""Purging validated rows from their source: planned, guarded, in batches that a rerun resumes.

The source deletes a batch and notes it in its own audit in one step; the
target's audit follows. A run that was cut finds what the source has deleted in
the source's audit and goes on with the rest.
"""

from __future__ import annotations

from bisect import bisect_left
from collections.abc import Iterable, Mapping, Sequence
from dataclasses import dataclass
from itertools import accumulate
from typing import Protocol

from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from ..scratch import staged

#: Rows of a bucket in which batches are numbered, about.
_BUCKET = 100_000


class PurgeGuardError(ValueError):
    pass


def purge_ranks(tables: Iterable[str], references: Sequence[tuple[str, str]]) -> dict[str, int]:
    """A rank for each table, children before the parents they refer to; ``references`` are pairs (child, parent). A table may refer to itself."""
    left = set(tables) | {x for pair in references for x in pair}
    out: dict[str, int] = {}
    while left:
        free = {t for t in left if not any(p == t and c in left and c != t for c, p in references)}
        if not free:
            raise ValueError(f"tables refer to each other in a circle: {sorted(left)}")
        out |= dict.fromkeys(free, 1 + max(out.values(), default=0))
        left -= free
    return out


def purge_batches(keys: DataFrame, key: str, rows: int) -> tuple[DataFrame, int]:
    """``key, batch``, written, with batches of at most ``rows`` keys numbered from 1, and the number of batches.

    Keys are numbered inside buckets of their hash; only the buckets' sizes
    are added up, so nothing is sorted as a whole. The same keys get the same batches.
    """
    numbered, ends = _numbered(keys, key, rows)
    return numbered.select(key, "batch"), ends[-1] if ends else 0


def _numbered(keys: DataFrame, key: str, rows: int) -> tuple[DataFrame, list[int]]:
    """``purge_batches`` with ``_bucket``, whose files lie in a folder of their own, and the last batch of each bucket."""
    n = keys.count()
    buckets = max(1, -(-n // _BUCKET))
    bucket = F.pmod(F.xxhash64(key), F.lit(buckets)).cast("int")
    per = keys.groupBy(bucket.alias("_bucket")).agg(F.ceil(F.count("*") / rows).cast("long").alias("_n"))
    # One number for each hundred thousand keys.
    sizes = dict(map(tuple, per.collect()))
    ends = list(accumulate(sizes.get(b, 0) for b in range(max(sizes, default=-1) + 1)))
    first = {b: ends[b] - n for b, n in sizes.items()}
    spark = keys.sparkSession
    bases = spark.createDataFrame(list(first.items()), "_bucket int, _base long")
    at = F.row_number().over(_by_bucket(key)) - 1
    numbered = keys.select(key, bucket.alias("_bucket")).withColumn("_at", at).join(bases, "_bucket")
    return staged(numbered.select(key, (F.col("_base") + F.floor(F.col("_at") / rows) + 1).cast("long").alias("batch"), "_bucket"), "_bucket"), ends


def _by_bucket(key: str):
    return Window.partitionBy("_bucket").orderBy(F.xxhash64(key), key)


class Source(Protocol):
    """Where rows are deleted. ``delete`` removes the keys of some batches and notes them in one step; ``audited`` gives the keys it noted for the run."""

    def delete(self, batches: DataFrame, run_id: str) -> None: ...

    def audited(self, spark: SparkSession, run_id: str) -> DataFrame: ...


def _read(spark: SparkSession, path: str, schema: str) -> DataFrame:
    """Rows of a folder that may not be there yet."""
    at = spark._jvm.org.apache.hadoop.fs.Path(path)
    if not at.getFileSystem(spark._jsc.hadoopConfiguration()).exists(at):
        return spark.createDataFrame([], schema)
    return spark.read.schema(schema).parquet(path)


@dataclass(frozen=True)
class LakeSource:
    """A Parquet table whose deleted keys are written beside it: a note of the deletion is the deletion."""

    rows: DataFrame
    key: str
    path: str

    def _schema(self) -> str:
        return f"`{self.key}` {self.rows.schema[self.key].dataType.simpleString()}, batch long, run_id string"

    def delete(self, batches: DataFrame, run_id: str) -> None:
        batches.select(self.key, "batch", F.lit(run_id).alias("run_id")).write.mode("append").parquet(self.path)

    def audited(self, spark: SparkSession, run_id: str) -> DataFrame:
        return _read(spark, self.path, self._schema()).where(F.col("run_id") == run_id).select(self.key)

    def live(self, spark: SparkSession) -> DataFrame:
        """Rows that are not deleted."""
        return self.rows.join(_read(spark, self.path, self._schema()).select(self.key), self.key, "left_anti")


@dataclass(frozen=True)
class Audit:
    """The target's audit: ``table_name, key`` (as text) ``, batch, run_id`` of purged rows; batch 0 for those a rerun recovered."""

    path: str

    def rows(self, spark: SparkSession) -> DataFrame:
        return _read(spark, self.path, "table_name string, key string, batch long, run_id string")

    def add(self, table: str, keys: DataFrame, key: str, run_id: str) -> None:
        keys.select(F.lit(table).alias("table_name"), F.col(key).cast("string").alias("key"), "batch", F.lit(run_id).alias("run_id")).write.mode("append").parquet(self.path)


LEDGER = "table_name string, validated long, purge_intended long, purged long, dry_run boolean"


def purge_table(spark: SparkSession, table: str, safe: DataFrame, key: str, validated: int, source: Source, audit: Audit, run_id: str, batch_rows: int = 1000, wave: int = 1000, dry_run: bool = False) -> DataFrame:
    """Deletes the ``safe`` keys of a table from its source; returns its row of the ledger.

    Nothing is deleted unless there are as many safe keys as ``validated``
    rows, or in a dry run. Keys that this run has purged before are passed
    over, and those that the source has deleted, but the audit does not hold,
    are taken into it. The rest goes in waves of ``wave`` batches of at most
    ``batch_rows``, each a Spark job.
    """
    keys = staged(safe.select(key).distinct())
    intended = keys.count()
    if intended != validated:
        raise PurgeGuardError(f"{table}: {intended} keys are safe to purge, {validated} rows are validated; nothing is deleted")
    purged = 0
    if not dry_run:
        own = lambda: audit.rows(spark).where((F.col("table_name") == table) & (F.col("run_id") == run_id))
        text = F.col(key).cast("string")
        todo = staged(keys.join(own().select(F.col("key").alias("_key")), text == F.col("_key"), "left_anti"))
        gone = staged(todo.join(source.audited(spark, run_id), key, "left_semi").withColumn("batch", F.lit(0).cast("long")))
        if not gone.isEmpty():
            audit.add(table, gone, key, run_id)
        rest, ends = _numbered(todo.join(gone.select(key), key, "left_anti"), key, batch_rows)
        for at in range(1, (ends[-1] if ends else 0) + 1, wave):
            # A wave reads the buckets that its batches lie in, not all keys.
            buckets = F.col("_bucket").between(bisect_left(ends, at), bisect_left(ends, at + wave - 1))
            some = rest.where(buckets & F.col("batch").between(at, at + wave - 1)).drop("_bucket")
            source.delete(some, run_id)
            audit.add(table, some, key, run_id)
        purged = own().select("key").distinct().count()
        if purged != validated:
            raise PurgeGuardError(f"{table}: {purged} rows are purged, {validated} are validated")
    return spark.createDataFrame([(table, validated, intended, purged, dry_run)], LEDGER)


def guarded(plan: DataFrame, safe: DataFrame, ledger: DataFrame, validated: str = "validated") -> DataFrame:
    """``plan`` as it is, if there are as many ``safe`` rows as the one row of ``ledger`` says; else an error when it is read. No count comes to the driver."""
    n = safe.agg(F.count("*").alias("_n")).join(ledger.select(F.col(validated).alias("_m")))
    said = F.concat(F.col("_n").cast("string"), F.lit(" keys are safe to purge, "), F.coalesce(F.col("_m").cast("string"), F.lit("no")), F.lit(" rows are validated"))
    ok = F.when(F.col("_n").eqNullSafe(F.col("_m")), True).otherwise(F.raise_error(said).cast("boolean"))
    return plan.join(F.broadcast(n.select(ok.alias("_ok")))).where("_ok").drop("_ok")


def run_order(counts: Mapping[str, DataFrame], references: Sequence[tuple[str, str]]) -> DataFrame:
    """``table_name, purge_order, n_rows`` of tables that are purged, children first."""
    ranks = purge_ranks(counts, references)
    out = None
    for name, df in counts.items():
        one = df.agg(F.count("*").alias("n_rows")).select(F.lit(name).alias("table_name"), F.lit(ranks[name]).alias("purge_order"), "n_rows")
        out = one if out is None else out.unionByName(one)
    return out
