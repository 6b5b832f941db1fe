"""Ranking, running and versioning logic, set-based."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from ..scratch import staged


def top_rows(df: DataFrame, measure: str, key: str, n: int) -> DataFrame:
    """The ``n`` greatest, ties by key: no global sort and no single-partition window."""
    return df.orderBy(F.desc(measure), key).limit(n)


def recent_per_key(df: DataFrame, key: str, order: Sequence[Column], k: int) -> DataFrame:
    """The first ``k`` rows of each key; Spark cuts groups before the shuffle."""
    return df.withColumn("_n", F.row_number().over(Window.partitionBy(key).orderBy(*order))).where(F.col("_n") <= k).drop("_n")


def latest_per_key(df: DataFrame, key: str, order: Sequence[str]) -> DataFrame:
    """The last row of each key by an aggregation, which combines before the shuffle."""
    rest = [c for c in df.columns if c != key]
    return df.groupBy(key).agg(F.max_by(F.struct(*rest), F.struct(*order)).alias("_r")).select(key, "_r.*")


def rollover(ratings: DataFrame, key: str, start: str, value: str, included: Column, months: int = 3) -> DataFrame:
    """``rollover``: the sum of the prior periods' values within ``months`` before each period, at most twice what is included."""
    at = F.months_between(F.trunc(start, "MM"), F.lit("1970-01-01").cast("date")).cast("int")
    prior = F.sum(value).over(Window.partitionBy(key).orderBy(at).rangeBetween(-months, -1))
    return ratings.withColumn("rollover", F.least(2 * included, F.coalesce(prior, F.lit(0))))


def fifo_allocate(notes: DataFrame, owner: str, order: Sequence[str], remaining: str, amount: str) -> DataFrame:
    """``used`` of each note, oldest first, until its owner's ``amount`` is covered."""
    before = F.coalesce(F.sum(remaining).over(Window.partitionBy(owner).orderBy(*order).rowsBetween(Window.unboundedPreceding, -1)), F.lit(0))
    return notes.withColumn("used", F.greatest(F.lit(0), F.least(F.col(remaining), F.col(amount) - before)))


def next_attempt(invoices: DataFrame, attempts: DataFrame, key: str) -> DataFrame:
    last = attempts.groupBy(key).agg(F.max("attempt_no").alias("_last"))
    return invoices.join(last, key, "left").withColumn("attempt_no", F.coalesce("_last", F.lit(0)) + 1).drop("_last")


def scd2(changes: DataFrame, scope: Sequence[str], starts: str, ends: str) -> DataFrame:
    """Versions from dated changes: each ends the day before the next of its scope; of one day's changes the last stays.

    A null in the scope is a value of its own. ``_seq`` orders the changes of a day.
    """
    rest = [c for c in changes.columns if c not in (*scope, starts)]
    day = changes.groupBy(*scope, starts).agg(F.max_by(F.struct(*rest), "_seq").alias("_r")).select(*scope, starts, "_r.*").drop("_seq")
    return day.withColumn(ends, F.date_sub(F.lead(starts).over(Window.partitionBy(*scope).orderBy(starts)), 1))


def key_ranges(df: DataFrame, key: str, n: int, partitions: int | None = None) -> DataFrame:
    """``seq, from_key, to_key, rows``: sorted keys cut into ranges of ``n``.

    Keys are range-partitioned once and written with their partition's number,
    so the rows that are counted are the rows that are numbered; each partition
    numbers its own and adds what lies before it. Repeated keys, which fall into
    one partition, are an error. Null keys are left out.
    """
    keys = df.where(F.col(key).isNotNull()).select(F.col(key).alias("k"))
    spread = keys.repartitionByRange(partitions, "k") if partitions else keys.repartitionByRange("k")
    cut = staged(spread.select("k", F.spark_partition_id().alias("p")))
    # Partition numbers and their row counts: one row for each partition.
    before, base = 0, []
    for p, rows in sorted(map(tuple, cut.groupBy("p").count().collect())):
        base.append((p, before))
        before += rows
    offsets = F.broadcast(df.sparkSession.createDataFrame(base, "p int, base long"))
    w = Window.partitionBy("p").orderBy("k")
    numbered = cut.withColumns({"i": F.row_number().over(w) - 1, "same": F.lag("k").over(w) == F.col("k")}).join(offsets, "p")
    at = F.floor((F.col("base") + F.col("i")) / n).cast("long") + 1
    out = numbered.groupBy(at.alias("seq")).agg(F.min("k").alias("from_key"), F.max("k").alias("to_key"), F.count("*").alias("rows"), F.bool_or("same").alias("_same"))
    refuse = F.raise_error(F.lit("duplicate keys")).cast("long")
    return out.select("seq", "from_key", "to_key", F.when(F.col("_same"), refuse).otherwise(F.col("rows")).alias("rows"))


def resource_history(audit: DataFrame, resource: str, ts: str, id_col: str) -> DataFrame:
    """Each resource's events, newest first, with their place and number.

    Events are numbered by day and the days' counts added up, so no task sorts
    all of a busy resource. Events without a time come last.
    """
    rows = audit.withColumn("_day", F.to_date(ts))
    rows = rows.withColumn("_at", F.row_number().over(Window.partitionBy(resource, "_day").orderBy(F.col(ts).desc(), id_col)))
    w = Window.partitionBy(resource)
    later = w.orderBy(F.col("_day").desc()).rowsBetween(Window.unboundedPreceding, -1)
    days = audit.groupBy(resource, F.to_date(ts).alias("_day")).agg(F.count("*").alias("_c"))
    days = days.select(F.col(resource).alias("_r"), F.col("_day").alias("_d"), F.coalesce(F.sum("_c").over(later), F.lit(0)).alias("_base"), F.sum("_c").over(w).alias("n"))
    joined = rows.join(days, F.col(resource).eqNullSafe(F.col("_r")) & F.col("_day").eqNullSafe(F.col("_d")))
    return joined.select(*audit.columns, (F.col("_base") + F.col("_at")).alias("place"), "n")


def version_restore(versions: DataFrame, wanted: DataFrame, key: str) -> DataFrame:
    """A new version of each document of ``wanted`` (key, version): that version's content under the next number. Versions that are not there restore nothing."""
    last = versions.groupBy(key).agg(F.max("version").alias("_last"))
    return versions.join(wanted.select(key, "version"), [key, "version"]).join(last, key).withColumn("version", F.col("_last") + 1).drop("_last")


def version_append(docs: DataFrame, edits: DataFrame, key: str, order: Sequence[str]) -> DataFrame:
    """A version row for each edit, numbered on from the document's own version."""
    at = F.row_number().over(Window.partitionBy(key).orderBy(*order))
    return edits.join(docs.select(key, F.col("version").alias("_base")), key).withColumn("version", F.col("_base") + at).drop("_base")
