"""Comparing large tables by digests: rows move only where the sides differ."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ..scratch import staged
from .joins import compare_sides

#: Buckets of keys of each level; each number is a multiple of the one before. The last is the bound of what is broadcast.
LEVELS = (1024, 1 << 20)


def _bucket(key: str, n: int) -> Column:
    return F.pmod(F.xxhash64(F.col(key).cast("string")), F.lit(n))


def key_digests(df: DataFrame, key: str, columns: Sequence[str], buckets: int) -> DataFrame:
    """``bucket, n, one, two``: the rows of each bucket of keys, and the sums of two hashes of them, in any order."""
    text = [F.coalesce(F.col(c).cast("string"), F.lit("\0")) for c in (key, *columns)]
    total = lambda h: F.sum(h.cast("decimal(38,0)"))
    return df.groupBy(_bucket(key, buckets).alias("bucket")).agg(F.count("*").alias("n"), total(F.xxhash64(*text)).alias("one"), total(F.xxhash64(F.lit(1), *text)).alias("two"))


def differing_buckets(a: DataFrame, b: DataFrame, key: str, columns: Sequence[str], levels: Sequence[int] = LEVELS) -> DataFrame | None:
    """The finest buckets whose digests differ, written; None if the tables are equal.

    Each level is added up before the shuffle, so a task sends a row for each
    bucket at most; the next, finer level reads the buckets that differ alone.
    """
    found, before = None, 0
    for n in levels:
        if found is not None:
            own = F.broadcast(found.withColumnRenamed("bucket", "_b"))  # as many numbers as the level has buckets
            a, b = (x.join(own, _bucket(key, before) == F.col("_b"), "left_semi") for x in (a, b))
        one, two = (key_digests(x, key, columns, n).alias(s) for x, s in ((a, "a"), (b, "b")))
        joined = one.join(two, F.col("a.bucket") == F.col("b.bucket"), "full_outer")
        same = F.col("a.n").eqNullSafe(F.col("b.n")) & F.col("a.one").eqNullSafe(F.col("b.one")) & F.col("a.two").eqNullSafe(F.col("b.two"))
        found, before = staged(joined.where(~same).select(F.coalesce("a.bucket", "b.bucket").alias("bucket"))), n
        if found.isEmpty():
            return None
    return found


def compare_by_digests(a: DataFrame, b: DataFrame, key: str, columns: Sequence[str], levels: Sequence[int] = LEVELS) -> DataFrame:
    """``key, status, field`` as of ``compare_sides`` for the rows that do not agree.

    Two equal tables are read once and move their digests alone. Else the rows
    of differing buckets are compared one by one. Rows with a null key agree
    with nothing, as in ``compare_sides``, but are seen only if their bucket differs.
    """
    found = differing_buckets(a, b, key, columns, levels)
    if found is None:
        a, b = a.limit(0), b.limit(0)
    else:
        own = F.broadcast(found.withColumnRenamed("bucket", "_b"))
        a, b = (x.join(own, _bucket(key, levels[-1]) == F.col("_b"), "left_semi") for x in (a, b))
    return compare_sides(a, b, key, columns).where("status <> 'AGREE'")
