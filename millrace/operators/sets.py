"""Unions, differences, pages and upserts."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F


def union_sources(*frames: DataFrame) -> DataFrame:
    """All rows of frames whose columns differ; missing ones are null."""
    out = frames[0]
    for f in frames[1:]:
        out = out.unionByName(f, allowMissingColumns=True)
    return out


def distinct_values(df: DataFrame, column: str) -> DataFrame:
    return df.select(column).distinct()


def except_keys(a: DataFrame, b: DataFrame, key: str) -> DataFrame:
    return a.select(key).distinct().join(b.select(key).distinct(), key, "left_anti")


def intersect_keys(a: DataFrame, b: DataFrame, key: str) -> DataFrame:
    return a.select(key).distinct().join(b.select(key).distinct(), key, "left_semi")


def numbered_lines(df: DataFrame, keep: Sequence[str], lines: Sequence[tuple[str, Column]]) -> DataFrame:
    """One row for each named line, numbered from 1, in one pass over the input."""
    items = [F.struct(F.lit(k).alias("line_no"), F.lit(n).alias("line_type"), c.alias("amount")) for k, (n, c) in enumerate(lines, 1)]
    return df.select(*keep, F.explode(F.array(*items)).alias("_l")).select(*keep, "_l.*")


def merged_page(parts: Sequence[DataFrame], order: Sequence[Column], page: int, size: int) -> DataFrame:
    """A page of the parts one after the other, each in its own order."""
    out = union_sources(*[p.withColumn("source_rank", F.lit(k)) for k, p in enumerate(parts)])
    return out.orderBy("source_rank", *order).offset((page - 1) * size).limit(size)


def upsert_by_key(existing: DataFrame, incoming: DataFrame, keys: Sequence[str]) -> DataFrame:
    """Incoming rows, and existing rows whose key did not come in."""
    return incoming.select(existing.columns).unionByName(existing.join(incoming.select(*keys).distinct(), list(keys), "left_anti"))


def insert_if_absent(existing: DataFrame, incoming: DataFrame, keys: Sequence[str]) -> DataFrame:
    """Existing rows, and incoming rows whose key is new: of several with one key the least."""
    rest = [c for c in existing.columns if c not in keys]
    new = incoming.join(existing.select(*keys), list(keys), "left_anti")
    if rest:
        new = new.groupBy(*keys).agg(F.min(F.struct(*rest)).alias("_r")).select(*keys, "_r.*")
    else:
        new = new.select(*keys).distinct()
    return existing.unionByName(new.select(existing.columns))


def plan_catalog(plans: DataFrame, fee: str, code: str, active: Column) -> DataFrame:
    return plans.where(active).orderBy(fee, code)
