"""Data-quality checks: each is a row of ``check_name, status, detail``."""

from __future__ import annotations

from collections.abc import Sequence
from functools import reduce

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from .joins import orphans, temporal_violations


def _row(df: DataFrame, name: str, bad: Column, detail: Column) -> DataFrame:
    """``df`` is one row of measures."""
    return df.select(F.lit(name).alias("check_name"), F.when(bad, "FAIL").otherwise("PASS").alias("status"), detail.cast("string").alias("detail"))


def row_count_between(df: DataFrame, name: str, low: int, high: int) -> DataFrame:
    n = F.col("n")
    return _row(df.agg(F.count("*").alias("n")), name, ~n.between(low, high), n)


def not_null(df: DataFrame, name: str, columns: Sequence[str]) -> DataFrame:
    missing = reduce(lambda a, b: a + b, [F.count_if(F.col(c).isNull()) for c in columns])
    return _row(df.agg(missing.alias("n")), name, F.col("n") > 0, F.col("n"))


def unique(df: DataFrame, name: str, column: str) -> DataFrame:
    return _row(df.agg((F.count(column) - F.count_distinct(column)).alias("n")), name, F.col("n") > 0, F.col("n"))


def _count(df: DataFrame, name: str) -> DataFrame:
    return _row(df.agg(F.count("*").alias("n")), name, F.col("n") > 0, F.col("n"))


def foreign_key(child: DataFrame, parent: DataFrame, name: str, child_key: str, parent_key: str) -> DataFrame:
    return _count(orphans(child, parent, child_key, parent_key), name)


def temporal(events: DataFrame, entities: DataFrame, name: str, key: str, at: str, created: str) -> DataFrame:
    return _count(temporal_violations(events, entities, key, at, created), name)


def enum(df: DataFrame, name: str, column: str, allowed: Sequence[str]) -> DataFrame:
    bad = df.where(~F.col(column).isin(list(allowed))).select(column).distinct()
    found = bad.agg(F.array_join(F.array_sort(F.collect_set(column)), ",").alias("v"))
    return _row(found, name, F.col("v") != "", F.col("v"))


def business_rule(df: DataFrame, name: str, holds: Column) -> DataFrame:
    return _count(df.where(~F.coalesce(holds, F.lit(False))), name)


def run_suite(checks: Sequence[DataFrame]) -> DataFrame:
    return reduce(DataFrame.unionByName, checks)


def suite_totals(results: DataFrame) -> DataFrame:
    return results.agg(F.count_if(F.col("status") == "PASS").alias("passed"), F.count_if(F.col("status") == "FAIL").alias("failed"))
