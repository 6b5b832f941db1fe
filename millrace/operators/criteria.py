"""Acceptance criteria, read from JSON and compiled into one aggregation for each table.

Criteria of a table: ``min_rows`` and ``max_rows``, ``required_columns`` (no
nulls), ``unique_columns`` (each for itself; nulls do not count) and
``enum_constraints`` (allowed values of columns; nulls do not count).
"""

from __future__ import annotations

import json
from collections.abc import Mapping
from functools import reduce

from pyspark.sql import Column, DataFrame, Observation, SparkSession
from pyspark.sql import functions as F

RESULT = "check_name string, status string, detail string"
_KNOWN = {"min_rows", "max_rows", "required_columns", "unique_columns", "enum_constraints"}


def _measures(rules: Mapping) -> tuple[dict[str, Column], dict[str, Column]]:
    """What is aggregated for a table: by name, those without and those with a distinct count."""
    plain, distinct = {}, {}
    if "min_rows" in rules or "max_rows" in rules:
        plain["rows"] = F.count("*")
    if rules.get("required_columns"):
        plain["missing"] = reduce(lambda a, b: a + b, [F.count_if(F.col(c).isNull()) for c in rules["required_columns"]])
    if rules.get("unique_columns"):
        distinct["repeated"] = reduce(lambda a, b: a + b, [F.count(c) - F.count_distinct(c) for c in rules["unique_columns"]])
    for c, allowed in rules.get("enum_constraints", {}).items():
        other = F.when(~F.col(c).isin(list(allowed)), F.col(c).cast("string"))
        plain[f"values:{c}"] = F.array_join(F.array_sort(F.collect_set(other)), ",")
    return plain, distinct


def _verdicts(table: str, rules: Mapping, measures: list[str]) -> list[Column]:
    """A row of each check from the table's measures, as a struct."""

    def row(name: str, bad: Column, detail: Column) -> Column:
        return F.struct(F.lit(f"{table}: {name}").alias("check_name"), F.when(bad, "FAIL").otherwise("PASS").alias("status"), detail.cast("string").alias("detail"))

    out = []
    if "rows" in measures:
        n = F.col("rows")
        low, high = rules.get("min_rows"), rules.get("max_rows")
        out.append(row("row count", (n < low if low is not None else F.lit(False)) | (n > high if high is not None else F.lit(False)), n))
    if "missing" in measures:
        out.append(row("not null", F.col("missing") > 0, F.col("missing")))
    if "repeated" in measures:
        out.append(row("unique", F.col("repeated") > 0, F.col("repeated")))
    for c in rules.get("enum_constraints", {}):
        if f"values:{c}" in measures:
            out.append(row(f"values of {c}", F.col(f"`values:{c}`") != "", F.col(f"`values:{c}`")))
    return out


def read_criteria(text: str) -> dict[str, dict]:
    """Criteria by table; a rule that is not known is an error, not passed over."""
    found = json.loads(text)
    for table, rules in found.items():
        if odd := set(rules) - _KNOWN:
            raise ValueError(f"criteria of {table} that are not known: {sorted(odd)}")
    return found


def table_criteria(df: DataFrame, table: str, rules: Mapping) -> DataFrame:
    """``check_name, status, detail`` of all criteria of one table, from one scan."""
    plain, distinct = _measures(rules)
    both = plain | distinct
    if not both:
        return df.sparkSession.createDataFrame([], RESULT)
    one = df.agg(*[c.alias(n) for n, c in both.items()])
    return one.select(F.inline(F.array(*_verdicts(table, rules, list(both)))))


def run_criteria(spark: SparkSession, tables: Mapping[str, DataFrame], criteria: str) -> DataFrame:
    """The rows of all tables' criteria. A table that is not there fails."""
    out = []
    for table, rules in read_criteria(criteria).items():
        if table in tables:
            out.append(table_criteria(tables[table], table, rules))
        else:
            out.append(spark.createDataFrame([(f"{table}: exists", "FAIL", "no such table")], RESULT))
    return reduce(DataFrame.unionByName, out) if out else spark.createDataFrame([], RESULT)


class Observed:
    """The criteria of a table that is being written anyway, taken on the way.

    Write ``rows`` instead of the table, then ask for ``results``: no scan is
    made for them. Unique columns cannot be told on the way; ``results`` has
    no row for them, and ``left`` holds their rules for ``table_criteria``.
    """

    def __init__(self, df: DataFrame, table: str, rules: Mapping):
        self.spark, self.table, self.rules = df.sparkSession, table, rules
        plain, distinct = _measures(rules)
        self.names = list(plain)
        self.left = {k: v for k, v in rules.items() if k == "unique_columns"} if distinct else {}
        self.seen = Observation() if plain else None
        self.rows = df.observe(self.seen, *[c.alias(n) for n, c in plain.items()]) if plain else df

    def results(self) -> DataFrame:
        """Waits until ``rows`` has been written or counted."""
        if self.seen is None:
            return self.spark.createDataFrame([], RESULT)
        got = self.seen.get
        one = self.spark.range(1).select(*[F.lit(got[n]).alias(n) for n in self.names])
        return one.select(F.inline(F.array(*_verdicts(self.table, self.rules, self.names))))
