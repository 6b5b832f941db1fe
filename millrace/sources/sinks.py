"""Sinks: lake partitions, CSV and JSON exports, archives and reports."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F


def write_lake_partition(df: DataFrame, root: str, day: str) -> None:
    """A day's rows as gzip JSON under year, month and day; a rerun overwrites that day alone."""
    y, m, d = day.split("-")
    out = df.withColumns({"year": F.lit(int(y)), "month": F.lit(int(m)), "day": F.lit(int(d))})
    (
        out.write.mode("overwrite").option("partitionOverwriteMode", "dynamic").option("compression", "gzip")
        .partitionBy("year", "month", "day").json(root)
    )


def write_lake_days(df: DataFrame, root: str, day: Column) -> None:
    """Rows of many days in one job, each under its year, month and day; days that the rows hold are overwritten."""
    out = df.withColumns({"year": F.year(day), "month": F.month(day), "day": F.day(day)})
    out.write.mode("overwrite").option("partitionOverwriteMode", "dynamic").option("compression", "gzip").partitionBy("year", "month", "day").json(root)


def csv_lines(df: DataFrame, columns: Sequence[str], quote_all: bool = False) -> DataFrame:
    """``value``: a CSV line of each row; fields are quoted if they must be (or all), inner quotes doubled, nulls empty."""
    def field(c: str) -> Column:
        text = F.coalesce(F.col(c).cast("string"), F.lit(""))
        quoted = F.concat(F.lit('"'), F.replace(text, F.lit('"'), F.lit('""')), F.lit('"'))
        return quoted if quote_all else F.when(text.rlike('[,"\n\r]'), quoted).otherwise(text)

    return df.select(F.concat_ws(",", *[field(c) for c in columns]).alias("value"))


def export_csv(df: DataFrame, path: str, columns: Sequence[str], quote_all: bool = False) -> None:
    """CSV with a header, which an empty frame has, too."""
    df.select(*columns).write.mode("overwrite").csv(path, header=True, quoteAll=quote_all, escape='"', emptyValue="", nullValue="")


def export_json(df: DataFrame, path: str, period: str, generated_at: str) -> None:
    """Rows as JSON lines beside a header of format, period, time and number of rows."""
    df.write.mode("overwrite").json(f"{path}/rows")
    written = df.sparkSession.read.schema(df.schema).json(f"{path}/rows")
    head = written.agg(F.lit("json").alias("format"), F.lit(period).alias("period"), F.lit(generated_at).alias("generated_at"), F.count("*").alias("record_count"))
    head.coalesce(1).write.mode("overwrite").json(f"{path}/header")


def archive_jsonl(df: DataFrame, root: str, ts: str) -> None:
    """Rows by year and week of their time, as gzip JSON; appended."""
    out = df.withColumns({"year": F.year(ts), "week": F.weekofyear(ts)})
    out.write.mode("append").option("compression", "gzip").partitionBy("year", "week").json(root)


def publish_latest(df: DataFrame, root: str, day: str) -> None:
    """A dated report, and the same rows as the latest one."""
    df.write.mode("overwrite").json(f"{root}/{day}")
    df.sparkSession.read.schema(df.schema).json(f"{root}/{day}").write.mode("overwrite").json(f"{root}/latest")


def write_report_rows(df: DataFrame, path: str, name: str, period: str) -> None:
    """A CSV body with nulls as empty text, and its name, period and number of rows beside it."""
    export_csv(df, f"{path}/body", df.columns)
    df.agg(F.lit(name).alias("name"), F.lit(period).alias("period"), F.count("*").alias("row_count")).coalesce(1).write.mode("overwrite").json(f"{path}/meta")


def decimal_text(value: Column) -> Column:
    """A sum as text with eight decimals."""
    return value.cast("decimal(38,8)").cast("string")


def reconciliation_report(ledger: DataFrame, rejects: DataFrame, totals: DataFrame, path: str) -> None:
    ledger.orderBy("table_name").coalesce(1).write.mode("overwrite").json(f"{path}/ledger")
    rejects.orderBy("table_name", "key").write.mode("overwrite").csv(f"{path}/rejects", header=True)
    sums = [decimal_text(F.col(c)).alias(c) if c.startswith("sum_") else F.col(c) for c in totals.columns]
    totals.select(*sums).write.mode("overwrite").csv(f"{path}/class_totals", header=True)
