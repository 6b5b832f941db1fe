"""Rates, quantiles, ratios and alerts over labelled time series."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F


def increase(samples: DataFrame, series: Sequence[str], window: str, ts: str = "ts", value: str = "value") -> DataFrame:
    """``start, increase`` of a counter for each series and window; a fall is a reset to zero.

    An increase counts in the window of the later sample; range ends are not extrapolated.
    """
    before = F.lag(value).over(Window.partitionBy(*series).orderBy(ts))
    step = F.when(before.isNull(), 0).when(F.col(value) < before, F.col(value)).otherwise(F.col(value) - before)
    steps = samples.withColumn("_step", step)
    return steps.groupBy(*series, F.window(ts, window).alias("w")).agg(F.sum("_step").alias("increase")).select(*series, F.col("w.start").alias("start"), "increase")


def rate(samples: DataFrame, series: Sequence[str], window: str, seconds: int, ts: str = "ts", value: str = "value") -> DataFrame:
    return increase(samples, series, window, ts, value).withColumn("rate", F.col("increase") / seconds)


def error_ratio(samples: DataFrame, by: Sequence[str], bad: Column, weight: str) -> DataFrame:
    """The bad share of a weight; null where there is none at all."""
    total = F.sum(weight)
    return samples.groupBy(*by).agg((F.sum(F.when(bad, F.col(weight)).otherwise(0)) / F.nullif(total, F.lit(0))).alias("ratio"))


def histogram_quantile(q: float, buckets: DataFrame, series: Sequence[str], le: str = "le", count: str = "n") -> DataFrame:
    """Linear interpolation in cumulative buckets; in the last, unbounded one the bound before it."""
    w = Window.partitionBy(*series).orderBy(le)
    total = F.max(count).over(Window.partitionBy(*series))
    low, under = F.coalesce(F.lag(le).over(w), F.lit(0.0)), F.coalesce(F.lag(count).over(w), F.lit(0))
    rows = buckets.withColumns({"_t": total * q, "_low": low, "_under": under}).where((F.col(count) >= F.col("_t")) & (F.col("_under") < F.col("_t")))
    at = F.row_number().over(w)
    inside = F.col("_low") + (F.col(le) - F.col("_low")) * (F.col("_t") - F.col("_under")) / (F.col(count) - F.col("_under"))
    return rows.withColumn("_n", at).where("_n = 1").select(*series, F.when(F.col(le) == float("inf"), F.col("_low")).otherwise(inside).alias("quantile"))


def gauge_ratio(a: DataFrame, b: DataFrame, labels: Sequence[str], threshold: float, value: str = "value") -> DataFrame:
    joined = a.select(*labels, F.col(value).alias("_a")).join(b.select(*labels, F.col(value).alias("_b")), list(labels))
    ratio = F.col("_a") / F.nullif(F.col("_b"), F.lit(0))
    return joined.select(*labels, ratio.alias("ratio"), F.coalesce(ratio > threshold, F.lit(False)).alias("over"))


def availability(up: DataFrame, series: str, window: str, ts: str = "ts", value: str = "up") -> DataFrame:
    return up.groupBy(series, F.window(ts, window).alias("w")).agg(F.avg(value).alias("availability")).select(series, F.col("w.start").alias("start"), "availability")


def up_down(up: DataFrame, series: str, ts: str = "ts", value: str = "up") -> DataFrame:
    last = up.groupBy(series).agg(F.max_by(value, ts).alias("v"))
    return last.agg(F.count_if(F.col("v") > 0).alias("n_up"), F.count_if(F.col("v") <= 0).alias("n_down"))


def changes(samples: DataFrame, series: str, window: str, ts: str = "ts", value: str = "value") -> DataFrame:
    before = F.lag(value).over(Window.partitionBy(series).orderBy(ts))
    rows = samples.withColumn("_c", F.coalesce((F.col(value) != before).cast("int"), F.lit(0)))
    return rows.groupBy(series, F.window(ts, window).alias("w")).agg(F.sum("_c").alias("changes")).select(series, F.col("w.start").alias("start"), "changes")


def alert_for(signal: DataFrame, series: Sequence[str], condition: Column, hold_seconds: int, ts: str = "ts") -> DataFrame:
    """``since, until, firing`` of each unbroken run of the condition; it fires if it has held for the time."""
    w = Window.partitionBy(*series).orderBy(ts)
    on = F.coalesce(condition, F.lit(False))
    rows = signal.withColumn("_on", on).withColumn("_island", F.sum(F.when(F.col("_on"), 0).otherwise(1)).over(w))
    runs = rows.where("_on").groupBy(*series, "_island").agg(F.min(ts).alias("since"), F.max(ts).alias("until"))
    held = F.unix_seconds(F.col("until").cast("timestamp")) - F.unix_seconds(F.col("since").cast("timestamp"))
    return runs.withColumn("firing", held >= hold_seconds).drop("_island")


def avg_per_request(sums: DataFrame, by: Sequence[str], total: str, count: str) -> DataFrame:
    return sums.groupBy(*by).agg((F.sum(total) / F.nullif(F.sum(count), F.lit(0))).alias("mean"))


def latency_summary(requests: DataFrame, by: Sequence[str], value: str, error: Column) -> DataFrame:
    """Count, the sorted values at floor(n / 2) and min(n - 1, floor(0.95 n)), and the share of errors.

    Rows are counted by value before the shuffle, so a busy group brings as many
    rows as it has distinct values, not requests.
    """
    per = requests.groupBy(*by, value).agg(F.count("*").alias("_c"), F.count_if(error).alias("_e"))
    w = Window.partitionBy(*by)
    rows = per.withColumns({"_upto": F.sum("_c").over(w.orderBy(value)), "_n": F.sum("_c").over(w)})
    at = lambda k: F.min_by(F.col(value), F.when(F.col("_upto") > k, F.col("_upto")))
    return rows.groupBy(*by).agg(
        F.sum("_c").alias("n"), at(F.floor(F.col("_n") / 2)).alias("p50"), at(F.least(F.col("_n") - 1, F.floor(F.col("_n") * 95 / 100))).alias("p95"),
        (F.sum("_e") / F.sum("_c")).alias("error_share"),
    )


def in_share(trace: str, percent: int, bucket: Column | None = None) -> Column:
    """Whether a trace is of the fixed share; ``bucket`` gives its number from 0 to 99, by default from a hash of its name."""
    return (F.pmod(F.xxhash64(trace), F.lit(100)) if bucket is None else bucket) < percent


def sample_traces(spans: DataFrame, trace: str, start: str, end: str, error: Column, slow_ms: int = 2000, percent: int = 10, bucket: Column | None = None) -> DataFrame:
    """All spans of traces with an error, of slow traces and of a fixed share, by hash, of the rest."""
    length = (F.unix_micros(F.max(F.col(end).cast("timestamp"))) - F.unix_micros(F.min(F.col(start).cast("timestamp")))) / 1000
    t = spans.groupBy(trace).agg(F.bool_or(F.coalesce(error, F.lit(False))).alias("_bad"), length.alias("_ms"))
    keep = t.where(F.col("_bad") | (F.col("_ms") > slow_ms) | in_share(trace, percent, bucket))
    return spans.join(keep.select(trace), trace, "left_semi")
