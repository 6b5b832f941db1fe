"""Rates of counters over sliding windows at regular steps, as range vectors give them.

A window of each step is not a set of samples but two edges in running sums:
the last sample at its end and the first after its start. Samples are never
copied into the windows that they lie in. Long series are cut into blocks of
time whose sums are carried over, so no task sorts a whole series.
"""

from __future__ import annotations

from collections.abc import Callable, Sequence

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

_SECOND = 1_000_000


def running_counter(samples: DataFrame, series: Sequence[str], ts: str = "ts", value: str = "value", block_seconds: int = 86_400, needed: Callable[[Column, Column], Column] | None = None) -> DataFrame:
    """``series, us, value, n, total, next_us, next_value, next_total``: each sample's number in its series, the counter's value without its resets, and the next sample.

    A fall is a reset to zero. Samples of one time are taken by value. Null
    times and values are no samples. Of the samples inside a block those are
    left out, once they are counted, that are not ``needed`` by their time and
    the next one's.
    """
    us = F.unix_micros(F.col(ts).cast("timestamp"))
    rows = samples.where(F.col(ts).isNotNull() & F.col(value).isNotNull()).select(*series, us.alias("us"), F.col(value).cast("double").alias("value"))
    rows = rows.withColumn("_block", F.floor(F.col("us") / (block_seconds * _SECOND)))
    w = Window.partitionBy(*series, "_block").orderBy("us", "value")
    fell = F.lag("value").over(w)
    rows = rows.withColumn("_fell", F.when(F.col("value") < fell, fell).otherwise(0.0))
    rows = rows.withColumns({"_n": F.row_number().over(w), "_drops": F.sum("_fell").over(w), "_next_us": F.lead("us").over(w), "_next": F.lead("value").over(w)})
    # One row for each block, from the same partitions.
    blocks = rows.groupBy(*series, "_block").agg(
        F.count("*").alias("_count"), F.max("_drops").alias("_sum"),
        F.min_by(F.struct("us", "value"), "_n").alias("_first"), F.max_by("value", "_n").alias("_last"),
    )
    order = Window.partitionBy(*series).orderBy("_block")
    before = F.lag("_last").over(order)
    blocks = blocks.withColumn("_edge", F.when(F.col("_first.value") < before, before).otherwise(0.0))
    past = order.rowsBetween(Window.unboundedPreceding, -1)
    blocks = blocks.select(
        *series, "_block", F.coalesce(F.sum("_count").over(past), F.lit(0)).alias("_n0"),
        (F.coalesce(F.sum(F.col("_sum") + F.col("_edge")).over(past), F.lit(0.0)) + F.col("_edge")).alias("_drops0"), F.lead("_first").over(order).alias("_after"),
    )
    if needed is not None:
        rows = rows.where((F.col("_n") == 1) | F.col("_next_us").isNull() | needed(F.col("us"), F.col("_next_us")))
    same = [F.col(f"a.{c}").eqNullSafe(F.col(f"b.{c}")) for c in (*series, "_block")]
    joined = rows.alias("a").join(blocks.alias("b"), on=_all(same))
    total = F.col("value") + F.col("_drops") + F.col("_drops0")
    next_value = F.coalesce("_next", "_after.value")
    return joined.select(
        *[F.col(f"a.{c}").alias(c) for c in series], "us", "value", (F.col("_n") + F.col("_n0")).alias("n"), total.alias("total"),
        F.coalesce("_next_us", "_after.us").alias("next_us"), next_value.alias("next_value"),
        (next_value + F.col("_drops") + F.col("_drops0") + F.when(next_value < F.col("value"), F.col("value")).otherwise(0.0)).alias("next_total"),
    )


def _all(conditions: Sequence[Column]) -> Column:
    out = conditions[0]
    for c in conditions[1:]:
        out = out & c
    return out


def _steps(low: Column, high: Column, step: int) -> Column:
    """The multiples of ``step`` from ``low`` up to but without ``high``."""
    first, last = F.ceil(low / step) * step, F.ceil(high / step) * step - step
    return F.when(first <= last, F.sequence(first, last, F.lit(step).cast("long"))).otherwise(F.array().cast("array<long>"))


def _any_step(low: Column, high: Column, step: int) -> Column:
    """Whether ``_steps`` has any."""
    return F.ceil(low / step) < F.ceil(high / step)


def window_edges(samples: DataFrame, series: Sequence[str], range_seconds: int, step_seconds: int, ts: str = "ts", value: str = "value", block_seconds: int = 86_400) -> DataFrame:
    """Of each series and step ``us`` with two samples or more in the ``range_seconds`` up to it: their number ``n``, first and last times and values, and the increase between.

    A sample is the last one of the windows that end between it and the next,
    and the next is the first one of the windows that begin there, so it makes
    a row for each step in between and none for the windows it merely lies in.
    """
    span, step = range_seconds * _SECOND, step_seconds * _SECOND
    # Only samples at the edges of windows are carried on; of a dense series these are a few for each step.
    at_edge = lambda us, after: _any_step(us, F.least(after, us + span), step) | _any_step(F.greatest(us + span, after), after + span, step)
    rows = running_counter(samples, series, ts, value, block_seconds, at_edge)
    own = F.col("us")
    ends = _steps(own, F.least(F.coalesce("next_us", own + span), own + span), step)
    starts = F.when(F.col("next_us").isNotNull(), _steps(F.greatest(own + span, F.col("next_us")), F.col("next_us") + span, step)).otherwise(F.array().cast("array<long>"))
    # Windows that begin before the series have its first sample as their first.
    opens = F.when(F.col("n") == 1, _steps(own, own + span, step)).otherwise(F.array().cast("array<long>"))
    end = F.struct(F.col("n").alias("n"), F.col("us").alias("us"), F.col("total").alias("total"), F.col("value").alias("value"))
    start = F.struct((F.col("n") + 1).alias("n"), F.col("next_us").alias("us"), F.col("next_total").alias("total"), F.col("next_value").alias("value"))
    none = F.lit(None).cast("struct<n:bigint,us:bigint,total:double,value:double>")

    def each(at: Column, first: Column, last: Column) -> Column:
        return F.transform(at, lambda t: F.struct(t.alias("t"), first.cast("struct<n:bigint,us:bigint,total:double,value:double>").alias("first"), last.cast("struct<n:bigint,us:bigint,total:double,value:double>").alias("last")))

    edges = rows.select(*series, F.explode(F.concat(each(ends, none, end), each(starts, start, none), each(opens, end, none))).alias("e"))
    met = edges.groupBy(*series, F.col("e.t").alias("us")).agg(F.max("e.first").alias("f"), F.max("e.last").alias("l"))
    return met.where(F.col("l.n") > F.col("f.n")).select(
        *series, "us", (F.col("l.n") - F.col("f.n") + 1).alias("n"), F.col("f.us").alias("first_us"), F.col("l.us").alias("last_us"),
        F.col("f.value").alias("first_value"), (F.col("l.total") - F.col("f.total")).alias("increase"),
    )


def range_rate(samples: DataFrame, series: Sequence[str], range_seconds: int = 300, step_seconds: int = 15, ts: str = "ts", value: str = "value", block_seconds: int = 86_400) -> DataFrame:
    """``series, ts, rate``: the increase a second over the last ``range_seconds``, at each multiple of ``step_seconds``.

    The increase between the first and the last sample is carried on to the
    window's ends, each at most by half the mean distance of samples where the
    end lies further than 1.1 times that, and not back beyond where the
    counter was zero. A step with fewer than two samples has no row.
    """
    rows = window_edges(samples, series, range_seconds, step_seconds, ts, value, block_seconds)
    sampled = (F.col("last_us") - F.col("first_us")) / _SECOND
    mean = sampled / (F.col("n") - 1)
    to_start = (F.col("first_us") - (F.col("us") - range_seconds * _SECOND)) / _SECOND
    to_end = (F.col("us") - F.col("last_us")) / _SECOND
    to_start = F.when(to_start >= mean * 1.1, mean / 2).otherwise(to_start)
    to_zero = sampled * F.col("first_value") / F.col("increase")
    to_start = F.when((F.col("increase") > 0) & (F.col("first_value") >= 0) & (to_zero < to_start), to_zero).otherwise(to_start)
    to_end = F.when(to_end >= mean * 1.1, mean / 2).otherwise(to_end)
    # Whether a bucket reaches a quantile's rank may hang on the last digit, so the order of these steps is fixed.
    rate = F.col("increase") * (sampled + to_start + to_end) / sampled / range_seconds
    return rows.where("last_us > first_us").select(*series, F.timestamp_micros("us").alias("ts"), rate.alias("rate"))


def summed_rate(rates: DataFrame, by: Sequence[str]) -> DataFrame:
    """``sum by (...)`` of ``range_rate``'s rows at each step."""
    return rates.groupBy(*by, "ts").agg(F.sum("rate").alias("rate"))


def rate_ratio(rates: DataFrame, by: Sequence[str], part: Column) -> DataFrame:
    """A part's share of the summed rate at each step; null where the whole is zero, no row where no series is a part."""
    out = rates.groupBy(*by, "ts").agg(F.sum(F.when(part, F.col("rate"))).alias("_part"), F.sum("rate").alias("_all"))
    return out.where("_part IS NOT NULL").select(*by, "ts", (F.col("_part") / F.nullif(F.col("_all"), F.lit(0.0))).alias("ratio"))
