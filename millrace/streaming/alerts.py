"""Alerts that fire once a condition has held for a time, continuously and in batch."""

from __future__ import annotations

from collections.abc import Iterator, Sequence
from contextlib import contextmanager

from pyspark.sql import Column, DataFrame, Row, SparkSession, Window
from pyspark.sql import functions as F
from pyspark.sql.streaming import StatefulProcessor, StatefulProcessorHandle

_PROVIDER = "spark.sql.streaming.stateStore.providerClass"
_ROCKSDB = "org.apache.spark.sql.execution.streaming.state.RocksDBStateStoreProvider"


@contextmanager
def state_in_rocksdb(spark: SparkSession) -> Iterator[None]:
    """Streams that are started inside keep their state in RocksDB, which state with timers needs; the session's setting is put back."""
    before = spark.conf.get(_PROVIDER, None)
    spark.conf.set(_PROVIDER, _ROCKSDB)
    try:
        yield
    finally:
        if before is None:
            spark.conf.unset(_PROVIDER)
        else:
            spark.conf.set(_PROVIDER, before)


def condition_windows(events: DataFrame, by: Sequence[str], seconds: int, bad: Column, threshold: float, floor: int, ts: str = "ts", late: str = "10 minutes") -> DataFrame:
    """``by, at, us, is_on`` of each window with events: whether over ``threshold`` of at least ``floor`` events are bad. ``us`` is the window's end.

    On a stream a window comes once, when the watermark has passed its end.
    """
    rows = events.withWatermark(ts, late) if events.isStreaming else events
    out = rows.groupBy(F.window(ts, f"{seconds} seconds").alias("w"), *by).agg(F.count_if(bad).alias("_bad"), F.count("*").alias("_all"))
    on = (F.col("_all") >= floor) & (F.col("_bad") / F.col("_all") > threshold)
    return out.select(*by, F.window_time("w").alias("at"), F.unix_micros("w.end").alias("us"), on.alias("is_on"))


class HeldCondition(StatefulProcessor):
    """Of one key: since when the condition is on, the last window in which it was, and whether it fires. Nothing is kept while it is off.

    A run of windows ends with one in which the condition is off, or with a
    window that never came: a timer waits for the watermark to pass the end of
    the next one.
    """

    def __init__(self, by: Sequence[str], step: int, hold: int):
        self.row, self.step, self.hold = Row(*by, "state", "since", "us"), step, hold

    def init(self, handle: StatefulProcessorHandle) -> None:
        self.handle = handle
        self.state = handle.getValueState("run", "since long, last long, firing boolean")

    def _timer(self, last: int) -> int:
        return -(-(last + self.step) // 1000)

    def _ended(self, key: tuple, since: int, last: int, firing: bool) -> Row:
        return self.row(*key, "resolved" if firing else "inactive", since, last + self.step)

    def handleInputRows(self, key, rows, timerValues) -> Iterator[Row]:  # noqa: N802, N803
        run = self.state.get() if self.state.exists() else None
        if run:
            self.handle.deleteTimer(self._timer(run[1]))
        for us, on in sorted((r.us, r.is_on) for r in rows):
            if run and (not on or us - run[1] > self.step):
                yield self._ended(key, *run)
                run = None
            if on:
                since, firing = (run[0], run[2]) if run else (us, False)
                if not run and self.hold > 0:
                    yield self.row(*key, "pending", since, us)
                if not firing and us - since >= self.hold:
                    firing = True
                    yield self.row(*key, "firing", since, us)
                run = since, us, firing
        if run:
            self.state.update(run)
            self.handle.registerTimer(self._timer(run[1]))
        else:
            self.state.clear()

    def handleExpiredTimer(self, key, timerValues, expiredTimerInfo) -> Iterator[Row]:  # noqa: N802, N803
        if self.state.exists():
            run = self.state.get()
            if self._timer(run[1]) <= expiredTimerInfo.getExpiryTimeInMs():
                self.state.clear()
                yield self._ended(key, *run)

    def close(self) -> None:
        pass


def held_alerts(windows: DataFrame, by: Sequence[str], seconds: int, hold_seconds: int) -> DataFrame:
    """``by, state, since, ts``: the changes of each key's alert, of a stream of ``condition_windows``.

    ``pending`` at the first window of an unbroken run of windows with the
    condition on, ``firing`` once it has held for ``hold_seconds``, and at the
    end of the first window without it ``resolved`` if it fired, else
    ``inactive``. ``since`` is the end of the run's first window. The stream is
    to be started in ``state_in_rocksdb``.
    """
    step, hold = seconds * 1_000_000, hold_seconds * 1_000_000
    kinds = ", ".join(f"`{c}` {windows.schema[c].dataType.simpleString()}" for c in by)
    out = windows.groupBy(*by).transformWithState(
        statefulProcessor=HeldCondition(by, step, hold), outputStructType=f"{kinds}, state string, since long, us long", outputMode="Append", timeMode="EventTime"
    )
    return out.select(*by, "state", F.timestamp_micros("since").alias("since"), F.timestamp_micros("us").alias("ts"))


def held_alerts_batch(windows: DataFrame, by: Sequence[str], seconds: int, hold_seconds: int) -> DataFrame:
    """The same changes of a whole table: runs are windows one step apart, numbered by key."""
    step, hold = seconds * 1_000_000, hold_seconds * 1_000_000
    n = F.row_number().over(Window.partitionBy(*by).orderBy("us"))
    runs = windows.where("is_on").withColumn("_run", F.col("us") - n * step).groupBy(*by, "_run").agg(F.min("us").alias("since"), F.max("us").alias("last"))
    fires = F.col("last") - F.col("since") >= hold
    change = lambda state, us: F.struct(F.lit(state).alias("state"), us.cast("long").alias("us"))
    changes = F.array(
        F.when(F.lit(hold > 0), change("pending", F.col("since"))), F.when(fires, change("firing", F.col("since") + -(-hold // step) * step)),
        F.when(fires, change("resolved", F.col("last") + step)).otherwise(change("inactive", F.col("last") + step)),
    )
    each = runs.select(*by, "since", F.explode(F.array_compact(changes)).alias("c"))
    return each.select(*by, "c.state", F.timestamp_micros("since").alias("since"), F.timestamp_micros("c.us").alias("ts"))
