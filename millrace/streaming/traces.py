"""Sampling of whole traces on streams of spans."""

from __future__ import annotations

import pickle
from collections.abc import Iterator

from pyspark.sql import Column, DataFrame, Row
from pyspark.sql import functions as F
from pyspark.sql.streaming import StatefulProcessor, StatefulProcessorHandle

from ..operators.metrics import in_share

#: Spans of one trace that may wait; with more it is kept at once.
WAITING = 10_000
#: Traces are dealt over so many buckets by a hash; a bucket should have a few thousand open traces at most.
BUCKETS = 4096


class TailSampler(StatefulProcessor):
    """Spans of a trace wait until the watermark is ``wait`` past the last of them, then all go out or none.

    A trace that is known to be kept does not wait: with its first error, or
    once its spans are too far apart or too many, those that wait go out and
    later ones follow at once. A span that comes after the decision of a trace
    that was left out starts it anew.

    The key is a bucket of traces. Each access to state is a message between
    the worker and the JVM, and each row in it is converted by itself, so a
    bucket's traces are read and written together, its spans in one piece for
    each batch, and they have one timer, that of the first which is due.
    """

    def __init__(self, columns: list[str], trace: str, wait_us: int, slow_us: int, most: int):
        self.row, self.columns, self.at = Row(*columns), columns, columns.index(trace)
        self.wait, self.slow, self.most = wait_us, slow_us, most

    def init(self, handle: StatefulProcessorHandle) -> None:
        self.handle = handle
        self.waiting = handle.getListState("waiting", "spans binary")
        self.traces = handle.getValueState("traces", "of binary")  # name: first, last, number of spans, whether kept
        self.due = handle.getValueState("due", "ms long")

    def _timer(self, last: int) -> int:
        return -(-(last + self.wait) // 1000)

    def _open(self) -> dict:
        return pickle.loads(self.traces.get()[0]) if self.traces.exists() else {}

    def _waiting(self) -> Iterator[tuple]:
        for (piece,) in self.waiting.get():
            yield from pickle.loads(piece)

    def _write(self, open_: dict, fired: int | None = None) -> None:
        """Write the bucket's traces and set its timer, unless that is as it was; ``fired`` is one that has just gone off."""
        before = fired if fired is not None else self.due.get()[0] if self.due.exists() else None
        next_ = self._timer(min(of[1] for of in open_.values())) if open_ else None
        if open_:
            self.traces.update((pickle.dumps(open_),))
        else:
            self.traces.clear()
        if next_ == before and fired is None:
            return
        if before is not None and fired is None:
            self.handle.deleteTimer(before)
        if next_ is None:
            self.due.clear()
        else:
            self.due.update((next_,))
            self.handle.registerTimer(next_)

    def handleInputRows(self, key, rows, timerValues) -> Iterator[Row]:  # noqa: N802, N803
        open_ = self._open()
        new, released = {}, set()
        for r in rows:
            name, start, end = r[self.columns[self.at]], r["_from"], r["_to"]
            of = open_.get(name)
            if of is None:
                of = open_[name] = [start, end, 0, False]
            of[0], of[1], of[2] = min(of[0], start), max(of[1], end), of[2] + 1
            if not of[3] and (r["_bad"] or of[1] - of[0] > self.slow or of[2] > self.most):
                of[3] = True
                mine = new.pop(name, ())
                if of[2] - 1 > len(mine):  # others wait since earlier batches
                    released.add(name)
                yield from (self.row(*x) for x in mine)
            span = tuple(r[c] for c in self.columns)
            if of[3]:
                yield self.row(*span)
            else:
                new.setdefault(name, []).append(span)
        if released:
            rest = []
            for span in self._waiting():
                if span[self.at] in released:
                    yield self.row(*span)
                else:
                    rest.append(span)
            self._wait_for(rest)
        if new:
            self.waiting.appendValue((pickle.dumps([span for spans in new.values() for span in spans]),))
        self._write(open_)

    def _wait_for(self, spans: list[tuple]) -> None:
        if spans:
            self.waiting.put([(pickle.dumps(spans),)])
        else:
            self.waiting.clear()

    def handleExpiredTimer(self, key, timerValues, expiredTimerInfo) -> Iterator[Row]:  # noqa: N802, N803
        now, at = timerValues.getCurrentWatermarkInMs(), expiredTimerInfo.getExpiryTimeInMs()
        open_ = {name: of for name, of in self._open().items() if not ((due := self._timer(of[1])) < now or due <= at)}
        if self.waiting.exists():
            self._wait_for([span for span in self._waiting() if span[self.at] in open_] if open_ else [])
        self._write(open_, at)
        return iter(())

    def close(self) -> None:
        pass


def sample_trace_stream(
    spans: DataFrame, trace: str, start: str, end: str, error: Column, wait_seconds: int = 10, slow_ms: int = 2000, percent: int = 10,
    late: str = "10 seconds", bucket: Column | None = None, most: int = WAITING, buckets: int = BUCKETS,
) -> DataFrame:
    """All spans of traces with an error, of slow traces and of a fixed share, by hash, of the rest; as ``operators.metrics.sample_traces`` for a stream.

    The share is known by the trace's name, so its spans never wait. The same
    spans go out in any order of arrival, if no span of a trace comes after
    the watermark has passed the others by ``wait_seconds``. A trace with more
    than ``most`` spans waiting is kept. State is on disk
    (``alerts.state_in_rocksdb``) and ends with each trace; a worker holds one
    of the ``buckets`` over which traces are dealt at a time. A stream keeps
    the number it began with. ``start`` and ``end`` are TIMESTAMP; a null
    trace has no spans.
    """
    rows = spans.where(F.col(trace).isNotNull())
    lucky = in_share(trace, percent, bucket)
    micros = lambda c: F.unix_micros(F.col(c))
    held = rows.where(~lucky).withWatermark(end, late).withColumns({"_from": micros(start), "_to": micros(end), "_bad": F.coalesce(error, F.lit(False))})
    kinds = ", ".join(f"`{f.name}` {f.dataType.simpleString()}" for f in spans.schema)
    sampler = TailSampler(spans.columns, trace, wait_seconds * 1_000_000, slow_ms * 1000, most)
    kept = held.withColumn("_bucket", F.pmod(F.xxhash64(trace), F.lit(buckets))).groupBy("_bucket").transformWithState(
        statefulProcessor=sampler, outputStructType=kinds, outputMode="Append", timeMode="EventTime"
    )
    return rows.where(lucky).unionByName(kept)
