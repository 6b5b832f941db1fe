"""Terms that overlap, cut into segments that do not."""

from __future__ import annotations

from collections.abc import Iterator, Sequence

import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

_EVER = (1 << 62) - 1


class _Sweep:
    """One ordered pass over a key's terms. Of the open ones the one that began last counts, so it lies on top of a stack."""

    def __init__(self):
        self.open: list[tuple[int, tuple]] = []  # ends fall towards the top
        self.at = -_EVER

    def _until(self, start: int, out: list) -> None:
        """Segments of what is open, up to ``start`` (exclusive)."""
        while self.open and self.at < start:
            end, values = self.open[-1]
            if end >= self.at:
                out.append((self.at, values))
            if end >= start:
                self.at = start
                return
            self.at = max(self.at, end + 1)
            self.open.pop()
        if self.at < start and self.at > -_EVER:
            out.append((self.at, None))  # nothing is open from here

    def add(self, start: int, end: int, values: tuple, out: list) -> None:
        self._until(start, out)
        self.at = start
        while self.open and self.open[-1][0] <= end:
            self.open.pop()  # ends below the new one, so it never shows again
        self.open.append((end, values))

    def finish(self, out: list) -> None:
        self._until(_EVER, out)
        self.open, self.at = [], -_EVER


def _number(c: Column, kind: T.DataType) -> Column:
    return F.unix_date(c) if isinstance(kind, T.DateType) else F.unix_micros(c.cast("timestamp"))


def disjoint_terms(terms: DataFrame, keys: Sequence[str], starts: str, ends: str, values: Sequence[str], ties: Sequence[str] = (), kind: T.DataType | None = None) -> DataFrame:
    """``keys, at, values``: the term in force from each time ``at`` on at which it changes; null values where none is.

    Of overlapping terms the one that started last counts, of those the first
    by ``ties``. ``ends`` is inclusive, null is for ever; terms that end before
    they start, or have no start, are never in force. ``kind`` is DATE or a
    timestamp type, by default that of ``starts``; a date that is made a
    timestamp is its midnight. Null keys are a key. A key's terms
    come to one task in order, which holds those that are still open; there
    are at most twice as many segments as terms.
    """
    kind = kind or terms.schema[starts].dataType
    typed = lambda c: F.col(c).cast(kind)
    rows = terms.select(*keys, _number(typed(starts), kind).cast("long").alias("_s"), F.coalesce(_number(typed(ends), kind).cast("long"), F.lit(_EVER)).alias("_e"), *values, *[F.col(t).alias(f"_t{k}") for k, t in enumerate(ties)])
    tied = [F.desc(f"_t{k}") for k in range(len(ties))]
    rows = rows.where("_s IS NOT NULL AND _e >= _s").repartition(*keys).sortWithinPartitions(*keys, "_s", *tied).select(*keys, "_s", "_e", *values)
    n = len(keys)

    def cut(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        key, sweep, schema = None, _Sweep(), None
        none = (None,) * len(values)

        def batch(found: list) -> pa.RecordBatch:
            columns = zip(*((*k, at, *(v or none)) for k, part in found for at, v in part), strict=True)
            return pa.RecordBatch.from_arrays([pa.array(c, f.type) for c, f in zip(columns, schema, strict=True)], [f.name for f in schema])

        for b in batches:
            own = list(b.schema)
            schema = [*own[:n], pa.field("at", pa.int64()), *own[n + 2 :]]
            found: list = []
            for row in zip(*(c.to_pylist() for c in b.columns), strict=True):
                if key is None or row[:n] != key[0]:
                    if key is not None:
                        sweep.finish(part := [])
                        found.append((key[0], part))
                    key = (row[:n],)
                sweep.add(row[n], row[n + 1], row[n + 2 :], part := [])
                found.append((key[0], part))
            if any(p for _, p in found):
                yield batch(found)
        if key is not None:
            sweep.finish(part := [])
            if part:
                yield batch([(key[0], part)])

    fields = [*[rows.schema[k] for k in keys], T.StructField("at", T.LongType()), *[T.StructField(v, rows.schema[v].dataType) for v in values]]
    out = rows.mapInArrow(cut, T.StructType(fields))
    at = F.date_from_unix_date(F.col("at").cast("int")) if isinstance(kind, T.DateType) else F.timestamp_micros("at").cast(kind)
    return out.withColumn("at", at)
