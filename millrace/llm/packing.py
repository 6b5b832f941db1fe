"""Packing documents into sequences by minimum bin slack.

Only the number of pieces of each length, at most as many numbers as a
sequence has tokens, decides how sequences are filled: each is the fullest
combination that the lengths still there can make, found by subset sums in a
bitset. A combination is used as often as its lengths last, so the plan has a
bounded number of combinations at any size of the corpus. Pieces then take
their places in it by their number among the pieces of their length.
"""

from __future__ import annotations

import zlib
from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from .common import bounded_batches, staged
from .pretokens import default_tokenizer, packer
from .token_files import encode_ids

CAPACITY = 2048


class SlackDp:
    """Which totals the lengths still there can make, as bits of an integer, after each length in ascending order.

    A layer stays right until the number of its length, or of a smaller one,
    that a sequence could hold changes.
    """

    def __init__(self, counts: dict[int, int], capacity: int):
        self.capacity, self.lengths = capacity, sorted(counts)
        self.at = {n: k for k, n in enumerate(self.lengths)}
        self.left = dict(counts)
        self.mask = (1 << (capacity + 1)) - 1
        self.layers, self.valid = [1] * (len(self.lengths) + 1), 0

    def most(self, n: int) -> int:
        return min(self.left[n], self.capacity // n)

    def take(self, n: int, number: int) -> None:
        before = self.most(n)
        self.left[n] -= number
        if self.most(n) != before:
            self.valid = min(self.valid, self.at[n])

    def _fill(self, upto: int) -> None:
        for k in range(self.valid, upto):
            n, reach, c, step = self.lengths[k], self.layers[k], self.most(self.lengths[k]), 1
            while c > 0:  # as many as there are, in steps of powers of two
                some = min(step, c)
                reach |= (reach << (some * n)) & self.mask
                c, step = c - some, step * 2
            self.layers[k + 1] = reach
        self.valid = max(self.valid, upto)

    def fullest(self, room: int, upto: int) -> dict[int, int]:
        """Lengths of the first ``upto``, and how many of each, with the greatest total up to ``room``; long ones are preferred."""
        self._fill(upto)
        total = (self.layers[upto] & ((1 << (room + 1)) - 1)).bit_length() - 1
        out = {}
        for k in range(upto, 0, -1):
            if not total:
                break
            n = self.lengths[k - 1]
            c = min(self.most(n), total // n)
            while not self.layers[k - 1] >> (total - c * n) & 1:
                c -= 1
            if c:
                out[n] = c
                total -= c * n
        return out


def slack_plan(counts: dict[int, int], capacity: int = CAPACITY) -> list[tuple[int, dict[int, int]]]:
    """Combinations and how often each is used, for ``counts`` pieces of each length; every piece is in one.

    Each sequence begins with the longest piece left, which has to go somewhere,
    and is filled up by the combination that leaves the least slack.
    """
    if any(not 0 < n <= capacity for n in counts):
        raise ValueError("lengths must be from 1 to the capacity")
    dp = SlackDp({n: c for n, c in counts.items() if c > 0}, capacity)
    plan = []
    for n in reversed(dp.lengths):
        while dp.left[n]:
            dp.take(n, 1)
            one = dp.fullest(capacity - n, dp.at[n] + 1)
            dp.take(n, -1)
            one[n] = one.get(n, 0) + 1
            times = min(dp.left[m] // c for m, c in one.items())
            for m, c in one.items():
                dp.take(m, times * c)
            plan.append((times, one))
    return plan


@dataclass
class Places:
    """The plan by length: for the pieces of a length from number ``first`` on, their first sequence, how many go into each, and where the first lies."""

    first: dict[int, np.ndarray]
    rest: dict[int, np.ndarray]

    @classmethod
    def of(cls, plan: list[tuple[int, dict[int, int]]]) -> Places:
        rows: dict[int, list] = {}
        used: dict[int, int] = {}
        sequence = 0
        for times, one in plan:
            offset = 0
            for n in sorted(one, reverse=True):
                rows.setdefault(n, []).append((used.get(n, 0), sequence, one[n], offset))
                used[n] = used.get(n, 0) + times * one[n]
                offset += n * one[n]
            sequence += times
        table = {n: np.array(r, np.int64) for n, r in rows.items()}
        return cls({n: t[:, 0].copy() for n, t in table.items()}, table)

    def __call__(self, length: np.ndarray, number: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """Sequence and offset of pieces, from their lengths and their numbers among the pieces of that length."""
        sequence, offset = np.zeros((2, len(length)), np.int64)
        for n in np.unique(length).tolist():
            own = np.flatnonzero(length == n)
            row = self.rest[n][np.searchsorted(self.first[n], number[own], "right") - 1]
            k = number[own] - row[:, 0]
            sequence[own] = row[:, 1] + k // row[:, 2]
            offset[own] = row[:, 3] + k % row[:, 2] * n
        return sequence, offset


PIECE = "piece int, start long, length long, ids_crc32 long"


def _pieces(docs: DataFrame, path: str, end_id: int, capacity: int, id_col: str, text_col: str) -> DataFrame:
    """Written pieces of documents: their own columns, ``ids``, and ``part, number``: the task that wrote a piece and its number among that task's pieces of its length."""
    code, _ = packer(path)
    kind = np.dtype(f"<u{2 if code == 'H' else 4}")
    bounded_batches(docs.sparkSession)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        part, seen = TaskContext.get().partitionId(), np.zeros(capacity + 1, np.int64)
        for b in batches:
            texts = encode_ids(path, b.column(1), end_id)
            size = np.array([len(t) // kind.itemsize for t in texts], np.int64)
            pieces = -(-size // capacity)
            doc = np.repeat(np.arange(len(size)), pieces)
            k = np.arange(len(doc)) - np.repeat(np.cumsum(pieces) - pieces, pieces)
            # The first piece has what is over, all others are full.
            over = size - (pieces - 1) * capacity
            start = np.where(k > 0, over[doc] + (k - 1) * capacity, 0)
            length = np.where(k > 0, capacity, over[doc])
            ids = [texts[d][s * kind.itemsize : (s + n) * kind.itemsize] for d, s, n in zip(doc.tolist(), start.tolist(), length.tolist(), strict=True)]
            crc = [zlib.crc32(np.frombuffer(x, kind).astype("<u4").tobytes()) for x in ids]
            order = np.argsort(length, kind="stable")
            sorted_length = length[order]
            number = np.empty(len(length), np.int64)
            number[order] = np.arange(len(length)) - np.searchsorted(sorted_length, sorted_length) + seen[sorted_length]
            seen += np.bincount(length, minlength=capacity + 1)
            yield pa.RecordBatch.from_arrays(
                [b.column(0).take(pa.array(doc)), pa.array(k, pa.int32()), pa.array(start), pa.array(length), pa.array(crc, pa.int64()), pa.array(ids, pa.binary()), pa.array([part] * len(doc), pa.int32()), pa.array(number)],
                [id_col, "piece", "start", "length", "ids_crc32", "ids", "_part", "_number"],
            )

    rows = docs.where(F.col(id_col).isNotNull()).select(F.col(id_col).cast("long"), text_col)
    return staged(rows.mapInArrow(run, f"`{id_col}` long, {PIECE}, ids binary, _part int, _number long"))


def pack_documents(docs: DataFrame, path: str | None = None, end_id: int = 0, capacity: int = CAPACITY, id_col: str = "doc_id", text_col: str = "text", with_ids: bool = False) -> DataFrame:
    """``id_col, piece, start, length, ids_crc32, sequence_id, offset`` of each piece, and with ``with_ids`` its ``ids``.

    A document is the ids of its whole text, then ``end_id``. Documents over
    ``capacity`` are cut into pieces of that length, of which the first may be
    shorter; others are one piece. The pieces of a sequence lie one after the
    other from offset 0. ``ids`` are little-endian unsigned integers, 2 bytes
    each if the vocabulary allows, else 4.

    Null texts are empty (the end id alone); rows without an id are left out;
    repeated rows are packed as often as they occur; an empty table gives an
    empty result; other columns are ignored. A very long text is encoded whole
    by its task.
    """
    pieces = _pieces(docs, path or default_tokenizer(), end_id, capacity, id_col, text_col)
    per = staged(pieces.groupBy("length", "_part").agg(F.count("*").alias("n")))
    # At most ``capacity`` numbers, whatever the number of pieces.
    counts = {r.length: r.n for r in per.groupBy("length").agg(F.sum("n").alias("n")).collect()}
    places = docs.sparkSession.sparkContext.broadcast(Places.of(slack_plan(counts, capacity)))
    # A length has as many rows here as tasks that wrote pieces; the whole grows with the tasks, so it is not broadcast.
    before = Window.partitionBy("length").orderBy("_part").rowsBetween(Window.unboundedPreceding, -1)
    bases = per.select("length", "_part", F.coalesce(F.sum("n").over(before), F.lit(0)).alias("_base"))
    kept = [c for c in pieces.columns if c not in ("_part", "_number") and (with_ids or c != "ids")]
    numbered = pieces.join(bases.hint("merge"), ["length", "_part"]).select(*kept, (F.col("_base") + F.col("_number")).alias("_number"))

    def place(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            sequence, offset = places.value(b.column("length").to_numpy(), b.column("_number").to_numpy())
            yield pa.RecordBatch.from_arrays([*(b.column(c) for c in kept), pa.array(sequence), pa.array(offset)], [*kept, "sequence_id", "offset"])

    return numbered.mapInArrow(place, f"`{id_col}` long, {PIECE}{', ids binary' if with_ids else ''}, sequence_id long, offset long")


def packed_sequences(packed: DataFrame) -> DataFrame:
    """``sequence_id, length, ids`` of each sequence, from ``pack_documents`` with ids. A sequence has at most its capacity of pieces."""
    each = F.array_sort(F.collect_list(F.struct("offset", "ids")))
    rows = packed.groupBy("sequence_id").agg(F.sum("length").alias("length"), each.alias("_p"))
    return rows.select("sequence_id", "length", F.aggregate("_p", F.lit(b""), lambda x, p: F.concat(x, p["ids"])).alias("ids"))
