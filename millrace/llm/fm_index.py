"""Benchmark decontamination by an FM-index of each training shard."""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .common import bounded_batches, left_out, numbered, staged

#: Words of a shard, about: a shard is a run of whole documents of one partition.
SHARD_WORDS = 500_000
#: Every position divisible by this is kept, so that locating walks fewer steps.
SAMPLED = 16
#: Bytes of item texts that are searched for at once; a larger benchmark is taken in blocks.
BLOCK_BYTES = 16 << 20
WINDOW = 10
#: Bytes of words; ASCII capitals are lower-cased and all other bytes part words.
_TABLE = bytes(b + 32 if 65 <= b <= 90 else b if b >= 128 or chr(b) in "0123456789abcdefghijklmnopqrstuvwxyz" else 32 for b in range(256))


def words_of(text: bytes | None) -> list[bytes]:
    return text.translate(_TABLE).split() if text else []


class Bits:
    """A bit vector with ranks."""

    def __init__(self, bits: np.ndarray):
        n = len(bits)
        padded = np.zeros((n // 64 + 1) * 64, np.uint8)
        padded[:n] = bits
        self.blocks = np.packbits(padded.reshape(-1, 64), axis=1, bitorder="little").view("<u8").ravel()
        self.before = np.concatenate([[0], np.cumsum(np.bitwise_count(self.blocks), dtype=np.int64)])

    def rank(self, i: np.ndarray) -> np.ndarray:
        """Ones before each position."""
        block, bit = i >> 6, (i & 63).astype(np.uint64)
        mask = (np.uint64(1) << bit) - np.uint64(1)
        return self.before[block] + np.bitwise_count(self.blocks[block] & mask)

    def get(self, i: np.ndarray) -> np.ndarray:
        return ((self.blocks[i >> 6] >> (i & 63).astype(np.uint64)) & np.uint64(1)).astype(np.int64)


class WaveletTree:
    """Symbols in levels of bits, each level with the symbols that have a zero there first."""

    def __init__(self, symbols: np.ndarray, sigma: int):
        self.levels, self.zeros, now = [], [], symbols
        self.height = max(1, int(sigma - 1).bit_length())
        for k in range(self.height - 1, -1, -1):
            bit = (now >> k & 1).astype(np.uint8)
            self.levels.append(Bits(bit))
            self.zeros.append(int(len(bit) - bit.sum()))
            one = bit.view(bool)
            now = np.concatenate([now[~one], now[one]])
        self.start = self._walk(np.arange(sigma), np.zeros(sigma, np.int64))

    def _walk(self, c: np.ndarray, i: np.ndarray) -> np.ndarray:
        for k, bits, zeros in zip(range(self.height - 1, -1, -1), self.levels, self.zeros, strict=True):
            ones = bits.rank(i)
            i = np.where(c >> k & 1, zeros + ones, i - ones)
        return i

    def rank(self, c: np.ndarray, i: np.ndarray) -> np.ndarray:
        """Occurrences of symbol ``c`` before position ``i``."""
        return self._walk(c, i) - self.start[c]

    def get(self, i: np.ndarray) -> np.ndarray:
        c = np.zeros(len(i), np.int64)
        for bits, zeros in zip(self.levels, self.zeros, strict=True):
            one, ones = bits.get(i), bits.rank(i)
            c = c << 1 | one
            i = np.where(one, zeros + ones, i - ones)
        return c


def suffix_order(s: np.ndarray, sigma: int) -> np.ndarray:
    """Positions of ``s`` in the order of their suffixes. Zeros are separators, each a symbol of its own in order of place."""
    n = len(s)
    at = np.flatnonzero(s)
    zeros = np.flatnonzero(s == 0)
    bits = max(1, int(sigma - 1).bit_length())
    taken = min(16, 62 // bits)
    padded = np.concatenate([s, np.zeros(taken, s.dtype)]).astype(np.int64)
    key = padded[at]
    alive = np.ones(len(at), bool)
    for j in range(1, taken):
        nxt = padded[at + j] * alive
        alive &= nxt > 0
        key = key << bits | nxt
    order = np.argsort(key, kind="stable")
    pos, key, alive = at[order], key[order], alive[order]
    rank = np.empty(n, np.int64)
    rank[zeros] = np.arange(len(zeros))
    # Those that hold a separator are in their place: equal ones follow the separators' order.
    new = np.ones(len(pos), bool)
    new[1:] = (key[1:] != key[:-1]) | ~alive[1:]
    group = np.maximum.accumulate(np.where(new, np.arange(len(pos)), 0))
    rank[pos] = group + len(zeros)
    step = taken
    tied = ~new
    tied[:-1] |= ~new[1:]
    left = np.flatnonzero(tied)
    while len(left):
        p, g = pos[left], group[left]
        k = rank[p + step]  # tied suffixes hold no separator so far, so the place exists
        by = np.lexsort((k, g))
        p, k = p[by], k[by]
        pos[left] = p
        new = np.ones(len(left), bool)
        new[1:] = (k[1:] != k[:-1]) | (g[1:] != g[:-1])
        group[left] = np.maximum.accumulate(np.where(new, left, 0))
        rank[p] = group[left] + len(zeros)
        tied = ~new
        tied[:-1] |= ~new[1:]
        left = left[tied]
        step *= 2
    return np.concatenate([zeros, pos])


class FmIndex:
    """Backward search and location in one shard. ``s`` ends with a zero."""

    def __init__(self, s: np.ndarray, sigma: int):
        order = suffix_order(s, sigma)
        last = s[order - 1]
        last[order == 0] = 0
        self.tree = WaveletTree(last, sigma)
        self.less = np.concatenate([[0], np.cumsum(np.bincount(s, minlength=sigma))])
        kept = (order % SAMPLED == 0) | (last == 0)
        self.kept, self.places, self.n = Bits(kept), order[kept], len(s)

    def search(self, phrases: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """The rows ``[lo, hi)`` of each phrase; ``phrases`` has one phrase of non-zero symbols a line."""
        lo, hi = np.zeros(len(phrases), np.int64), np.full(len(phrases), self.n, np.int64)
        live = np.arange(len(phrases))
        for k in range(phrases.shape[1] - 1, -1, -1):
            c = phrases[live, k]
            lo[live] = self.less[c] + self.tree.rank(c, lo[live])
            hi[live] = self.less[c] + self.tree.rank(c, hi[live])
            live = live[lo[live] < hi[live]]
        return lo, hi

    def locate(self, rows: np.ndarray) -> np.ndarray:
        """The places of rows: walked back to one that is kept."""
        rows, out, left, steps = rows.copy(), np.empty(len(rows), np.int64), np.arange(len(rows)), 0
        while len(left):
            r = rows[left]
            there = self.kept.get(r).astype(bool)
            out[left[there]] = self.places[self.kept.rank(r[there])] + steps
            left, r = left[~there], r[~there]
            c = self.tree.get(r)
            rows[left] = self.less[c] + self.tree.rank(c, r)
            steps += 1
        return out


class Phrases:
    """The windows of items: distinct, by length, with the items of each."""

    def __init__(self, items: list[tuple[str, list[bytes]]], window: int = WINDOW):
        self.symbol: dict[bytes, int] = {}
        found: dict[tuple[int, ...], set[str]] = {}
        for item, words in items:
            ids = [self.symbol.setdefault(w, len(self.symbol) + 1) for w in words]
            for k in range(max(1, len(ids) - window + 1) if ids else 0):
                found.setdefault(tuple(ids[k : k + window]), set()).add(item)
        self.groups = []
        for n in sorted({len(k) for k in found}):
            keys = [k for k in found if len(k) == n]
            self.groups.append((np.array(keys, np.int64), [sorted(found[k]) for k in keys]))

    @property
    def sigma(self) -> int:
        return len(self.symbol) + 1


def search_shard(docs: list[np.ndarray], phrases: Phrases) -> list[tuple[list[tuple[int, int]], list[str]]]:
    """Of each document (its words' symbols): merged spans of words inside windows, and the items that occur, sorted."""
    starts = np.cumsum([0] + [len(d) + 1 for d in docs])
    s = np.zeros(starts[-1], np.int64)
    for d, a in zip(docs, starts, strict=False):
        s[a : a + len(d)] = d
    edge = np.zeros(len(s) + 1, np.int64)
    items: list[set[str]] = [set() for _ in docs]
    if s.any():
        index = FmIndex(s, phrases.sigma)
        for keys, names in phrases.groups:
            lo, hi = index.search(keys)
            hits = np.flatnonzero(lo < hi)
            if not len(hits):
                continue
            n = (hi - lo)[hits]
            which = np.repeat(hits, n)
            rows = np.repeat(lo[hits] - np.concatenate([[0], np.cumsum(n)[:-1]]), n) + np.arange(n.sum())
            places = index.locate(rows)
            np.add.at(edge, places, 1)
            np.add.at(edge, places + keys.shape[1], -1)
            doc = np.searchsorted(starts, places, "right") - 1
            for pair in np.unique(doc * len(keys) + which).tolist():
                items[pair // len(keys)].update(names[pair % len(keys)])
    covered = np.cumsum(edge[:-1]) > 0
    turn = np.flatnonzero(np.diff(np.concatenate([[0], covered.astype(np.int8), [0]])))
    spans: list[list[tuple[int, int]]] = [[] for _ in docs]
    for a, b in turn.reshape(-1, 2).tolist():
        d = int(np.searchsorted(starts, a, "right")) - 1
        spans[d].append((a - int(starts[d]), b - int(starts[d])))
    return [(x, sorted(y)) for x, y in zip(spans, items, strict=True)]


def merge_spans(spans: list[tuple[int, int]]) -> list[tuple[int, int]]:
    out: list[tuple[int, int]] = []
    for a, b in sorted(spans):
        if out and a <= out[-1][1]:
            out[-1] = (out[-1][0], max(b, out[-1][1]))
        else:
            out.append((a, b))
    return out


def contamination(
    docs: DataFrame, benchmark: DataFrame, id_col: str = "doc_id", text_col: str = "text", item_col: str = "item_id", item_text: str = "text",
    window: int = WINDOW, block_bytes: int = BLOCK_BYTES,
) -> DataFrame:
    """``id_col, n_words, spans, items`` of each row of ``docs``.

    ``spans`` (ARRAY<STRUCT<start, end>>, in words, merged) are the words inside
    occurrences of any window of ``window`` consecutive item words, or of a
    whole item that has fewer; ``items`` are the ids, as strings, of the items
    with such windows. Null texts have no words, items without words have no
    windows, rows without an id are left out (of items, too), repeated rows are
    returned as often as they occur; other columns are ignored.
    """
    spark = docs.sparkSession
    bounded_batches(spark)
    asked = benchmark.where(F.col(item_col).isNotNull()).select(F.col(item_col).cast("string").alias("i"), F.col(item_text).cast("binary").alias("t"))
    total = asked.agg(F.sum(F.octet_length("t"))).first()[0] or 0
    blocks = total // block_bytes + 1

    def searcher(shared, last: bool):
        def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
            phrases: Phrases = shared.value
            get, held, size = phrases.symbol.get, [], 0

            def flush() -> pa.RecordBatch:
                found = search_shard([h[4] for h in held], phrases)
                spans = [merge_spans(h[2] + s) for h, (s, _) in zip(held, found, strict=True)]
                items = [sorted({*h[3], *i}) for h, (_, i) in zip(held, found, strict=True)]
                cols = [
                    pa.array([h[0] for h in held], pa.int64()), pa.array([len(h[4]) for h in held], pa.int64()),
                    pa.array([[{"start": a, "end": b} for a, b in x] for x in spans], kind), pa.array(items, pa.list_(pa.string())),
                ]
                if not last:
                    cols.append(pa.array([h[1] for h in held], pa.binary()))
                return pa.RecordBatch.from_arrays(cols, names[: len(cols)])

            for b in batches:
                before = b.num_columns > 2
                for k in range(b.num_rows):
                    text = b.column(1)[k].as_py()
                    words = words_of(text)
                    ids = np.fromiter([get(w, 0) for w in words], np.int64, len(words))
                    old = [(x["start"], x["end"]) for x in b.column(2)[k].as_py()] if before else []
                    held.append((b.column(0)[k].as_py(), None if last else text, old, b.column(3)[k].as_py() if before else [], ids))
                    size += len(words) + 1
                    if size >= SHARD_WORDS:
                        yield flush()
                        held, size = [], 0
            if held:
                yield flush()

        return run

    kind = pa.list_(pa.struct([("start", pa.int32()), ("end", pa.int32())]))
    names = [id_col, "n_words", "spans", "items", "t"]
    schema = f"`{id_col}` long, n_words long, spans array<struct<start:int,end:int>>, items array<string>"
    now = docs.where(F.col(id_col).isNotNull()).select(F.col(id_col).cast("long"), F.col(text_col).cast("binary").alias("t"))
    for k in range(blocks):
        block = asked if blocks == 1 else asked.where(F.pmod(F.xxhash64("i"), F.lit(blocks)) == k)
        # A block of about block_bytes of the stated query set.
        shared = spark.sparkContext.broadcast(Phrases([(r.i, words_of(r.t and bytes(r.t))) for r in block.collect()], window))
        last = k == blocks - 1
        now = now.mapInArrow(searcher(shared, last), schema + ("" if last else ", t binary"))
        if not last:
            now = staged(now).select(id_col, "t", "spans", "items")
    return now


def decontaminate(docs: DataFrame, benchmark: DataFrame, id_col: str = "doc_id", text_col: str = "text", window: int = WINDOW) -> DataFrame:
    """``docs`` without the rows whose text has a benchmark window. Each row is judged by itself, with an id or without. Columns stay."""
    rows, row = numbered(docs)
    hit = contamination(rows.select(row, text_col), benchmark, row, text_col, window=window).where(F.size("spans") > 0)
    return left_out(rows, row, hit).select(docs.columns)
