"""Periodic runs inside documents, by seeds on diagonals that are extended.

A run of period q has at least two more periods behind each word of its first,
so it agrees with itself q words on over a stretch of some guaranteed length.
Grams of that length are indexed: of a pair of places of one gram in one
document the distance is a candidate period. The gram is at least as long as
the periods looked for with it, so by the periodicity lemma the next place of a
run's gram is exactly one smallest period away, and only neighbouring places
are enumerated, never all pairs of a frequent gram.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .common import bounded_batches, words_in

#: A run has at least so many words, and so many times its period.
LEAST_WORDS, LEAST_TIMES = 24, 3
RUN = "struct<start:long,length:long,period:long>"
_MIX, _TIMES = np.uint64(0x9E3779B97F4A7C15), np.uint64(0xBF58476D1CE4E5B9)


def _mixed(h: np.ndarray, more: np.ndarray) -> np.ndarray:
    x = (h * _TIMES) ^ (more + _MIX)
    x = (x ^ (x >> np.uint64(30))) * _MIX
    return x ^ (x >> np.uint64(27))


def _repeated(h: np.ndarray) -> np.ndarray:
    """Places whose value occurs more than once."""
    s = np.sort(h)
    twice = s[1:][s[1:] == s[:-1]]
    if not len(twice):
        return np.zeros(0, np.int64)
    twice = twice[np.concatenate([[True], twice[1:] != twice[:-1]])]
    at = np.minimum(np.searchsorted(twice, h), len(twice) - 1)
    return np.flatnonzero(twice[at] == h)


def _first_gram(least_words: int, times: int) -> int:
    """The length of the shortest grams, which is also the largest period that is looked for with them.

    A run of period q agrees with itself over max(least_words - q, (times - 1) * q)
    words or more. The gram may be no longer than that for any q up to the
    largest, and no shorter than the largest period.
    """
    overlap = np.minimum.accumulate([max(least_words - q, (times - 1) * q) for q in range(1, least_words + 1)])
    return max(q for q in range(1, least_words + 1) if overlap[q - 1] >= q)


def _seeds(code: np.ndarray, ends: np.ndarray, least_words: int, times: int) -> Iterator[tuple[np.ndarray, np.ndarray, int]]:
    """``place, lag, gram`` arrays of neighbouring places of equal grams in one document, for each gram length.

    ``code`` numbers the words of all documents in a row, ``ends`` is each
    place's end of its document. Grams are compared by 64-bit hashes that hold
    the document; what is extended is compared in full.
    """
    gram = top = _first_gram(least_words, times)
    place, low = np.arange(len(code)), 1
    # Hashes of 1, 2, 4 ... words, put together to the gram's own length.
    h, size = _mixed(code.astype(np.uint64), np.full(len(code), 7, np.uint64)), 1
    while 2 * size <= gram and len(h) > size:
        h, size = _mixed(h[:-size], h[size:]), 2 * size
    if gram > size:
        rest = gram - size
        h = _mixed(h[:-rest], h[rest:]) if len(h) > rest else h[:0]
    h, place = h[: max(0, len(code) - gram + 1)], place[: max(0, len(code) - gram + 1)]
    inside = place + gram <= ends[place]
    place, h = place[inside], _mixed(h[inside], ends[place[inside]].astype(np.uint64))
    while len(place):
        again = _repeated(h)
        place, h = place[again], h[again]
        order = np.argsort(h, kind="stable")
        near = h[order][1:] == h[order][:-1]
        one, two = place[order][:-1][near], place[order][1:][near]
        lag = two - one
        ok = (lag >= low) & (lag <= top)
        yield one[ok], lag[ok], gram
        # Twice the gram, for twice the period; a gram that occurs once has no longer one that occurs twice.
        low, top = top + 1, 2 * top
        at = np.searchsorted(place, place + gram)
        both = np.flatnonzero((place + 2 * gram <= ends[place]) & (place[np.minimum(at, len(place) - 1)] == place + gram)) if len(place) else at
        place, h = place[both], _mixed(h[both], h[at[both]])
        gram *= 2


def _agrees(code: np.ndarray, i: int, lag: int, end: int, step: int) -> int:
    """Words from ``i`` on, in the direction of ``step``, up to ``end``, that equal the word ``lag`` further."""
    n, width = 0, 32
    total = (end - i) * step
    while n < total:
        take = min(width, total - n)
        if step > 0:
            a = i + n
            differ = code[a : a + take] != code[a + lag : a + lag + take]
        else:
            a = i - n - take + 1
            differ = (code[a : a + take] != code[a + lag : a + lag + take])[::-1]
        if differ.any():
            return n + int(differ.argmax())
        n, width = n + take, 4 * width
    return n


def runs_of(code: np.ndarray, offsets: np.ndarray, least_words: int = LEAST_WORDS, times: int = LEAST_TIMES) -> np.ndarray:
    """Rows ``start, length, period`` of all maximal runs in documents ``code[offsets[k]:offsets[k + 1]]``, by start and period; places count from the first document."""
    size = np.diff(offsets)
    begins, ends = np.repeat(offsets[:-1], size), np.repeat(offsets[1:], size)
    found = []
    for place, lag, gram in _seeds(code, ends, least_words, times):
        order = np.lexsort((place, lag))
        place, lag = place[order], lag[order]
        # The next place on the same diagonal is in the same stretch.
        head = np.ones(len(place), bool)
        head[1:] = (place[1:] != place[:-1] + 1) | (lag[1:] != lag[:-1])
        covered: dict[int, int] = {}
        for i, q in zip(place[head].tolist(), lag[head].tolist(), strict=True):
            if i < covered.get(q, 0):
                continue
            right = i + _agrees(code, i, q, int(ends[i]) - q, 1)
            if right - i < gram:  # two grams that have a hash in common
                continue
            left = i - _agrees(code, i - 1, q, int(begins[i]) - 1, -1) if i > begins[i] else i
            covered[q] = right
            length = right + q - left
            if length >= max(least_words, times * q):
                found.append((left, length, q))
    return np.array(sorted(found, key=lambda r: (r[0], r[2])), np.int64).reshape(-1, 3)


def kept_words(runs: np.ndarray, n: int) -> np.ndarray:
    """Which of ``n`` words no run contains after its first period."""
    depth = np.zeros(n + 1, np.int64)
    np.add.at(depth, runs[:, 0] + runs[:, 2], 1)
    np.add.at(depth, runs[:, 0] + runs[:, 1], -1)
    return np.cumsum(depth)[:n] == 0


def periodic_runs(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", least_words: int = LEAST_WORDS, times: int = LEAST_TIMES) -> DataFrame:
    """``id_col, n_words, runs, collapsed`` of each row.

    ``runs`` lists ``start, length, period``, in words, of every maximal
    stretch with smallest period ``period`` of at least ``least_words`` words
    and ``times`` periods, by start, then period. ``collapsed`` is the text's
    words, joined by one space, without those that a run repeats after its
    first period. ``times`` is at least 3.

    Words are runs of other bytes than ASCII white space, compared as they
    are. Null texts have no words, as empty ones; rows without an id are left
    out; repeated rows are returned as often as they occur; an empty table
    gives an empty result; other columns are ignored. A text is worked on
    whole, in memory that is a multiple of its length.
    """
    if times < 3 or least_words < 2:
        raise ValueError("runs need at least 3 periods and 2 words")
    bounded_batches(docs.sparkSession)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            words, n = words_in(b.column(1), lower=False)
            offsets = np.concatenate([[0], np.cumsum(n)]).astype(np.int64)
            code = words.dictionary_encode().indices.to_numpy() if len(words) else np.zeros(0, np.int32)
            runs = runs_of(code, offsets, least_words, times)
            keep = kept_words(runs, len(code))
            left = np.concatenate([[0], np.cumsum(keep)])[offsets]
            kept = pa.LargeListArray.from_arrays(pa.array(left, pa.int64()), words.filter(pa.array(keep)))
            texts = pc.binary_join(kept, pa.scalar(b" ", pa.large_binary()))
            owner = np.searchsorted(offsets, runs[:, 0], "right") - 1
            each = pa.StructArray.from_arrays([pa.array(runs[:, 0] - offsets[owner]), pa.array(runs[:, 1]), pa.array(runs[:, 2])], ["start", "length", "period"])
            lists = pa.ListArray.from_arrays(pa.array(np.searchsorted(owner, np.arange(len(n) + 1)), pa.int32()), each)
            yield pa.RecordBatch.from_arrays([b.column(0), pa.array(n, pa.int64()), lists, texts.cast(pa.binary())], [id_col, "n_words", "runs", "collapsed"])

    rows = docs.where(F.col(id_col).isNotNull()).select(F.col(id_col).cast("long"), F.col(text_col).cast("binary"))
    out = rows.mapInArrow(run, f"`{id_col}` long, n_words long, runs array<{RUN}>, collapsed binary")
    return out.withColumn("collapsed", F.col("collapsed").cast("string"))
