"""What several operators of this subpackage share."""

from __future__ import annotations

from collections.abc import Callable, Iterator

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from ..scratch import scratch_dir, scratch_path, staged  # noqa: F401


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def bounded_batches(spark: SparkSession) -> None:
    """Keep each Arrow batch small, whatever the length of the texts in it. The session keeps this setting, as results are computed later."""
    spark.conf.set("spark.sql.execution.arrow.maxRecordsPerBatch", "1000")
    spark.conf.set("spark.sql.execution.arrow.maxBytesPerBatch", str(8 << 20))


#: Rows to leave out whose numbers are broadcast at most, 8 bytes each; beyond it they are joined.
BROADCAST_ROWS = 1_000_000


def numbered(docs: DataFrame) -> tuple[DataFrame, str]:
    """``docs``, written once, with a number for each row, and the number's column: rows without an id or with the same id are told apart by it."""
    name = next(n for n in (f"_row{k}" for k in range(len(docs.columns) + 1)) if n not in docs.columns)
    return staged(docs.withColumn(name, F.monotonically_increasing_id())), name


def left_out(rows: DataFrame, number: str, gone: DataFrame) -> DataFrame:
    """``rows`` of ``numbered`` less those whose numbers are in ``gone``, without the number. Rows are not shuffled for a short list."""
    gone = staged(gone.select(F.col(number)).distinct())
    if gone.count() <= BROADCAST_ROWS:
        gone = F.broadcast(gone)
    return rows.join(gone, number, "left_anti").drop(number)


def hash_sample(df: DataFrame, key: str, n: int) -> DataFrame:
    """About ``n`` rows, all of them if there are no more: those whose hash of ``key`` is low enough.

    The same rows each time; nothing is gathered to choose them.
    """
    total = df.count()
    if total <= n:
        return df
    return df.where(F.pmod(F.xxhash64(F.col(key)), F.lit(1 << 40)) < int((1 << 40) * n / total))


def components(links: DataFrame, most: int = 60) -> DataFrame:
    """Connected components by alternating large and small stars.

    ``links``: two LONG columns ``a`` and ``b``. Returns ``id, component`` for
    every id that is not the smallest of its component. Every round is a few
    keyed aggregations and joins, so neither a component nor the list of links
    has to fit in a task or in the driver; each round's links are written to
    the shared folder.
    """
    stars = staged(
        links.where("a <> b")
        .select(F.greatest("a", "b").alias("a"), F.least("a", "b").alias("b"))
        .distinct()
    )

    def mark(df: DataFrame):
        return df.agg(F.count("*"), F.sum(F.xxhash64("a", "b").cast("decimal(38,0)"))).first()

    before = mark(stars)
    # Few links need no salt, and so no count of their keys.
    join = (lambda x, y: x.join(y, "a")) if before[0] <= BROADCAST_ROWS else (lambda x, y: spread_join(x, y, ["a"]))
    if not before[0]:
        return stars.select(F.col("a").alias("id"), F.col("b").alias("component"))
    for _ in range(most):
        both = stars.unionByName(stars.select(F.col("b").alias("a"), F.col("a").alias("b")))
        # The hub of a large component is a key with all its members: its rows are dealt over several tasks.
        least = both.groupBy("a").agg(F.least(F.min("b"), F.col("a")).alias("m"))
        large = (
            join(both, least).where("b > a").select(F.col("b").alias("a"), F.col("m").alias("b")).where("a <> b").distinct()
        )
        lowest = large.groupBy("a").agg(F.min("b").alias("m"))
        small = (
            join(large, lowest)
            .select(F.explode(F.array(F.struct("b", "m"), F.struct(F.col("a").alias("b"), "m"))).alias("x"))
            .select(F.col("x.b").alias("a"), F.col("x.m").alias("b"))
            .where("a <> b")
            .distinct()
        )
        stars = staged(small)
        after = mark(stars)
        if after == before:
            return stars.select(F.col("a").alias("id"), F.col("b").alias("component"))
        before = after
    raise RuntimeError(f"components did not settle in {most} rounds")


def spread_join(rows: DataFrame, side: DataFrame, keys: list[str], parts: int = 64) -> DataFrame:
    """``rows`` joined to ``side``, which has each key once, with hot keys dealt over ``parts`` tasks.

    Hot are keys with over a thousandth of all rows, so there are fewer than a
    thousand of them and their list can be broadcast at any size of the input.
    """
    counts = rows.groupBy(keys).agg(F.count("*").alias("_c"))
    total = rows.count()
    hot = F.broadcast(counts.where(F.col("_c") > max(1, total / 1000)).select(*keys, F.lit(parts).alias("_parts")))
    salt = F.pmod(F.xxhash64(*[c for c in rows.columns if c not in keys]), F.coalesce("_parts", F.lit(1))).cast("int")
    left = rows.join(hot, keys, "left").withColumn("_salt", salt).drop("_parts")
    right = side.join(hot, keys, "left").withColumn("_salt", F.explode(F.sequence(F.lit(0), F.coalesce("_parts", F.lit(1)) - 1))).drop("_parts")
    return left.join(right, [*keys, "_salt"]).drop("_salt")


#: Bytes that are no ASCII white space.
SOLID = np.ones(256, bool)
SOLID[[*range(9, 14), 32]] = False


def words_in(texts: pa.Array, solid: np.ndarray = SOLID, lower: bool = True) -> tuple[pa.LargeBinaryArray, np.ndarray]:
    """All words of a BINARY array in a row, and how many each text has; nulls have none.

    A word is a run of bytes for which ``solid`` holds; with ``lower``, ASCII
    capitals are lower-cased.
    """
    texts = pc.fill_null(texts, b"")
    if not len(texts):
        return pa.array([], pa.large_binary()), np.zeros(0, np.int64)
    _, where, data = texts.buffers()
    kind = np.int64 if pa.types.is_large_binary(texts.type) else np.int32
    offsets = np.frombuffer(where, kind)[texts.offset : texts.offset + len(texts) + 1].astype(np.int64)
    raw = np.frombuffer(data, np.uint8)[offsets[0] : offsets[-1]] if offsets[-1] > offsets[0] else np.zeros(0, np.uint8)
    offsets = offsets - offsets[0]
    if lower:
        raw = raw + ((raw - np.uint8(65)) < 26).view(np.uint8) * np.uint8(32)
    inside = solid[raw]
    edge = np.zeros(len(raw) + 1, bool)  # where a text begins, a word ends
    edge[offsets] = True
    start = np.flatnonzero(inside & np.concatenate([[True], ~inside[:-1] | edge[1:-1]])) if len(raw) else np.zeros(0, np.int64)
    end = np.flatnonzero(inside & np.concatenate([~inside[1:] | edge[1:-1], [True]])) if len(raw) else start
    ends = np.concatenate([[0], np.cumsum(end + 1 - start)])
    words = pa.LargeBinaryArray.from_buffers(pa.large_binary(), len(start), [None, pa.py_buffer(ends), pa.py_buffer(np.ascontiguousarray(raw[inside]))])
    return words, np.diff(np.searchsorted(start, offsets))


def word_counts(texts: DataFrame, words: Callable[[pa.Array], pa.Array]) -> DataFrame:
    """``w`` (BINARY), ``n`` over all rows of ``texts``, a frame of one BINARY column; written to the shared folder.

    ``words`` gives the words of a batch; its counts are added up before the shuffle.
    """

    def count(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            pair = pc.value_counts(words(b.column(0)))
            yield pa.RecordBatch.from_arrays([pair.field(0).cast(pa.binary()), pair.field(1)], ["w", "n"])

    return staged(texts.mapInArrow(count, "w binary, n long").groupBy("w").agg(F.sum("n").alias("n")))


def most_frequent(counts: DataFrame, most: int, *more: str) -> list[tuple]:
    """The most frequent words ``w`` by ``n``, and columns ``more``: at most ``most``, most frequent first, ties in the words' order.

    Counts are put into about a thousand levels at most, and whole levels are
    taken from the top, so the driver gets the levels and the words taken.
    """
    level = F.when(F.col("n") < 64, F.col("n")).otherwise(64 + F.floor(F.log2(F.col("n") / 64) * 16)).cast("int")
    taken, least = 0, None
    for at, n in sorted(map(tuple, counts.groupBy(level.alias("at")).count().collect()), reverse=True):
        taken += n
        if taken > most:
            break
        least = at
    if least is None:
        return []
    rows = [(bytes(r[0]), *r[1:]) for r in counts.where(level >= least).select("w", "n", *more).collect()]
    return sorted(rows, key=lambda x: (-x[1], x[0]))
