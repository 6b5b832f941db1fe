"""SimHash near-duplicates by tiled exact comparison of 64-bit fingerprints."""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .common import bounded_batches, components, left_out, numbered, spread_join, staged

SEED = 42
#: Fingerprints in a tile, about. Two tiles are compared by one matrix of exclusive-ors.
TILE = 512


def fingerprint(text: bytes, shingle: int = 3) -> bytes:
    """SimHash of a text, 8 bytes, most significant first.

    ASCII capitals are lower-cased, words are runs without ASCII white space
    and every shingle counts as often as it occurs. A bit is set if more than
    half of the shingles' XXH64 have it. No words: zero.
    """
    words = text.lower().split()
    if not words:
        return bytes(8)
    if len(words) < shingle:
        return xxhash.xxh64_digest(b" ".join(words), SEED)
    digest = xxhash.xxh64_digest
    parts = zip(*(words[i:] for i in range(shingle)), strict=False)
    hashes = np.frombuffer(b"".join([digest(b" ".join(x), SEED) for x in parts]), np.uint8).reshape(-1, 8)
    ones = np.zeros(64, np.int64)
    for k in range(0, len(hashes), 255):  # at most 255 rows fit the sums of one byte
        ones += np.unpackbits(hashes[k : k + 255], axis=1).sum(0, dtype=np.uint8)
    return np.packbits(ones * 2 > len(hashes)).tobytes()


def fingerprints(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", shingle: int = 3) -> DataFrame:
    """``id_col`` and ``fp`` (LONG) of each row; a null text is empty, rows without an id are left out."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            out = b"".join([fingerprint(x.as_py() or b"", shingle) for x in b.column(1)])
            yield pa.RecordBatch.from_arrays(
                [b.column(0), pa.array(np.frombuffer(out, ">i8").astype(np.int64))], ["id", "fp"]
            )

    rows = docs.where(F.col(id_col).isNotNull()).select(F.col(id_col).cast("long").alias("id"), F.col(text_col).cast("binary").alias("text"))
    return rows.mapInArrow(run, "id long, fp long")


def _linked(a: np.ndarray, b: np.ndarray, ra: np.ndarray, rb: np.ndarray, radius: int, same: bool) -> tuple[np.ndarray, np.ndarray]:
    """Links of two tiles, thinned to stars: the tiles' own components, each as links to its smallest id."""
    i, j = np.nonzero(np.bitwise_count(a[:, None] ^ b[None, :]) <= radius)
    if same:
        i, j = i[i < j], j[i < j]
    if not len(i):
        return ra[:0], ra[:0]
    x, y = ra[i], rb[j]
    ids, flat = np.unique(np.concatenate([x, y]), return_inverse=True)
    u, v = flat[: len(x)], flat[len(x) :]
    low = np.arange(len(ids))
    while True:
        was = low.copy()
        np.minimum.at(low, u, low[v])
        np.minimum.at(low, v, low[u])
        low = low[low]
        if (low == was).all():
            break
    far = np.flatnonzero(low != np.arange(len(ids)))
    return ids[far], ids[low[far]]


def fingerprint_links(unique: DataFrame, radius: int = 2, tile: int = TILE) -> DataFrame:
    """Links (``a``, ``b``) whose components are those of all pairs within ``radius``.

    ``unique``: distinct ``fp`` with ``id``. Fingerprints are put into cells by
    the population counts of their four 16-bit quarters, and cells into tiles
    of about ``tile``. Differing in r bits moves the four counts by r in all,
    so only tiles of cells within ``radius`` of each other are compared; every
    pair of such tiles is compared in full. Work is dealt out by pairs of
    tiles, so that one crowded cell is spread like any other.
    """
    quarter = [F.bit_count(F.shiftrightunsigned("fp", 16 * k).bitwiseAND(F.lit(65535))).cast("int") for k in range(4)]
    cell = sum((q * 17**k for k, q in enumerate(quarter)), F.lit(0))
    rows = unique.select("fp", "id", cell.alias("cell"))
    # At most 17 ** 4 = 83,521 cells, so this side has a proven size bound.
    tiles_in = F.broadcast(rows.groupBy("cell").agg(F.ceil(F.count("*") / tile).cast("int").alias("n")))
    tiles = (
        rows.join(tiles_in, "cell")
        .groupBy("cell", F.pmod(F.xxhash64("fp"), F.col("n")).cast("int").alias("tile"))
        .agg(F.collect_list("fp").alias("fps"), F.collect_list("id").alias("ids"))
    )
    tiles = staged(tiles)
    span = range(-radius, radius + 1)
    steps = [
        (a, b, c, d)
        for a in span for b in span for c in span for d in span
        if abs(a) + abs(b) + abs(c) + abs(d) <= radius and a + 17 * b + 289 * c + 4913 * d >= 0
    ]
    near = F.array(*[F.array(*[F.lit(x) for x in s]) for s in steps])
    digit = [F.floor(F.col("cell") / 17**k).cast("int") % 17 for k in range(4)]
    inside = lambda s: F.reduce(F.array(*[(digit[k] + s[k]).between(0, 16) for k in range(4)]), F.lit(True), lambda x, y: x & y)
    # Pairs of tiles by number first; each side's fingerprints are joined to them once.
    left = (
        tiles.select("cell", "tile", F.explode(F.filter(near, inside)).alias("s"))
        .withColumn("cell2", F.col("cell") + sum((F.col("s")[k] * 17**k for k in range(4)), F.lit(0)))
        .join(tiles_in.select(F.col("cell").alias("cell2"), "n"), "cell2")
        .withColumn("tile2", F.explode(F.sequence(F.lit(0), F.col("n") - 1)))
        .where("cell <> cell2 or tile <= tile2")
        .select("cell", "tile", "cell2", "tile2")
    )
    right = tiles.select(F.col("cell").alias("cell2"), F.col("tile").alias("tile2"), F.col("fps").alias("fps2"), F.col("ids").alias("ids2"))
    pairs = left.join(tiles.select("cell", "tile", "fps", "ids"), ["cell", "tile"]).join(right, ["cell2", "tile2"]).select(
        "fps", "ids", "fps2", "ids2", ((F.col("cell") == F.col("cell2")) & (F.col("tile") == F.col("tile2"))).alias("same")
    )

    def compare(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            lists = []
            for k in range(4):
                col = b.column(k)
                at, flat = col.offsets.to_numpy(), col.values.to_numpy(zero_copy_only=False)
                lists.append([flat[x:y] for x, y in zip(at[:-1], at[1:], strict=True)])
            found = [
                _linked(f.view(np.uint64), g.view(np.uint64), i, j, radius, same)
                for f, i, g, j, same in zip(*lists, b.column(4).to_pylist(), strict=True)
            ]
            if found:
                yield pa.RecordBatch.from_arrays([pa.array(np.concatenate([x[k] for x in found])) for k in (0, 1)], ["a", "b"])

    return pairs.mapInArrow(compare, "a long, b long")


def simhash_groups(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", shingle: int = 3, radius: int = 2) -> DataFrame:
    """``id_col``, ``fingerprint`` (16 hex digits), ``component_id`` of each row.

    Rows link if their fingerprints differ in at most ``radius`` bits;
    ``component_id`` is the smallest id that links reach. Rows without an id
    are left out; null texts and texts without words have fingerprint zero and
    link like any other; repeated rows are returned as often as they occur; an
    empty table gives an empty result. Other columns are ignored.
    """
    bounded_batches(docs.sparkSession)
    rows = staged(fingerprints(docs, id_col, text_col, shingle))
    unique = rows.groupBy("fp").agg(F.min("id").alias("id"))
    joined = components(fingerprint_links(unique, radius))
    classes = unique.join(joined, "id", "left").select("fp", F.coalesce("component", "id").alias("component_id"))
    return spread_join(rows, classes, ["fp"]).select(
        F.col("id").alias(id_col), F.lower(F.lpad(F.hex("fp"), 16, "0")).alias("fingerprint"), "component_id"
    )


def simhash_dedup(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", shingle: int = 3, radius: int = 2) -> DataFrame:
    """``docs`` with one row of each near-duplicate group: the one with the smallest id.

    Rows are told apart by a number of their own, so rows with the same id but
    unlike texts all stay, and rows without an id are compared like any other;
    one of them stays only where no row of its group has an id. Null texts and
    texts without words are one group. Columns stay as they are.
    """
    bounded_batches(docs.sparkSession)
    rows, row = numbered(docs)
    marks = staged(fingerprints(rows, row, text_col, shingle))
    unique = marks.groupBy("fp").agg(F.min("id").alias("id"))
    joined = components(fingerprint_links(unique, radius))
    classes = unique.join(joined, "id", "left").select("fp", F.coalesce("component", "id").alias("group"))
    named = spread_join(marks, classes, ["fp"]).select(F.col("id").alias(row), "group").join(rows.select(row, F.col(id_col).alias("id")), row)
    named = staged(named.select(row, "group", F.struct(F.col("id").isNull().alias("none"), "id", row).alias("place")))
    first = named.groupBy("group").agg(F.min("place").alias("first")).select(F.col(f"first.{row}").alias(row))
    return left_out(rows, row, named.select(row).join(first, row, "left_anti")).select(docs.columns)
