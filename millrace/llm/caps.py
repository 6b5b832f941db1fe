"""Near-duplicate vectors by spherical-cap filters."""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass
from functools import lru_cache

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from .common import bounded_batches, components, spread_join, staged

#: Share of random pairs at the wanted cosine that share a filter, on ``SAMPLE`` pairs; a vector passes ``LEAST`` filters at least.
WANTED, SAMPLE, LEAST = 0.955, 1000, 5
#: Filters that a vector may pass on average.
MOST = 80
#: Of a pair of vectors so many words of either half are looked at for their best common filter.
NEAR = 48
#: Crowded buckets whose list is broadcast at most; beyond it the list is joined.
BROADCAST = 100_000
#: One filter for so many vectors, about, between the bounds; and vectors in a tile of a crowded bucket.
VECTORS, TILE = 25, 1600
FILTERS = (1024, 1 << 22)


class Caps:
    """Filter directions that are the product of two random codes, and what decodes a vector to its list.

    Space is turned by a random rotation and cut into halves, with ``words``
    random unit vectors in each. A filter is a pair of words; a vector passes
    it if the sum of its products with both is over the threshold. Sums over
    the threshold are found from the words alone, not by going through all
    pairs of words.

    The threshold is the one at which random pairs at ``cosine`` share a filter
    as often as wanted, by these very codes. In few dimensions caps that fine
    would have to be passed by the hundred, so there are only as many filters,
    ``filters`` at most, as make the comparisons few: a vector's list times the
    vectors of a bucket. A single filter, which all pass, is the last resort.
    """

    def __init__(self, dim: int, filters: int, cosine: float = 0.95, seed: int = 11):
        rng = np.random.default_rng([seed, dim])
        self.turn = np.linalg.qr(rng.standard_normal((dim, dim)))[0]
        self.half = max(1, dim // 2)
        # So few dimensions do not tell more words apart.
        most = 2 * 8 ** min(self.half - 1, 6)
        words = max(1, min(most, int(np.ceil(np.sqrt(filters)))))
        codes = []
        for n in (self.half, dim - self.half):
            w = rng.standard_normal((words, n))
            length = np.linalg.norm(w, axis=1, keepdims=True)
            codes.append(w / np.where(length == 0, 1, length))
        one = _unit(rng.standard_normal((SAMPLE, dim)) + 1e-9)
        away = rng.standard_normal((SAMPLE, dim)) if dim > 1 else np.zeros((SAMPLE, 1))
        away -= (away * one).sum(1, keepdims=True) * one
        length = np.linalg.norm(away, axis=1, keepdims=True)
        two = _unit(cosine * one + np.sqrt(max(0.0, 1 - cosine**2)) * away / np.where(length == 0, 1, length))
        best = None
        while True:
            self.words, self.codes = words, [c[:words] for c in codes]
            passed = self._calibrate(one, two)
            cost = passed**2 / words**2
            if (passed <= MOST or words == 1) and (best is None or cost < best[0]):
                best = cost, words, self.threshold
            if words == 1 or best is not None and cost > best[0]:
                break
            words //= 2
        _, self.words, self.threshold = best
        self.codes = [c[: self.words] for c in codes]

    def _calibrate(self, one: np.ndarray, two: np.ndarray) -> float:
        """Sets the threshold by pairs of vectors; returns how many filters a vector passes on average."""
        if self.words == 1:
            self.threshold = -np.inf
            return 1.0
        products = []
        m = min(NEAR, self.words)
        for at, code in ((slice(None, self.half), self.codes[0]), (slice(self.half, None), self.codes[1])):
            x, y = (one @ self.turn)[:, at] @ code.T, (two @ self.turn)[:, at] @ code.T
            near = np.argpartition(-(x + y), m - 1, axis=1)[:, :m]
            products.append((np.take_along_axis(x, near, 1), np.take_along_axis(y, near, 1)))
        (a, c), (b, d) = products
        common = np.minimum(a[:, :, None] + b[:, None], c[:, :, None] + d[:, None]).reshape(len(one), -1).max(1)
        for lost in (0.12, 0.08, 0.06, 0.045, 0.03):  # the least number of filters each passes makes up for some
            self.threshold = float(np.quantile(common, lost))
            x = self.lists(one[:100])
            passed = float(np.mean([len(v) for v in x]))
            if passed > 4 * MOST:  # far too many at any threshold
                break
            x += self.lists(one[100:])
            if np.mean([len(np.intersect1d(p, q, True)) > 0 for p, q in zip(x, self.lists(two), strict=True)]) >= WANTED:
                break
        return passed

    def lists(self, unit: np.ndarray) -> list[np.ndarray]:
        turned = unit @ self.turn
        one, two = turned[:, : self.half] @ self.codes[0].T, turned[:, self.half :] @ self.codes[1].T
        out = []
        for a, b in zip(one, two, strict=True):
            least = self.threshold
            top = np.sort(a)[-LEAST:, None] + np.sort(b)[-LEAST:]
            if top.size >= LEAST:
                least = min(least, np.sort(top, axis=None)[-LEAST])
            i, j = np.flatnonzero(a >= least - b.max()), np.flatnonzero(b >= least - a.max())
            x, y = np.nonzero(a[i, None] + b[None, j] >= least)
            out.append(np.sort(i[x] * self.words + j[y]).astype(np.int32))
        return out


@lru_cache(maxsize=64)
def caps_for(dim: int, filters: int, cosine: float) -> Caps:
    return Caps(dim, filters, cosine)


def _ragged(col: pa.Array) -> list[np.ndarray]:
    at, flat = col.offsets.to_numpy(), col.values.to_numpy(zero_copy_only=False)
    return [flat[x:y] for x, y in zip(at[:-1], at[1:], strict=True)]


def _unit(rows: np.ndarray) -> np.ndarray:
    rows = rows.astype(np.float64)
    rows = rows / np.abs(rows).max(1, keepdims=True)
    return rows / np.linalg.norm(rows, axis=1, keepdims=True)


def _flat(col: pa.Array) -> np.ndarray:
    """The bytes of a BINARY array, one after the other."""
    _, where, data = col.buffers()
    at = np.frombuffer(where, np.int32)[col.offset : col.offset + len(col) + 1]
    return np.frombuffer(data, np.uint8)[at[0] : at[-1]] if len(col) and at[-1] > at[0] else np.zeros(0, np.uint8)


@dataclass
class Tile:
    """Vectors of a bucket: keys, copies, unit vectors, and filters in a row with the vector each belongs to."""

    key: np.ndarray
    n: np.ndarray
    unit: np.ndarray
    filters: np.ndarray
    owner: np.ndarray

    @classmethod
    def read(cls, rows: pa.StructArray, dim: int) -> Tile:
        key, n, v, f, c = (rows.field(name) for name in ("k", "n", "v", "f", "c"))
        size = c.to_numpy()
        flat = _flat(v)
        return cls(key.to_numpy(), n.to_numpy().astype(np.float64), _unit(flat.view(f"<f{len(flat) // (dim * len(rows))}").reshape(-1, dim)), _flat(f).view("<i4"), np.repeat(np.arange(len(rows)), size))

    def has(self, used: np.ndarray, cap: int) -> tuple[np.ndarray, np.ndarray]:
        """Vectors and filters under ``cap`` of the vectors used."""
        wanted = np.zeros(len(self.key), bool)
        wanted[used] = True
        at = np.flatnonzero(wanted[self.owner] & (self.filters < cap))
        return self.owner[at], self.filters[at]


def _links(cap: int, one: Tile, two: Tile | None, cosine: float) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Rows ``kind, a, b`` of one pair of tiles: 0 for a vector's number of links, 1 for links thinned to stars.

    A pair that shares several filters is counted at the least of them alone.
    """
    other = one if two is None else two
    hit = one.unit @ other.unit.T >= cosine
    if two is None:
        hit = np.triu(hit, 1)
    i, j = np.nonzero(hit)
    none = np.empty(0, np.int64)
    if not len(i):
        return none, none, none
    (x, f), (y, g) = one.has(i, cap), other.has(j, cap)
    both = np.intersect1d(f, g)
    if len(both):
        has = []
        for t, row, fs in ((one, x, f), (other, y, g)):
            at = np.searchsorted(both, fs)
            ok = both[np.minimum(at, len(both) - 1)] == fs
            m = np.zeros((len(t.key), len(both)), np.float32)
            m[row[ok], at[ok]] = 1
            has.append(m)
        new = (has[0] @ has[1].T)[i, j] == 0
        i, j = i[new], j[new]
        if not len(i):
            return none, none, none
    ids, flat = np.unique(np.concatenate([one.key[i], other.key[j]]), return_inverse=True)
    u, v = flat[: len(i)], flat[len(i) :]
    count = np.bincount(u, other.n[j], len(ids)) + np.bincount(v, one.n[i], len(ids))
    low = np.arange(len(ids))
    while True:
        was = low.copy()
        np.minimum.at(low, u, low[v])
        np.minimum.at(low, v, low[u])
        low = low[low]
        if (low == was).all():
            break
    far = np.flatnonzero(low != np.arange(len(ids)))
    kind = np.concatenate([np.zeros(len(ids), np.int64), np.ones(len(far), np.int64)])
    return kind, np.concatenate([ids, ids[far]]), np.concatenate([count.astype(np.int64), ids[low[far]]])


def cap_links(unique: DataFrame, filters: int, cosine: float, tile: int = TILE) -> DataFrame:
    """``kind, a, b`` as in ``_links`` for ``unique`` rows ``k`` (key), ``n`` (copies), ``v`` (ARRAY<FLOAT> or ARRAY<DOUBLE>)."""
    width = 4 if unique.schema["v"].dataType.elementType.typeName() == "float" else 8

    def decode(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            rows = _ragged(b.column(2))
            lists: list = [None] * len(rows)
            for dim in {len(r) for r in rows}:
                at = [k for k, r in enumerate(rows) if len(r) == dim]
                for k, found in zip(at, caps_for(dim, filters, cosine).lists(_unit(np.array([rows[k] for k in at]))), strict=True):
                    lists[k] = found
            # Vectors keep their own width in shuffles, as bytes.
            own = [b.column(0), b.column(1), pa.array([len(r) for r in rows], pa.int32()), pa.array([r.astype(f"<f{width}").tobytes() for r in rows], pa.binary())]
            yield pa.RecordBatch.from_arrays([*own, pa.array([len(x) for x in lists], pa.int32()), pa.array([x.astype("<i4").tobytes() for x in lists], pa.binary()), pa.array(lists, pa.list_(pa.int32()))], ["k", "n", "dim", "v", "c", "f", "caps"])

    passed = staged(unique.select("k", "n", "v").mapInArrow(decode, "k long, n long, dim int, v binary, c int, f binary, caps array<int>"))
    caps = passed.select("dim", F.explode("caps").alias("cap"))
    crowded = caps.groupBy("dim", "cap").agg(F.count("*").alias("c")).where(F.col("c") > tile).select("dim", "cap", F.ceil(F.col("c") / tile).cast("int").alias("tiles"))
    crowded = staged(crowded)
    dealt = passed.select("dim", F.explode("caps").alias("cap"), "k", "n", "v", "c", "f")
    if crowded.count() <= BROADCAST:
        rows = dealt.join(F.broadcast(crowded), ["dim", "cap"], "left").withColumn("tiles", F.coalesce("tiles", F.lit(1)))
    else:
        # Crowded buckets are many: what is dealt out is the list of a vector's filters, not the vectors.
        sizes = passed.select("k", "dim", F.explode("caps").alias("cap")).join(crowded.hint("shuffle_hash"), ["dim", "cap"])
        several = sizes.groupBy("k").agg(F.map_from_entries(F.collect_list(F.struct("cap", "tiles"))).alias("m"))
        rows = passed.join(several, "k", "left").select("dim", F.explode("caps").alias("cap"), "k", "n", "v", "c", "f", "m").withColumn("tiles", F.coalesce(F.try_element_at("m", F.col("cap")), F.lit(1))).drop("m")
    tiles = staged(
        rows.groupBy("dim", "cap", "tiles", F.pmod(F.xxhash64("k"), F.col("tiles")).cast("int").alias("tile")).agg(
            F.collect_list(F.struct("k", "n", "v", "c", "f")).alias("one")
        )
    )
    split = tiles.where("tiles > 1")
    left = split.withColumn("tile2", F.explode(F.sequence("tile", F.col("tiles") - 1))).where("tile2 > tile")
    right = split.select("dim", "cap", F.col("tile").alias("tile2"), F.col("one").alias("two"))
    alone = tiles.where((F.col("tiles") > 1) | (F.size("one") > 1)).select("cap", "dim", "one", F.lit(None).cast(tiles.schema["one"].dataType).alias("two"))
    pairs = alone.unionByName(left.join(right, ["dim", "cap", "tile2"]).select("cap", "dim", "one", "two"))

    def compare(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            found = []
            for k in range(b.num_rows):
                dim = b.column(1)[k].as_py()
                one, two = (Tile.read(c[k].values, dim) if c[k].is_valid else None for c in (b.column(2), b.column(3)))
                found.append(_links(b.column(0)[k].as_py(), one, two, cosine))
            if found:
                yield pa.RecordBatch.from_arrays([pa.array(np.concatenate([x[c] for x in found])) for c in range(3)], ["kind", "a", "b"])

    return pairs.mapInArrow(compare, "kind long, a long, b long")


def vector_groups(
    vectors: DataFrame, id_col: str = "vec_id", vec_col: str = "embedding", cosine: float = 0.95, filters: int | None = None, tile: int = TILE
) -> DataFrame:
    """``id_col, n_links, component_id, kept`` of each row.

    Rows link if the cosine of their vectors, in double precision, is at least
    ``cosine``; every link found is verified. Vectors that are null, empty, zero
    or hold null or non-finite components link with nothing, and vectors of
    different lengths do not link with each other. Equal vectors are compared
    once and link with each other. Rows without an id are left out; repeated
    rows are rows like any other and are returned as often as they occur; an
    empty table gives an empty result; other columns are ignored.
    Of pairs at ``cosine`` itself about WANTED are found, whatever the vectors'
    length and the number of filters; nearer pairs are found more often.
    ``filters`` is the most there are; it follows from the number of rows if it
    is not given. A bucket of more than ``tile`` vectors is compared in tiles.
    """
    bounded_batches(vectors.sparkSession)
    own = vectors.schema[vec_col].dataType
    kind = "float" if isinstance(own, T.ArrayType) and isinstance(own.elementType, T.FloatType) else "double"
    rows = vectors.where(F.col(id_col).isNotNull()).select(F.col(id_col).cast("long").alias("id"), F.col(vec_col).cast(f"array<{kind}>").alias("v"))
    fit = F.coalesce((F.size("v") > 0) & F.forall("v", lambda x: x.isNotNull() & ~F.isnan(x) & (F.abs(x) < float("inf"))) & F.exists("v", lambda x: x != 0), F.lit(False))
    good = rows.where(fit)
    unique = staged(good.groupBy("v").agg(F.min("id").alias("id"), F.count("*").alias("n")).withColumn("k", F.monotonically_increasing_id()))
    if filters is None:
        filters = min(FILTERS[1], max(FILTERS[0], unique.count() // VECTORS))
    found = staged(cap_links(unique, filters, cosine, tile))
    near = found.where("kind = 0").groupBy(F.col("a").alias("k")).agg(F.sum("b").alias("links"))
    joined = components(found.where("kind = 1").select("a", "b")).select(F.col("id").alias("k"), "component")
    named = unique.join(joined, "k", "left").withColumn("component", F.coalesce("component", "k"))
    lowest = named.groupBy("component").agg(F.min("id").alias("component_id"))
    classes = (
        named.join(lowest, "component").join(near, "k", "left")
        .select("v", (F.col("n") - 1 + F.coalesce("links", F.lit(0))).alias("n_links"), "component_id")
    )
    linked = spread_join(good, classes, ["v"]).select("id", "n_links", "component_id")
    alone = rows.where(~fit).select("id", F.lit(0).cast("long").alias("n_links"), F.col("id").alias("component_id"))
    out = linked.unionByName(alone)
    return out.select(F.col("id").alias(id_col), "n_links", "component_id", (F.col("id") == F.col("component_id")).alias("kept"))
