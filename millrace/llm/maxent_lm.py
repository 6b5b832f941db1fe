"""Language-model scores from a hashed maximum-entropy model."""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass, replace

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .common import bounded_batches, most_frequent, staged, words_in

#: The end of a text; no word holds white space.
END = b"\n"
#: Words whose counts every task holds; the counts of all others come by a join.
HEAD = 150_000
#: Classes of words, most frequent words first, and the words in each. One more class holds all other words.
CLASSES, MEMBERS = 32, 64
#: Words with fewer than so many more frequent ones stand for themselves in contexts, others for their leaf.
CONTEXTS = 16_384
#: Words of the last class are put in order and cut into leaves of a tree: children of a node, and levels at most.
BRANCH, LEVELS = 32, 4
#: Words to a leaf, about, that make for two levels, and for more.
LEAF, CROWDED = 16, 8192
#: Words to a leaf, about, that the leaves' bounds are taken from.
SAMPLED = 64
#: Bytes of a word that its place in the order follows from.
PREFIX = 7
#: Rows of hashed weights at least, powers of two: for classes, for the words of a class, and for the nodes of the tree.
CLASS_ROWS, WORD_ROWS, TREE_ROWS = 1 << 14, 1 << 15, 1 << 14
#: Training tokens for each row of classes, about; the tables grow to so many times their least size.
ROW_TOKENS, GROWN = 1 << 11, 8
FEATURES = 3
#: The training texts are dealt into as many rounds; after each the tasks' updates are mixed.
ROUNDS = 2
#: Training tokens for each task at least, times the growth of the tables, so that updates stay small against the texts.
TASK_TOKENS = 2_000_000
RATE, CHUNK = 0.25, 64
#: Tokens of one gradient step, and tokens that are scored together.
STEP, SCORED = 32_768, 8192
_MASK = np.float32(-1e9)


def depth_of(words: int) -> int:
    """Levels of the tree for so many words."""
    depth = 0
    while depth < LEVELS and words > (LEAF if depth < 2 else CROWDED) * BRANCH**depth:
        depth += 1
    return depth


def _order(rows: np.ndarray, n: int) -> np.ndarray:
    """Stable order of row numbers below ``n``, by halves that numpy sorts by radix."""
    order = np.argsort(rows.astype(np.uint16), kind="stable")
    if n > 1 << 16:
        order = order[np.argsort((rows[order] >> 16).astype(np.uint16), kind="stable")]
    return order


def segment_sums(rows: np.ndarray, order: np.ndarray, first: np.ndarray) -> np.ndarray:
    """Sums of ``rows[order]`` over segments that begin at ``first``: short ones by their length together, long ones by eights."""
    lens = np.diff(np.append(first, len(order)))
    out = np.empty((len(first), rows.shape[1]), np.float32)
    for n in range(1, 8):
        at = np.flatnonzero(lens == n)
        part = rows.take(order[first[at]], 0)
        for k in range(1, n):
            part += rows.take(order[first[at] + k], 0)
        out[at] = part
    at = np.flatnonzero(lens >= 8)
    if len(at):
        eights = (lens[at] + 7) >> 3
        begins = np.cumsum(eights) - eights
        place = (np.repeat(first[at] - 8 * begins, eights) + 8 * np.arange(eights.sum()))[:, None] + np.arange(8)
        over = place >= np.repeat(first[at] + lens[at], eights)[:, None]
        part = rows.take(order[np.where(over, 0, place)].ravel(), 0)
        part[over.ravel()] = 0
        part = part.reshape(-1, 8, rows.shape[1]).sum(1)
        out[at] = segment_sums(part, np.arange(len(part)), begins)
    return out


def _sums(bias: np.ndarray, weights: np.ndarray, rows: np.ndarray) -> np.ndarray:
    """Logits, kept to where their exponentials are finite."""
    z = bias + weights.take(rows[0], 0)
    part = np.empty_like(z)
    for r in rows[1:]:
        z += weights.take(r, 0, part, "clip")
    return np.minimum(z, 60, out=z)


@dataclass
class Model:
    """Weights and what words mean to them.

    A word of the vocabulary is its rank; rank // MEMBERS is its class. The
    probability of a word is that of its class times that within the class,
    both softmaxes over sums of hashed weights for the features of the two
    words before: the last, the one before it (a skip) and the pair. All other
    words are leaves of a tree by their hash, and the choice of a child at each
    node is a softmax of the same features; the words of a leaf share its
    probability by their counts. Numbers of words beyond ``head`` hold the hash.
    """

    class_bias: np.ndarray
    word_bias: np.ndarray
    class_rows: np.ndarray
    word_rows: np.ndarray
    vocabulary: int
    head: int
    leaf_of: np.ndarray
    tree_bias: np.ndarray
    tree_rows: np.ndarray
    leaves: np.ndarray
    depth: int = 0

    @classmethod
    def start(cls, counts: np.ndarray, leaves: np.ndarray, leaf_of: np.ndarray | None = None, grown: int = 1) -> Model:
        """Starts from the unigrams. ``counts``: of the vocabulary by rank; ``leaves``: tokens of other words by leaf.

        ``leaf_of``: leaves of words by rank; ``grown``: size of the tables as
        times the least.
        """
        leaves = leaves.astype(np.float64) + 1
        depth = round(np.log(len(leaves)) / np.log(BRANCH))
        sums = [leaves.reshape(BRANCH**level, BRANCH, -1).sum(2) for level in range(depth)]
        tree_bias = np.concatenate([np.log(x / x.sum(1, keepdims=True)) for x in sums]) if sums else np.zeros((0, BRANCH))
        size = np.zeros((CLASSES, MEMBERS), np.float64)
        size.ravel()[: len(counts)] = counts
        with np.errstate(divide="ignore", invalid="ignore"):
            word_bias = np.where(size > 0, np.log(size / size.sum(1, keepdims=True)), _MASK)
            total = np.append(size.sum(1), leaves.sum())
            class_bias = np.where(total > 0, np.log(total / total.sum()), _MASK)
        zero = lambda *n: np.zeros(n, np.float32)
        return cls(class_bias.astype(np.float32), word_bias.astype(np.float32), zero(CLASS_ROWS * grown, CLASSES + 1), zero(WORD_ROWS * grown, MEMBERS), len(counts),
                   0 if leaf_of is None else len(leaf_of), np.zeros(0, np.int64) if leaf_of is None else leaf_of,
                   tree_bias.astype(np.float32), zero(TREE_ROWS * grown if depth else 0, BRANCH), np.log(leaves), depth)

    @property
    def tables(self) -> list[np.ndarray]:
        return [self.class_rows, self.word_rows, *([self.tree_rows] if self.depth else [])]

    def leaf(self, word: np.ndarray) -> np.ndarray:
        """Leaves of words outside the vocabulary."""
        out = word - self.head - 2
        known = word < self.head
        out[known] = self.leaf_of[word[known]]
        return out

    def features(self, one: np.ndarray, two: np.ndarray) -> np.ndarray:
        """Hashes of the contexts, one line for each feature. ``one``: the word before, ``two``: the one before that."""
        a, b = one.astype(np.uint64) + np.uint64(3), two.astype(np.uint64) + np.uint64(3)
        mix = lambda x: (x ^ (x >> np.uint64(29))) * np.uint64(0xBF58476D1CE4E5B9)
        return np.stack([mix(a * np.uint64(0x9E3779B97F4A7C15)), mix(b * np.uint64(0xC2B2AE3D27D4EB4F)), mix(a * np.uint64(0x165667B19E3779F9) + b * np.uint64(0x27D4EB2F165667C5))])

    def _sides(self, word: np.ndarray, hashed: np.ndarray):
        known = word < self.vocabulary
        klass = np.where(known, word // MEMBERS, CLASSES)
        rows = (hashed >> np.uint64(20)) & np.uint64(len(self.class_rows) - 1)
        yield self.class_rows, rows.astype(np.int64), self.class_bias[None, :], klass, None
        at = np.flatnonzero(known)
        k = klass[at]
        rows = ((hashed[:, at] + k.astype(np.uint64) * np.uint64(0x9FB21C651E98DF25)) >> np.uint64(24)) & np.uint64(len(self.word_rows) - 1)
        yield self.word_rows, rows.astype(np.int64), self.word_bias[k], word[at] % MEMBERS, at
        if self.depth:
            at = np.flatnonzero(~known)
            leaf = self.leaf(word[at])
            # All levels in a row; nodes are numbered level by level.
            nodes = np.concatenate([leaf // BRANCH ** (self.depth - k) + (BRANCH**k - 1) // (BRANCH - 1) for k in range(self.depth)])
            goal = np.concatenate([leaf // BRANCH ** (self.depth - k - 1) % BRANCH for k in range(self.depth)])
            rows = np.tile(hashed[:, at], self.depth) + (nodes + 1).astype(np.uint64) * np.uint64(0xD6E8FEB86659FD93)
            rows = ((rows ^ (rows >> np.uint64(32))) * np.uint64(0x9E3779B97F4A7C15) >> np.uint64(24)) & np.uint64(len(self.tree_rows) - 1)
            yield self.tree_rows, rows.astype(np.int64), self.tree_bias[nodes], goal, np.tile(at, self.depth)

    def score(self, word: np.ndarray, one: np.ndarray, two: np.ndarray) -> np.ndarray:
        """Natural logarithms; for a word outside the vocabulary, of its leaf, less that of the leaf's tokens and one."""
        out = np.empty(len(word), np.float64)
        for k in range(0, len(word), SCORED):
            w = word[k : k + SCORED]
            part = np.zeros(len(w))
            for weights, rows, bias, goal, at in self._sides(w, self.features(one[k : k + SCORED], two[k : k + SCORED])):
                z = _sums(bias, weights, rows)
                value = z[np.arange(len(goal)), goal]
                value = value - np.log(np.exp(z, out=z) @ np.ones(z.shape[1], np.float32))
                if at is None:
                    part += value
                else:
                    part += np.bincount(at, value, len(part))
            other = np.flatnonzero(w >= self.vocabulary)
            part[other] -= self.leaves[self.leaf(w[other])]
            out[k : k + SCORED] = part
        return out

    def train(self, word: np.ndarray, one: np.ndarray, two: np.ndarray, squares: list[np.ndarray]) -> None:
        """Gradient steps over these tokens; ``squares`` holds the sums of squared gradients of each row."""
        for k in range(0, len(word), STEP):
            sides = self._sides(word[k : k + STEP], self.features(one[k : k + STEP], two[k : k + STEP]))
            for (weights, rows, bias, goal, _), square in zip(sides, squares, strict=True):
                if not len(goal):
                    continue
                z = _sums(bias, weights, rows)
                np.exp(z, out=z)
                z *= (1 / (z @ np.ones(z.shape[1], np.float32)))[:, None]
                z[np.arange(len(goal)), goal] -= 1
                flat = rows.ravel()
                order = _order(flat, len(weights))
                flat = flat[order]
                first = np.flatnonzero(np.concatenate([[True], flat[1:] != flat[:-1]]))
                slope = segment_sums(z, order % len(goal), first)
                at = flat[first]
                total = square[at] + np.einsum("ij,ij->i", slope, slope) / slope.shape[1]
                square[at] = total
                slope *= (-RATE / np.sqrt(total + 1))[:, None]
                slope += weights.take(at, 0)
                weights[at] = slope


def _contexts(word: np.ndarray, n: np.ndarray, none: int) -> tuple[np.ndarray, np.ndarray]:
    """The two tokens before each of texts of ``n`` tokens in a row; ``none`` stands before a text."""
    one, two = np.roll(word, 1), np.roll(word, 2)
    starts = np.cumsum(n) - n
    one[starts] = none
    two[starts] = none
    two[starts[n > 1] + 1] = none
    return one, two


def _keys(words: pa.LargeBinaryArray) -> np.ndarray:
    """The first bytes of words as numbers in the same order."""
    _, where, data = words.buffers()
    at = np.frombuffer(where, np.int64)[words.offset : words.offset + len(words) + 1]
    raw = np.concatenate([np.frombuffer(data, np.uint8)[: at[-1]], np.zeros(8, np.uint8)])
    first = np.ndarray(len(raw) - 7, ">u8", raw.data, strides=(1,))[at[:-1]].astype(np.uint64)
    cut = np.uint64(8) * (np.uint64(8) - np.minimum(np.diff(at), PREFIX).astype(np.uint64))
    return (first >> cut << cut >> np.uint64(8)).astype(np.int64)


@dataclass
class Numbers:
    """What gives words their numbers: the head, most frequent first, with counts and leaves, and the bounds of leaves."""

    head: pa.LargeBinaryArray
    n: np.ndarray
    bounds: np.ndarray
    leaf: np.ndarray

    @property
    def none(self) -> int:
        return min(len(self.head), CONTEXTS) + 1

    def read(self, texts: pa.Array) -> tuple[np.ndarray, np.ndarray, np.ndarray, pa.LargeBinaryArray, np.ndarray]:
        """Numbers of all tokens, ends included, tokens of each text, ranks in the head (-1: not there); distinct places of words, and which one each token is."""
        words, n = words_in(texts)
        order = np.insert(np.arange(len(words)), np.cumsum(n), len(words))
        words = pa.concat_arrays([words, pa.array([END], pa.large_binary())])
        rank = pc.fill_null(pc.index_in(words, self.head), -1).to_numpy(zero_copy_only=False).astype(np.int64)
        leaf = np.append(self.leaf, 0)[rank]
        other = np.flatnonzero(rank < 0)
        leaf[other] = np.searchsorted(self.bounds, _keys(words.take(other)), "right")
        itself = (np.append(self.n, 0)[rank] > 0) & (rank < CONTEXTS)
        number = np.where(itself, rank, self.none + 1 + leaf)
        return number[order], n + 1, rank[order], words, order


def _numbered(docs: DataFrame, numbers, tasks: int, wide: bool) -> DataFrame:
    """The words' numbers of each text, dealt to ``tasks`` tasks and put in order by a hash of the id.

    So each task meets the same texts in the same order, however the rows lie
    in files; numbers, not texts, are shuffled.
    """

    def read(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            if b.num_rows:
                word, n, _, _, _ = numbers.value.read(b.column(1))
                data, ends = word.astype("<i4" if wide else "<u2").tobytes(), np.cumsum(n) * (4 if wide else 2)
                parts = [data[x:y] for x, y in zip([0, *ends.tolist()], ends.tolist())]  # noqa: B905
                yield pa.RecordBatch.from_arrays([b.column(0), pa.array(parts, pa.binary())], ["h", "words"])

    rows = docs.select(F.xxhash64("id").alias("h"), "t").mapInArrow(read, "h long, words binary")
    # As many tasks as were asked for, whatever the session makes of the number: each sends its own changes.
    return rows.repartition(tasks, "h").sortWithinPartitions("h", "words").select("words").coalesce(tasks)


def _train(texts: DataFrame, shared, numbers, wide: bool) -> list[tuple[int, int, bytes]]:
    """One round: each task takes gradient steps from the shared weights; changes of rows are averaged over the tasks that changed them."""

    def steps(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        model, words = shared.value, numbers.value
        old = model.tables
        model = replace(model, class_rows=old[0].copy(), word_rows=old[1].copy(), tree_rows=model.tree_rows.copy())
        squares = [np.zeros(len(w), np.float32) for w in old]
        kind = np.dtype("<i4" if wide else "<u2")
        for b in batches:
            if b.num_rows:
                word = np.frombuffer(b"".join(b.column(0).to_pylist()), kind).astype(np.int64)
                n = pc.binary_length(b.column(0)).to_numpy().astype(np.int64) // kind.itemsize
                model.train(word, *_contexts(word, n, words.none), squares)
        out = []
        for table, (before, after) in enumerate(zip(old, model.tables, strict=True)):
            change = (after - before).astype(np.float16)
            for k in range(0, len(change), CHUNK):
                part = change[k : k + CHUNK]
                if part.any():
                    out.append({"t": table, "k": k, "d": part.tobytes()})
        if out:
            yield pa.RecordBatch.from_pylist(out, pa.schema([("t", pa.int32()), ("k", pa.int32()), ("d", pa.binary())]))

    def mix(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        sums: dict = {}
        for b in batches:
            for t, k, d in zip(*(b.column(c).to_pylist() for c in range(3)), strict=True):
                part = np.frombuffer(d, np.float16).astype(np.float32).reshape(CHUNK, -1)
                total, times = sums.setdefault((t, k), (np.zeros_like(part), np.zeros((CHUNK, 1), np.float32)))
                total += part
                times += part.any(1, keepdims=True)
        for (t, k), (total, times) in sums.items():
            row = {"t": t, "k": k, "d": (total / np.maximum(times, 1)).astype(np.float16).tobytes()}
            yield pa.RecordBatch.from_pylist([row], pa.schema([("t", pa.int32()), ("k", pa.int32()), ("d", pa.binary())]))

    changes = texts.mapInArrow(steps, "t int, k int, d binary")
    # The model's changes alone come to the driver: 50 MB at most, by the rows above grown eight times.
    return [(r.t, r.k, bytes(r.d)) for r in changes.repartition("t", "k").mapInArrow(mix, "t int, k int, d binary").collect()]


def count_words(rows: DataFrame) -> DataFrame:
    """``w``, ``n`` (in training texts), ``every`` (in all) over ``t`` and ``held_out``; written to the shared folder."""

    def count(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            words, n = words_in(b.column(0))
            held = b.column(1).to_numpy(zero_copy_only=False).astype(bool)
            own = np.repeat(~held, n)
            coded = words.dictionary_encode()
            at = coded.indices.to_numpy(zero_copy_only=False)
            every = np.append(np.bincount(at, minlength=len(coded.dictionary)), len(held)).astype(np.int64)
            train = np.append(np.bincount(at[own], minlength=len(coded.dictionary)), (~held).sum()).astype(np.int64)
            yield pa.RecordBatch.from_arrays([pa.concat_arrays([coded.dictionary.cast(pa.binary()), pa.array([END], pa.binary())]), pa.array(train), pa.array(every)], ["w", "n", "every"])

    both = rows.select("t", "held_out").mapInArrow(count, "w binary, n long, every long")
    return staged(both.groupBy("w").agg(F.sum("n").alias("n"), F.sum("every").alias("every")))


def fit(train: DataFrame, counts: DataFrame, head: int = HEAD, rounds: int = ROUNDS) -> tuple[Model, Numbers, Tail, int, int]:
    """``train``: ``id`` and ``t`` (BINARY). Returns the model, the words' numbers, the share of other words, N and V."""
    spark = train.sparkSession
    seen = F.when(F.col("n") > 0, 1)
    total, distinct, once, twice = counts.agg(
        F.coalesce(F.sum("n"), F.lit(0)), F.count(seen), F.count_if(F.col("n") == 1), F.count_if(F.col("n") == 2)
    ).first()
    # By all texts: what is left has at most a ``head``-th of all tokens, held out or not, so no key of the later join is hot.
    top = sorted(most_frequent(counts.select("w", F.col("every").alias("n"), F.col("n").alias("own")), head, "own"), key=lambda x: (-x[2], x[0]))
    n = np.array([x[2] for x in top], np.int64)
    vocabulary = n[: CLASSES * MEMBERS]
    vocabulary = vocabulary[vocabulary > 0]
    depth = depth_of(distinct - len(vocabulary))

    def keyed(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in (x for x in batches if x.num_rows):
            yield pa.RecordBatch.from_arrays([pa.array(_keys(b.column(0).cast(pa.large_binary())))], ["key"])

    size = BRANCH**depth
    bounds = np.zeros(0, np.int64)
    if depth:
        # Words are chosen by their hash, so the bounds do not hang on how rows fall into tasks.
        most = max(8 * size, min(SAMPLED * size, 1 << 21))
        some = counts.where(F.pmod(F.xxhash64("w"), F.lit(1 << 40)) < int(min(1.0, most / counts.count()) * (1 << 40)))
        keys = np.sort(some.select("w").mapInArrow(keyed, "key long").toArrow()["key"].to_numpy())
        bounds = keys[np.arange(1, size) * len(keys) // size] if len(keys) else np.zeros(size - 1, np.int64)
    words = pa.array([x[0] for x in top], pa.large_binary())
    leaf_of = np.searchsorted(bounds, _keys(words), "right")
    numbers = Numbers(words, n, bounds, leaf_of)

    def sums(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        n, v = np.zeros((2, size), np.int64)
        for b in (x for x in batches if x.num_rows):
            at = np.searchsorted(bounds, _keys(b.column(0).cast(pa.large_binary())), "right")
            np.add.at(n, at, b.column(1).to_numpy())
            v += np.bincount(at, minlength=size)
        has = np.flatnonzero(v)
        yield pa.RecordBatch.from_arrays([pa.array(has.astype(np.int32)), pa.array(n[has]), pa.array(v[has])], ["leaf", "n", "v"])

    # Tasks add up their words, so at most BRANCH ** LEVELS rows each.
    by_leaf = counts.where("n > 0").select("w", "n").mapInArrow(sums, "leaf int, n long, v long")
    got = by_leaf.groupBy("leaf").agg(F.sum("n").alias("n"), F.sum("v").alias("v")).toArrow()
    tokens, types = np.zeros(size, np.int64), np.zeros(size, np.int64)
    tokens[got["leaf"].to_numpy()], types[got["leaf"].to_numpy()] = got["n"].to_numpy(), got["v"].to_numpy()
    np.subtract.at(tokens, leaf_of[: len(vocabulary)], vocabulary)
    np.subtract.at(types, leaf_of[: len(vocabulary)], 1)
    grown = 1
    while grown < GROWN and CLASS_ROWS * grown * 2 * ROW_TOKENS <= total:
        grown *= 2
    model = Model.start(vocabulary, tokens, leaf_of[: min(len(top), CONTEXTS)], grown)
    discount = min(0.9, max(0.1, once / (once + 2 * twice))) if once else 0.5
    shared_numbers = spark.sparkContext.broadcast(numbers)  # at most ``head`` words
    tasks = max(1, int(total // (TASK_TOKENS * grown)))
    wide = numbers.none + 1 + size > 1 << 16
    for r in range(rounds if total else 0):
        shared = spark.sparkContext.broadcast(model)
        part = train.where(F.pmod(F.xxhash64("id", F.lit(1)), F.lit(rounds)) == r)
        for t, k, d in _train(_numbered(part, shared_numbers, tasks, wide), shared, shared_numbers, wide):
            rows = model.tables[t]
            rows[k : k + CHUNK] += np.frombuffer(d, np.float16).astype(np.float32).reshape(CHUNK, -1)
    return model, numbers, Tail(discount, np.log10(discount * types + 1)), int(total), int(distinct)


@dataclass
class Tail:
    """Shares in a leaf: a word's tokens less a discount, and for an unseen word what is discounted, and one."""

    discount: float
    unseen: np.ndarray


def language_scores(
    docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", head: int = HEAD, rounds: int = ROUNDS, folds: int = 7, held_fold: int = 2
) -> DataFrame:
    """``id_col, held_out, n_tokens, n_known, train_tokens, base_score, score`` of each row.

    Tokens are runs without ASCII white space, ASCII capitals lower-cased, and
    one end for each text. Rows whose CRC-32 of the id, as text, modulo
    ``folds`` is ``held_fold`` are scored but not learned from. ``base_score``
    is the add-one unigram log10 probability, ``score`` the model's. The
    CLASSES * MEMBERS most frequent words are predicted one by one from the
    words before; any other has the probability of its leaf in a tree of all
    others, given the words before, times its share in the leaf. An unseen
    word has the share that the discount of the leaf's words leaves, so the
    probabilities of all words, and of one unseen word in each leaf, sum to
    one. Levels of the tree and rows of weights follow from the corpus.
    Texts are dealt to training tasks, and put in order there, by a hash of
    the id, so scores repeat but for rounding however the rows are partitioned.

    Null texts are empty (the end alone), rows without an id are left out,
    repeated rows are learned from and returned as often as they occur, other
    columns are ignored; an empty table gives an empty result. With nothing to
    learn from, all probabilities are one. A very long text is read whole by
    its task and learned from in steps of STEP tokens.

    Bounds that stay at any size: CLASSES * MEMBERS words with classes of their
    own, LEVELS levels of the tree, tables of GROWN times their least rows
    (from ROW_TOKENS * CLASS_ROWS * GROWN training tokens on), and words whose
    first PREFIX bytes agree share a leaf. What lies beyond them is hashed
    together, not left out.
    """
    spark = docs.sparkSession
    bounded_batches(spark)
    rows = docs.where(F.col(id_col).isNotNull()).select(
        F.col(id_col).cast("long").alias("id"),
        (F.pmod(F.crc32(F.col(id_col).cast("string")), F.lit(folds)) == held_fold).alias("held_out"),
        F.col(text_col).cast("binary").alias("t"),
    )
    counts = count_words(rows)
    return score_texts(rows, counts, fit(rows.where(~F.col("held_out")).select("id", "t"), counts, head, rounds), id_col)


def score_texts(rows: DataFrame, counts: DataFrame, fitted: tuple[Model, Numbers, Tail, int, int], id_col: str = "doc_id") -> DataFrame:
    """Scores of ``id``, ``held_out``, ``t`` as ``language_scores`` returns them, from what ``fit`` gave."""
    model, numbers, tail, total, distinct = fitted
    spark = rows.sparkSession
    shared = spark.sparkContext.broadcast((model, numbers, tail))

    def score(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        model, numbers, tail = shared.value
        count = np.append(numbers.n, 0)
        add_one = np.log10(count + 1.0)
        share = np.log10(np.maximum(count - tail.discount, 0.05))
        for b in batches:
            if not b.num_rows:
                continue
            word, n, rank, words, order = numbers.read(b.column(2))
            doc = np.repeat(np.arange(len(n)), n)
            add = lambda v: np.bincount(doc, v, len(n))  # noqa: B023, E731
            held, other = rank >= 0, word >= model.vocabulary
            # Words of the head that no training text has are unseen like any other.
            own = np.where(count[rank] > 0, share[rank], tail.unseen[np.where(held, np.append(numbers.leaf, 0)[rank], 0)])
            value = add(np.where(other & held, own, 0)) + add(model.score(word, *_contexts(word, n, numbers.none))) / np.log(10)
            at = np.flatnonzero(~held)
            coded = words.take(order[at]).dictionary_encode()
            pair, times = np.unique(doc[at] * max(1, len(coded.dictionary)) + coded.indices.to_numpy(zero_copy_only=False), return_counts=True)
            of, at = np.divmod(pair, max(1, len(coded.dictionary)))
            leaf = np.searchsorted(numbers.bounds, _keys(coded.dictionary), "right")[at]
            item = pa.StructArray.from_arrays([coded.dictionary.take(at).cast(pa.binary()), pa.array(times), pa.array(tail.unseen[leaf])], ["w", "m", "u"])
            lists = pa.ListArray.from_arrays(pa.array(np.searchsorted(of, np.arange(len(n) + 1)), pa.int32()), item)
            yield pa.RecordBatch.from_arrays(
                [b.column(0), b.column(1), pa.array(n), pa.array(add(held & (count[rank] > 0)).astype(np.int64)), pa.array(add(np.where(held, add_one[rank], 0))), pa.array(value), lists],
                ["id", "held_out", "n_tokens", "known", "logs", "value", "rare"],
            )

    kind = "id long, held_out boolean, n_tokens long, known long, logs double, value double, rare array<struct<w:binary,m:long,u:double>>"
    scored = staged(rows.mapInArrow(score, kind).withColumn("row", F.monotonically_increasing_id()))
    rare = scored.select("row", F.explode("rare").alias("r")).select("row", "r.*").join(counts.where("n > 0").select("w", "n"), "w", "left")
    more = rare.groupBy("row").agg(
        F.sum(F.when(F.col("n").isNotNull(), F.col("m"))).alias("more"),
        F.sum(F.col("m") * F.log10(F.col("n") + 1)).alias("more_logs"),
        F.sum(F.col("m") * F.coalesce(F.log10(F.col("n") - tail.discount), "u")).alias("more_value"),
    )
    nought = lambda c: F.coalesce(c, F.lit(0))
    return scored.drop("rare").join(more, "row", "left").select(
        F.col("id").alias(id_col), "held_out", "n_tokens", (F.col("known") + nought("more")).alias("n_known"), F.lit(total).cast("long").alias("train_tokens"),
        (F.col("logs") + nought("more_logs") - F.col("n_tokens") * F.log10(F.lit(float(total + distinct + 1)))).alias("base_score"),
        (F.col("value") + nought("more_value")).alias("score"),
    )
