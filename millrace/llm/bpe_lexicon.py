"""BPE encoding through a minimal acyclic transducer of frequent words."""

from __future__ import annotations

import hashlib
import json
import mmap
import os
import tempfile
from array import array
from collections.abc import Iterable, Iterator

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark import SparkFiles
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from .common import bounded_batches, most_frequent, word_counts, words_in
from .pretokens import Bpe, Merger, Pieces, default_tokenizer, letters, packer

#: Words in the lexicon at most; all other words are merged.
LEXICON_WORDS = 50_000
#: Longer words are not counted for it.
LEXICON_BYTES = 64
_BYTE = [bytes([k]) for k in range(256)]
#: Bytes of words: ASCII letters and digits, and all of other characters.
_WORD = np.array([k >= 0x80 or chr(k).isalnum() for k in range(256)])
_tables: dict = {}
_shared: dict[str, set] = {}


class Lexicon:
    """Words with id outputs in an automaton that shares prefixes and suffixes.

    Each arc holds how many words come before those behind it, so a walk gives
    the word's number, and that number's slot holds its ids. The arrays lie in
    one file, which is mapped read-only.
    """

    def __init__(self, buffer: mmap.mmap):
        self.buffer = buffer
        size = int.from_bytes(buffer[:4], "little")
        head = json.loads(buffer[4 : 4 + size])
        view = memoryview(buffer)
        self.width = head["width"]
        part = {k: (a, n) for k, a, n in head["parts"]}
        ints = lambda k: view[part[k][0] : part[k][0] + part[k][1]].cast("I")
        self.first, self.target, self.skip, self.slot = ints("first"), ints("target"), ints("skip"), ints("slot")
        self.final = view[part["final"][0] : part["final"][0] + part["final"][1]]
        self.labels, self.ids = part["labels"][0], part["ids"][0]
        # An arc's state and label in one number: in order, as the arcs are.
        state = np.repeat(np.arange(len(self.first) - 1), np.diff(np.asarray(self.first).astype(np.int64)))
        self.arcs = state * 256 + np.frombuffer(buffer, np.uint8, part["labels"][1], self.labels)

    @classmethod
    def open(cls, path: str) -> Lexicon:
        with open(path, "rb") as f:
            return cls(mmap.mmap(f.fileno(), 0, access=mmap.ACCESS_READ))

    def __len__(self) -> int:
        return len(self.slot) - 1

    def get(self, word: bytes) -> bytes | None:
        """The word's packed ids, None if it is not in the lexicon."""
        first, find, base, state, number = self.first, self.buffer.find, self.labels, 0, 0
        for c in word:
            arc = find(_BYTE[c], base + first[state], base + first[state + 1]) - base
            if arc < 0:
                return None
            number += self.skip[arc]
            state = self.target[arc]
        if not self.final[state]:
            return None
        return self.buffer[self.ids + self.slot[number] * self.width : self.ids + self.slot[number + 1] * self.width]

    def get_many(self, words: list[bytes]) -> list[bytes | None]:
        """The same for many words, all walked a byte at a time together."""
        out: list[bytes | None] = [None] * len(words)
        if not len(self.arcs):
            return out
        text = np.frombuffer(b"".join(words), np.uint8)
        lens = np.fromiter(map(len, words), np.int64, len(words))
        start = np.cumsum(lens) - lens
        target, skip = np.asarray(self.target), np.asarray(self.skip)
        live = np.flatnonzero(lens > 0)
        state, number = np.zeros(len(words), np.int64), np.zeros(len(words), np.int64)
        ended, step = [], 0
        while len(live):
            key = state[live] * 256 + text[start[live] + step]
            arc = np.minimum(np.searchsorted(self.arcs, key), len(self.arcs) - 1)
            found = self.arcs[arc] == key
            live, arc = live[found], arc[found]
            number[live] += skip[arc]
            state[live] = target[arc]
            step += 1
            ends = lens[live] == step
            ended.append(live[ends])
            live = live[~ends]
        at = np.concatenate(ended) if ended else live
        at = at[np.asarray(self.final)[state[at]] > 0]
        slot = np.asarray(self.slot).astype(np.int64) * self.width + self.ids
        for k, a, b in zip(at.tolist(), slot[number[at]].tolist(), slot[number[at] + 1].tolist(), strict=True):
            out[k] = self.buffer[a:b]
        return out


def compile_lexicon(words: Iterable[tuple[bytes, bytes]], width: int) -> bytes:
    """``words``: distinct, with their packed ids of ``width`` bytes each.

    States are made minimal while the sorted words are read: once no later word
    can change a state, it is replaced by an equal one met before.
    """
    words = sorted(words)
    known: dict = {}
    path: list[list] = [[False, []]]  # [final, [(label, state number)]] of the states on the last word's path
    number: list[tuple] = []

    def settle(depth: int) -> None:
        while len(path) > depth:
            final, arcs = path.pop()
            key = (final, tuple(arcs))
            if key not in known:
                known[key] = len(number)
                number.append(key)
            label = last[len(path) - 1]
            path[-1][1].append((label, known[key]))

    last = b""
    for word, _ in words:
        same = next((k for k, (a, b) in enumerate(zip(last, word, strict=False)) if a != b), min(len(last), len(word)))
        settle(same + 1)
        path.extend([False, []] for _ in word[same:])
        path[-1][0] = True
        last = word
    settle(1)
    # The start comes first, states it leads to after; a state's arcs are sorted as the words are.
    states = [(path[0][0], tuple(path[0][1])), *number]
    below = [0] * len(states)
    for k, (final, arcs) in enumerate(number, 1):
        below[k] = final + sum(below[t + 1] for _, t in arcs)
    first, labels, target, skip = array("I", [0]), bytearray(), array("I"), array("I")
    for final, arcs in states:
        before = int(final)
        for label, t in arcs:
            labels.append(label)
            target.append(t + 1)
            skip.append(before)
            before += below[t + 1]
        first.append(len(labels))
    slot = array("I", [0])
    for _, ids in words:
        slot.append(slot[-1] + len(ids) // width)
    body = {"first": first.tobytes(), "target": target.tobytes(), "skip": skip.tobytes(), "slot": slot.tobytes(), "final": bytes(f for f, _ in states), "labels": bytes(labels), "ids": b"".join(i for _, i in words)}
    at, parts, out = 4096, [], bytearray()
    for k, data in body.items():
        parts.append([k, at + len(out), len(data)])
        out += data + bytes(-len(data) % 8)
    head = json.dumps({"width": width, "parts": parts}).encode()
    return (len(head).to_bytes(4, "little") + head).ljust(at, b"\0") + bytes(out)


def frequent_words(docs: DataFrame, text_col: str = "text", most: int = LEXICON_WORDS) -> list[str]:
    """The most frequent words of all texts, with a space before them: at most ``most``."""
    bounded_batches(docs.sparkSession)
    counts = word_counts(docs.select(F.col(text_col).cast("binary")), lambda t: words_in(t, _WORD, False)[0])
    return [f" {w.decode()}" for w, _ in most_frequent(counts.where(F.octet_length("w").between(1, LEXICON_BYTES - 1)), most)]


def build_lexicon(docs: DataFrame, path: str, text_col: str = "text", most: int = LEXICON_WORDS) -> bytes:
    code, _ = packer(path)
    encode = Pieces(path, Merger(Bpe(path), code))
    words = [w for w in frequent_words(docs, text_col, most) if not any(s in w for s in encode.special)]
    width = encode.kind.itemsize
    ids, n = encode.values(words)
    data, ends = ids.tobytes(), (np.cumsum(n) * width).tolist()
    return compile_lexicon(((w.encode(), data[a:b]) for w, a, b in zip(words, [0, *ends], ends)), width)  # noqa: B905


class Codec:
    """Texts to ids and back, exactly as the tokenizer file says."""

    def __init__(self, path: str, lexicon: Lexicon):
        bpe = Bpe(path)
        self.pieces = Pieces(path, Merger(bpe, packer(path)[0]), known=lexicon.get_many)
        byte_of = letters()
        tokens = {i: t for t, i in bpe.vocab.items()} | {i: t for t, i in self.pieces.special.items()}
        self.bytes_of = pa.array(
            [bytes(byte_of[c] for c in t) if all(c in byte_of for c in t) else t.encode() for t in (tokens.get(i, "") for i in range(max(tokens) + 1))], pa.large_binary()
        )
        self.text_of = pa.array([str(i) for i in range(len(self.bytes_of))], pa.large_string())

    def encode(self, texts: pa.Array | list[str]) -> pa.LargeListArray:
        """Lists of ids."""
        ids, n = self.pieces.values(texts)
        return pa.LargeListArray.from_arrays(np.concatenate([[0], np.cumsum(n)]), ids.astype(np.int32))

    def _joined(self, rows: pa.LargeListArray, table: pa.Array, mark: pa.Scalar) -> pa.Array:
        return pc.binary_join(pa.LargeListArray.from_arrays(rows.offsets, table.take(rows.values)), mark)

    def decimal(self, rows: pa.LargeListArray) -> list[str]:
        return self._joined(rows, self.text_of, pa.scalar(",", pa.large_string())).to_pylist()

    def decode(self, rows: pa.LargeListArray) -> list[str]:
        return [t.decode("utf-8", "replace") for t in self._joined(rows, self.bytes_of, pa.scalar(b"", pa.large_binary())).to_pylist()]


def share_lexicon(spark: SparkSession, data: bytes) -> str:
    """Hand the lexicon, whose size ``most`` bounds, to all machines as a file; its name there.

    Spark fetches the file once for each executor, and the Python workers on it map the same pages.
    """
    name = f"lexicon-{hashlib.sha256(data).hexdigest()}"
    if name not in _shared.setdefault(spark.sparkContext.applicationId, set()):
        path = os.path.join(tempfile.mkdtemp(prefix="spark-"), name)
        with open(path, "wb") as f:
            f.write(data)
        spark.sparkContext.addFile(path)  # served from here as long as the application runs
        _shared[spark.sparkContext.applicationId].add(name)
    return name


def bpe_codec(
    docs: DataFrame, path: str | None = None, id_col: str = "doc_id", text_col: str = "text", most: int = LEXICON_WORDS, texts: bool = False
) -> DataFrame:
    """``id_col, n_tokens, ids_sha256, decoded_sha256`` of each row's whole text.

    With ``texts`` also ``ids`` (ARRAY<INT>) and ``decoded``. Rows without an
    id are left out, a null text is empty, repeated rows are returned as often
    as they occur, other columns are ignored.
    """
    spark = docs.sparkSession
    bounded_batches(spark)
    path = path or default_tokenizer()
    name = share_lexicon(spark, build_lexicon(docs, path, text_col, most))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        if name not in _tables:
            _tables.clear()
            _tables[name] = Codec(path, Lexicon.open(SparkFiles.get(name)))
        codec, sha = _tables[name], hashlib.sha256
        for b in batches:
            rows = codec.encode(b.column(1))
            back = codec.decode(rows)
            cols = [
                b.column(0),
                rows.value_lengths(),
                pa.array([sha(t.encode()).hexdigest() for t in codec.decimal(rows)], pa.string()),
                pa.array([sha(t.encode()).hexdigest() for t in back], pa.string()),
            ]
            if texts:
                cols += [rows.cast(pa.list_(pa.int32())), pa.array(back, pa.string())]
            yield pa.RecordBatch.from_arrays(cols, names)

    names = [id_col, "n_tokens", "ids_sha256", "decoded_sha256"] + ["ids", "decoded"] * texts
    kind = f"`{id_col}` long, n_tokens long, ids_sha256 string, decoded_sha256 string" + ", ids array<int>, decoded string" * texts
    return docs.where(F.col(id_col).isNotNull()).select(F.col(id_col).cast("long"), text_col).mapInArrow(run, kind)
