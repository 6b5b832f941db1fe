"""Token ids in binary shards, each document compressed with a shared dictionary.

A shard is one row of a Parquet table, so that it can lie in any store that
Spark writes: ``index`` holds 16-byte entries (doc id int64, end of the
document's block uint64), ``blocks`` the compressed documents one after the
other, ``dictionary`` the hash of the dictionary they need, ``code`` the array
code of the ids, ``tokens_before`` the ids that lie before the shard in its
part. ``load_document`` reads one document without touching the others.
"""

from __future__ import annotations

import hashlib
import zlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import zstandard
from pyspark import TaskContext
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from tokenizers import Tokenizer

from .common import bounded_batches, hash_sample, staged
from .pretokens import Pieces, default_tokenizer, packer

LEVEL = 3
#: The dictionary is fitted on about this many documents, chosen by a hash, of at most this many characters.
SAMPLE_DOCS, SAMPLE_CHARS = 1500, 20_000
DICTIONARY_BYTES = 64 << 10
SHARD_BYTES = 4 << 20
ENTRY = np.dtype([("doc", "<i8"), ("end", "<u8")])
SHARD = "part int, seq int, first_id long, last_id long, n_docs long, n_tokens long, tokens_before long, code string, dictionary string, index binary, blocks binary"
_tables: dict = {}


def encode_ids(path: str, texts: pa.Array | list[str | None], end_id: int) -> list[bytes]:
    """The library's ids of each text, then ``end_id``, as packed integers. A piece is tokenized once."""
    if path not in _tables:
        model, (_, pack) = Tokenizer.from_file(path).model, packer(path)
        _tables[path] = Pieces(path, lambda ws: [pack([t.id for t in model.tokenize(w)]) for w in ws])
    pieces = _tables[path]
    ids, n = pieces.values(texts)
    ends = np.cumsum(n)
    data, width = np.insert(ids, ends, end_id).tobytes(), pieces.kind.itemsize
    stop = ((ends + np.arange(1, len(ends) + 1)) * width).tolist()
    return [data[a:b] for a, b in zip([0, *stop], stop)]  # noqa: B905


def train_dictionary(docs: DataFrame, path: str, end_id: int, id_col: str, text_col: str) -> bytes:
    """A zstandard dictionary from a bounded sample of serialized id arrays; empty if there is too little to learn from."""
    some = hash_sample(docs.where(F.col(id_col).isNotNull()), id_col, SAMPLE_DOCS)
    texts = some.where(F.length(text_col).between(1, SAMPLE_CHARS)).select(F.xxhash64(id_col).alias("h"), F.col(text_col).alias("t")).collect()
    texts.sort()
    samples = encode_ids(path, [r.t for r in texts], end_id)
    try:
        return zstandard.train_dictionary(DICTIONARY_BYTES, samples).as_bytes()
    except zstandard.ZstdError:
        return b""


def write_token_files(docs: DataFrame, to: str, path: str | None = None, end_id: int = 2, id_col: str = "doc_id", text_col: str = "text") -> None:
    """Write ``to/dictionary`` and ``to/shards`` in ascending id order.

    The dictionary is fitted on about SAMPLE_DOCS documents of at most
    SAMPLE_CHARS characters; all documents are written, whatever their length.

    Null texts are empty (their block holds the end id alone), rows without an
    id are left out, repeated ids are kept one after the other.
    """
    spark = docs.sparkSession
    bounded_batches(spark)
    path = path or default_tokenizer()
    code = packer(path)[0]
    raw = train_dictionary(docs, path, end_id, id_col, text_col)
    name = hashlib.sha256(raw).hexdigest()
    spark.createDataFrame([(name, bytearray(raw))], "hash string, data binary").coalesce(1).write.mode("overwrite").parquet(f"{to}/dictionary")
    shared = spark.sparkContext.broadcast(raw)  # at most DICTIONARY_BYTES

    def encode(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        press = zstandard.ZstdCompressor(level=LEVEL, dict_data=zstandard.ZstdCompressionDict(shared.value) if shared.value else None)
        width = 2 if code == "H" else 4
        for b in batches:
            ids = encode_ids(path, b.column(1), end_id)
            yield pa.RecordBatch.from_arrays(
                [b.column(0), pa.array([len(x) // width for x in ids], pa.int64()), pa.array([press.compress(x) for x in ids], pa.binary())],
                ["doc", "n", "block"],
            )

    def pack(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        part, seq, before, held, size, tokens = TaskContext.get().partitionId(), 0, 0, [], 0, 0

        def shard() -> pa.RecordBatch:
            index = np.zeros(len(held), ENTRY)
            index["doc"], index["end"] = [d for d, _ in held], np.cumsum([len(x) for _, x in held])
            row = (part, seq, held[0][0], held[-1][0], len(held), tokens, before, code, name, index.tobytes(), b"".join(x for _, x in held))
            return pa.RecordBatch.from_pylist([dict(zip(types.names, row, strict=True))], types)

        for b in batches:
            for doc, n, block in zip(*(b.column(k).to_pylist() for k in range(3)), strict=True):
                held.append((doc, block))
                size, tokens = size + len(block), tokens + n
                if size >= SHARD_BYTES:
                    yield shard()
                    seq, before, held, size, tokens = seq + 1, before + tokens, [], 0, 0
        if held:
            yield shard()

    kinds = {"int": pa.int32(), "long": pa.int64(), "string": pa.string(), "binary": pa.binary()}
    types = pa.schema([(n, kinds[k]) for n, k in (x.split() for x in SHARD.split(", "))])
    rows = docs.where(F.col(id_col).isNotNull()).select(F.col(id_col).cast("long"), text_col)
    blocks = staged(rows.mapInArrow(encode, "doc long, n long, block binary"))
    (
        blocks.repartitionByRange("doc").sortWithinPartitions("doc", "n", "block").mapInArrow(pack, SHARD)
        .write.mode("overwrite").parquet(f"{to}/shards")
    )


def read_dictionary(spark: SparkSession, at: str) -> tuple[str, bytes]:
    row = spark.read.parquet(f"{at}/dictionary").first()
    return row.hash, bytes(row.data)


def load_document(shard, k: int, dictionary: bytes) -> np.ndarray:
    """The ids of the ``k``-th document of a shard row; only its own block is decompressed."""
    index = np.frombuffer(shard["index"], ENTRY)
    start, end = int(index["end"][k - 1]) if k else 0, int(index["end"][k])
    if hashlib.sha256(dictionary).hexdigest() != shard["dictionary"]:
        raise ValueError("the shard was written with another dictionary")
    plain = zstandard.ZstdDecompressor(dict_data=zstandard.ZstdCompressionDict(dictionary) if dictionary else None)
    return np.frombuffer(plain.decompress(bytes(shard["blocks"][start:end])), np.dtype(f"<u{2 if shard['code'] == 'H' else 4}"))


def read_token_files(spark: SparkSession, at: str, id_col: str = "doc_id") -> DataFrame:
    """Per document of the files: ``id_col, start, n_tokens, ids_crc32``, from the ids that they hold."""
    bounded_batches(spark)
    name, raw = read_dictionary(spark, at)
    shared = spark.sparkContext.broadcast(raw)
    shards = spark.read.parquet(f"{at}/shards")
    # One row for each part that was written: the number of parts, not of shards or documents.
    parts = sorted(map(tuple, shards.groupBy("part").agg(F.sum("n_tokens")).collect()))
    base = dict(zip([p for p, _ in parts], np.cumsum([0, *[n for _, n in parts]]).tolist(), strict=False))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        plain = zstandard.ZstdDecompressor(dict_data=zstandard.ZstdCompressionDict(shared.value) if shared.value else None)
        for b in batches:
            for row in b.to_pylist():
                if row["dictionary"] != name:
                    raise ValueError("a shard was written with another dictionary")
                index, blocks = np.frombuffer(row["index"], ENTRY), memoryview(row["blocks"])
                kind, at, counts, sums = np.dtype(f"<u{2 if row['code'] == 'H' else 4}"), 0, [], []
                for end in index["end"].tolist():
                    ids = np.frombuffer(plain.decompress(blocks[at:end]), kind)
                    counts.append(len(ids))
                    sums.append(zlib.crc32(ids.astype("<u4").tobytes()))
                    at = end
                starts = base[row["part"]] + row["tokens_before"] + np.cumsum([0, *counts[:-1]])
                yield pa.RecordBatch.from_arrays(
                    [pa.array(index["doc"].astype(np.int64)), pa.array(starts), pa.array(counts, pa.int64()), pa.array(sums, pa.int64())],
                    [id_col, "start", "n_tokens", "ids_crc32"],
                )

    wanted = shards.select("part", "tokens_before", "code", "dictionary", "index", "blocks")
    return wanted.mapInArrow(run, f"`{id_col}` long, start long, n_tokens long, ids_crc32 long")
