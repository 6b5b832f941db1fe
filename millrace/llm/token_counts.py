"""Token counts by the whole-token shortcut."""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .common import bounded_batches
from .pretokens import Bpe, Merger, Pieces, default_tokenizer

_tables: dict = {}


def whole_tokens(path: str) -> frozenset[str]:
    """The vocabulary strings that the merges turn back into one token.

    A vocabulary string need not: merges may lead elsewhere first, and special
    tokens have no merges at all. Each string is merged once, so a pre-token
    found in this set is known to count one.
    """
    bpe = Bpe(path)
    strings = [v for v in bpe.vocab if all(c in bpe.vocab for c in v)]
    return frozenset(v for v, ids in zip(strings, Merger(bpe, "I")(strings), strict=True) if ids == np.array([bpe.vocab[v]], "<u4").tobytes())


def _counter(path: str, whole: frozenset[str]) -> Pieces:
    merge = Merger(Bpe(path), "I")

    def count(words: list[str]) -> list[int]:
        rest = [w for w in words if w not in whole]
        merged = dict(zip(rest, (len(x) // 4 for x in merge(rest)), strict=True))
        return [merged.get(w, 1) for w in words]

    return Pieces(path, count, counts=True)


def token_counts(docs: DataFrame, path: str | None = None, id_col: str = "doc_id", text_col: str = "text", limit: int = 1024) -> DataFrame:
    """``id_col, n_bytes, n_tokens, over_limit`` of each row's whole text.

    ``path``: a byte-level BPE file (.json), counted by the shortcut, or a
    sentencepiece file (.model), counted by its library. Rows without an id are
    left out, a null text is empty, repeated rows are returned as often as they
    occur, other columns are ignored.
    """
    spark = docs.sparkSession
    bounded_batches(spark)
    path = path or default_tokenizer()
    # The set is a part of the vocabulary file, so its size has a bound.
    whole = spark.sparkContext.broadcast(whole_tokens(path)) if path.endswith(".json") else None

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        if path not in _tables:
            if whole is None:
                import sentencepiece

                model = sentencepiece.SentencePieceProcessor(model_file=path)
                _tables[path] = lambda texts: np.array([len(x) for x in model.encode([t or "" for t in texts.to_pylist()], num_threads=1)], np.int64)
            else:
                pieces = _counter(path, whole.value)
                _tables[path] = lambda texts: pieces.values(texts)[1]
        count = _tables[path]
        for b in batches:
            n = count(b.column(2))
            yield pa.RecordBatch.from_arrays(
                [b.column(0), b.column(1), pa.array(n, pa.int64()), pa.array(n > limit)],
                [id_col, "n_bytes", "n_tokens", "over_limit"],
            )

    rows = docs.where(F.col(id_col).isNotNull()).select(
        F.col(id_col).cast("long"), F.coalesce(F.octet_length(text_col), F.lit(0)).cast("long"), F.col(text_col)
    )
    return rows.mapInArrow(run, f"`{id_col}` long, n_bytes long, n_tokens long, over_limit boolean")
