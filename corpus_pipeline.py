"""The corpus pipeline: each stage works on what its predecessor kept.

Documents that the quality classifier rejects go, one document of each group of
near copies stays, documents with a benchmark window go, personal data is
masked, and what is left is encoded and decoded.

Rows without an id, and rows that share one, pass the filtering stages like any
other: quality judges them by text and site, near_dedup and decontaminate tell
rows apart by a number of their own. The last stage returns results by id, so
rows without one end there. Null texts count as empty; of all rows without
words near_dedup keeps one.
"""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession

from millrace.llm import bpe_lexicon, fm_index, pii_tagger, simhash, site_quality
from millrace.llm.common import scratch_path, table


def quality(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that are likely neither poor nor toxic."""
    return site_quality.keep_good(docs, table(spark, sf_dir, "labels"))


def near_dedup(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """The document with the smallest id of each group of near copies; rows without an id come last."""
    return simhash.simhash_dedup(docs)


def decontaminate(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents without any window of a benchmark item."""
    return fm_index.decontaminate(docs, table(spark, sf_dir, "benchmark"))


def mask(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """All documents, with personal data masked in their texts."""
    return pii_tagger.mask_personal_data(docs)


def encode(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Token counts and digests of ids and of decoded texts."""
    return bpe_lexicon.bpe_codec(docs)


STAGES: list[tuple[str, Callable[[SparkSession, DataFrame, str], DataFrame]]] = [
    ("quality", quality),
    ("near_dedup", near_dedup),
    ("decontaminate", decontaminate),
    ("mask", mask),
    ("encode", encode),
]

ORACLE_SQL = None  # a fitted classifier and BPE are not SQL; tests hold the stages against brute force


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All stages over ``documents``; each stage's result is written and read again."""
    docs = table(spark, sf_dir, "documents")
    at = scratch_path(spark, "pipeline")
    for name, stage in STAGES[:-1]:
        stage(spark, docs, sf_dir).write.parquet(f"{at}/{name}")
        docs = spark.read.parquet(f"{at}/{name}")
    return STAGES[-1][1](spark, docs, sf_dir)
