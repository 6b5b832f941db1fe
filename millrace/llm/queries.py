"""The registered queries of this subpackage and their SQL."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from . import bpe_lexicon, caps, chaining, fm_index, maxent_lm, packing, periodic, pii_tagger, simhash, site_quality, token_counts, token_files, whitening
from .common import scratch_path, table

QUERIES: dict[str, Callable[[SparkSession, str], DataFrame]] = {}
ORACLE: dict[str, str] = {}


def query(name: str):
    def add(f):
        QUERIES[name] = f
        return f

    return add


@query("op1_simhash")
def op1(spark: SparkSession, sf_dir: str) -> DataFrame:
    return simhash.simhash_groups(table(spark, sf_dir, "documents"))


@query("op2_token_files")
def op2(spark: SparkSession, sf_dir: str) -> DataFrame:
    at = scratch_path(spark, "tokens")
    token_files.write_token_files(table(spark, sf_dir, "documents"), at)
    return token_files.read_token_files(spark, at)


@query("op3_cap_filters")
def op3(spark: SparkSession, sf_dir: str) -> DataFrame:
    return caps.vector_groups(table(spark, sf_dir, "embeddings"))


@query("op4_fm_index")
def op4(spark: SparkSession, sf_dir: str) -> DataFrame:
    found = fm_index.contamination(table(spark, sf_dir, "documents"), table(spark, sf_dir, "benchmark"))
    hit = F.aggregate("spans", F.lit(0).cast("long"), lambda n, s: n + (s["end"] - s["start"]))
    return found.select(
        "doc_id", "n_words", hit.alias("n_hit"), F.size("items").cast("long").alias("n_items"),
        F.sha2(F.concat_ws(",", "items"), 256).alias("items_sha256"), (F.size("spans") > 0).alias("contaminated"),
    )


_WORDS = r"""regexp_extract_all(translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'), '[^\x00-\x2F\x3A-\x60\x7B-\x7F]+')"""
ORACLE["op4_fm_index"] = f"""
WITH docs AS (SELECT doc_id, {_WORDS} AS w FROM documents WHERE doc_id IS NOT NULL),
items AS (SELECT item_id::VARCHAR AS item, {_WORDS} AS w FROM benchmark WHERE item_id IS NOT NULL),
grams AS (
  SELECT DISTINCT item, least(10, len(w)) AS n, array_to_string(w[k : k + least(10, len(w)) - 1], ' ') AS g
  FROM (SELECT item, w, unnest(range(1, greatest(len(w) - 9, 1) + 1)) AS k FROM items WHERE len(w) > 0)),
places AS (
  SELECT doc_id, n, k, array_to_string(w[k : k + n - 1], ' ') AS g
  FROM (SELECT doc_id, w, n, unnest(range(1, len(w) - n + 2)) AS k FROM docs, (SELECT DISTINCT n FROM grams) WHERE len(w) >= n)),
hits AS (SELECT doc_id, n, k, item FROM places JOIN grams USING (n, g)),
words AS (SELECT doc_id, count(DISTINCT p) AS n_hit FROM (SELECT doc_id, unnest(range(k, k + n)) AS p FROM hits) GROUP BY doc_id),
found AS (SELECT doc_id, count(*) AS n_items, string_agg(item, ',' ORDER BY item) AS ids FROM (SELECT DISTINCT doc_id, item FROM hits) GROUP BY doc_id)
SELECT doc_id, len(w)::BIGINT AS n_words, coalesce(n_hit, 0)::BIGINT AS n_hit, coalesce(n_items, 0)::BIGINT AS n_items,
  sha256(coalesce(ids, '')) AS items_sha256, coalesce(n_hit, 0) > 0 AS contaminated
FROM docs LEFT JOIN words USING (doc_id) LEFT JOIN found USING (doc_id)
"""


@query("op5_site_quality")
def op5(spark: SparkSession, sf_dir: str) -> DataFrame:
    return site_quality.site_quality(table(spark, sf_dir, "documents"), table(spark, sf_dir, "labels"))


@query("op6_pii_tagger")
def op6(spark: SparkSession, sf_dir: str) -> DataFrame:
    found = pii_tagger.personal_data(table(spark, sf_dir, "documents"))
    joined = lambda c: F.array_join(F.transform(c, lambda s: F.concat_ws(":", s["kind"], s["start"], s["end"])), ",")
    count = lambda kind: F.size(F.filter("base", lambda s: s["kind"] == kind)).cast("long").alias(f"n_{kind}")
    return found.select("doc_id", *map(count, pii_tagger.BASE_KINDS), F.sha2(joined("base"), 256).alias("base_sha256"), joined("spans").alias("spans"))


@query("op7_chaining")
def op7(spark: SparkSession, sf_dir: str) -> DataFrame:
    return chaining.repeated_passages(table(spark, sf_dir, "documents"))


@query("op8_maxent_lm")
def op8(spark: SparkSession, sf_dir: str) -> DataFrame:
    return maxent_lm.language_scores(table(spark, sf_dir, "documents"))


@query("op9_bpe_lexicon")
def op9(spark: SparkSession, sf_dir: str) -> DataFrame:
    return bpe_lexicon.bpe_codec(table(spark, sf_dir, "documents"))


@query("op10_token_counts")
def op10(spark: SparkSession, sf_dir: str) -> DataFrame:
    return token_counts.token_counts(table(spark, sf_dir, "documents"))


@query("op11_periodic")
def op11(spark: SparkSession, sf_dir: str) -> DataFrame:
    """A tenth of the texts, by a hash of their ids, end in a period of their own; the runs of all are reported."""
    h = F.crc32(F.col("doc_id").cast("string"))
    g = F.floor(h / 10)

    def looped(w):
        n = F.size(w).cast("long")
        a = g % n
        p = 1 + F.floor((n - a) / (3 + g % 8))
        word = lambda i: F.get(w, F.when(i < a, i).otherwise(a + (i - a) % p).cast("int"))
        return F.when(n > 0, F.array_join(F.transform(F.sequence(F.lit(0).cast("long"), n - 1), word), " "))

    # The words are bound to a variable, so that the text is split once, not for each word.
    words = F.regexp_extract_all("text", F.lit(r"[^\x20\x09-\x0D]+"), F.lit(0))
    text = F.when(h % 10 == 0, F.get(F.transform(F.array(words), looped), 0)).otherwise(F.col("text"))
    found = periodic.periodic_runs(table(spark, sf_dir, "documents").select("doc_id", text.alias("text")))
    # Runs are in the order that breaks ties, so a later one must be greater.
    best = F.aggregate(F.slice("runs", 2, F.greatest(F.size("runs"), F.lit(1))), F.get("runs", 0), lambda x, r: F.when(r["length"] * x["period"] > x["length"] * r["period"], r).otherwise(x))
    lines = F.array_join(F.transform("runs", lambda r: F.concat(F.concat_ws(",", r["start"], r["length"], r["period"]), F.lit("\n"))), "")
    return found.withColumn("best", best).select(
        "doc_id", F.size("runs").cast("long").alias("n_runs"), "best.start", "best.length", "best.period",
        F.expr("1000 * best.length DIV best.period").alias("exponent_milli"),
        F.sha2(lines, 256).alias("runs_sha256"), F.sha2(F.col("collapsed"), 256).alias("collapsed_sha256"),
    )


@query("op12_slack_packing")
def op12(spark: SparkSession, sf_dir: str) -> DataFrame:
    return packing.pack_documents(table(spark, sf_dir, "documents"))


@query("op13_whitening")
def op13(spark: SparkSession, sf_dir: str) -> DataFrame:
    return whitening.whitened_components(table(spark, sf_dir, "embeddings"), grid=whitening.Grid(64, 1_000_000))
