"""Ranked search of many queries over kept postings.

Postings, with the places of each term, are built and written once, sorted by
term; a search reads the row groups of its terms. Terms within one or two edits
of a query's word share a key with it, so words meet terms in a join by key
that is verified by the edit distance itself.
"""

from __future__ import annotations

from collections.abc import Iterator, Sequence

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from ..scratch import staged
from .content import terms

#: Words of so many letters may have one typo, and two.
ONE_TYPO, TWO_TYPOS = 5, 9
#: Longer terms have keys by thirds, not by letters left out: three keys instead of a number that grows with the square.
LONG = 8
#: Terms that are pushed into the scan of the postings at most; beyond it they are joined only.
PUSHED = 1000
#: Places of different fields lie this far apart, so that no window over two fields counts.
_FIELD = 1 << 40


def _without_one(word: Column) -> Column:
    """The word with each of its letters left out."""
    n = F.length(word)
    each = F.transform(F.sequence(F.lit(1), F.greatest(n, F.lit(1))), lambda i: F.concat(F.substr(word, F.lit(1), i - 1), F.substr(word, i + 1)))
    return F.when(n > 0, each).otherwise(F.array(F.lit("")))


def _hashes(parts: Column) -> Column:
    return F.array_distinct(F.transform(parts, lambda v: F.xxhash64(v)))


def _left_out(word: Column, one: Column, two: Column) -> Column:
    """Hashes of the word, and with up to one or two letters left out where that holds."""
    ones = _without_one(word)
    more = F.when(two, F.concat(ones, F.flatten(F.transform(ones, _without_one)))).when(one, ones).otherwise(F.array().cast("array<string>"))
    return _hashes(F.concat(F.array(word), more))


def _third(size: Column, k: int, text: Column, shift: int | Column = 0) -> Column:
    """The k-th third of a term of ``size`` letters, as found ``shift`` letters on in ``text``, with what it is a third of."""
    each = F.floor(size / 3).cast("int")
    n = each if k < 2 else size - 2 * each
    return F.concat_ws("|", size.cast("string"), F.lit(str(k)), F.substr(text, each * k + 1 + shift, n))


def term_keys(term: Column) -> Column:
    """Keys under which a term of the index is found."""
    n = F.length(term)
    thirds = F.array(*[_third(n, k, term) for k in range(3)])
    return F.when(n > LONG, _hashes(thirds)).otherwise(_left_out(term, n >= ONE_TYPO - 1, n >= TWO_TYPOS - 2))


def allowed(word: Column) -> Column:
    n = F.length(word)
    return F.when(n >= TWO_TYPOS, 2).when(n >= ONE_TYPO, 1).otherwise(0)


def word_keys(word: Column) -> Column:
    """Keys that a query's word has in common with each term within its typos.

    Two edits leave one third of a long term whole, moved by two letters at most.
    """
    n = F.length(word)
    shifted = [
        F.when((n + d > LONG) & (F.floor((n + d) / 3) * k + 1 + s > 0), _third(n + d, k, word, s))
        for d in range(-2, 3) for k in range(3) for s in range(-2, 3)
    ]
    thirds = F.when(n > LONG - 2, _hashes(F.array_compact(F.array(*shifted)))).otherwise(F.array().cast("array<long>"))
    left = F.when(n <= LONG + 2, _left_out(word, n >= ONE_TYPO, n >= TWO_TYPOS)).otherwise(F.array().cast("array<long>"))
    return F.array_distinct(F.concat(left, thirds))


def _places(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Of rows ``id, field, weight, terms``: a row for each distinct term of each, with its places in order."""
    for b in batches:
        words = b.column(3)
        flat = words.flatten().dictionary_encode()
        code = flat.indices.to_numpy()
        n = words.value_lengths().to_numpy()
        row = np.repeat(np.arange(len(n)), n)
        place = np.arange(len(code)) - np.repeat(np.cumsum(n) - n, n)
        order = np.lexsort((place, code, row))
        row, code = row[order], code[order]
        new = np.ones(len(code), bool)
        new[1:] = (row[1:] != row[:-1]) | (code[1:] != code[:-1])
        first = np.flatnonzero(new)
        of = pa.array(row[first])
        ends = pa.array(np.append(first, len(code)).astype(np.int32))
        places = pa.ListArray.from_arrays(ends, pa.array(place[order].astype(np.int32)))
        term = flat.dictionary.take(pa.array(code[first]))
        yield pa.RecordBatch.from_arrays([term, *(b.column(k).take(of) for k in range(3)), places], ["term", "id", "field", "weight", "places"])


def postings(rows: DataFrame, fields: Sequence[tuple[str, int]]) -> DataFrame:
    """``term, id, field, weight, places`` of each term of each row and field; places count from 0. Rows of null fields have none.

    A text's terms are put together where it is read, so no word is shuffled
    by itself. Rows that share an id have postings of their own.
    """
    each = F.array(*[F.struct(F.lit(k).alias("field"), F.lit(w).alias("weight"), terms(F.col(f)).alias("terms")) for k, (f, w) in enumerate(fields)])
    texts = rows.select("id", F.explode(each).alias("x")).select("id", "x.field", "x.weight", "x.terms")
    kind = rows.schema["id"].dataType.simpleString()
    return texts.mapInArrow(_places, f"term string, id {kind}, field int, weight int, places array<int>")


def write_index(rows: DataFrame, fields: Sequence[tuple[str, int]], at: str) -> None:
    """Write the postings, and the keys of all terms, each sorted by what it is read by.

    A term that a third of all rows has is cut over several files, as rows of a
    term are ranged by id too.
    """
    found = staged(postings(rows, fields))  # ranging reads its rows twice
    found.repartitionByRange("term", "id").sortWithinPartitions("term", "id").write.mode("overwrite").parquet(f"{at}/postings")
    kept = rows.sparkSession.read.parquet(f"{at}/postings")
    # Terms are few bytes, which would be put into one task, but many keys; and ranging reads its rows twice.
    parts = int(rows.sparkSession.conf.get("spark.sql.shuffle.partitions"))
    each = kept.groupBy("term").agg(F.count("*").alias("rows")).repartition(parts, "term")
    keys = staged(each.select("term", "rows", F.explode(term_keys(F.col("term"))).alias("key")))
    keys.repartitionByRange("key", "term").sortWithinPartitions("key").write.mode("overwrite").parquet(f"{at}/keys")


def query_words(queries: DataFrame, query_id: str = "query_id", text: str = "query") -> DataFrame:
    """``query_id, pos, word``: each query's distinct words in order."""
    return queries.select(query_id, F.posexplode(F.array_distinct(terms(F.col(text)))).alias("pos", "word"))


def similar_terms(spark: SparkSession, at: str, words: DataFrame) -> DataFrame:
    """``word, term, typos``: the terms of the index within each word's typos."""
    wanted = words.select("word").distinct().select("word", F.explode(word_keys(F.col("word"))).alias("key"))
    met = wanted.join(spark.read.parquet(f"{at}/keys").select("key", "term"), "key").select("word", "term").distinct()
    typos = F.levenshtein("word", "term", 2)
    return met.withColumn("typos", typos).where((F.col("typos") >= 0) & (F.col("typos") <= allowed(F.col("word"))))


def _smallest_window(places: Column, words: Column) -> Column:
    """Least distance from first to last place over all words, by one pass over sorted ``(place, k)``; null if they meet in no field.

    The pass keeps the last place of each word; a window ends wherever each word has one.
    """
    start = F.struct(F.array_repeat(F.lit(None).cast("long"), words).alias("last"), F.lit(_FIELD).alias("best"))

    def step(s: Column, x: Column) -> Column:
        last = F.transform(s["last"], lambda v, i: F.when(i == x["k"], x["place"]).otherwise(v))
        full = ~F.exists(last, lambda v: v.isNull())
        return F.struct(last.alias("last"), F.when(full, F.least(s["best"], x["place"] - F.array_min(last))).otherwise(s["best"]).alias("best"))

    best = F.aggregate(F.sort_array(places), start, step, lambda s: s["best"])
    return F.when(words == 1, 0).when(best < _FIELD // 2, best)


def _in_reach(hits: DataFrame, k: int) -> DataFrame:
    """``query_id, id`` of rows that may be among the best ``k``: fewer than ``k`` rows of the query match more words, or as many with fewer typos.

    Rows are counted by these two, so none is left out that another order of
    the rest could bring in. The rows are dealt by query and id once, for both
    aggregations.
    """
    dealt = hits.select("query_id", "id", "pos", "typos").repartition("query_id", "id")
    found = dealt.groupBy("query_id", "id", "pos").agg(F.min("typos").alias("typos")).groupBy("query_id", "id").agg(F.count("*").alias("matched"), F.sum("typos").alias("typos"))
    found = staged(found)
    levels = found.groupBy("query_id", "matched", "typos").agg(F.count("*").alias("n"))
    better = F.sum("n").over(Window.partitionBy("query_id").orderBy(F.desc("matched"), F.asc("typos")).rowsBetween(Window.unboundedPreceding, -1))
    levels = levels.withColumn("better", F.coalesce(better, F.lit(0))).where(F.col("better") < k).select("query_id", "matched", "typos")
    return staged(found.join(levels, ["query_id", "matched", "typos"]).select("query_id", "id"))


def ranked_search(spark: SparkSession, at: str, queries: DataFrame, k: int = 20) -> DataFrame:
    """``query_id, rank, id, matched, typos, proximity, score, exact``: the best ``k`` rows of each query.

    Rows with more of a query's words come first, then those with fewer typos,
    with the words closer together (the window of places from the first to the
    last, in one field; rows where they never meet come last), in weightier
    fields, with more words as they were written, and by id. Of a word's terms
    in a row only those with the fewest typos count. A query without words has
    no rows; queries are told apart by ``query_id``. Places are read only of
    rows whose words and typos may be enough.
    """
    words = query_words(queries)
    similar = similar_terms(spark, at, words).persist()
    few = [r.term for r in similar.select("term").distinct().limit(PUSHED + 1).collect()]
    held = spark.read.parquet(f"{at}/postings")
    if len(few) <= PUSHED:  # the files are sorted by term, so other row groups are not read
        held = held.where(F.col("term").isin(few))
    hits = words.join(similar, "word").join(held, "term")
    one = F.struct("pos", "typos", "weight", F.transform("places", lambda p: p + F.col("field") * F.lit(_FIELD)).alias("places"))
    rows = hits.join(_in_reach(hits, k), ["query_id", "id"]).groupBy("query_id", "id").agg(F.collect_list(one).alias("h"))
    # Of each word found: its least typos, and the greatest weight with these.
    own = lambda p: F.filter("h", lambda x: x["pos"] == p)
    least = F.transform(F.array_sort(F.array_distinct(F.transform("h", lambda x: x["pos"]))), lambda p: F.struct(p.alias("pos"), F.array_min(F.transform(own(p), lambda x: x["typos"])).alias("typos")))
    rows = rows.withColumn("w", least)
    best = F.transform("w", lambda w, k: F.struct(k.alias("k"), F.filter("h", lambda x: (x["pos"] == w["pos"]) & (x["typos"] == w["typos"])).alias("h")))
    rows = rows.withColumn("b", best)
    places = F.flatten(F.transform("b", lambda b: F.flatten(F.transform(b["h"], lambda x: F.transform(x["places"], lambda p: F.struct(p.alias("place"), b["k"].alias("k")))))))
    total = lambda xs: F.aggregate(xs, F.lit(0).cast("long"), lambda a, x: a + x)
    scored = rows.select(
        "query_id", "id", F.size("w").cast("long").alias("matched"), total(F.transform("w", lambda w: w["typos"])).alias("typos"),
        _smallest_window(places, F.size("w")).alias("proximity"),
        total(F.transform("b", lambda b: F.array_max(F.transform(b["h"], lambda x: x["weight"])))).alias("score"),
        F.size(F.filter("w", lambda w: w["typos"] == 0)).cast("long").alias("exact"),
    )
    order = [F.desc("matched"), F.asc("typos"), F.asc_nulls_last("proximity"), F.desc("score"), F.desc("exact"), F.asc("id")]
    ranked = scored.withColumn("rank", F.row_number().over(Window.partitionBy("query_id").orderBy(*order)).cast("long"))
    return ranked.where(F.col("rank") <= k).select("query_id", "rank", "id", "matched", "typos", "proximity", "score", "exact")
