import random

import duckdb
import pytest
from pyspark.sql import functions as F

from millrace.plans import search as se
from millrace.queries import ORACLE, QUERIES


def edits(a, b):
    row = list(range(len(b) + 1))
    for i, x in enumerate(a, 1):
        before, row[0] = row[0], i
        for j, y in enumerate(b, 1):
            before, row[j] = row[j], min(row[j] + 1, row[j - 1] + 1, before + (x != y))
    return row[-1]


def changed(rng, w, n):
    w = list(w)
    for _ in range(n):
        k, kind = rng.randrange(len(w) + 1), rng.randrange(3)
        if kind == 0:
            w.insert(k, rng.choice("abé"))
        elif w and kind == 1:
            del w[min(k, len(w) - 1)]
        elif w:
            w[min(k, len(w) - 1)] = rng.choice("abé")
    return "".join(w)


def test_similar_terms_of_all_lengths(spark, tmp_path):
    rng = random.Random(7)
    words = ["".join(rng.choice("abé") for _ in range(n)) for n in [*range(1, 34), 60] for _ in range(4)]
    texts = sorted({changed(rng, w, rng.randrange(4)) for w in words for _ in range(6)} - {""})
    rows = spark.createDataFrame([(k, " ".join(texts[k::20])) for k in range(20)], "id long, text string")
    at = str(tmp_path / "index")
    se.write_index(rows, [("text", 1)], at)
    asked = se.query_words(spark.createDataFrame([(0, " ".join(words))], "query_id long, query string"))
    got = {tuple(r) for r in se.similar_terms(spark, at, asked).select("word", "term", "typos").collect()}
    want = set()
    for w in set(words):
        most = 2 if len(w) >= 9 else 1 if len(w) >= 5 else 0
        want |= {(w, t, d) for t in texts if abs(len(t) - len(w)) <= 2 and (d := edits(w, t)) <= most}
    assert got == want and sum(d == 2 and len(w) > 26 for w, _, d in want) > 5


@pytest.mark.parametrize("pushed", [1000, 1])
def test_order_of_ranks(spark, tmp_path, monkeypatch, pushed):
    monkeypatch.setattr(se, "PUSHED", pushed)  # whether terms are pushed into the scan or only joined
    texts = {
        1: ("", "rapid river crossing"),  # all words, side by side
        2: ("", "rapid x river x crossing"),
        3: ("", "rapid river crosing"),  # one typo
        4: ("rapid", "river crossing"),  # all words, never in one field
        5: ("", "river rapid"),  # fewer words
        6: ("rapid river", "none"),  # fewer words, weightier field
        7: (None, "nothing here"),
        8: ("", "crossing far away river and rapid crossing river"),  # the smallest window is at the end
    }
    rows = spark.createDataFrame([(k, t, x) for k, (t, x) in texts.items()], "id long, title string, text string")
    at = str(tmp_path / "index")
    se.write_index(rows, [("title", 3), ("text", 1)], at)
    queries = spark.createDataFrame([(1, "Rapid river crossing"), (2, "…"), (3, "river"), (4, None)], "query_id int, query string")
    got = sorted(map(tuple, se.ranked_search(spark, at, queries, 7).collect()))
    assert [(r[2], r[3], r[4], r[5]) for r in got if r[0] == 1] == [(1, 3, 0, 2), (8, 3, 0, 2), (2, 3, 0, 4), (4, 3, 0, None), (3, 3, 1, 2), (6, 2, 0, 1), (5, 2, 0, 1)]
    assert [r[2] for r in got if r[0] == 3] == [6, 1, 2, 3, 4, 5, 8] and {r[0] for r in got} == {1, 3}
    assert [r[1] for r in got] == [*range(1, 8), *range(1, 8)]


def test_hot_terms_are_ranged_over_files(spark, tmp_path):
    rows = spark.range(4000).select("id", F.concat_ws(" ", F.lit("the"), F.col("id").cast("string")).alias("text"))
    at = str(tmp_path / "index")
    spark.conf.set("spark.sql.adaptive.coalescePartitions.enabled", "false")  # so few rows would be put together
    se.write_index(rows, [("text", 1)], at)
    spark.conf.unset("spark.sql.adaptive.coalescePartitions.enabled")
    assert spark.read.parquet(f"{at}/postings").where("term = 'the'").select(F.input_file_name()).distinct().count() > 1


def test_words_are_marked_whole_in_any_script(spark, tmp_path):
    texts = ["The end, und the rest", "éthe und", "thé thé the", "theñ THE-und_the", "und\nthe", "the² the٣", "X" * 196 + " the", "", None]
    spark.createDataFrame([(k, x, "en") for k, x in enumerate(texts)], "doc_id long, text string, lang string").coalesce(1).write.parquet(f"{tmp_path}/documents.parquet")
    got = sorted(map(tuple, QUERIES["dom17_highlight"](spark, str(tmp_path)).select("doc_id", "snippet").collect()))
    db = duckdb.connect()
    db.sql(f"CREATE VIEW documents AS SELECT * FROM '{tmp_path}/documents.parquet/*.parquet'")
    assert got == sorted(db.sql(f"SELECT doc_id, snippet FROM ({ORACLE['dom17_highlight']})").fetchall())
    assert [r[1] for r in got[:4]] == ["<em>The</em> end, <em>und</em> <em>the</em> rest", "éthe <em>und</em>", "thé thé <em>the</em>", "theñ <em>THE</em>-und_the"]


def test_places_are_read_only_of_rows_in_reach(spark, tmp_path):
    texts = ["rapid river"] * 3 + ["rapid rivers"] * 3 + ["rapid"] * 50 + ["river of rapid"] * 2
    rows = spark.createDataFrame(list(enumerate(texts)), "id long, text string")
    at = str(tmp_path / "index")
    se.write_index(rows, [("text", 1)], at)
    queries = spark.createDataFrame([(1, "rapid river"), (2, "rapid")], "query_id int, query string")
    words = se.query_words(queries)
    hits = words.join(se.similar_terms(spark, at, words), "word").join(spark.read.parquet(f"{at}/postings"), "term")
    reach = {k: sorted(r.id for r in se._in_reach(hits, k).collect() if r.query_id == 1) for k in (4, 5, 6)}
    assert reach == {4: [0, 1, 2, 56, 57], 5: [0, 1, 2, 56, 57], 6: [0, 1, 2, 3, 4, 5, 56, 57]}
    assert [r.id for r in sorted(se.ranked_search(spark, at, queries, 4).where("query_id = 1").collect(), key=lambda r: r.rank)] == [0, 1, 2, 56]


def test_words_are_not_shuffled_one_by_one(spark):
    rows = spark.createDataFrame([(1, "a b a", "b"), (2, None, "c c"), (3, "", None), (1, "a", "x")], "id long, text string, title string")
    found = se.postings(rows, [("title", 3), ("text", 1)])
    assert "Exchange" not in found._jdf.queryExecution().executedPlan().toString()
    got = sorted(map(tuple, found.collect()))
    assert got == sorted([("a", 1, 1, 1, [0, 2]), ("b", 1, 1, 1, [1]), ("b", 1, 0, 3, [0]), ("c", 2, 0, 3, [0, 1]), ("a", 1, 1, 1, [0]), ("x", 1, 0, 3, [0])])
