import hashlib
import re
import zlib
from fractions import Fraction

import numpy as np
import pytest
from hypothesis import given, settings
from hypothesis import strategies as st

from millrace.llm import queries
from millrace.llm.periodic import _first_gram, periodic_runs, runs_of

WORD = re.compile(r"[^\x20\x09-\x0D]+")


def by_hand(words, least=24, times=3):
    """All runs, one lag after the other; a stretch counts for its smallest period alone."""
    code = np.unique(words, return_inverse=True)[1] if len(words) else np.zeros(0, int)
    n, out = len(words), []
    for q in range(1, n // times + 1):
        same = np.concatenate([[False], code[:-q] == code[q:], [False]]).astype(int)
        edge = np.diff(same)
        for a, b in zip(np.flatnonzero(edge == 1).tolist(), np.flatnonzero(edge == -1).tolist(), strict=True):
            length = b + q - a
            if length >= max(least, times * q) and not any((code[a : a + length - r] == code[a + r : a + length]).all() for r in range(1, q)):
                out.append((a, length, q))
    return sorted(out, key=lambda r: (r[0], r[2]))


def digest(doc_id, text):
    words = WORD.findall(text or "")
    h, n = zlib.crc32(str(doc_id).encode()), len(words)
    g = h // 10
    if h % 10 == 0 and n:
        a = g % n
        p = 1 + (n - a) // (3 + g % 8)
        words = [w if i < a else words[a + (i - a) % p] for i, w in enumerate(words)]
    runs = by_hand(words)
    gone = {i for s, length, q in runs for i in range(s + q, s + length)}
    best = min(runs, key=lambda r: (-Fraction(r[1], r[2]), r[0], r[2])) if runs else (None,) * 3
    milli = 1000 * best[1] // best[2] if runs else None
    sha = lambda s: hashlib.sha256(s.encode()).hexdigest()
    return (doc_id, len(runs), *best, milli, sha("".join(f"{s},{n},{q}\n" for s, n, q in runs)), sha(" ".join(w for i, w in enumerate(words) if i not in gone)))


COLUMNS = ["doc_id", "n_runs", "start", "length", "period", "exponent_milli", "runs_sha256", "collapsed_sha256"]


def test_given_documents(spark):
    at = "/root/testdata/sf0.01"
    docs = spark.read.parquet(f"{at}/documents.parquet").select("doc_id", "text").collect()
    got = {r.doc_id: tuple(r[c] for c in COLUMNS) for r in queries.QUERIES["op11_periodic"](spark, at).collect()}
    assert len(got) == len(docs)
    short = [r for r in docs if len(r.text or "") < 12_000]
    assert len(short) > 0.95 * len(docs)
    for r in short:
        assert got[r.doc_id] == digest(r.doc_id, r.text)
    assert sum(x[1] > 0 for x in got.values()) > 50


def test_edge_cases(spark):
    loop = lambda k, n: " ".join(f"w{i % k}" for i in range(n))
    texts = [None, "", " \t\n", "a", "a " * 23, "a " * 24, loop(8, 24), loop(9, 26), loop(9, 27), loop(500, 1499), loop(500, 1700), "x y " * 3000 + loop(7, 40) + " é é " + "é é " * 30, "A a " * 40]
    rows = [(k, t) for k, t in enumerate(texts)] + [(3, "a"), (None, "b")]
    df = spark.createDataFrame([(*r, "q", 5) for r in rows], "doc_id long, text string, runs string, n_words int")
    got = sorted((r.doc_id, r.n_words, [tuple(x) for x in r.runs], r.collapsed) for r in periodic_runs(df).collect())
    want = []
    for k, t in rows:
        if k is not None:
            words = WORD.findall(t or "")
            runs = by_hand(words)
            gone = {i for s, length, q in runs for i in range(s + q, s + length)}
            want.append((k, len(words), runs, " ".join(w for i, w in enumerate(words) if i not in gone)))
    assert got == sorted(want)
    assert [x[2] for x in got if x[0] in (4, 5)] == [[], [(0, 24, 1)]] and periodic_runs(df.limit(0)).count() == 0
    with pytest.raises(ValueError):
        periodic_runs(df, times=2)


def joined(texts, least=24, times=3):
    code = np.array([w for t in texts for w in t], np.int32)
    offsets = np.cumsum([0, *map(len, texts)]).astype(np.int64)
    got = [[] for _ in texts]
    for s, length, q in runs_of(code, offsets, least, times).tolist():
        k = int(np.searchsorted(offsets, s, "right")) - 1
        got[k].append((s - int(offsets[k]), length, q))
    return got


@pytest.mark.parametrize("least, times", [(24, 3), (6, 3), (10, 4), (40, 5)])
def test_runs_of_few_words(least, times):
    """Texts of two or three words, and of nested repeats, have many runs of many periods."""
    rng = np.random.default_rng(least)
    texts = [rng.integers(0, rng.integers(1, 4), rng.integers(0, 200)).tolist() for _ in range(150)]
    for _ in range(60):
        inner = rng.integers(0, 3, rng.integers(1, 9)).tolist() * int(rng.integers(1, 5))
        block = inner + rng.integers(0, 4, rng.integers(0, 30)).tolist()
        texts.append((block * int(rng.integers(1, 7)) + inner)[: rng.integers(1, 400)])
    assert joined(texts, least, times) == [by_hand(np.array(t, int), least, times) for t in texts]


@settings(max_examples=150, deadline=None)
@given(st.lists(st.lists(st.integers(0, 1), max_size=12), max_size=4), st.integers(1, 40))
def test_runs_of_repeated_blocks(blocks, times):
    texts = [b * times for b in blocks] + [[x for b in blocks for x in b] * times]
    assert joined(texts) == [by_hand(np.array(t, int)) for t in texts]


def test_shortest_gram():
    assert [_first_gram(*x) for x in ((24, 3), (6, 3), (10, 4), (40, 5), (2, 3))] == [16, 4, 8, 32, 2]


def test_query_on_odd_texts(spark, tmp_path):
    """Ids whose texts are made periodic, with null, empty, one-word and repeated texts."""
    planted = [k for k in range(400) if zlib.crc32(str(k).encode()) % 10 == 0]
    texts = [None, "", "  ", "one", "a b", "x " * 500, " ".join(f"w{k}" for k in range(300))]
    rows = [(planted[k % len(planted)] if k < 14 else k + 1000, texts[k % len(texts)]) for k in range(28)] + [(None, "z")]
    spark.createDataFrame(rows, "doc_id long, text string").write.parquet(str(tmp_path / "documents.parquet"))
    got = sorted(tuple(r[c] for c in COLUMNS) for r in queries.QUERIES["op11_periodic"](spark, str(tmp_path)).collect())
    assert got == sorted(digest(i, t) for i, t in rows if i is not None)
