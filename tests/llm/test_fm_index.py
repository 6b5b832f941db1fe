import random
import re

import numpy as np

from millrace.llm import fm_index


def lower(t):
    return "".join(c.lower() if "A" <= c <= "Z" else c for c in t)


def by_hand(docs, items, window):
    words = lambda t: re.findall(r"[^\x00-\x2F\x3A-\x60\x7B-\x7F]+", lower(t or ""))
    grams = {}
    for i, t in items:
        if i is None:
            continue
        w = words(t)
        for k in range(max(1, len(w) - window + 1) if w else 0):
            grams.setdefault(tuple(w[k : k + window]), set()).add(str(i))
    out = []
    for d, t in docs:
        if d is None:
            continue
        w, hit, found = words(t), set(), set()
        for n in {len(g) for g in grams}:
            for k in range(len(w) - n + 1):
                if (g := tuple(w[k : k + n])) in grams:
                    hit |= set(range(k, k + n))
                    found |= grams[g]
        out.append((d, len(w), sorted(hit), sorted(found)))
    return sorted(out)


def case(rng):
    word = lambda: rng.choice(["the", "Of", "a", "b", "c", "é", "9", "Ñx", "zz"])
    text = lambda n: "".join(word() + rng.choice([" ", ", ", "\n", "-"]) for _ in range(n))
    items = [(k, text(rng.randint(0, 14))) for k in range(30)] + [(100, None), (101, ""), (None, "a b c"), (7, "the the")]
    docs = [(k, text(rng.randint(0, 120))) for k in range(60)]
    docs += [(k + 100, text(5) + (rng.choice(items)[1] or "").upper() + text(4)) for k in range(25)]
    docs += [(500, None), (501, ""), (502, "the " * 9000), (503, "?!"), (503, "?!"), (None, "the the")]
    return docs, items


def test_matches_brute_force_in_one_block_and_in_many(spark):
    docs, items = case(random.Random(4))
    d = spark.createDataFrame([(i, t, "x") for i, t in docs], "doc_id long, text string, spans string")
    b = spark.createDataFrame(items, "item_id long, text string")
    was, fm_index.SHARD_WORDS = fm_index.SHARD_WORDS, 700
    for window in (4, 10):
        for block in (1 << 20, 150):
            rows = fm_index.contamination(d, b, window=window, block_bytes=block).collect()
            got = sorted((r.doc_id, r.n_words, [k for s in r.spans for k in range(s.start, s.end)], r["items"]) for r in rows)
            assert got == by_hand(docs, items, window)
    fm_index.SHARD_WORDS = was
    dirty = {r[0] for r in by_hand(docs, items, 10) if r[2]}
    kept = fm_index.decontaminate(d, b)
    assert kept.columns == d.columns and sorted(r.doc_id for r in kept.collect()) == sorted(i for i, _ in docs if i is not None and i not in dirty)


def test_index_parts():
    rng = np.random.default_rng(0)
    for sigma, n in ((2, 50), (5, 400), (300, 3000)):
        s = rng.integers(0, sigma, n) * (rng.random(n) < 0.9)
        s = np.concatenate([s, s[: n // 2], [0]])
        unique = s.astype(float)
        unique[s == 0] = -1 + np.arange((s == 0).sum()) / (2 * len(s))  # separators: unlike each other, in order of place
        want = sorted(range(len(s)), key=lambda p: unique[p:].tolist())
        order = fm_index.suffix_order(s, sigma)
        assert order.tolist() == want
        tree = fm_index.WaveletTree(s, sigma)
        at = rng.integers(0, len(s), 200)
        assert (tree.get(at) == s[at]).all()
        c = rng.integers(0, sigma, 200)
        assert tree.rank(c, at).tolist() == [int((s[:i] == x).sum()) for i, x in zip(at, c)]
        index = fm_index.FmIndex(s, sigma)
        phrases = np.array([s[i : i + 3] for i in range(len(s) - 3) if s[i : i + 3].all()] + [[1, 1, 1]])
        for (lo, hi), p in zip(zip(*index.search(phrases)), phrases):
            places = [i for i in range(len(s) - 2) if (s[i : i + 3] == p).all()]
            assert sorted(index.locate(np.arange(lo, hi)).tolist()) == places


def test_empty(spark):
    d = spark.createDataFrame([], "doc_id long, text string")
    b = spark.createDataFrame([], "item_id long, text string")
    assert fm_index.contamination(d, b).count() == 0
    some = spark.createDataFrame([(1, "a b")], "doc_id long, text string")
    assert [tuple(r) for r in fm_index.contamination(some, b).collect()] == [(1, 2, [], [])]
