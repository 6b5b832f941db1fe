import math
import random
import zlib
from collections import Counter

import numpy as np
import pytest

from millrace.llm import maxent_lm


def toks(t):
    return [*(t or "").encode().lower().split(), b"\n"]


def test_base_score_and_gain_on_held_out(spark):
    rng = random.Random(1)
    follow = {w: [f"w{rng.randrange(80)}" for _ in range(4)] for w in (f"w{k}" for k in range(80))}
    rows = []
    for k in range(700):
        w, out = "w0", []
        for _ in range(rng.randint(0, 60)):
            w = rng.choice(follow[w])
            out.append(w if rng.random() < 0.9 else f"rare{rng.randrange(3000)}")
            w = out[-1] if out[-1] in follow else "w1"
        rows.append((k, " ".join(out).upper()))
    rows += [(900, None), (901, ""), (902, "only\x0bhere é x"), (903, "w1 " * 20000), (904, "dup"), (904, "dup"), (None, "w1")]
    df = spark.createDataFrame([(i, t, 1, "z") for i, t in rows], "doc_id long, text string, n int, row string")
    rows = rows[:-1]
    c = Counter(w for i, t in rows if zlib.crc32(str(i).encode()) % 7 != 2 for w in toks(t))
    n, v = sum(c.values()), len(c)
    got = sorted(map(tuple, maxent_lm.language_scores(df, head=60).collect()))
    assert len(got) == len(rows)
    for g, (i, t) in zip(got, rows):
        w = toks(t)
        assert g[:5] == (i, zlib.crc32(str(i).encode()) % 7 == 2, len(w), sum(x in c for x in w), n)
        assert g[5] == pytest.approx(sum(math.log10((c[x] + 1) / (n + v + 1)) for x in w))
        assert g[6] < 0
    held = [g for g in got if g[1]]
    assert len(held) > 50
    assert sum(g[6] for g in held) > 0.88 * sum(g[5] for g in held)  # both are negative: the model gains over the base
    more = sorted(map(tuple, maxent_lm.language_scores(df, head=100_000).collect()))
    assert [g[:5] for g in more] == [g[:5] for g in got]
    assert [g[5] for g in more] == pytest.approx([g[5] for g in got])


def test_probabilities_sum_to_one():
    rng = np.random.default_rng(0)
    m = maxent_lm.Model.start(np.arange(200, 0, -1), np.array([50]))
    word = rng.integers(0, 260, 5000)
    word[word >= 200] = 202  # one leaf
    squares = [np.zeros(maxent_lm.CLASS_ROWS, np.float32), np.zeros(maxent_lm.WORD_ROWS, np.float32)]
    m.leaf_of, m.head = np.zeros(200, np.int64), 200
    before = m.score(word, np.roll(word, 1), np.roll(word, 2)).sum()
    for _ in range(3):
        m.train(word, np.roll(word, 1), np.roll(word, 2), squares)
    assert m.score(word, np.roll(word, 1), np.roll(word, 2)).sum() > before
    every = np.append(np.arange(200), 202)
    share = np.append(np.ones(200), 51)
    assert (np.exp(m.score(every, np.full(201, 3), np.full(201, 7))) * share).sum() == pytest.approx(1, abs=1e-4)


def test_nothing_to_learn_from(spark):
    df = spark.createDataFrame([], "doc_id long, text string")
    assert maxent_lm.language_scores(df).count() == 0
    held = next(k for k in range(100) if zlib.crc32(str(k).encode()) % 7 == 2)
    df = spark.createDataFrame([(held, "a b")], "doc_id long, text string")
    assert [tuple(r) for r in maxent_lm.language_scores(df).collect()] == [(held, True, 3, 0, 0, 0.0, 0.0)]


def test_rare_words_are_predicted_from_their_context(spark):
    words = [f"t{k}" for k in range(4500)]  # more than twice the words of the frequent classes, all alike in frequency
    rng = random.Random(4)
    rows = []
    for k in range(2500):
        at = [rng.randrange(0, 4500, 2) for _ in range(15)]
        rows.append((k, " ".join(f"{words[x]} {words[x + 1]}" for x in at)))  # every second word follows from the one before
    df = spark.createDataFrame(rows, "doc_id long, text string")
    got = [r for r in maxent_lm.language_scores(df, head=3000).collect() if r.held_out]
    assert sum(r.score for r in got) > 0.78 * sum(r.base_score for r in got)  # 0.83 if other words share a class without contexts
    assert [maxent_lm.depth_of(n) for n in (0, 16, 17, 4500 - 2048, 409_487, 8_000_000, 9_000_000, 10**12)] == [0, 0, 1, 2, 2, 2, 3, 4]


def test_tree_probabilities_sum_to_one():
    rng = np.random.default_rng(0)
    counts, size = np.arange(3300, 0, -1), maxent_lm.BRANCH**2
    leaf_of, inside = rng.integers(0, size, 3300), maxent_lm.CLASSES * maxent_lm.MEMBERS
    tokens, types = np.bincount(leaf_of[inside:], counts[inside:], size), np.bincount(leaf_of[inside:], minlength=size)
    m = maxent_lm.Model.start(counts[:inside], tokens, leaf_of, 2)
    word = rng.integers(0, 3300, 20000)
    before = m.score(word, np.roll(word, 1), np.roll(word, 2)).sum()
    m.train(word, np.roll(word, 1), np.roll(word, 2), [np.zeros(len(t), np.float32) for t in m.tables])
    assert m.score(word, np.roll(word, 1), np.roll(word, 2)).sum() > before
    unseen = m.head + 2 + np.arange(size)  # one in each leaf
    every = np.concatenate([np.arange(3300), unseen])
    share = np.concatenate([np.where(np.arange(3300) < inside, 1, counts - 0.6), 0.6 * types + 1])
    assert (np.exp(m.score(every, np.full(len(every), 3), np.full(len(every), 7))) * share).sum() == pytest.approx(1, abs=1e-3)


def by_hand(text, fitted, counts):
    """The score of a text from exported weights, word by word."""
    m, numbers, tail, _, _ = fitted
    head = [w for w in numbers.head.to_pylist()]
    rank = {w: k for k, w in enumerate(head)}
    mask = (1 << 64) - 1
    mix = lambda x: ((x ^ (x >> 29)) * 0xBF58476D1CE4E5B9) & mask
    softmax = lambda z, k: math.exp(z[k]) / sum(map(math.exp, z))

    def leaf(w):
        key = int.from_bytes(w[:7].ljust(7, b"\0"), "big")
        return sum(b <= key for b in numbers.bounds.tolist())

    def number(w):
        k = rank.get(w, 10**9)
        return k if counts.get(w) and k < maxent_lm.CONTEXTS else numbers.none + 1 + leaf(w)

    total, past = 0.0, [numbers.none, numbers.none]
    for w in toks(text):
        a, b = past[-1] + 3, past[-2] + 3
        hashed = [mix(a * 0x9E3779B97F4A7C15 & mask), mix(b * 0xC2B2AE3D27D4EB4F & mask), mix((a * 0x165667B19E3779F9 + b * 0x27D4EB2F165667C5) & mask)]
        k = number(w)
        inside = k < m.vocabulary
        c = k // maxent_lm.MEMBERS if inside else maxent_lm.CLASSES
        p = softmax([m.class_bias[x] + sum(m.class_rows[(h >> 20) % len(m.class_rows)][x] for h in hashed) for x in range(maxent_lm.CLASSES + 1)], c)
        if inside:
            rows = [m.word_rows[((h + c * 0x9FB21C651E98DF25 & mask) >> 24) % len(m.word_rows)] for h in hashed]
            p *= softmax([min(60, m.word_bias[c][x] + sum(r[x] for r in rows)) for x in range(maxent_lm.MEMBERS)], k % maxent_lm.MEMBERS)
        else:
            at, node = leaf(w), 0
            for level in range(m.depth):
                first = (maxent_lm.BRANCH**level - 1) // (maxent_lm.BRANCH - 1)
                node = first + at // maxent_lm.BRANCH ** (m.depth - level)
                goal = at // maxent_lm.BRANCH ** (m.depth - level - 1) % maxent_lm.BRANCH
                rows = []
                for h in hashed:
                    x = (h + (node + 1) * 0xD6E8FEB86659FD93) & mask
                    rows.append(m.tree_rows[(((x ^ (x >> 32)) * 0x9E3779B97F4A7C15 & mask) >> 24) % len(m.tree_rows)])
                p *= softmax([m.tree_bias[node][x] + sum(r[x] for r in rows) for x in range(maxent_lm.BRANCH)], goal)
            n = counts.get(w, 0)
            p *= (n - tail.discount if n else 10 ** tail.unseen[at]) / math.exp(m.leaves[at])
        total += math.log10(p)
        past.append(k)
    return total


def test_score_by_hand(spark):
    rng = random.Random(3)
    rows = [(k, k % 5 == 0, " ".join(f"{chr(97 + rng.randrange(26))}{min(int(rng.paretovariate(0.2)), 900)}é" for _ in range(rng.randrange(90)))) for k in range(400)]
    df = spark.createDataFrame([(i, h, t.encode()) for i, h, t in rows], "id long, held_out boolean, t binary")
    words = maxent_lm.count_words(df)
    fitted = maxent_lm.fit(df.where("not held_out").select("id", "t"), words, head=4000)
    model = fitted[0]
    assert model.depth == 2 and all(t.any() for t in model.tables)
    counts = Counter(w for _, h, t in rows if not h for w in toks(t))
    got = {r.doc_id: r.score for r in maxent_lm.score_texts(df, words, fitted).collect()}
    for i, _, t in rows[:60]:
        assert got[i] == pytest.approx(by_hand(t, fitted, counts), rel=1e-4, abs=1e-3)


def test_scores_do_not_hang_on_partitions(spark):
    """Three layouts of the same rows, and the gain of the trained weights over what smoothing alone gives."""
    docs = spark.read.parquet("/root/testdata/sf0.01/documents.parquet").select("doc_id", "text")
    runs = [{r.doc_id: r for r in maxent_lm.language_scores(df).collect()} for df in (docs, docs.repartition(7), docs.orderBy(docs.doc_id.desc()).coalesce(3))]
    for other in runs[1:]:
        assert max(abs(other[k].score - r.score) / r.n_tokens for k, r in runs[0].items()) < 0.001
    plain = {r.doc_id: r for r in maxent_lm.language_scores(docs, rounds=0).collect()}
    total = lambda rows, c: sum(getattr(r, c) for r in rows.values() if r.held_out)
    base, smoothed, trained = total(plain, "base_score"), total(plain, "score"), total(runs[0], "score")
    assert smoothed > 0.95 * base  # discounts and leaves alone
    assert trained > 0.955 * smoothed  # what the contexts give beyond them


def test_segment_sums():
    rng = np.random.default_rng(0)
    lens = np.concatenate([rng.integers(1, 12, 60), [8, 64, 65, 511, 1000, 1]])
    first = np.cumsum(lens) - lens
    rows, order = rng.standard_normal((300, 5)).astype(np.float32), rng.integers(0, 300, lens.sum())
    want = np.add.reduceat(rows[order].astype(float), first, axis=0)
    assert np.abs(maxent_lm.segment_sums(rows, order, first) - want).max() < 1e-3
