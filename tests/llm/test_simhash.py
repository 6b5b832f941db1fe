import random

import pytest
import xxhash

from millrace.llm import simhash
from millrace.llm.common import components


def by_hand(text):
    words = [w for w in "".join(c.lower() if "A" <= c <= "Z" else c for c in text or "").replace("\t", " ").replace("\n", " ").split(" ") if w]
    parts = [" ".join(words[i : i + 3]) for i in range(len(words) - 2)] or ([" ".join(words)] if words else [])
    hs = [xxhash.xxh64_intdigest(p.encode(), 42) for p in parts]
    return sum(1 << b for b in range(64) if sum(h >> b & 1 for h in hs) * 2 > len(hs))


def find(pairs, ids):
    top = {i: i for i in ids}

    def root(x):
        while top[x] != x:
            x = top[x]
        return x

    for a, b in pairs:
        a, b = root(a), root(b)
        top[max(a, b)] = min(a, b)
    return {i: root(i) for i in ids}


def test_groups_match_brute_force(spark):
    rng = random.Random(3)
    word = lambda: "".join(rng.choice("abcdeé") for _ in range(rng.randint(1, 5)))
    rows = []
    for i in range(300):
        if i % 3 and rows:
            base = rng.choice(rows)[1].split(" ")
            base[rng.randrange(len(base))] = word()
            rows.append((i, " ".join(base)))
        else:
            rows.append((i, " ".join(word() for _ in range(rng.randint(1, 400)))))
    rows += [(300, None), (301, ""), (302, " \n\t "), (303, "One"), (304, "one"), (305, "x " * 30000), (305, "x " * 30000), (None, "gone")]
    df = spark.createDataFrame([(i, t, "z", "z") for i, t in rows], "doc_id long, text string, fp string, id string")
    got = {(r.doc_id): (r.fingerprint, r.component_id) for r in simhash.simhash_groups(df).collect()}
    fps = {i: by_hand(t) for i, t in rows if i is not None}
    want = find([(a, b) for a in fps for b in fps if a < b and (fps[a] ^ fps[b]).bit_count() <= 2], fps)
    assert got == {i: (f"{fps[i]:016x}", want[i]) for i in fps}
    assert len(set(want.values())) < len(want) - 20
    kept = simhash.simhash_dedup(df)
    assert kept.columns == df.columns
    # Rows without an id are compared, too; here its text is unlike all others.
    assert sorted(r.doc_id for r in kept.collect() if r.doc_id is not None) == sorted(set(want.values()))
    assert [r.text for r in kept.where("doc_id is null").collect()] == ["gone"]


def test_dedup_tells_rows_apart(spark):
    a, b = " ".join(f"a{k}" for k in range(50)), " ".join(f"b{k}" for k in range(50))
    rows = [(1, a), (1, b), (2, a), (None, a), (None, "c d e f"), (None, "c d e f"), (3, None), (4, "")]
    df = spark.createDataFrame(rows, "doc_id long, text string")
    got = sorted(map(str, map(tuple, simhash.simhash_dedup(df).collect())))
    assert got == sorted(map(str, [(1, a), (1, b), (None, "c d e f"), (3, None)]))
    assert simhash.simhash_dedup(df.limit(0)).count() == 0


def test_hot_cell_in_tiles(spark):
    rng = random.Random(1)
    fps = {rng.getrandbits(64) for _ in range(50)}
    base = rng.getrandbits(64)
    fps |= {base ^ 1 << a ^ 1 << b for a in range(40) for b in range(a)}
    fps = sorted(fps)
    signed = [x - (1 << 64) if x >> 63 else x for x in fps]
    df = spark.createDataFrame(list(zip(signed, range(len(fps)))), "fp long, id long")
    links = simhash.fingerprint_links(df, tile=32)
    got = {r.id: r.component for r in components(links).collect()}
    want = find([(i, j) for i in range(len(fps)) for j in range(i) if (fps[i] ^ fps[j]).bit_count() <= 2], range(len(fps)))
    assert got == {i: r for i, r in want.items() if i != r}


def test_empty(spark):
    df = spark.createDataFrame([], "doc_id long, text string")
    assert simhash.simhash_groups(df).count() == 0


@pytest.mark.parametrize("links", [[(i + 1, i) for i in range(70)], [(0, i) for i in range(1, 50)], [(5, 5)]])
def test_components(spark, links):
    ids = {x for p in links for x in p}
    got = {r.id: r.component for r in components(spark.createDataFrame(links, "a long, b long")).collect()}
    assert got == {i: min(ids) for i in ids if i != min(ids)}
