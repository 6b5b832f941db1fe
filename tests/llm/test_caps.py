import numpy as np
import pytest

from millrace.llm import caps
from millrace.llm.caps import Caps, vector_groups

from .test_simhash import find


def by_hand(rows, cosine=0.95):
    ok = [(i, np.array(v, float)) for i, v in rows if v is not None and len(v) and None not in v and np.isfinite(np.array(v, float)).all() and any(v)]
    ids, m = [i for i, _ in ok], np.array([v / np.linalg.norm(v) for _, v in ok])
    hit = m @ m.T >= cosine
    np.fill_diagonal(hit, False)
    top = find([(ids[a], ids[b]) for a, b in zip(*np.nonzero(hit))], [i for i, _ in rows])
    links = dict(zip(ids, hit.sum(1).tolist()))
    return {i: (links.get(i, 0), top[i], top[i] == i) for i, _ in rows}


def test_links_recall_and_edge_cases(spark):
    rng = np.random.default_rng(2)
    base = rng.standard_normal((400, 64))
    rows = [(k + 10, v.tolist()) for k, v in enumerate(base)]
    for k in range(500):  # near copies at cosines about the threshold
        v = base[k % 400]
        rows.append((1000 + k, (v + rng.standard_normal(64) * rng.choice([0.05, 0.25, 0.3, 0.35])).tolist()))
    for k in range(900):  # one crowded group of near copies: more than a tile
        rows.append((3000 + k, (base[7] + rng.standard_normal(64) * 0.1).tolist()))
    rows += [(5000 + k, base[9].tolist()) for k in range(30)] + [(1, (base[9] * 2).tolist())]
    rows += [(6000, None), (6001, []), (6002, [0.0] * 64), (6003, [None] + [1.0] * 63), (6004, [float("nan")] * 64), (6005, [float("inf")] * 64)]
    df = spark.createDataFrame([(i, v, 1, "x") for i, v in rows] + [(None, [1.0] * 64, 1, "x")], "vec_id long, embedding array<double>, n int, v string")
    got = {r.vec_id: (r.n_links, r.component_id, r.kept) for r in vector_groups(df, tile=400).collect()}
    want = by_hand(rows)
    assert got.keys() == want.keys()
    assert all(got[i][0] <= want[i][0] for i in got)  # none below the threshold
    assert sum(x[0] for x in got.values()) >= 0.97 * sum(x[0] for x in want.values())
    assert sum(got[i] == want[i] for i in got) >= 0.95 * len(want)
    assert got[6000] == (0, 6000, True) and got[5003][0] == want[5003][0] and got[5003][1] == 1


def test_repeated_short_and_empty(spark):
    rows = [(1, [1.0, 0.0]), (1, [1.0, 0.0]), (2, [2.0, 0.001]), (3, [1.0]), (4, [-5.0]), (4, [1.0])]
    df = spark.createDataFrame(rows, "vec_id long, embedding array<double>")
    got = sorted(map(tuple, vector_groups(df).collect()))
    assert got == [(1, 2, 1, True), (1, 2, 1, True), (2, 2, 1, False), (3, 1, 3, True), (4, 0, 4, True), (4, 1, 3, False)]
    assert vector_groups(df.limit(0)).count() == 0


def test_recall_on_given_vectors(spark):
    df = spark.read.parquet("/root/testdata/sf0.1/embeddings.parquet")
    rows = [(r.vec_id, r.embedding) for r in df.select("vec_id", "embedding").collect()]
    want = by_hand(rows)
    got = {r.vec_id: (r.n_links, r.component_id, r.kept) for r in vector_groups(df).collect()}
    assert all(got[i][0] <= want[i][0] for i in got)
    assert sum(x[0] for x in got.values()) >= 0.97 * sum(x[0] for x in want.values())


@pytest.mark.parametrize("filters", [1024, 40_000, 1 << 22])
@pytest.mark.parametrize("dim", [2, 4, 8, 16, 32, 64, 128, 768])
def test_recall_at_every_width_and_number_of_filters(dim, filters):
    rng = np.random.default_rng(1)
    one, other = (v / np.linalg.norm(v, axis=1, keepdims=True) for v in rng.standard_normal((2, 800, dim)))
    other -= (other * one).sum(1, keepdims=True) * one
    two = 0.95 * one + np.sqrt(1 - 0.95**2) * other / np.linalg.norm(other, axis=1, keepdims=True)
    some = Caps(dim, filters)
    lists = some.lists(one)
    assert np.mean([len(np.intersect1d(a, b)) > 0 for a, b in zip(lists, some.lists(two), strict=True)]) >= 0.93
    assert np.mean([len(x) for x in lists]) <= 1.1 * caps.MOST


@pytest.mark.parametrize("dim", [1, 2, 4, 8, 16])
def test_links_of_short_vectors(spark, dim):
    rng = np.random.default_rng(dim)
    rows = [(k, v.tolist()) for k, v in enumerate(rng.standard_normal((600, dim)))]
    rows += [(1000 + k, (np.array(rows[k][1]) + 0.1 * rng.standard_normal(dim)).tolist()) for k in range(200)]
    df = spark.createDataFrame(rows, "vec_id long, embedding array<double>")
    want = by_hand(rows)
    for filters in (None, 1 << 20):
        got = {r.vec_id: (r.n_links, r.component_id, r.kept) for r in vector_groups(df, filters=filters).collect()}
        assert all(got[i][0] <= want[i][0] for i in got)
        assert sum(x[0] for x in got.values()) >= 0.95 * sum(x[0] for x in want.values())


def test_many_crowded_buckets(spark, monkeypatch):
    rng = np.random.default_rng(6)
    base = rng.standard_normal(64)
    rows = [(k, (base + rng.standard_normal(64) * 0.1).astype(np.float32).tolist()) for k in range(1500)]
    df = spark.createDataFrame(rows, "vec_id long, embedding array<float>")
    want = sorted(map(tuple, caps.vector_groups(df, tile=400).collect()))
    monkeypatch.setattr(caps, "BROADCAST", 0)  # their list is joined
    assert sorted(map(tuple, caps.vector_groups(df, tile=400).collect())) == want
    assert sorted(map(tuple, caps.vector_groups(df).collect())) == want
    assert sum(r[1] for r in want) >= 0.97 * sum(x[0] for x in by_hand(rows).values())
