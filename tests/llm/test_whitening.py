import numpy as np
import pytest

from millrace.llm import queries
from millrace.llm.whitening import Grid, Whitening, fit_whitening, whiten, whitened_components


def by_hand(rows, scale=64, offset=1_000_000):
    """vec_id, n * x - S, the covariance's eigenvalues and vectors, from exact integers."""
    ok = [(i, np.array(v, float)) for i, v in rows if v is not None and len(v) and None not in v and np.isfinite(np.array(v, float)).all()]
    x = np.array([np.floor(scale * v) for _, v in ok]).astype(np.int64) + offset
    n, s = len(x), x.sum(0)
    d = (n * x - s).astype(object)
    # Of the rows themselves: a covariance matrix in double precision loses the small eigenvalues.
    _, sigma, v = np.linalg.svd((d / n).astype(float), full_matrices=False)
    return [i for i, _ in ok], d, sigma**2 / n, v.T


def check(got, rows, components=32):
    ids, d, e, v = by_hand(rows)
    n, k = len(ids), min(components, int((e > 1e-18 * e[0]).sum()))
    assert len(got) == n * k
    dev = {i: int((x**2).sum()) for i, x in zip(ids, d, strict=True)}
    table = {(r.vec_id, r.component): r for r in got}
    assert {c for _, c in table} == set(range(1, k + 1))
    assert len({r.identity_error for r in got}) == 1 and got[0].identity_error < 1e-8
    for r in got:
        assert r.n == n and r.deviation == dev[r.vec_id] and r.explained == pytest.approx(e[r.component - 1] / e.sum(), rel=1e-9)
    w = np.array([[table[i, c + 1].whitened for c in range(k)] for i in ids])
    want = (d / n).astype(float) @ v[:, :k] / np.sqrt(e[:k])
    sign = np.sign((w * want).sum(0))
    assert np.abs(w - want * sign).max() < 1e-6
    assert np.abs(w.T @ w / n - np.eye(k)).max() < 1e-9


@pytest.mark.parametrize("sf", ["sf0.01", "sf0.1"])
def test_given_vectors(spark, sf):
    at = f"/root/testdata/{sf}"
    rows = [(r.vec_id, r.embedding) for r in spark.read.parquet(f"{at}/embeddings.parquet").collect()]
    check(queries.QUERIES["op13_whitening"](spark, at).collect(), rows)


def test_badly_conditioned(spark):
    """Deviations from some 3 to 100,000 around the large offset, one column nearly a sum of others."""
    rng = np.random.default_rng(4)
    base = rng.standard_normal((700, 12)) * np.logspace(-1.3, 3.2, 12)
    base[:, 3] = base[:, 10] + base[:, 11] + 0.02 * base[:, 0]
    rows = [(k, v.tolist()) for k, v in enumerate(base)]
    df = spark.createDataFrame(rows, "vec_id long, embedding array<double>").repartition(7)
    check(whitened_components(df, grid=Grid(64, 1_000_000)).collect(), rows)


def test_dependent_columns_and_edge_cases(spark):
    rng = np.random.default_rng(5)
    base = rng.integers(-50, 50, (300, 6)) / 64.0
    base[:, 4], base[:, 5] = base[:, 0] + base[:, 1], 2.0  # rank 4
    rows = [(k, v.tolist()) for k, v in enumerate(base)]
    odd = [(900, None), (901, []), (902, [None] + [1.0] * 5), (903, [float("nan")] * 6), (904, [float("inf")] * 6)]
    df = spark.createDataFrame([(i, v, 1, 2) for i, v in rows + odd], "vec_id long, embedding array<double>, n int, component int").repartition(5)
    got = whitened_components(df, grid=Grid(64, 1_000_000)).collect()
    check(got, rows)
    assert {r.component for r in got} == {1, 2, 3, 4}
    assert whitened_components(df.limit(0)).count() == 0
    assert whitened_components(df.where("vec_id = 3")).count() == 0  # one row has no variance


def test_lengths_repeats_and_floats(spark):
    rng = np.random.default_rng(6)
    two, three = rng.standard_normal((40, 2)), rng.standard_normal((50, 3))
    rows = [(None if k == 5 else k, v.tolist()) for k, v in enumerate(two)] + [(7, v.tolist()) for v in three]
    df = spark.createDataFrame(rows, "vec_id long, embedding array<float>")
    models = fit_whitening(df)
    assert {d: m.n for d, m in models.items()} == {2: 40, 3: 50}
    got = whiten(df, models).collect()
    assert len(got) == 90 and sum(r.vec_id is None for r in got) == 1 and all(r.deviation is None for r in got)
    w = np.array([r.whitened for r in got if len(r.whitened) == 3])
    assert np.abs(np.cov(w.T, bias=True) - np.eye(3)).max() < 1e-9


def test_exact_beyond_fast_integers():
    m = Whitening(3_000_000, np.array([5, 7]), np.empty(0), np.empty(0), np.empty(0))
    assert m.deviation(np.array([[900_000, -4]])) == [(3_000_000 * 900_000 - 5) ** 2 + (3_000_000 * -4 - 7) ** 2]
    with pytest.raises(ValueError):
        Grid(64, 0)(np.array([[1e300]]))
