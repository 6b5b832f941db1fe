import datetime
import random

import pytest

from millrace.operators import digests as dg
from millrace.operators.joins import compare_sides, effective_dated, rate_segments
from millrace.operators.terms import disjoint_terms

D0 = datetime.date(2024, 1, 1)


def day(n):
    return None if n is None else D0 + datetime.timedelta(days=n)


def some_terms(seed, n):
    rng = random.Random(seed)
    rows = []
    for k in range(n):
        s = rng.randrange(40)
        e = rng.choice([None, s + rng.randrange(-3, 25), s, s + 1])
        rows.append((rng.choice(["a", "b", None]), None if rng.random() < 0.03 else s, e, k))
    return rows


def in_force(rows, key, d):
    open_ = [(s, -i, i) for k, s, e, i in rows if k == key and s is not None and s <= d and (e is None or e >= d)]
    return max(open_)[2] if open_ else None


@pytest.mark.parametrize("seed, n", [(1, 12), (2, 60), (3, 3), (4, 200)])
def test_segments_against_each_day(spark, seed, n):
    rows = some_terms(seed, n)
    df = spark.createDataFrame([(k, day(s), day(e), i) for k, s, e, i in rows], "key string, s date, e date, id int").repartition(4)
    got = disjoint_terms(df, ["key"], "s", "e", ["id"], ["id"]).collect()
    assert len(got) == len({(r.key, r["at"]) for r in got}) <= 2 * n
    for key in ("a", "b", None):
        own = sorted((r["at"], r.id) for r in got if r.key == key)
        for d in range(-2, 75):
            last = [i for at, i in own if at <= day(d)]
            assert (last[-1] if last else None) == in_force(rows, key, d)


def test_effective_dated_against_pairs(spark):
    rows = [(k, s, e, i) for k, s, e, i in some_terms(5, 80) if k]
    rng = random.Random(6)
    facts = [(n, rng.choice(["a", "b", "z", None]), rng.randrange(-3, 70)) for n in range(300)]
    terms = spark.createDataFrame([(k, day(s), day(e), i) for k, s, e, i in rows], "key string, starts_on date, ends_on date, id int")
    df = spark.createDataFrame([(n, k, day(d)) for n, k, d in facts], "n int, key string, on date")
    got = sorted((r.n, r.id) for r in effective_dated(df, terms, "key", "on", ties=["id"]).collect())
    assert got == sorted((n, i) for n, k, d in facts if k and (i := in_force(rows, k, d)) is not None)
    assert effective_dated(df, terms.limit(0), "key", "on").count() == 0


def test_rate_segments_keep_gaps_and_null_agents(spark):
    rates = spark.createDataFrame([(1, "p", None, 5.0, day(0), day(9)), (2, "p", None, 6.0, day(20), None), (3, "p", 7, 9.0, day(3), day(3))], "rate_id int, product string, agent int, rate_pct double, effective_from date, effective_to date")
    got = sorted(((r.agent or 0, r["at"], r.rate_id) for r in rate_segments(rates, "product", "agent").collect()), key=str)
    assert got == sorted([(0, day(0), 1), (0, day(10), None), (0, day(20), 2), (7, day(3), 3), (7, day(4), None)], key=str)


def sides(spark, n, changed=()):
    a = spark.range(n).selectExpr("id AS k", "concat('v', id) AS v", "if(id % 7 = 0, null, id * 2) AS w")
    b = a.repartition(5)
    for k, what in changed:
        if what == "gone":
            b = b.where(f"k <> {k}")
        elif what == "new":
            b = b.unionByName(spark.createDataFrame([(k, "v", 1)], a.schema))
        elif what == "null":
            b = b.selectExpr("k", "v", f"if(k = {k}, null, w) AS w")
        else:
            b = b.selectExpr("k", f"if(k = {k}, 'changed', v) AS v", "w")
    return a, b


@pytest.mark.parametrize("levels", [(4, 64), (8,), (2, 8, 512)])
def test_planted_faults_are_found(spark, levels):
    a, b = sides(spark, 2000, [(5, "gone"), (9000, "new"), (33, "null"), (700, "value")])
    want = sorted(map(tuple, compare_sides(a, b, "k", ["v", "w"]).where("status <> 'AGREE'").collect()))
    assert sorted(map(tuple, dg.compare_by_digests(a, b, "k", ["v", "w"], levels).collect())) == want and len(want) == 4
    assert dg.differing_buckets(a, b, "k", ["v", "w"], levels).count() <= 4


def test_equal_tables_move_digests_alone(spark):
    a, b = sides(spark, 2000)
    assert dg.differing_buckets(a, b, "k", ["v", "w"]) is None
    assert dg.compare_by_digests(a, b, "k", ["v", "w"]).count() == 0
    twice = a.unionByName(a.where("k = 3"))  # two more rows of the same hash do not cancel out
    assert dg.differing_buckets(a, twice.unionByName(a.where("k = 3")), "k", ["v", "w"]).count() == 1
