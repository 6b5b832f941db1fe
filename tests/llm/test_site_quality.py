import math
import random
import re

import pytest
from pyspark.sql import functions as F

from millrace.llm import site_quality as sq


def test_held_out_labels(spark):
    docs = spark.read.parquet("/root/testdata/sf0.1/documents.parquet")
    labels = spark.read.parquet("/root/testdata/sf0.1/labels.parquet")
    fold = F.pmod(F.xxhash64("doc_id"), F.lit(4)) == 0
    got = sq.site_quality(docs, labels.where(~fold)).join(labels.where(fold), "doc_id").collect()
    assert len(got) > 800
    bad = [r for r in got if r.toxic or not r.quality]
    good = [r for r in got if r.quality and not r.toxic]
    assert sum(r.rejected for r in bad) >= 0.93 * len(bad)
    assert sum(r.rejected for r in good) <= 0.01 * len(good)


def test_sites_are_shrunk_and_decide_for_weak_evidence(spark):
    rng = random.Random(0)
    rows, labels = [], []
    for k in range(900):
        host = f"h{k % 3}"
        low = rng.random() < (0.9 if host == "h0" else 0.05)
        rows.append((k, " ".join(rng.choice(["a", "b", "c", "d"]) for _ in range(9)), host, "en" if k % 2 else "de", "x"))
        labels.append((k, 0 if low else 1, 0))
    rows += [(5000, None, "h0", None, "x"), (5001, "", None, None, "x"), (5002, "a b " * 20000, "new", "en", "x"), (5003, "a", "h0", "en", "x"), (5003, "a", "h0", "en", "x"), (None, "a", "h1", "en", "x")]
    labels += [(None, 0, 1), (7777, None, None), (1, None, 0), (1, 1, None)]
    docs = spark.createDataFrame(rows, "doc_id long, text string, source string, lang string, low string")
    known = spark.createDataFrame(labels, "doc_id long, quality int, toxic int")
    got = sq.site_quality(docs, known).collect()
    by = {r.doc_id: r for r in got}
    assert len(got) == len(rows) - 1
    assert by[5000].site_low > 0.7 and by[1].site_low < 0.2
    assert by[5000].rejected and not by[1].rejected
    few = by[5002].site_low
    assert 0.1 < few < 0.7  # one document: near the rate of all
    kept = sq.keep_good(docs, known)
    assert kept.columns == docs.columns
    want = sorted(r.doc_id for r in got if not r.rejected)
    assert sorted(r.doc_id for r in kept.where("doc_id is not null").collect()) == want
    was, sq.BROADCAST_SITES = sq.BROADCAST_SITES, 0
    again = {r.doc_id: r for r in sq.site_quality(docs, known).collect()}
    sq.BROADCAST_SITES = was
    assert all(again[k].p_low == pytest.approx(by[k].p_low) for k in by)


def test_without_labels_and_empty(spark):
    none = spark.createDataFrame([], "doc_id long, quality int, toxic int")
    docs = spark.createDataFrame([(1, "a b", "h", "en")], "doc_id long, text string, source string, lang string")
    assert [r.rejected for r in sq.site_quality(docs, none).collect()] == [False]
    assert sq.site_quality(docs.limit(0), none).count() == 0


def test_posteriors_by_brute_force(spark):
    """Rates and posteriors from the evidence, with plain sums."""
    rng = random.Random(5)
    rows, labels = [], []
    for k in range(1200):
        host, part = f"h{rng.randrange(6)}.org", rng.choice(["", "/a", "/b/x", "/c?q=1"])
        bad = rng.random() < {"h0.org": 0.7, "h1.org": 0.4}.get(host, 0.1) * (0.5 if part == "/a" else 1.2)
        text = " ".join(rng.choice(["good", "fine", "ok"] if not bad or rng.random() < 0.2 else ["bad", "ok", "junk!"]) for _ in range(rng.randint(1, 4)))
        rows.append((k, text, rng.choice(["http://", ""]) + host + part, rng.choice(["en", "de", None])))
        if rng.random() < 0.5:
            labels.append((k, int(not bad), int(rng.random() < 0.1)))
    docs = spark.createDataFrame(rows, "doc_id long, text string, source string, lang string")
    known = spark.createDataFrame(labels, "doc_id long, quality int, toxic int")
    judge = sq._Judge(docs, known, "doc_id", "text", None, None, "quality", "toxic", 6000)
    evidence = {r.id: (r[judge.h], r[judge.p], r[judge.e]) for r in judge.narrow.collect()}
    site = {}
    for k, _, source, lang in rows:
        host, _, path = source.removeprefix("http://").partition("/")
        site[k] = (host, re.split("[/?#]", path)[0] or lang or "")
    assert {k: v[:2] for k, v in evidence.items()} == site
    given = {k: (1 - q, t) for k, q, t in labels}
    logit = lambda p: math.log(p / (1 - p))
    rates = []
    for x in range(2):
        prior = min(max(sum(g[x] for g in given.values()) / len(given), 1e-4), 1 - 1e-4)
        y = {k: given[k][x] if k in given else 1 / (1 + math.exp(-(evidence[k][2][x] + logit(prior)))) for k in site}
        whole = (sum(y.values()) + prior) / (len(y) + 1)

        def groups(key):
            out = {}
            for k, v in y.items():
                n, s = out.get(key(k), (0, 0.0))
                out[key(k)] = (n + 1, s + v)
            return out

        def weight(g, p):
            total, squares = sum(n for n, _ in g.values()), sum(n * n for n, _ in g.values())
            spread = sum(n * (s / n - p) ** 2 for n, s in g.values())
            between = (spread - (len(g) - 1) * p * (1 - p)) / (total - squares / total)
            return min(sq.MOST_PRIOR, max(sq.LEAST_PRIOR, p * (1 - p) / between - 1)) if between > 1e-12 else sq.MOST_PRIOR

        hosts, paths = groups(lambda k: site[k][0]), groups(lambda k: site[k])
        w = weight(hosts, whole)
        above = {h: (s + w * whole) / (n + w) for h, (n, s) in hosts.items()}
        w = weight(paths, whole)
        rates.append({p: (s + w * above[p[0]]) / (n + w) for p, (n, s) in paths.items()})
    got = sq.site_quality(docs, known).collect()
    assert len(got) == len(rows) and 50 < sum(r.rejected for r in got) < 900
    for r in got:
        low, toxic = (rates[x][site[r.doc_id]] for x in range(2))
        p = [1 / (1 + math.exp(-(evidence[r.doc_id][2][x] + logit(v)))) for x, v in enumerate((low, toxic))]
        assert (r.site_low, r.site_toxic, r.p_low, r.p_toxic) == pytest.approx((low, toxic, *p))
        assert r.rejected == (max(p) > 0.5)
