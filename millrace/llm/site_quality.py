"""Quality and toxicity by hierarchical empirical Bayes."""

from __future__ import annotations

import re
from collections.abc import Iterator
from math import log2

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from .common import bounded_batches, hash_sample, spread_join, staged

#: Labelled ids that the document classifier is fitted on, about, and its features for each target.
SAMPLE, FEATURES = 6000, 800
#: A feature is used if it is in so many sampled documents and its share differs by so many standard errors.
LEAST_DOCS, LEAST_Z = 4, 4.0
#: What a site's own rate is weighed against: at least so many documents at the rate above it.
LEAST_PRIOR, MOST_PRIOR = 20.0, 1e6
#: Sites are broadcast up to this number, else joined by a shuffle.
BROADCAST_SITES = 20_000
TARGETS = ("low", "toxic")
#: Host and first part of the path of a source; a source without a path is divided by language instead.
HOST, PATH = r"^(?:[A-Za-z]+://)?([^/]*)", r"^(?:[A-Za-z]+://)?[^/]*/([^/?#]+)"
_WORD = re.compile(r"[^\W\d_]+")
_SIGN = re.compile(r"[^\w\s.,;:'\"?!()-]")
_PREFIXES = (4, 5, 6, 7)


def features(text: str | None) -> set[str]:
    """Words, beginnings of words and levels of surface measures, as strings; nothing for no text."""
    if not text:
        return set()
    words = _WORD.findall(text)
    lower = [w.lower() for w in words]
    own = set(lower)
    out = {f"w{w}" for w in own if len(w) <= 24}
    for n in _PREFIXES:
        out |= {f"p{w[:n]}" for w in own if len(w) > n}
    n = max(1, len(words))
    shares = {
        "sign": len(_SIGN.findall(text)) / len(text),
        "bang": text.count("!") / n,
        "upper": sum(map(str.isupper, words)) / n,
        "again": sum(a == b for a, b in zip(lower, lower[1:], strict=False)) / n,
        "distinct": len(own) / n,
        "letters": sum(map(len, words)) / len(text),
    }
    return out | {f"s{k}{int(2 * log2(1 + 200 * v))}" for k, v in shares.items()}


def _logit(x):
    return np.log(x / (1 - x))


def _regress(x: np.ndarray, y: np.ndarray, steps: int = 300, ridge: float = 0.5) -> tuple[np.ndarray, float]:
    """Logistic regression by accelerated gradient steps on scaled columns, with an L2 penalty on the scaled weights."""
    n = len(y)
    mean, scale = x.mean(0), x.std(0) + 1e-3
    x = (x - mean) / scale
    top = np.ones(x.shape[1], np.float32)
    for _ in range(20):  # the largest eigenvalue sets the step
        top = x.T @ (x @ (top / np.linalg.norm(top)))
    size = 1 / (1.1 * float(np.linalg.norm(top)) / (4 * n) + ridge / n)
    w, b = np.zeros(x.shape[1], np.float32), float(_logit(y.mean()))
    v, c = w, b
    for k in range(steps):
        miss = 1 / (1 + np.exp(-(x @ v + c))) - y
        w2, b2 = v - size * (x.T @ miss / n + ridge / n * v), c - min(size, 4.0) * float(miss.mean())
        v, c = w2 + k / (k + 3) * (w2 - w), b2 + k / (k + 3) * (b2 - b)
        w, b = w2, b2
    return w / scale, b - float((w / scale) @ mean)


def fit_documents(docs: DataFrame, labels: DataFrame, id_col: str, text_col: str, sample: int = SAMPLE) -> tuple[dict[str, tuple[float, float]], tuple[float, float]]:
    """Weights of features for both targets, as evidence (log odds less the sample's own), and the evidence of no feature.

    ``labels``: id, ``low``, ``toxic`` (0, 1 or null). Fitted on about
    ``sample`` labelled ids, chosen by a hash.
    """
    spark = docs.sparkSession
    chosen = hash_sample(labels, id_col, sample)
    # Of rows that repeat an id one counts, so that the sample keeps its bound.
    joined = docs.select(F.col(id_col).alias("id"), F.col(text_col).alias("t")).join(F.broadcast(chosen.withColumnRenamed(id_col, "id")), "id")
    rows = joined.groupBy("id").agg(F.max(F.struct("t", "low", "toxic")).alias("r")).select("r.low", "r.toxic", "r.t")

    def read(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            yield pa.RecordBatch.from_arrays([b.column(0), b.column(1), pa.array([sorted(features(x.as_py())) for x in b.column(2)], pa.list_(pa.string()))], ["low", "toxic", "f"])

    seen = staged(rows.mapInArrow(read, "low int, toxic int, f array<string>"))
    sums = [x for t in TARGETS for x in (F.count(t).alias(f"n_{t}"), F.sum(t).alias(f"y_{t}"))]
    base = seen.agg(*sums).first()
    rates = {t: (base[f"y_{t}"] or 0) / base[f"n_{t}"] if base[f"n_{t}"] else 0.0 for t in TARGETS}
    used: dict[str, int] = {}
    counts = staged(seen.select("low", "toxic", F.explode("f").alias("f")).groupBy("f").agg(*sums))
    for t in TARGETS:
        p = rates[t]
        if 0 < p < 1:
            z = F.abs(F.col(f"y_{t}") - F.col(f"n_{t}") * p) / F.sqrt(F.col(f"n_{t}") * p * (1 - p))
            top = counts.where((F.col(f"n_{t}") >= LEAST_DOCS) & (z >= LEAST_Z)).orderBy(z.desc(), "f").limit(FEATURES)
            for r in top.select("f").collect():
                used.setdefault(r.f, len(used))
    names = sorted(used)
    if not names:
        return {}, (0.0, 0.0)
    # About ``sample`` rows come to the driver, with the used features alone.
    shared = spark.sparkContext.broadcast({f: k for k, f in enumerate(names)})

    def thin(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        at = shared.value
        for b in batches:
            lists = [[at[f] for f in x.as_py() if f in at] for x in b.column(2)]
            yield pa.RecordBatch.from_arrays([b.column(0), b.column(1), pa.array(lists, pa.list_(pa.int32()))], ["low", "toxic", "f"])

    small = seen.mapInArrow(thin, "low int, toxic int, f array<int>").collect()
    x = np.zeros((len(small), len(names)), np.float32)
    for k, r in enumerate(small):
        x[k, r.f] = 1
    weights, bias = np.zeros((len(names), 2)), [0.0, 0.0]
    for k, t in enumerate(TARGETS):
        has = np.array([r[t] is not None for r in small])
        y = np.array([r[t] or 0 for r in small], np.float32)[has]
        if len(y) and 0 < y.mean() < 1:
            w, b = _regress(x[has], y)
            weights[:, k], bias[k] = w, b - float(_logit(y.mean()))
    return {f: (float(a), float(b)) for f, (a, b) in zip(names, weights, strict=True)}, (bias[0], bias[1])


def _shrink(sites: DataFrame, keys: list[str], above: dict[str, Column], weight: dict[str, float]) -> DataFrame:
    """Posterior mean rates of groups: their own sums against ``weight`` documents at the rate above."""
    return sites.select(*keys, "n", *[f"y_{t}" for t in TARGETS], *[((F.col(f"y_{t}") + weight[t] * above[t]) / (F.col("n") + weight[t])).alias(f"rate_{t}") for t in TARGETS])


def _prior_weight(groups: DataFrame, rate: dict[str, float]) -> dict[str, float]:
    """Empirical Bayes: the beta prior's weight by moments, from the groups' spread beyond what sampling makes."""
    out = {}
    for t in TARGETS:
        p = rate[t]
        r = groups.agg(F.sum("n"), F.count("*"), F.sum(F.col("n") * F.pow(F.col(f"y_{t}") / F.col("n") - p, 2)), F.sum(F.pow("n", F.lit(2)))).first()
        total, k, spread, squares = (float(x or 0) for x in r)
        free = total - squares / total if total else 0.0
        between = (spread - (k - 1) * p * (1 - p)) / free if free > 0 else 0.0
        out[t] = min(MOST_PRIOR, max(LEAST_PRIOR, p * (1 - p) / between - 1)) if between > 1e-12 else MOST_PRIOR
    return out


class _Judge:
    """The fitted parts: evidence of texts, and rates of sites from all documents' evidence and labels."""

    def __init__(self, docs: DataFrame, labels: DataFrame, id_col: str, text_col: str, host: Column | None, path: Column | None, quality_col: str, toxic_col: str, sample: int, whole: bool = False):
        spark = docs.sparkSession
        bounded_batches(spark)
        host = F.regexp_extract("source", HOST, 1) if host is None else host
        path = F.coalesce(F.nullif(F.regexp_extract("source", PATH, 1), F.lit("")), F.col("lang")) if path is None else path
        known = (
            labels.where(F.col(id_col).isNotNull()).groupBy(F.col(id_col))
            .agg(F.max(1 - F.col(quality_col)).cast("int").alias("low"), F.max(toxic_col).cast("int").alias("toxic"))
        )
        weights, bias = fit_documents(docs, known, id_col, text_col, sample)
        shared = spark.sparkContext.broadcast((weights, bias))  # at most 2 * FEATURES features

        @F.arrow_udf("struct<low:double,toxic:double>")
        def evidence(texts: pa.Array) -> pa.Array:
            weights, bias = shared.value
            low, toxic = [], []
            for x in texts:
                a, b = bias
                for f in features(x.as_py()) & weights.keys():
                    a += weights[f][0]
                    b += weights[f][1]
                low.append(a)
                toxic.append(b)
            return pa.StructArray.from_arrays([pa.array(low), pa.array(toxic)], ["low", "toxic"])

        taken = set(docs.columns)
        self.e, self.h, self.p = (next(n for n in (f"_{c}{k}" for k in range(99)) if n not in taken) for c in ("e", "h", "p"))
        site = {self.h: F.coalesce(host.cast("string"), F.lit("")), self.p: F.coalesce(path.cast("string"), F.lit(""))}
        marked = docs.withColumns({**site, self.e: evidence(F.col(text_col))})
        #: The documents (with ``whole``) with their site and evidence, computed once and written; and ids, sites and evidence alone.
        self.marked = staged(marked if whole else marked.select(F.col(id_col), self.h, self.p, self.e))
        self.narrow = self.marked.select(F.col(id_col).alias("id"), self.h, self.p, self.e)
        self.sites = self._rates(known.select(F.col(id_col).alias("id"), *TARGETS))

    def _rates(self, known: DataFrame) -> DataFrame:
        h, p = self.h, self.p
        given = known.agg(*[F.avg(t).alias(t) for t in TARGETS]).first()
        prior = {t: min(max(given[t] or 0.0, 1e-4), 1 - 1e-4) for t in TARGETS}
        guess = {t: 1 / (1 + F.exp(-(F.col(f"{self.e}.{t}") + float(_logit(prior[t]))))) for t in TARGETS}
        y = self.narrow.join(known, "id", "left").select(h, p, *[F.coalesce(F.col(t).cast("double"), guess[t]).alias(t) for t in TARGETS])
        sums = lambda c: [F.sum(c.format(t)).alias(f"y_{t}") for t in TARGETS]
        paths = staged(y.groupBy(h, p).agg(F.count("*").alias("n"), *sums("{}")))
        hosts = paths.groupBy(h).agg(F.sum("n").alias("n"), *sums("y_{}"))
        whole = hosts.agg(F.sum("n").alias("n"), *sums("y_{}")).first()
        rate = {t: ((whole[f"y_{t}"] or 0.0) + prior[t]) / ((whole["n"] or 0) + 1) for t in TARGETS}
        host_rates = _shrink(hosts, [h], {t: F.lit(rate[t]) for t in TARGETS}, _prior_weight(hosts, rate))
        above = paths.join(host_rates.select(h, *[F.col(f"rate_{t}").alias(f"above_{t}") for t in TARGETS]), h)
        sites = _shrink(above, [h, p], {t: F.col(f"above_{t}") for t in TARGETS}, _prior_weight(paths, rate))
        return staged(sites.select(h, p, *[F.col(f"rate_{t}").alias(f"{h}_{t}") for t in TARGETS]))

    def decide(self, rows: DataFrame, keep: list[str], threshold: float) -> DataFrame:
        """``keep`` of ``marked`` or ``narrow`` rows, and ``_judged``."""
        h, p = self.h, self.p
        if self.sites.count() <= BROADCAST_SITES:
            joined = rows.join(F.broadcast(self.sites), [h, p])
        else:
            joined = spread_join(rows, self.sites, [h, p])
        site = {t: F.col(f"{h}_{t}") for t in TARGETS}
        post = {t: 1 / (1 + F.exp(-(F.col(f"{self.e}.{t}") + F.log(site[t] / (1 - site[t]))))) for t in TARGETS}
        worst = F.greatest(*post.values()) > threshold
        parts = [site["low"].alias("site_low"), site["toxic"].alias("site_toxic"), post["low"].alias("p_low"), post["toxic"].alias("p_toxic"), worst.alias("rejected")]
        return joined.select(*[F.col(f"`{c}`") for c in keep], F.struct(*parts).alias("_judged"))


def site_quality(
    docs: DataFrame, labels: DataFrame, id_col: str = "doc_id", text_col: str = "text", host: Column | None = None, path: Column | None = None,
    quality_col: str = "quality", toxic_col: str = "toxic", threshold: float = 0.5, sample: int = SAMPLE,
) -> DataFrame:
    """``id_col, site_low, site_toxic, p_low, p_toxic, rejected`` of each row with an id.

    The document classifier's log odds (evidence) of low quality and of toxic
    content are added to those of the document's site: its ``host`` (by default
    of ``source``) and ``path`` (the first part of the source's, or else
    ``lang``). A site's rate is that
    of its documents (labels where given, else the classifier's probability),
    shrunk: paths towards their host, hosts towards all documents, each by a
    weight estimated from how much the groups differ. A document is rejected
    if either probability is over ``threshold``.

    Null texts give no evidence; null hosts and paths are groups of their own;
    null labels are not used, and of labels that differ for an id the worse one
    counts; repeated rows are judged like any other; without labels nothing is
    rejected. Other columns are ignored.
    """
    judge = _Judge(docs, labels, id_col, text_col, host, path, quality_col, toxic_col, sample)
    return judge.decide(judge.narrow.where("id is not null"), ["id"], threshold).select(F.col("id").alias(id_col), "_judged.*")


def keep_good(
    docs: DataFrame, labels: DataFrame, id_col: str = "doc_id", text_col: str = "text", host: Column | None = None, path: Column | None = None,
    quality_col: str = "quality", toxic_col: str = "toxic", threshold: float = 0.5, sample: int = SAMPLE,
) -> DataFrame:
    """``docs`` without the rows that ``site_quality`` rejects; rows without an id are judged by text and site. Columns stay.

    The documents are written once with their evidence, so that it is not computed again and texts are not shuffled.
    """
    judge = _Judge(docs, labels, id_col, text_col, host, path, quality_col, toxic_col, sample, whole=True)
    return judge.decide(judge.marked, docs.columns, threshold).where(~F.col("_judged.rejected")).select(docs.columns)
