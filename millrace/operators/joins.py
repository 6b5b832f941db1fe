"""Joins: as-of, effective-dated, presence, comparison and look-ups."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from ..scratch import staged
from .terms import disjoint_terms


def asof_backward(left: DataFrame, right: DataFrame, on: str, by: Sequence[str], values: Sequence[str], outer: bool = False) -> DataFrame:
    """The latest right values at or before each left row, within ``by``; left rows without one are dropped, or with ``outer`` kept.

    Both sides go into one stream by key and time, so there is one shuffle and
    no pairing of rows within a range. Of right rows at one time the greatest
    values count.
    """
    row = F.struct(*[F.col(c) for c in left.columns])
    a = left.select(*by, on, F.lit(1).alias("_side"), row.alias("_row"), F.lit(None).cast(right.select(F.struct(*values)).schema[0].dataType).alias("_v"))
    b = right.select(*by, on, F.lit(0).alias("_side"), F.lit(None).cast(left.select(row).schema[0].dataType).alias("_row"), F.struct(*values).alias("_v"))
    w = Window.partitionBy(*by).orderBy(on, "_side", "_v").rowsBetween(Window.unboundedPreceding, 0)
    out = a.unionByName(b).withColumn("_v", F.last("_v", ignorenulls=True).over(w)).where("_side = 1" if outer else "_side = 1 and _v is not null")
    return out.select("_row.*", "_v.*")


def effective_dated(facts: DataFrame, terms: DataFrame, key: str, on: str, starts: str = "starts_on", ends: str = "ends_on", ties: Sequence[str] = ()) -> DataFrame:
    """Each fact with the term of its key that is in force on its date; of several the one that starts last.

    Terms are cut into segments that do not overlap, and a fact takes the last
    one that began before it: it does not meet all terms of its key.
    """
    values = [c for c in terms.columns if c != key]
    inner = terms.select(key, F.struct(*values).alias("_term"), starts, ends, *[t for t in ties if t not in (starts, ends)])
    cut = disjoint_terms(inner, [key], starts, ends, ["_term"], ties, facts.schema[on].dataType)
    named = cut.select(key, F.col("at").alias(on), F.struct("_term").alias("_seg"))
    return asof_backward(facts.where(F.col(key).isNotNull()), named, on, [key], ["_seg"]).where("_seg._term IS NOT NULL").select(*facts.columns, "_seg._term.*")


#: Segments of rates whose lists are broadcast at most; beyond it they are joined as of the day.
BROADCAST_SEGMENTS = 100_000


def rate_segments(rates: DataFrame, product: str, agent: str) -> DataFrame:
    """``product, agent, at, rate_id, rate_pct``: the rate in force from each day on which it may change, null where there is none.

    Of overlapping rates the one that began last counts, then the smallest id.
    """
    return disjoint_terms(rates, [product, agent], "effective_from", "effective_to", ["rate_id", "rate_pct"], ["rate_id"])


def resolve_rate(requests: DataFrame, rates: DataFrame, product: str, agent: str, on: str) -> DataFrame:
    """Each request with ``rate_id, rate_pct`` in force: an agent's own before the product's default, then the latest.

    A request without one has ``error`` NO_RATE. A request meets the lists of
    its agent and of its product, not each of their rates.
    """
    segments = staged(rate_segments(rates, product, agent))
    own, default = segments.where(F.col(agent).isNotNull()), segments.where(F.col(agent).isNull()).drop(agent)
    if segments.count() <= BROADCAST_SEGMENTS:
        lists = lambda df, keys, name: F.broadcast(df.groupBy(*keys).agg(F.sort_array(F.collect_list(F.struct("at", "rate_id", "rate_pct"))).alias(name)))
        rows = requests.join(lists(own, [product, agent], "_own"), [product, agent], "left").join(lists(default, [product], "_all"), product, "left")
        last = lambda name: F.try_element_at(F.filter(name, lambda x: x["at"] <= F.col(on)), F.lit(-1))
        rows = rows.withColumns({"_own": last("_own"), "_all": last("_all")})
    else:
        named = lambda df, name, keys: df.select(*keys, F.col("at").alias(on), F.struct("rate_id", "rate_pct").alias(name))
        rows = asof_backward(requests, named(own, "_own", [product, agent]), on, [product, agent], ["_own"], outer=True)
        rows = asof_backward(rows, named(default, "_all", [product]), on, [product], ["_all"], outer=True)
    best = F.when(F.col("_own.rate_id").isNotNull(), F.struct("_own.rate_id", "_own.rate_pct")).otherwise(F.struct("_all.rate_id", "_all.rate_pct"))
    out = rows.withColumn("_best", best).select(*[F.col(c) for c in requests.columns], "_best.*")
    return out.withColumn("error", F.when(F.col("rate_id").isNull(), "NO_RATE"))


def orphans(child: DataFrame, parent: DataFrame, child_key: str, parent_key: str) -> DataFrame:
    """Children with a key that no parent has; null keys are no orphans."""
    keys = parent.select(F.col(parent_key).alias(child_key)).distinct()
    return child.where(F.col(child_key).isNotNull()).join(keys, child_key, "left_anti")


def parent_present(child: DataFrame, staged: DataFrame, archived: DataFrame, keys: Sequence[str]) -> DataFrame:
    """Children whose keys, without trailing blanks, are among the staged or the archived parents'."""
    trimmed = lambda df: df.select(*[F.rtrim(F.col(k).cast("string")).alias(k) for k in keys])
    parents = trimmed(staged).unionByName(trimmed(archived)).distinct().alias("p")
    on = [F.rtrim(F.col(f"c.{k}").cast("string")) == F.col(f"p.{k}") for k in keys]
    return child.alias("c").join(parents, on, "left_semi")


def with_events(entities: DataFrame, events: DataFrame, key: str, order: Sequence[str]) -> DataFrame:
    """Entities with their events in order; those without keep one row of nulls."""
    return entities.join(events, key, "left").orderBy(key, *order)


def temporal_violations(events: DataFrame, entities: DataFrame, key: str, at: str, created: str) -> DataFrame:
    return events.join(entities.select(key, created), key).where(F.col(at) < F.col(created))


def latest_rows(products: DataFrame, margins: DataFrame, key: str, on: str) -> DataFrame:
    """Products with their rows of the latest date there is; the date is one value, broadcast."""
    latest = margins.agg(F.max(on).alias(on))
    return products.join(margins.join(F.broadcast(latest), on, "left_semi"), key)


def users_with_quota(users: DataFrame, quotas: DataFrame, key: str) -> DataFrame:
    used, quota = F.col("used_bytes"), F.col("quota_bytes")
    return users.join(quotas, key, "left").select(
        key, "used_bytes", "quota_bytes",
        F.when(quota > 0, F.round(used.cast("decimal(30,4)") * 100 / quota, 2)).cast("double").alias("usage_pct"),
        F.greatest(quota - used, F.lit(0)).alias("remaining_bytes"), (used > quota).alias("over_quota"),
    )


def file_with_shares(files: DataFrame, shares: DataFrame, key: str, fields: Sequence[str]) -> DataFrame:
    """Files with the sorted list of their shares, empty where there are none."""
    listed = shares.groupBy(key).agg(F.array_sort(F.collect_list(F.struct(*fields))).alias("shares"))
    return files.join(listed, key, "left").withColumn("shares", F.coalesce("shares", F.array().cast(listed.schema["shares"].dataType)))


def shares_by(shares: DataFrame, who: str, fields: Sequence[str]) -> DataFrame:
    """Of each recipient, or owner, the sorted list of their shares."""
    return shares.where(F.col(who).isNotNull()).groupBy(who).agg(F.array_sort(F.collect_list(F.struct(*fields))).alias("shares"))


def share_of(shares: DataFrame, asked: DataFrame, keys: Sequence[str]) -> DataFrame:
    """The share of each (file, user) that is asked for; null columns where there is none."""
    return asked.join(shares, list(keys), "left")


def compare_sides(a: DataFrame, b: DataFrame, key: str, columns: Sequence[str]) -> DataFrame:
    """``key, status, field``: AGREE, MISMATCH with the first column that differs, MISSING_TARGET or MISSING_SOURCE."""
    side = lambda df, n: df.select(key, F.sha2(F.concat_ws("|", *[F.coalesce(F.col(c).cast("string"), F.lit("")) for c in columns]), 256).alias("hash"), *columns).alias(n)
    joined = side(a, "a").join(side(b, "b"), F.col(f"a.{key}") == F.col(f"b.{key}"), "full_outer")
    differs = F.coalesce(*[F.when(~F.col(f"a.{c}").eqNullSafe(F.col(f"b.{c}")), F.lit(c)) for c in columns])
    status = (
        F.when(F.col(f"b.{key}").isNull(), "MISSING_TARGET").when(F.col(f"a.{key}").isNull(), "MISSING_SOURCE")
        .when(F.col("a.hash") == F.col("b.hash"), "AGREE").otherwise("MISMATCH")
    )
    return joined.select(F.coalesce(f"a.{key}", f"b.{key}").alias(key), status.alias("status"), F.when(status == "MISMATCH", differs).alias("field"))


def successor_class(df: DataFrame, policies: DataFrame, code: str, mapping: Column | None = None) -> DataFrame:
    """Rows with ``new_class``: the successor that the policy names, else the map's value, else the code itself."""
    p = policies.select(F.col("policy_code").alias(code), F.nullif(F.trim("successor_code"), F.lit("")).alias("_next"))
    out = df.join(p, code, "left")
    return out.withColumn("new_class", F.coalesce("_next", *([mapping] if mapping is not None else []), code)).drop("_next")


def star_join(ledger: DataFrame, policies: DataFrame, dims: Sequence[tuple[DataFrame, str, str, str]]) -> DataFrame:
    """Ledger rows with their policy and the surrogate key of each dimension: (frame, natural key there, here, surrogate)."""
    out = ledger.join(policies, "policy_id")
    for dim, natural, here, surrogate in dims:
        out = out.join(dim.select(F.col(natural).alias(here), surrogate), here)
    return out
