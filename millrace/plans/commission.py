"""Insurance commissions and their star schema."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from ..operators.joins import resolve_rate
from ..operators.sets import upsert_by_key


def validate_splits(splits: DataFrame, agents: DataFrame, policies: DataFrame | None = None) -> DataFrame:
    """``policy_id, problem``: the first of no split (of ``policies``, if given), duplicate agent, share outside (0, 100], inactive agent, total not 100; null if sound."""
    a = agents.select("agent_id", F.col("status").alias("_status"))
    inactive = F.coalesce(F.col("_status") != "ACTIVE", F.lit(True))
    rows = splits.join(a, "agent_id", "left").select("policy_id", "agent_id", "split_pct", inactive.alias("_inactive"), F.lit(policies is None).alias("_asked"))
    if policies is not None:
        asked = {"agent_id": rows.schema["agent_id"].dataType, "split_pct": rows.schema["split_pct"].dataType, "_inactive": "boolean"}
        rows = rows.where("policy_id IS NOT NULL").unionByName(policies.select("policy_id", *[F.lit(None).cast(t).alias(c) for c, t in asked.items()], F.lit(True).alias("_asked")))
    # One sort serves both windows, and a task holds no table of all its policies.
    w = Window.partitionBy("policy_id")
    by_agent = w.orderBy("agent_id")
    rows = rows.withColumns({"_at": F.row_number().over(by_agent), "_again": F.lag("agent_id").over(by_agent) == F.col("agent_id")})
    pct = F.col("split_pct")
    rows = rows.withColumns({
        "_asked": F.bool_or("_asked").over(w), "_agents": F.count("agent_id").over(w), "_twice": F.bool_or("_again").over(w), "_range": F.bool_or((pct <= 0) | (pct > 100)).over(w),
        "_inactive": F.bool_or("_inactive").over(w), "_total": F.sum(pct).over(w),
    })
    problem = F.when(F.col("_agents") == 0, "NO_SPLIT").when(F.col("_twice"), "DUPLICATE_AGENT").when(F.col("_range"), "SPLIT_RANGE").when(F.col("_inactive"), "AGENT_INACTIVE").when(F.col("_total") != 100, "SPLIT_TOTAL")
    return rows.where("_asked AND _at = 1").select("policy_id", problem.alias("problem"))


def calculate_commission(policies: DataFrame, splits: DataFrame, rates: DataFrame, month: str) -> DataFrame:
    """Ledger rows of a month: premium / 12 x rate x share, rounded once; in-force policies alone; ``error`` where no rate or no split."""
    last = F.last_day(F.lit(f"{month}-01").cast("date"))
    live = policies.where(F.col("status") == "IN_FORCE").join(splits, "policy_id", "left").withColumn("_on", last)
    rated = resolve_rate(live, rates, "product_code", "agent_id", "_on")
    amount = F.round(F.col("annual_premium").cast("decimal(14,2)") * F.col("rate_pct").cast("decimal(5,2)") * F.col("split_pct").cast("decimal(5,2)") / F.lit(120000), 2)
    return rated.select(
        "policy_id", "agent_id", F.lit(month).alias("period_month"), "rate_id", "split_pct", F.when(F.col("agent_id").isNull(), "NO_SPLIT").otherwise(F.col("error")).alias("error"),
        F.when(F.col("agent_id").isNotNull(), amount.cast("decimal(12,2)")).alias("commission_amt"),
    )


def replace_month(ledger: DataFrame, rows: DataFrame) -> DataFrame:
    """A rerun replaces the rows of its policies and month."""
    keys = ["policy_id", "period_month"]
    return ledger.join(rows.select(*keys).distinct(), keys, "left_anti").unionByName(rows.select(ledger.columns))


def validate_rates(changes: DataFrame, products: DataFrame, agents: DataFrame) -> DataFrame:
    """Changes with ``problem``: rate outside (0, 50], unknown product, agent not active; null if sound."""
    p = products.select("product_code", F.lit(True).alias("_p")).distinct()
    a = agents.select("agent_id", F.col("status").alias("_status"))
    problem = (
        F.when(F.col("rate_pct").isNull() | (F.col("rate_pct") <= 0) | (F.col("rate_pct") > 50), "RATE_RANGE").when(F.col("_p").isNull(), "UNKNOWN_PRODUCT")
        .when(F.col("agent_id").isNotNull() & F.coalesce(F.col("_status") != "ACTIVE", F.lit(True)), "AGENT_INACTIVE")
    )
    return changes.join(p, "product_code", "left").join(a, "agent_id", "left").withColumn("problem", problem).drop("_p", "_status")


def rate_audit(validated: DataFrame, actor: str) -> DataFrame:
    """An audit row for each change of ``validate_rates`` that was taken: its rate's id, percentage and first day."""
    text = [F.lit("rate_id="), F.col("rate_id").cast("string"), F.lit(" pct="), F.col("rate_pct").cast("string"), F.lit(" from="), F.date_format("effective_from", "yyyy-MM-dd")]
    return validated.where("problem is null").select(F.lit("RATE_UPSERT").alias("action"), "product_code", "agent_id", F.concat(*text).alias("detail"), F.lit(actor).alias("actor"))


def dimension(rows: DataFrame, natural: str, surrogate: str) -> DataFrame:
    """A surrogate key from the natural one, so that a rebuilt dimension has the same keys."""
    return rows.withColumn(surrogate, F.xxhash64(natural))


def period_dimension(months: DataFrame, month: str = "period_month") -> DataFrame:
    m = F.substring(month, 6, 2).cast("int")
    return months.select(month).distinct().select(month, F.substring(month, 1, 4).cast("int").alias("year"), m.alias("month"), F.ceil(m / 3).cast("int").alias("quarter"), F.xxhash64(month).alias("period_key"))


def load_star(dims: dict[str, tuple[DataFrame, DataFrame, str]], facts: tuple[DataFrame, DataFrame, list[str]]) -> dict[str, DataFrame]:
    """Upserts of all dimensions (existing, incoming, key) and of the facts (existing, incoming, keys); running it twice changes nothing."""
    out = {n: upsert_by_key(old, new, [k]) for n, (old, new, k) in dims.items()}
    return out | {"facts": upsert_by_key(facts[0], facts[1], facts[2])}


def agent_share(premium: Column, rate: Column, share: Column) -> Column:
    return F.round(premium.cast("decimal(14,2)") * rate.cast("decimal(5,2)") * share.cast("decimal(5,2)") / F.lit(120000), 2).cast("decimal(12,2)")
