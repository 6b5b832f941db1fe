import uuid
from decimal import Decimal

from pyspark.sql import functions as F

from millrace.functions.normalize import uuid5
from millrace.operators import joins as jn
from millrace.operators.aggregates import daily_usage_rollup, usage_report_header
from millrace.plans import commission as cm
from millrace.plans import margin as mg
from millrace.queries import events
from millrace.queries.registry import Tables


def test_daily_rollup_of_a_seed(spark):
    """Three days of 55 events: created 4, viewed 9, edited 5, uploads 6, downloads 7, sessions 3, 6 MiB in, 2 MiB out."""
    mib = 1 << 20
    plan = {"document.created": 4, "document.viewed": 9, "document.edited": 5, "file.uploaded": 6, "file.downloaded": 7, "collab.session_started": 3, "storage.allocated": 6, "storage.released": 2, "other": 13}
    rows = []
    for d in (1, 2, 3):
        n = 0
        for kind, k in plan.items():
            for _ in range(k):
                rows.append((f"2024-03-0{d} {n // 60:02d}:{n % 60:02d}:00", f"u{n % 8}", kind, mib if kind.startswith("storage") else None))
                n += 1
    df = spark.createDataFrame(rows, "t string, user_id string, event_type string, bytes long").withColumn("ts", F.to_timestamp("t"))
    out = daily_usage_rollup(df, {}).orderBy("day").collect()
    assert len(out) == 3
    for r in out:
        assert (r.total_events, r.users, r.created, r.viewed, r.edited, r.uploaded, r.downloaded, r.sessions) == (55, 8, 4, 9, 5, 6, 7, 3)
        assert (r.allocated, r.released, r.net) == (6 * mib, 2 * mib, 4 * mib)
    head = usage_report_header(daily_usage_rollup(df, {})).first()
    assert (head.day_count, head.total_events) == (3, 165)


def test_rates_of_long_lists_are_the_same(spark, monkeypatch):
    t = Tables(spark, "/root/testdata/sf0.001")
    q = t.orders.select("o_orderkey", F.concat(F.lit("Brand#"), (F.col("o_custkey") % 25 + 1).cast("string")).alias("product"), (F.col("o_custkey") % 12).alias("agent"), F.to_date("o_orderdate").alias("on_day"))
    want = sorted(map(str, jn.resolve_rate(q, events.rates(t), "product", "agent", "on_day").collect()))
    monkeypatch.setattr(jn, "BROADCAST_SEGMENTS", 0)
    assert sorted(map(str, jn.resolve_rate(q, events.rates(t), "product", "agent", "on_day").collect())) == want
    assert any("NO_RATE" in x for x in want) and any("rate_id=" in x and "rate_id=None" not in x for x in want)


def test_commission_of_a_split_policy(spark):
    """Policy 4 in June 2025: 38.00, 19.20 and 12.80."""
    d = lambda s: F.lit(s).cast("date")
    policies = spark.createDataFrame([(4, "P", Decimal("9600.00"), "IN_FORCE"), (5, "P", Decimal("100.00"), "LAPSED"), (6, "P", Decimal("100.00"), "IN_FORCE")], "policy_id int, product_code string, annual_premium decimal(12,2), status string")
    splits = spark.createDataFrame([(4, 1, Decimal("50")), (4, 2, Decimal("30")), (4, 3, Decimal("20"))], "policy_id int, agent_id int, split_pct decimal(5,2)")
    rates = spark.createDataFrame([(1, "P", None, Decimal("8.00")), (2, "P", 1, Decimal("9.50")), (3, "Q", None, Decimal("1"))], "rate_id int, product_code string, agent_id int, rate_pct decimal(5,2)")
    rates = rates.select("*", d("2025-01-01").alias("effective_from"), F.lit(None).cast("date").alias("effective_to"))
    out = cm.calculate_commission(policies, splits, rates, "2025-06")
    got = {(r.policy_id, r.agent_id): (r.commission_amt, r.error) for r in out.collect()}
    assert got == {(4, 1): (Decimal("38.00"), None), (4, 2): (Decimal("19.20"), None), (4, 3): (Decimal("12.80"), None), (6, None): (None, "NO_SPLIT")}
    once = cm.replace_month(out.limit(0), out)
    assert sorted(map(str, cm.replace_month(once, out).collect())) == sorted(map(str, once.collect()))
    agents = spark.createDataFrame([(1, "ACTIVE"), (2, "ACTIVE"), (3, "INACTIVE")], "agent_id int, status string")
    assert [r.problem for r in cm.validate_splits(splits, agents).collect()] == ["AGENT_INACTIVE"]
    assert [r.problem for r in cm.validate_splits(splits.where("agent_id < 3"), agents).collect()] == ["SPLIT_TOTAL"]


def test_uuid5(spark):
    rows = spark.createDataFrame([(t,) for t in ("", "a", "tenant:7:2024-06", "é日")], "t string")
    got = {r.t: r.u for r in rows.select("t", uuid5(str(uuid.NAMESPACE_URL), F.col("t")).alias("u")).collect()}
    assert got == {t: str(uuid.uuid5(uuid.NAMESPACE_URL, t)) for t in got}


def test_margin_steps(spark):
    one = spark.range(1)
    x = lambda v: F.lit(v).cast("decimal(18,6)")
    m = mg.margin_columns(x("100"), x("10"), x("2500"), x("1"), x("5"), x("10"), x("30"))
    r = one.select(*[c.alias(n) for n, c in m.items()]).first()
    assert (r.commodity_cost_usd, r.freight_cost_usd, r.overhead_cost_usd, r.cogs_usd) == (Decimal("10.0000"), Decimal("0.5000"), Decimal("1.0500"), Decimal("11.5500"))
    assert r.margin_pct == Decimal("61.5")
    zero = mg.margin_columns(x("100"), x("10"), x("2500"), x("1"), x("5"), x("10"), x("0"))
    assert one.select(zero["margin_pct"].alias("m")).first().m == 0


def test_splits_are_validated_by_one_sort_of_each_policy(spark):
    splits = spark.createDataFrame([(1, 1, 60), (1, 2, 40), (2, 1, 50), (2, 1, 50), (3, 1, 0), (3, 2, 100), (4, 3, 100), (5, 9, 100), (6, 1, 90), (7, None, 100), (None, 1, 100), (99, 1, 100)], "policy_id int, agent_id int, split_pct int")
    agents = spark.createDataFrame([(1, "ACTIVE"), (2, "ACTIVE"), (3, "INACTIVE")], "agent_id int, status string")
    policies = spark.createDataFrame([(k,) for k in (1, 2, 3, 4, 5, 6, 7, 8, 8, None)], "policy_id int")
    out = cm.validate_splits(splits, agents, policies)
    want = {1: None, 2: "DUPLICATE_AGENT", 3: "SPLIT_RANGE", 4: "AGENT_INACTIVE", 5: "AGENT_INACTIVE", 6: "SPLIT_TOTAL", 7: "NO_SPLIT", 8: "NO_SPLIT", None: "NO_SPLIT"}
    assert sorted(map(tuple, out.collect()), key=str) == sorted(want.items(), key=str)
    own = {1: None, 2: "DUPLICATE_AGENT", 3: "SPLIT_RANGE", 4: "AGENT_INACTIVE", 5: "AGENT_INACTIVE", 6: "SPLIT_TOTAL", 7: "NO_SPLIT", None: None, 99: None}
    assert sorted(map(tuple, cm.validate_splits(splits, agents).collect()), key=str) == sorted(own.items(), key=str)
    assert "Aggregate" not in out._jdf.queryExecution().executedPlan().toString()
