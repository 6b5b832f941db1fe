"""Worked examples of rating, invoicing and dunning for February 2026."""

from decimal import Decimal

import pytest
from pyspark.sql import functions as F

from millrace.operators import joins as jn
from millrace.operators import sets as st
from millrace.operators import windows as wn
from millrace.plans import billing as bl

D = lambda s: F.lit(s).cast("date")


@pytest.fixture(scope="module")
def b(spark):
    def frame(rows, schema):
        return spark.createDataFrame(rows, schema)

    subs = [(f"s{k}", k, p, None if k != 2 else "2026-02-15") for k, p in enumerate([1, 2, 3, 1, 2, 1, 1, 1, 1], 1)]
    usage = [(1, "2026-02-10", 260), (2, "2026-02-10", 700), (3, "2026-02-10", 2201), (4, "2026-02-05", 20), (4, "2026-02-06", 30), (5, "2026-02-01", 610), (6, "2026-02-28", 201), (7, "2026-02-10", 260), (8, "2026-02-28", 202), (9, "2026-02-10", 1)]
    return {
        "tenants": frame([(k, k == 3, "suspended" if k == 2 else "active") for k in range(1, 10)], "id int, tax_exempt boolean, status string"),
        "plans": frame([(1, "STARTER", Decimal("49.00"), 100, Decimal("0.055")), (2, "GROWTH", Decimal("149.00"), 500, Decimal("0.035")), (3, "SCALE", Decimal("499.00"), 2000, Decimal("0.02"))], "id int, code string, monthly_fee decimal(12,2), included_units int, overage_rate decimal(12,6)"),
        "subs": frame(subs, "id string, tenant_id int, plan_id int, s string").select("id", "tenant_id", "plan_id", D("2026-01-01").alias("starts_on"), F.lit(None).cast("date").alias("ends_on"), F.when(F.col("s").isNull(), "active").otherwise("suspended").alias("status"), F.to_date("s").alias("suspended_on")),
        "usage": frame(usage, "tenant_id int, d string, units int").withColumn("occurred_at", F.to_timestamp("d")),
        "history": frame([(1, "2025-11-01", 100), (1, "2025-12-01", 100), (1, "2026-01-01", 100)], "tenant_id int, d string, rollover_units int").withColumn("period_start", F.to_date("d")),
        "credits": frame([("b", 4, "2026-02-01", "30"), ("a", 4, "2026-02-01", "30"), ("d", 3, "2026-02-02", "25"), ("e", 9, "2026-01-31", "5"), ("f", 9, "2026-02-01", "55")], "id string, tenant_id int, d string, r string").select("id", "tenant_id", F.to_date("d").alias("issued_on"), F.col("r").cast("decimal(12,2)").alias("remaining_amount")),
        "invoices": frame([("x", 2, "2026-02-01", "overdue"), ("y", 5, "2026-02-13", "overdue"), ("z", 6, "2026-02-28", "issued")], "id string, tenant_id int, issued_at string, status string"),
        "attempts": frame([("y", 1)], "invoice_id string, attempt_no int"),
    }


def rated(b):
    return bl.rate_usage(b["subs"], b["plans"], b["usage"], b["history"], D("2026-02-01"), D("2026-02-28"))


def test_rating(b):
    r = {x.tenant_id: x for x in rated(b).collect()}
    assert (r[7].used_units, r[7].billable_units) == (260, 160)
    assert (r[1].rollover_units, r[1].billable_units, r[1].overage_amount) == (200, 0, Decimal("0.00"))
    assert (r[2].billable_units, r[2].overage_amount) == (100, Decimal("4.37"))
    assert (r[6].first_tier, r[6].second_tier, r[6].overage_amount) == (101, 0, Decimal("5.56"))
    assert (r[8].first_tier, r[8].second_tier) == (101, 1)
    assert (r[3].first_tier, r[3].second_tier, r[3].overage_amount) == (101, 100, Decimal("5.02"))


def test_invoice_lines_and_credit(b):
    lines = bl.invoice_preview(rated(b), b["tenants"], b["credits"])
    six = {x.line_no: x.amount for x in lines.where("tenant_id = 6").collect()}
    assert [six[k].quantize(Decimal("0.01"), "ROUND_HALF_UP") for k in range(1, 6)] == [Decimal(x) for x in ("49.00", "5.56", "2.25", "2.25", "0.00")]
    heads = bl.issue_invoices(lines, D("2026-02-01"))
    h = {x.tenant_id: x for x in heads.collect()}
    assert h[6].total == Decimal("59.06") and h[3].tax == 0
    left = {x.id: x.remaining_amount for x in bl.consume_credits(heads, b["credits"]).collect()}
    assert left["a"] == 0 and left["b"] == Decimal("6.96")
    assert sorted(map(tuple, bl.issue_invoices(lines, D("2026-02-01")).collect())) == sorted(map(tuple, heads.collect()))


def test_dunning(b):
    late = bl.overdue_accounts(b["invoices"], D("2026-02-28")).collect()
    assert [(x.id, x.days_overdue) for x in late] == [("x", 27), ("y", 15)]
    plan = {x.invoice_id: (x.attempt_no, str(x.scheduled_for)) for x in bl.schedule_dunning(b["invoices"], b["attempts"], D("2026-02-14")).collect()}
    assert plan == {"x": (1, "2026-02-16"), "y": (2, "2026-02-16")}
    after = {x.id: (x.status, x.notify) for x in bl.suspend_overdue(b["tenants"], b["invoices"], D("2026-02-28")).collect()}
    assert after[5] == ("suspended", True) and after[2] == ("suspended", False) and after[6] == ("active", False)


def test_finalize_twice(b, spark):
    first = bl.finalize_rating(bl.finalize_rating_empty(spark).withColumn("tenant_id", F.col("tenant_id").cast("int")), rated(b), D("2026-02-01"))
    again = bl.finalize_rating(first, rated(b), D("2026-02-01"))
    assert sorted(map(tuple, first.collect())) == sorted(map(tuple, again.collect()))


def test_plans(b):
    """The catalogue, what a tenant is entitled to on a day, and changes of plan."""
    assert [(r.code, r.monthly_fee) for r in st.plan_catalog(b["plans"], "monthly_fee", "code", F.lit(True)).collect()] == [("STARTER", Decimal("49.00")), ("GROWTH", Decimal("149.00")), ("SCALE", Decimal("499.00"))]
    asked = b["tenants"].select(F.col("id").alias("tenant_id"), D("2026-02-28").alias("on_day"))
    got = {r.tenant_id: (r.code, r.included_units, r.status) for r in jn.effective_dated(asked, b["subs"].join(b["plans"].withColumnRenamed("id", "plan_id"), "plan_id"), "tenant_id", "on_day").collect()}
    assert got[1] == ("STARTER", 100, "active") and got[2] == ("GROWTH", 500, "suspended")
    own = b["subs"].select("tenant_id", "starts_on", "plan_id", F.lit("active").alias("status"), F.lit(0).alias("_seq"))
    new = b["tenants"].where("id in (1, 4)").select(F.col("id").alias("tenant_id"), F.when(F.col("id") == 1, D("2026-03-01")).otherwise(D("2026-03-15")).alias("starts_on"), F.when(F.col("id") == 1, 2).otherwise(3).alias("plan_id"), F.lit("active").alias("status"), F.lit(1).alias("_seq"))
    rows = wn.scd2(own.unionByName(new), ["tenant_id"], "starts_on", "ends_on").where("tenant_id in (1, 4)").orderBy("tenant_id", "starts_on")
    assert [(r.tenant_id, r.plan_id, str(r.starts_on), str(r.ends_on), r.status) for r in rows.collect()] == [
        (1, 1, "2026-01-01", "2026-02-28", "active"), (1, 2, "2026-03-01", "None", "active"), (4, 1, "2026-01-01", "2026-03-14", "active"), (4, 3, "2026-03-15", "None", "active"),
    ]
