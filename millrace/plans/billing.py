"""Rating, invoicing and dunning of all tenants at once."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from ..operators.sets import numbered_lines
from ..operators.windows import fifo_allocate, next_attempt

#: Units at the plain rate, the factor beyond them, and the tax rate.
FIRST_TIER, BEYOND, TAX = 101, "1.5", "0.0825"
#: Months of unused quota that carry over, and days after which an account is suspended.
CARRIED_MONTHS, SUSPEND_DAYS = 3, 14


def subscription_in_period(subscriptions: DataFrame, start: Column, end: Column) -> DataFrame:
    """Each tenant's subscription that overlaps the period; of several the one that starts last."""
    hit = (F.col("starts_on") <= end) & (F.col("ends_on").isNull() | (F.col("ends_on") >= start))
    last = Window.partitionBy("tenant_id").orderBy(F.col("starts_on").desc(), "id")
    return subscriptions.where(hit).withColumn("_n", F.row_number().over(last)).where("_n = 1").drop("_n")


def rate_usage(subscriptions: DataFrame, plans: DataFrame, usage: DataFrame, history: DataFrame, start: Column, end: Column) -> DataFrame:
    """Used, quota, rollover, billable, both tiers and the overage amount of each tenant's period.

    ``history``: ``tenant_id, period_start, rollover_units`` of earlier periods.
    A suspension within the period prorates billable units and amount by the
    days from it on; the tiers stay as they are.
    """
    subs = subscription_in_period(subscriptions, start, end).withColumnRenamed("id", "subscription_id")
    used = usage.where(F.to_date("occurred_at").between(start, end)).groupBy("tenant_id").agg(F.sum("units").alias("used_units"))
    prior = history.where((F.col("period_start") < start) & (F.col("period_start") >= F.add_months(start, -CARRIED_MONTHS)))
    prior = prior.groupBy("tenant_id").agg(F.sum("rollover_units").alias("_prior"))
    rows = subs.join(plans.withColumnRenamed("id", "plan_id"), "plan_id").join(used, "tenant_id", "left").join(prior, "tenant_id", "left")
    n = lambda c: F.coalesce(c, F.lit(0)).cast("long")
    rows = rows.withColumns({"used_units": n(F.col("used_units")), "rollover_units": F.least(n(F.col("_prior")), F.col("included_units") * 2).cast("long")})
    rows = rows.withColumn("_billable", F.greatest(F.col("used_units") - F.col("rollover_units") - F.col("included_units"), F.lit(0)))
    rows = rows.withColumns({"first_tier": F.least("_billable", F.lit(FIRST_TIER)).cast("long"), "second_tier": F.greatest(F.col("_billable") - FIRST_TIER, F.lit(0)).cast("long")})
    price = F.col("overage_rate").cast("decimal(12,6)")
    amount = F.round(F.col("first_tier") * price + F.col("second_tier") * price * F.lit(BEYOND).cast("decimal(2,1)"), 2).cast("decimal(18,2)")
    cut = (F.col("status") == "suspended") & F.col("suspended_on").between(start, end)
    days, whole = F.date_diff(end, "suspended_on") + 1, F.date_diff(end, start) + 1
    rows = rows.withColumn("_amount", amount)
    return rows.select(
        "tenant_id", "subscription_id", "plan_id", "code", "monthly_fee", "used_units", F.col("included_units").cast("long").alias("quota_units"), "rollover_units",
        F.when(cut, F.round(F.col("_billable").cast("decimal(18,0)") * days / whole)).otherwise(F.col("_billable")).cast("long").alias("billable_units"),
        "first_tier", "second_tier", F.when(cut, F.round(F.col("_amount") * days / whole, 2)).otherwise(F.col("_amount")).cast("decimal(18,2)").alias("overage_amount"),
    )


def finalize_rating(existing: DataFrame, rated: DataFrame, start: Column) -> DataFrame:
    """Results with ids from tenant and period; a result that is there keeps its quota and takes the rest."""
    new = rated.select(
        F.md5(F.concat_ws(":", "tenant_id", start.cast("string")).cast("binary")).alias("id"), "tenant_id", start.alias("period_start"), "used_units", "quota_units",
        F.greatest(F.col("quota_units") - F.col("used_units"), F.lit(0)).alias("rollover_units"), "billable_units", "overage_amount",
    )
    old = existing.select("id", F.col("quota_units").alias("_q"))
    taken = new.join(old, "id", "left").withColumn("quota_units", F.coalesce("_q", "quota_units")).drop("_q")
    return taken.unionByName(existing.join(new.select("id"), "id", "left_anti").select(taken.columns))


def invoice_preview(rated: DataFrame, tenants: DataFrame, credits: DataFrame) -> DataFrame:
    """Five numbered lines of each tenant: plan, usage, two halves of the tax, and credit, which is negative."""
    open_ = credits.where("remaining_amount > 0").groupBy("tenant_id").agg(F.sum("remaining_amount").alias("_open"))
    t = tenants.select(F.col("id").alias("tenant_id"), "tax_exempt")
    rows = rated.join(t, "tenant_id").join(open_, "tenant_id", "left")
    base = F.col("monthly_fee").cast("decimal(18,2)") + F.col("overage_amount")
    tax = F.when(F.col("tax_exempt"), F.lit(0)).otherwise(base * F.lit(TAX).cast("decimal(5,4)")).cast("decimal(24,6)")
    rows = rows.withColumns({"_base": base, "_tax": tax})
    credit = F.least(F.coalesce("_open", F.lit(0)).cast("decimal(24,6)"), F.round(F.col("_base") + F.col("_tax"), 2).cast("decimal(24,6)"))
    d = lambda c: c.cast("decimal(24,6)")
    half = d(F.col("_tax") / 2)
    return numbered_lines(rows, ["tenant_id"], [("plan", d(F.col("monthly_fee"))), ("usage", d(F.col("overage_amount"))), ("tax", half), ("local tax", half), ("credit", d(-credit))])


def issue_invoices(lines: DataFrame, period: Column) -> DataFrame:
    """Invoice headers with ids from tenant and period: lines are rounded one by one, then summed."""
    amount = F.round("amount", 2)
    part = lambda *ks: F.sum(F.when(F.col("line_type").isin(*ks), amount).otherwise(0)).cast("decimal(18,2)")
    head = lines.groupBy("tenant_id").agg(part("plan", "usage").alias("subtotal"), part("tax", "local tax").alias("tax"), part("credit").alias("credit"))
    total = F.greatest(F.col("subtotal") + F.col("tax") + F.col("credit"), F.lit(0)).cast("decimal(18,2)")
    return head.select(F.md5(F.concat_ws(":", "tenant_id", period.cast("string")).cast("binary")).alias("id"), "tenant_id", "subtotal", "tax", "credit", total.alias("total"))


def consume_credits(invoices: DataFrame, credits: DataFrame) -> DataFrame:
    """Credit notes after the invoices' credit has been taken from the oldest first."""
    due = invoices.select("tenant_id", (-F.col("credit")).alias("_due"))
    rows = fifo_allocate(credits.join(due, "tenant_id", "left").withColumn("_due", F.coalesce("_due", F.lit(0))), "tenant_id", ["issued_on", "id"], "remaining_amount", "_due")
    return rows.withColumn("remaining_amount", F.col("remaining_amount") - F.col("used")).drop("_due")


def overdue_accounts(invoices: DataFrame, as_of: Column) -> DataFrame:
    late = invoices.where((F.col("status") == "overdue") & (F.to_date("issued_at") < as_of))
    return late.withColumn("days_overdue", F.date_diff(as_of, F.to_date("issued_at"))).orderBy("issued_at", "id")


def working_day(day: Column) -> Column:
    """Saturdays and Sundays become the Monday after."""
    return F.date_add(day, F.when(F.weekday(day) == 5, 2).when(F.weekday(day) == 6, 1).otherwise(0))


def schedule_dunning(invoices: DataFrame, attempts: DataFrame, as_of: Column) -> DataFrame:
    """The next attempt for each overdue invoice, on a working day."""
    return next_attempt(overdue_accounts(invoices, as_of).withColumnRenamed("id", "invoice_id"), attempts, "invoice_id").withColumn("scheduled_for", working_day(as_of))


def suspend_overdue(tenants: DataFrame, invoices: DataFrame, as_of: Column) -> DataFrame:
    """Tenants with their status after the run and whether they are to be notified."""
    late = overdue_accounts(invoices, as_of).where(F.col("days_overdue") >= SUSPEND_DAYS).select(F.col("tenant_id").alias("id"), F.lit(True).alias("_late")).distinct()
    hit = (F.col("status") == "active") & F.col("_late").isNotNull()
    return tenants.join(late, "id", "left").withColumns({"notify": F.coalesce(hit, F.lit(False)), "status": F.when(hit, "suspended").otherwise(F.col("status"))}).drop("_late")


def finalize_rating_empty(spark) -> DataFrame:
    """Results of no period: what the first run starts from."""
    return spark.createDataFrame([], "id string, tenant_id long, period_start date, used_units long, quota_units long, rollover_units long, billable_units long, overage_amount decimal(18,2)")
