"""Billing, commissions and margins over the tables: customers are tenants, parts are plans and products."""

from __future__ import annotations

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from ..operators.aggregates import margin_kpis
from ..plans import billing as bl
from ..plans import commission as cm
from ..plans import margin as mg
from .events import day
from .registry import Tables, query

START, END = "1997-06-01", "1997-06-30"

#: Tenants with one subscription each, orders as usage, and counts of earlier months as unused quota.
BILL = f"""tenants AS (SELECT c_custkey AS tenant_id, c_custkey % 3 = 0 AS exempt FROM customer),
plans AS (SELECT p_partkey AS plan_id, (p_retailprice::DECIMAL(12, 2)) AS fee, p_size AS included, ((p_size % 7 + 1) * 0.005)::DECIMAL(12, 6) AS rate FROM part),
subs AS (SELECT tenant_id, tenant_id AS plan_id, CASE WHEN tenant_id % 11 = 0 THEN DATE '1997-06-16' END AS suspended FROM tenants),
used AS (SELECT o_custkey AS tenant_id, sum(floor(o_totalprice / 1000))::BIGINT AS used FROM orders WHERE o_orderdate::DATE BETWEEN DATE '{START}' AND DATE '{END}' GROUP BY 1),
prior AS (SELECT o_custkey AS tenant_id, count(*) * 5 AS prior FROM orders WHERE o_orderdate >= DATE '1997-03-01' AND o_orderdate < DATE '{START}' GROUP BY 1),
base AS (SELECT s.*, p.fee, p.included, p.rate, coalesce(u.used, 0) AS used, least(coalesce(prior, 0), 2 * included)::BIGINT AS rollover FROM subs s JOIN plans p USING (plan_id) LEFT JOIN used u USING (tenant_id) LEFT JOIN prior USING (tenant_id)),
tier AS (SELECT *, greatest(used - rollover - included, 0)::BIGINT AS b FROM base),
rated AS (SELECT *, least(b, 101)::BIGINT AS f, greatest(b - 101, 0)::BIGINT AS g, (least(b, 101) * (rate * 1000000)::BIGINT * 10 + greatest(b - 101, 0) * (rate * 1000000)::BIGINT * 15) AS amount7 FROM tier),
cents AS (SELECT *, ((amount7 + 50000) // 100000)::BIGINT AS c FROM rated),
final AS (SELECT *, CASE WHEN suspended IS NULL THEN b ELSE (b * 15 * 2 + 30) // 60 END AS billable, CASE WHEN suspended IS NULL THEN c ELSE (c * 15 * 2 + 30) // 60 END AS overage_cents FROM cents)"""


def rated(t: Tables) -> DataFrame:
    c = t.customer
    subs = c.select(F.col("c_custkey").alias("id"), F.col("c_custkey").alias("tenant_id"), F.col("c_custkey").alias("plan_id"), day("1995-01-01").alias("starts_on"), F.lit(None).cast("date").alias("ends_on"),
                    F.when(F.col("c_custkey") % 11 == 0, "suspended").otherwise("active").alias("status"), F.when(F.col("c_custkey") % 11 == 0, day("1997-06-16")).alias("suspended_on"))
    plans = t.part.select(F.col("p_partkey").alias("id"), F.col("p_brand").alias("code"), F.col("p_retailprice").cast("decimal(12,2)").alias("monthly_fee"), F.col("p_size").alias("included_units"), ((F.col("p_size") % 7 + 1) * 0.005).cast("decimal(12,6)").alias("overage_rate"))
    usage = t.orders.select(F.col("o_custkey").alias("tenant_id"), F.col("o_orderdate").alias("occurred_at"), F.floor(F.col("o_totalprice") / 1000).cast("long").alias("units"))
    history = t.orders.select(F.col("o_custkey").alias("tenant_id"), F.to_date("o_orderdate").alias("period_start"), F.lit(5).cast("long").alias("rollover_units"))
    return bl.rate_usage(subs, plans, usage, history, day(START), day(END))


@query("dom01_rate_usage", f"WITH {BILL} SELECT tenant_id, used AS used_units, included::BIGINT AS quota_units, rollover AS rollover_units, billable::BIGINT AS billable_units, f AS first_tier, g AS second_tier, overage_cents::BIGINT AS overage_cents FROM final")
def _(t):
    return rated(t).select("tenant_id", "used_units", "quota_units", "rollover_units", "billable_units", "first_tier", "second_tier", (F.col("overage_amount") * 100).cast("long").alias("overage_cents"))


@query("dom02_finalize", f"WITH {BILL} SELECT md5(tenant_id || ':{START}') AS id, tenant_id, CASE WHEN tenant_id % 2 = 0 THEN 7 ELSE included END::BIGINT AS quota_units, greatest(included - used, 0)::BIGINT AS rollover_units FROM final")
def _(t):
    new = rated(t)
    old = bl.finalize_rating(bl.finalize_rating_empty(t.spark), new.where("tenant_id % 2 = 0"), day(START)).withColumn("quota_units", F.lit(7).cast("long"))
    return bl.finalize_rating(old, new, day(START)).select("id", "tenant_id", "quota_units", "rollover_units")


LINES = """money AS (SELECT tenant_id, exempt, (fee * 100)::BIGINT AS fee_c, overage_cents AS use_c FROM final JOIN tenants USING (tenant_id)),
taxed AS (SELECT *, CASE WHEN exempt THEN 0 ELSE (fee_c + use_c) * 825 END AS tax_6 FROM money),
credit AS (SELECT o_custkey AS tenant_id, sum(CASE WHEN o_orderkey % 4 = 0 THEN 1000 ELSE 250 END) AS open_c FROM orders WHERE o_orderstatus = 'P' GROUP BY 1),
lines AS (SELECT *, least(coalesce(open_c, 0), fee_c + use_c + (tax_6 + 5000) // 10000)::BIGINT AS credit_c, (tax_6 + 10000) // 20000 AS half_c FROM taxed LEFT JOIN credit USING (tenant_id))"""


def credits(t: Tables) -> DataFrame:
    cents = F.when(F.col("o_orderkey") % 4 == 0, 1000).otherwise(250)
    return t.orders.where("o_orderstatus = 'P'").select(F.col("o_orderkey").alias("id"), F.col("o_custkey").alias("tenant_id"), F.to_date("o_orderdate").alias("issued_on"), (cents / F.lit(100)).cast("decimal(12,2)").alias("remaining_amount"))


def preview(t: Tables) -> DataFrame:
    tenants = t.customer.select(F.col("c_custkey").alias("id"), (F.col("c_custkey") % 3 == 0).alias("tax_exempt"))
    return bl.invoice_preview(rated(t), tenants, credits(t))


@query("dom03_invoice_preview", f"""WITH {BILL}, {LINES} SELECT tenant_id, n AS line_no, (CASE n WHEN 1 THEN fee_c * 10000 WHEN 2 THEN use_c * 10000 WHEN 5 THEN -credit_c * 10000 ELSE (tax_6 + 1) // 2 END)::BIGINT AS millionths FROM lines, range(1, 6) r(n)""")
def _(t):
    return preview(t).select("tenant_id", F.col("line_no").cast("long").alias("line_no"), (F.col("amount") * 1000000).cast("long").alias("millionths"))


HEADS = "heads AS (SELECT tenant_id, fee_c + use_c AS subtotal, 2 * half_c AS tax, credit_c AS credit, greatest(fee_c + use_c + 2 * half_c - credit_c, 0) AS total FROM lines)"


@query("dom04_issue_invoices", f"WITH {BILL}, {LINES}, {HEADS} SELECT md5(tenant_id || ':{START}') AS id, tenant_id, subtotal::BIGINT AS subtotal, tax::BIGINT AS tax, credit::BIGINT AS credit, total::BIGINT AS total FROM heads")
def _(t):
    c = lambda n, s=1: (F.col(n) * 100 * s).cast("long").alias(n)
    return bl.issue_invoices(preview(t), day(START)).select("id", "tenant_id", c("subtotal"), c("tax"), c("credit", -1), c("total"))


@query("dom04_consume_credits", f"""WITH {BILL}, {LINES}, n AS (SELECT o_orderkey AS id, o_custkey AS tenant_id, o_orderdate, CASE WHEN o_orderkey % 4 = 0 THEN 1000 ELSE 250 END AS c FROM orders WHERE o_orderstatus = 'P'),
r AS (SELECT *, coalesce(sum(c) OVER (PARTITION BY tenant_id ORDER BY o_orderdate, id ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING), 0) AS before FROM n)
SELECT id, (c - greatest(0, least(c, coalesce(credit_c, 0) - before)))::BIGINT AS remaining FROM r LEFT JOIN lines USING (tenant_id)""")
def _(t):
    out = bl.consume_credits(bl.issue_invoices(preview(t), day(START)), credits(t))
    return out.select("id", (F.col("remaining_amount") * 100).cast("long").alias("remaining"))


AS_OF = "2001-07-28"  # a Saturday
LATE = f"late AS (SELECT o_orderkey AS id, o_custkey AS tenant_id, date_diff('day', o_orderdate::DATE, DATE '{AS_OF}') AS days FROM orders WHERE o_orderstatus = 'O' AND o_orderdate < DATE '{AS_OF}' AND o_orderdate >= DATE '2001-01-01')"


def invoices(t: Tables) -> DataFrame:
    late = (F.col("o_orderstatus") == "O") & (F.col("o_orderdate") >= day("2001-01-01"))
    return t.orders.select(F.col("o_orderkey").alias("id"), F.col("o_custkey").alias("tenant_id"), F.col("o_orderdate").alias("issued_at"), F.when(late, "overdue").otherwise("paid").alias("status"))


@query("dom05_overdue", f"WITH {LATE} SELECT id, tenant_id, days::BIGINT AS days_overdue FROM late")
def _(t):
    return bl.overdue_accounts(invoices(t), day(AS_OF)).select("id", "tenant_id", F.col("days_overdue").cast("long").alias("days_overdue"))


@query("dom06_dunning", f"WITH {LATE} SELECT id AS invoice_id, coalesce((SELECT max(l_linenumber) FROM lineitem WHERE l_orderkey = id), 0)::BIGINT + 1 AS attempt_no, DATE '2001-07-30' AS scheduled_for FROM late")
def _(t):
    attempts = t.lineitem.select(F.col("l_orderkey").alias("invoice_id"), F.col("l_linenumber").cast("long").alias("attempt_no"))
    return bl.schedule_dunning(invoices(t), attempts, day(AS_OF)).select("invoice_id", "attempt_no", "scheduled_for")


@query("dom07_suspend", f"WITH {LATE} SELECT c_custkey AS id, CASE WHEN c_nationkey > 3 AND c_custkey IN (SELECT tenant_id FROM late WHERE days >= 14) THEN 'suspended' WHEN c_nationkey > 3 THEN 'active' ELSE 'closed' END AS status, c_nationkey > 3 AND c_custkey IN (SELECT tenant_id FROM late WHERE days >= 14) AS notify FROM customer")
def _(t):
    tenants = t.customer.select(F.col("c_custkey").alias("id"), F.when(F.col("c_nationkey") > 3, "active").otherwise("closed").alias("status"))
    return bl.suspend_overdue(tenants, invoices(t), day(AS_OF)).select("id", "status", "notify")


@query("dom08_validate_splits", """WITH s AS (SELECT l_orderkey AS policy_id, l_suppkey AS agent_id, CASE WHEN l_linenumber = 1 THEN 100 - 10 * (count(*) OVER (PARTITION BY l_orderkey) - 1) ELSE 10 END AS pct FROM lineitem WHERE l_orderkey % 9 > 0)
SELECT o_orderkey AS policy_id, CASE WHEN count(agent_id) = 0 THEN 'NO_SPLIT' WHEN count(agent_id) <> count(DISTINCT agent_id) THEN 'DUPLICATE_AGENT' WHEN bool_or(pct <= 0 OR pct > 100) THEN 'SPLIT_RANGE' WHEN bool_or(s_acctbal < 0) THEN 'AGENT_INACTIVE' WHEN sum(pct) <> 100 THEN 'SPLIT_TOTAL' END AS problem
FROM orders LEFT JOIN s ON policy_id = o_orderkey LEFT JOIN supplier ON s_suppkey = agent_id GROUP BY 1""")
def _(t):
    lines = t.lineitem.where("l_orderkey % 9 > 0")  # the others have no split
    splits = lines.withColumn("n", F.count("*").over(Window.partitionBy("l_orderkey"))).select(F.col("l_orderkey").alias("policy_id"), F.col("l_suppkey").alias("agent_id"), F.when(F.col("l_linenumber") == 1, 100 - 10 * (F.col("n") - 1)).otherwise(10).alias("split_pct"))
    agents = t.supplier.select(F.col("s_suppkey").alias("agent_id"), F.when(F.col("s_acctbal") < 0, "INACTIVE").otherwise("ACTIVE").alias("status"))
    return cm.validate_splits(splits, agents, t.orders.select(F.col("o_orderkey").alias("policy_id")))


COMMISSION = """p AS (SELECT o_orderkey AS policy_id, 'Brand#' || (o_custkey % 25 + 1) AS product, (o_totalprice * 100)::BIGINT AS c FROM orders WHERE o_orderstatus = 'O'),
s AS (SELECT l_orderkey AS policy_id, l_suppkey AS agent, sum(10)::BIGINT AS pct FROM lineitem GROUP BY 1, 2),
r AS (SELECT p_partkey AS rate_id, p_brand AS product, p_size % 20 + 1 AS pct FROM part WHERE p_partkey % 5 = 0 QUALIFY row_number() OVER (PARTITION BY p_brand ORDER BY p_partkey) = 1)"""


@query("dom09_commission", f"WITH {COMMISSION} SELECT policy_id, agent AS agent_id, CASE WHEN agent IS NULL THEN 'NO_SPLIT' WHEN rate_id IS NULL THEN 'NO_RATE' END AS error, CASE WHEN agent IS NOT NULL THEN ((c * r.pct * s.pct + 60000) // 120000)::BIGINT END AS cents FROM p LEFT JOIN s USING (policy_id) LEFT JOIN r USING (product)")
def _(t):
    policies = t.orders.select(F.col("o_orderkey").alias("policy_id"), F.concat(F.lit("Brand#"), (F.col("o_custkey") % 25 + 1).cast("string")).alias("product_code"), F.col("o_totalprice").cast("decimal(14,2)").alias("annual_premium"), F.when(F.col("o_orderstatus") == "O", "IN_FORCE").otherwise("LAPSED").alias("status"))
    splits = t.lineitem.groupBy(F.col("l_orderkey").alias("policy_id"), F.col("l_suppkey").alias("agent_id")).agg(F.sum(F.lit(10)).cast("decimal(5,2)").alias("split_pct"))
    rates = t.part.where("p_partkey % 5 = 0").groupBy(F.col("p_brand").alias("product_code")).agg(F.min("p_partkey").alias("rate_id"), F.min_by(F.col("p_size") % 20 + 1, "p_partkey").cast("decimal(5,2)").alias("rate_pct"))
    rates = rates.withColumns({"agent_id": F.lit(None).cast("long"), "effective_from": day("1990-01-01"), "effective_to": F.lit(None).cast("date")})
    out = cm.calculate_commission(policies, splits, rates, "1997-06")
    return out.select("policy_id", "agent_id", "error", (F.col("commission_amt") * 100).cast("long").alias("cents"))


@query("dom10_validate_rates", """SELECT p_partkey, CASE WHEN p_size <= 5 OR p_size > 45 THEN 'RATE_RANGE' WHEN p_type = 'ECONOMY' THEN 'UNKNOWN_PRODUCT' WHEN p_partkey % 200 >= (SELECT count(*) FROM supplier) OR s_acctbal < 0 THEN 'AGENT_INACTIVE' END AS problem
FROM part LEFT JOIN supplier ON s_suppkey = p_partkey % 200""")
def _(t):
    return _rate_changes(t).select("p_partkey", "problem")


def _rate_changes(t: Tables) -> DataFrame:
    changes = t.part.select("p_partkey", F.col("p_type").alias("product_code"), (F.col("p_partkey") % 200).alias("agent_id"), F.when(F.col("p_size") > 45, F.col("p_size") + 10).otherwise(F.col("p_size") - 5).alias("rate_pct"))
    products = t.part.where("p_type <> 'ECONOMY'").select(F.col("p_type").alias("product_code"))
    agents = t.supplier.select(F.col("s_suppkey").alias("agent_id"), F.when(F.col("s_acctbal") < 0, "INACTIVE").otherwise("ACTIVE").alias("status"))
    return cm.validate_rates(changes, products, agents)


@query("dom10_rate_audit", """SELECT 'RATE_UPSERT' AS action, p_type AS product_code, p_partkey % 200 AS agent_id, 'rate_id=' || p_partkey || ' pct=' || (p_size - 5) || ' from=1997-01-01' AS detail, 'load' AS actor
FROM part JOIN supplier ON s_suppkey = p_partkey % 200 WHERE p_size BETWEEN 6 AND 45 AND p_type <> 'ECONOMY' AND s_acctbal >= 0""")
def _(t):
    rows = _rate_changes(t).withColumns({"rate_id": F.col("p_partkey"), "effective_from": day("1997-01-01")})
    return cm.rate_audit(rows, "load").select("action", "product_code", "agent_id", "detail", "actor")


@query("dom11_load_star", "SELECT strftime(l_shipdate, '%Y-%m') AS period_month, quarter(l_shipdate)::BIGINT AS quarter, count(*) AS n FROM lineitem GROUP BY 1, 2")
def _(t):
    month = F.date_format("l_shipdate", "yyyy-MM")
    facts = t.lineitem.select("l_orderkey", "l_linenumber", "l_partkey", month.alias("period_month")).withColumn("period_key", F.xxhash64("period_month"))
    dim = cm.period_dimension(facts)
    star = cm.load_star({"period": (dim.where("month < 6"), dim, "period_key")}, (facts.where("l_linenumber = 1"), facts, ["l_orderkey", "l_linenumber", "l_partkey"]))
    joined = star["facts"].join(star["period"].select("period_key", "quarter"), "period_key")
    return joined.groupBy("period_month", F.col("quarter").cast("long").alias("quarter")).agg(F.count("*").alias("n"))


PRICES = """prices AS (SELECT o_orderpriority AS code, date_trunc('month', o_orderdate)::DATE AS d, max(o_totalprice::DECIMAL(14, 2)) AS v FROM orders GROUP BY 1, 2)"""
#: All products and months; amounts in ten-thousandths, so that each step rounds as the plan does.
MARGINS = f"""{PRICES}, s AS (SELECT p_partkey AS sku, CASE WHEN p_partkey % 2 = 0 THEN '1-URGENT' ELSE '2-HIGH' END AS code, p_size, p_retailprice::DECIMAL(12, 2) AS price FROM part),
f AS (SELECT d, v FROM prices WHERE code = '5-LOW'), b AS (SELECT sku, p.d, p.v, p_size, price FROM s JOIN prices p USING (code)),
j AS (SELECT b.*, f.v AS fr FROM (SELECT * FROM b WHERE d >= (SELECT min((ts - INTERVAL 11700 DAYS)::DATE) FROM events)) b ASOF JOIN f ON b.d >= f.d),
m AS (SELECT sku, d AS margin_date, price, ((v * 100)::BIGINT + 40) // 80 AS commodity, ((fr * 100)::BIGINT * p_size * 100 + 12500) // 25000 AS freight FROM j),
c AS (SELECT *, commodity + freight + (commodity + freight + 5) // 10 AS cogs FROM m)"""


def prices(t: Tables) -> DataFrame:
    """A price of each month and priority: the highest total of its orders."""
    month = F.to_date(F.trunc("o_orderdate", "MM"))
    return t.orders.groupBy(F.col("o_orderpriority").alias("series_code"), month.alias("price_date")).agg(F.max(F.col("o_totalprice").cast("decimal(14,2)")).alias("value"))


def products(t: Tables) -> DataFrame:
    code = F.when(F.col("p_partkey") % 2 == 0, "1-URGENT").otherwise("2-HIGH")
    return t.part.select(F.col("p_partkey").alias("sku"), code.alias("commodity_series_code"), F.lit(0.001).alias("content_kg"), F.col("p_size").alias("freight_kg"), F.lit(10).alias("overhead_pct"), F.col("p_retailprice").alias("list_price_usd"))


def margins(t: Tables) -> DataFrame:
    p = prices(t)
    fx = t.events.groupBy(F.to_date(F.expr("ts - INTERVAL 11700 DAYS")).alias("price_date")).agg(F.lit(8).alias("value"))
    return mg.product_margin(products(t), p, fx, p.where("series_code = '5-LOW'"))


@query("dom12_product_margin", f"WITH {MARGINS} SELECT sku, margin_date, commodity, freight, cogs FROM c")
def _(t):
    units = lambda c, n: (F.col(c) * 10000).cast("long").alias(n)
    return margins(t).select("sku", "margin_date", units("commodity_cost_usd", "commodity"), units("freight_cost_usd", "freight"), units("cogs_usd", "cogs"))


@query("dom13_recompute", f"WITH {MARGINS} SELECT sku, count(*) AS n, count(*) FILTER (WHERE margin_date >= DATE '1998-02-01' AND sku % 2 = 0) AS fresh FROM c GROUP BY 1")
def _(t):
    now = margins(t)
    out = mg.recompute_margins(now.withColumn("fresh", F.lit(0)), now.withColumn("fresh", F.lit(1)), products(t), ["1-URGENT"], ["5-LOW"], day("1998-02-01"))
    return out.groupBy("sku").agg(F.count("*").alias("n"), F.sum("fresh").alias("fresh"))


@query("agg23_margin_kpis", f"""WITH {MARGINS} SELECT round(avg(CASE WHEN price = 0 THEN 0 ELSE round((price::DOUBLE * 10000 - cogs) / (price::DOUBLE * 10000) * 100, 4) END), 2) AS avg_margin_pct, round(avg(cogs / 10000.0), 2)::DOUBLE AS avg_cogs_usd,
 (SELECT arg_max(v, d)::DOUBLE FROM prices WHERE code = '1-URGENT') AS commodity_index, (SELECT arg_max(v, d)::DOUBLE FROM prices WHERE code = '5-LOW') AS freight_index FROM c""")
def _(t):
    out = margin_kpis(margins(t), prices(t), "1-URGENT", "5-LOW")
    return out.select(*[F.col(c).cast("double").alias(c) for c in out.columns])
