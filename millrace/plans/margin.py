"""Product margins from commodity, currency and freight prices."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ..operators.joins import asof_backward

#: Fixed value: kilograms of the freight index's container.
CONTAINER_KG = 25000


def margin_columns(commodity: Column, fx: Column, freight: Column, content_kg: Column, freight_kg: Column, overhead_pct: Column, price: Column) -> dict[str, Column]:
    """Costs and margin, each rounded half up to four decimals before the next step; no price gives margin 0."""
    r4 = lambda c: F.round(c, 4).cast("decimal(20,4)")
    d = lambda c, t="decimal(18,6)": c.cast(t)
    one = r4(d(commodity) / d(fx) * d(content_kg, "decimal(12,4)"))
    two = r4(d(freight) / F.lit(CONTAINER_KG) * d(freight_kg, "decimal(12,4)"))
    three = r4((one + two) * d(overhead_pct, "decimal(6,2)") / 100)
    cogs = r4(one + two + three)
    p = d(price, "decimal(12,2)")
    return {"commodity_cost_usd": one, "freight_cost_usd": two, "overhead_cost_usd": three, "cogs_usd": cogs, "margin_pct": F.when(p == 0, F.lit(0)).otherwise((p - cogs) / p * 100).cast("decimal(28,10)")}


def product_margin(products: DataFrame, prices: DataFrame, fx: DataFrame, freight: DataFrame) -> DataFrame:
    """Margins of each product on each day its commodity has a price, with the exchange rate and freight index then known.

    ``prices, fx, freight``: ``series_code, price_date, value``.
    """
    base = products.join(prices.select(F.col("series_code").alias("commodity_series_code"), "price_date", "value"), "commodity_series_code").withColumn("_all", F.lit(1))
    side = lambda df, name: df.select(F.lit(1).alias("_all"), "price_date", F.col("value").alias(name))
    # The two reference series have one value a day: dates are joined first, not all product rows.
    days = base.select("_all", "price_date").distinct()
    known = asof_backward(asof_backward(days, side(fx, "fx"), "price_date", ["_all"], ["fx"]), side(freight, "freight"), "price_date", ["_all"], ["freight"])
    rows = base.join(known.drop("_all"), "price_date").drop("_all")
    m = margin_columns(F.col("value"), F.col("fx"), F.col("freight"), F.col("content_kg"), F.col("freight_kg"), F.col("overhead_pct"), F.col("list_price_usd"))
    return rows.select("sku", F.col("price_date").alias("margin_date"), *[c.alias(n) for n, c in m.items() if n != "margin_pct"], F.round(m["margin_pct"], 4).cast("decimal(20,4)").alias("margin_pct"))


def recompute_margins(existing: DataFrame, fresh: DataFrame, products: DataFrame, changed: Sequence[str], shared: Sequence[str], since: Column) -> DataFrame:
    """Existing margins with those of affected products, from a date on, replaced: all products if a shared series changed."""
    hit = products if set(changed) & set(shared) else products.where(F.col("commodity_series_code").isin(list(changed)))
    new = fresh.where(F.col("margin_date") >= since).join(hit.select("sku"), "sku", "left_semi")
    return existing.join(new.select("sku", "margin_date"), ["sku", "margin_date"], "left_anti").unionByName(new.select(existing.columns))
