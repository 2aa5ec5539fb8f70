"""Datasets behind the five dashboard pages. The pictures are not built.

Every page takes slicers: column -> values or a range. Sales, and marketing where
it knows the column, are filtered before anything is summed. Customer pages are
about customers scored over all orders and take slicers on their attributes.
"""

from __future__ import annotations

from datetime import date

from pyspark.sql import DataFrame, Window, functions as F

from tillsight.functions.money import money, pct, pct2, ratio
from tillsight.operators import marketing, rfm, sales
from tillsight.operators.measures import measures, sliced_marketing
from tillsight.sources.session import shared
from tillsight.sources.star import Between, Slicers, Star, slicer_test


def overview_kpis(star: Star, slicers: Slicers | None = None) -> DataFrame:
    return measures(star, [], ["revenue", "gross_profit", "gross_margin", "orders", "average_order_value",
                               "marketing_spend", "roas"], slicers)


def overview_monthly(star: Star, slicers: Slicers | None = None) -> DataFrame:
    """Revenue and margin by month with growth against the previous calendar month."""
    growth = sales.mom_growth_calendar(star.sliced(slicers))
    return growth.select("year_month", "revenue", ratio("gross_profit", "revenue").alias("gross_margin"),
                         "revenue_growth", "gross_profit_growth")


def overview_category(star: Star, slicers: Slicers | None = None) -> DataFrame:
    return measures(star, ["category"], ["gross_profit"], slicers).orderBy(F.desc("gross_profit"))


def product_table(star: Star, slicers: Slicers | None = None) -> DataFrame:
    """Products with the volume and margin averages that split the matrix."""
    scored = sales.scored_products(star.sliced(slicers))
    return scored.select(
        "product_id", "product_name", "category",
        F.col("quantity").alias("units_sold"),
        money("revenue").alias("revenue"),
        money("gross_profit").alias("gross_profit"),
        pct("gross_profit", "revenue").alias("gross_margin_pct"),
        ratio("all.units", "all.products").alias("average_units"),
        sales.mean_margin_pct("all.margin", "all.margins").alias("average_margin_pct"),
    )


def product_top10(star: Star, slicers: Slicers | None = None) -> DataFrame:
    return sales.top_products(star.sliced(slicers)).select("product_name", "category", money("gross_profit").alias("gross_profit"))


def marketing_kpis(star: Star, slicers: Slicers | None = None) -> DataFrame:
    return measures(star, [], ["marketing_spend", "revenue", "roas", "cac", "net_marketing_contribution",
                               "conversions"], slicers)


def marketing_channel(star: Star, slicers: Slicers | None = None) -> DataFrame:
    return measures(star, ["channel_name"], ["net_marketing_contribution", "marketing_spend", "roas", "cac",
                                             "new_customers"], slicers)


def marketing_campaign(star: Star, slicers: Slicers | None = None) -> DataFrame:
    days = star.with_tables(fact_marketing=lambda: sliced_marketing(star, slicers))
    return marketing.campaign_performance(days).select(
        "channel_name", "campaign_name", "spend", "impressions", "clicks", "conversions", "cost_per_conversion")


def customer_kpis(star: Star, slicers: Slicers | None = None) -> DataFrame:
    return measures(star, [], ["customers_with_orders", "repeat_purchase_rate", "revenue_per_customer",
                               "clv_approx"], slicers)


def _customers(customers: DataFrame, slicers: Slicers | None) -> DataFrame:
    """Scored customers under slicers on their own columns, the segment among them."""
    unknown = set(slicers or {}) - set(customers.columns)
    if unknown:
        raise ValueError(f"customers have no column {', '.join(sorted(unknown))}")
    return customers.filter(slicer_test(slicers)) if slicers else customers


def customer_segments(star: Star, slicers: Slicers | None = None) -> DataFrame:
    """Customers and value by segment, with the number of VIPs and their share of the value."""
    totals = rfm.segment_totals(_customers(rfm.all_customers(star), slicers), "segment")
    everything = Window.partitionBy()  # at most five rows
    vip = F.col("segment") == rfm.VIP
    return totals.withColumns({
        "vip_customers": F.coalesce(F.max(F.when(vip, F.col("customers"))).over(everything), F.lit(0)),
        "vip_monetary": F.coalesce(F.max(F.when(vip, F.col("monetary"))).over(everything), F.lit(0)),
    }).select("segment", "customers", money("monetary").alias("monetary"), "vip_customers",
              pct2("vip_monetary", "all_monetary").alias("vip_value_pct"))


def customer_scatter(star: Star, slicers: Slicers | None = None) -> DataFrame:
    """Buyers with recency, frequency, value and segment."""
    buyers = _customers(rfm.all_customers(star), slicers).filter("has_purchase = 1")
    return buyers.select("customer_id", "recency_days", "frequency", money("monetary").alias("monetary"), "segment")


def customer_at_risk(star: Star, slicers: Slicers | None = None) -> DataFrame:
    """Customers at risk, most valuable first."""
    return _customers(rfm.rfm_all_customers(star), slicers).filter(F.col("segment") == rfm.AT_RISK).select(
        "customer_id", "customer_segment", "region", "recency_days", "frequency", "monetary",
    ).orderBy(F.desc("monetary"), "customer_id")


def ops_returns(star: Star, slicers: Slicers | None = None) -> DataFrame:
    return measures(star, ["category"], ["return_rate", "refund_amount"], slicers)


def ops_shipping(star: Star, slicers: Slicers | None = None) -> DataFrame:
    return sales.shipping_by_region(star.sliced(slicers)).select("region", "avg_shipping_cost", "net_shipping")


def ops_discount(star: Star, slicers: Slicers | None = None) -> DataFrame:
    """Average discount and margin by discount level, as ratios of sums."""
    return sales.discount_levels(star.sliced(slicers)).select(
        "discount_level", ratio("discount_amount", "list_amount").alias("average_discount"),
        ratio("gross_profit", "revenue").alias("gross_margin"))


def ops_alerts(star: Star, slicers: Slicers | None = None) -> DataFrame:
    """Products that lose money or whose order return rate reaches the rate over all products."""
    totals = shared(sales.order_totals(star.sliced(slicers), ["product_id"], ["revenue", "gross_profit"]), "product_id", joined=True)
    overall = totals.agg(F.struct(*[F.sum(c).alias(c) for c in ("orders", "returned_orders")])).scalar()
    flagged = totals.withColumn("all", overall).withColumns({
        "negative_margin": F.col("gross_profit") < 0,
        "high_return": F.col("returned_orders") * F.col("all.orders")
        >= F.col("all.returned_orders") * F.col("orders"),
    }).filter("negative_margin OR high_return")
    return flagged.join(star.dim_product.select("product_id", "product_name", "category"), "product_id").select(
        "product_id", "product_name", "category",
        ratio("gross_profit", "revenue").alias("gross_margin"),
        ratio("returned_orders", "orders").alias("return_rate"),
        F.col("negative_margin").cast("int").alias("negative_margin"),
        F.col("high_return").cast("int").alias("high_return"),
    )


def product_table_sliced(star: Star) -> DataFrame:
    """The product table of two categories and three years: a page under slicers."""
    return product_table(star, {"category": ["PROMO", "SMALL"], "date": Between(date(1997, 1, 1), date(1999, 12, 31))})
