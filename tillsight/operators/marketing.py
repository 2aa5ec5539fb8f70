"""Channels, campaigns and acquisition.

Each fact is reduced to its channel before anything is joined: sales lines and
marketing days meeting line by line would count both twice.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, functions as F

from tillsight.functions.money import money, money_per, pct, pct2, ratio, ratio2, wide_sum
from tillsight.operators.sales import order_totals
from tillsight.sources.star import Star


def _spend(star: Star) -> DataFrame:
    return star.fact_marketing.groupBy("channel_id").agg(
        wide_sum("marketing_spend").alias("spend"), F.sum("conversions").alias("conversions"))


def spend_by_channel(star: Star) -> DataFrame:
    """Marketing spend and conversions per channel."""
    return _spend(star).select("channel_id", money("spend").alias("spend"), "conversions")


def new_customers_by_channel(star: Star) -> DataFrame:
    """Customers acquired since the first calendar day, per channel (matched by name)."""
    first_day = star.dim_date.agg(F.min("date")).scalar()
    acquired = star.dim_customer.filter(F.col("acquisition_date") >= first_day) \
        .groupBy(F.col("acquisition_channel").alias("channel_name")).agg(F.count(F.lit(1)).alias("new_customers"))
    return acquired.join(star.dim_channel, "channel_name").select("channel_id", "channel_name", "new_customers")


def channel_facts(star: Star) -> DataFrame:
    """Every channel with its sales, spend and new customers, in cents; missing parts are null."""
    sales = order_totals(star, ["channel_id"], ["revenue", "gross_profit"]).drop("lines", "returned_orders")
    new = new_customers_by_channel(star).drop("channel_name")
    return star.dim_channel.join(sales, "channel_id", "left").join(_spend(star), "channel_id", "left") \
        .join(new, "channel_id", "left")


def channel_performance(star: Star) -> DataFrame:
    """Channel economics; channels without sales or spend count as zero, undefined ratios are null."""
    facts = channel_facts(star).selectExpr("*", "coalesce(gross_profit, 0) AS earned", "coalesce(spend, 0) AS spent")
    return facts.select(
        "channel_id", "channel_name", "channel_type",
        F.coalesce("orders", F.lit(0)).alias("orders"),
        money("coalesce(revenue, 0)").alias("revenue"),
        money("earned").alias("gross_profit"),
        pct2("gross_profit", "revenue").alias("gross_margin_pct"),
        money("spent").alias("marketing_spend"),
        F.coalesce("new_customers", F.lit(0)).alias("new_customers"),
        F.coalesce("conversions", F.lit(0)).alias("conversions"),
        money_per("spend", "new_customers").alias("cac"),
        ratio2("revenue", "spend").alias("roas"),
        money("earned - spent").alias("net_marketing_contribution"),
        pct2("earned - spent", "revenue").alias("margin_after_mkt_pct"),
    ).orderBy(F.desc("net_marketing_contribution"))


def channel_performance_py(star: Star) -> DataFrame:
    """Unrounded variant: spend is zero-filled first, so CAC can be 0; sales stay null when absent."""
    facts = channel_facts(star).withColumns({
        c: F.coalesce(c, F.lit(0)) for c in ("spend", "conversions", "new_customers")})
    return facts.select(
        "channel_id", "channel_name", "channel_type", "orders",
        money("revenue").alias("revenue"),
        money("gross_profit").alias("gross_profit"),
        money("spend").alias("spend"),
        "conversions", "new_customers",
        pct("gross_profit", "revenue").alias("gross_margin_pct"),
        F.when(F.col("new_customers") > 0, ratio("spend", "new_customers * 100")).alias("cac"),
        F.when(F.col("spend") > 0, ratio("revenue", "spend")).alias("roas"),
        money("gross_profit - spend").alias("net_marketing_contribution"),
    ).orderBy(F.desc("net_marketing_contribution"))


def campaign_performance(star: Star) -> DataFrame:
    """Spend, funnel and cost per conversion by channel and campaign."""
    sums = ("impressions", "clicks", "conversions")
    campaigns = star.fact_marketing.groupBy("channel_id", "campaign_name").agg(
        wide_sum("marketing_spend").alias("spend"), *[F.sum(c).alias(c) for c in sums])
    return campaigns.join(star.dim_channel, "channel_id").select(
        "channel_name", "campaign_name",
        money("spend").alias("spend"), *sums,
        pct2("clicks", "impressions").alias("ctr_pct"),
        pct2("conversions", "clicks").alias("cvr_pct"),
        money_per("spend", "conversions").alias("cost_per_conversion"),
    ).orderBy(F.desc("spend"))
