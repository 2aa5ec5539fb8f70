"""A registry of reusable measures: any measure by any dimension, under any slicers.

Sales, buyers, marketing days and acquired customers are aggregated on their own
and meet only on shared dimensions, so nothing is counted twice. A measure whose
fact does not have the dimension (marketing by product, say) is null.
"""

from __future__ import annotations

from collections.abc import Callable, Iterable
from datetime import date
from functools import reduce

from pyspark.sql import Column, DataFrame, functions as F

from tillsight.functions.economics import year_month
from tillsight.functions.money import money, ratio, wide_sum
from tillsight.operators.rfm import with_segments
from tillsight.operators.sales import calendar_growth, order_totals
from tillsight.sources.star import Between, Slicers, Star, slicer_test

SALES_SUMS = ("revenue", "product_cost", "shipping_cost", "payment_fee", "refund_amount", "quantity",
              "discount_amount", "list_amount")
BUYERS = ("customers_with_orders", "repeat_customers")
MARKETING = ("marketing_spend", "conversions")
ACQUISITION = ("new_customers",)

# Dimensions the smaller facts know; sales know every column of the star.
TIME = ("year", "quarter", "month", "year_month", "month_start", "date")
CHANNEL = ("channel_name", "channel_type")
MARKETING_DIMENSIONS = (*TIME, *CHANNEL, "campaign_name")
ACQUISITION_DIMENSIONS = (*TIME, *CHANNEL, "customer_segment", "city", "region", "acquisition_channel")


GROSS_PROFIT = "revenue - product_cost - shipping_cost - payment_fee - refund_amount"


def _money_per(cents: str, count: str) -> Column:
    return ratio(cents, f"({count}) * 100")


# Measure -> (base columns it reads, expression over them).
MEASURES: dict[str, tuple[tuple[str, ...], Callable[[], Column]]] = {}


def _measure(name: str, inputs: tuple[str, ...], expression: Callable[[], Column]) -> None:
    MEASURES[name] = (inputs, expression)


PROFIT_INPUTS = ("revenue", "product_cost", "shipping_cost", "payment_fee", "refund_amount")
_measure("revenue", ("revenue",), lambda: money("revenue"))
_measure("product_cost", ("product_cost",), lambda: money("product_cost"))
_measure("shipping_cost", ("shipping_cost",), lambda: money("shipping_cost"))
_measure("payment_fee", ("payment_fee",), lambda: money("payment_fee"))
_measure("refund_amount", ("refund_amount",), lambda: money("refund_amount"))
_measure("gross_profit", PROFIT_INPUTS, lambda: money(GROSS_PROFIT))
_measure("gross_margin", PROFIT_INPUTS, lambda: ratio(GROSS_PROFIT, "revenue"))
_measure("orders", ("orders",), lambda: F.col("orders"))
_measure("units_sold", ("quantity",), lambda: F.col("quantity").cast("bigint"))
_measure("average_order_value", ("revenue", "orders"), lambda: _money_per("revenue", "orders"))
_measure("marketing_spend", ("marketing_spend",), lambda: money("marketing_spend"))
_measure("new_customers", ("new_customers",), lambda: F.col("new_customers"))
_measure("cac", ("marketing_spend", "new_customers"), lambda: _money_per("marketing_spend", "new_customers"))
_measure("roas", ("revenue", "marketing_spend"), lambda: ratio("revenue", "marketing_spend"))
_measure("net_marketing_contribution", (*PROFIT_INPUTS, "marketing_spend"),
         lambda: money(f"{GROSS_PROFIT} - coalesce(marketing_spend, 0)"))
_measure("returned_orders", ("returned_orders",), lambda: F.col("returned_orders"))
_measure("return_rate", ("returned_orders", "orders"), lambda: ratio("returned_orders", "orders"))
_measure("customers_with_orders", BUYERS[:1], lambda: F.col("customers_with_orders"))
_measure("repeat_customers", BUYERS[1:], lambda: F.col("repeat_customers"))
_measure("repeat_purchase_rate", BUYERS, lambda: ratio("repeat_customers", "customers_with_orders"))
_measure("revenue_per_customer", ("revenue", "customers_with_orders"),
         lambda: _money_per("revenue", "customers_with_orders"))
_measure("average_discount", ("discount_amount", "list_amount"), lambda: ratio("discount_amount", "list_amount"))
_measure("clv_approx", (*PROFIT_INPUTS, "customers_with_orders"),
         lambda: _money_per(GROSS_PROFIT, "customers_with_orders"))
_measure("conversions", ("conversions",), lambda: F.col("conversions"))
_measure("cost_per_conversion", ("marketing_spend", "conversions"), lambda: _money_per("marketing_spend", "conversions"))


def measures(star: Star, by: Iterable[str] = (), names: Iterable[str] | None = None,
             slicers: Slicers | None = None) -> DataFrame:
    """``names`` (all by default) by the dimensions ``by``, over rows that the slicers let through.

    Customers of a group come from the same reduction to orders as the sums. Where
    they are asked for, an order is taken to have one customer.
    """
    star = star.sliced(slicers)
    by, names, slicers = list(by), list(names or MEASURES), star.slicers
    inputs = {c for n in names for c in MEASURES[n][0]}
    parts = []
    sums = [c for c in SALES_SUMS if c in inputs]
    if inputs & set(BUYERS):
        parts.append(customer_totals(star, by, sums))
    elif sums or inputs & {"orders", "returned_orders"}:
        parts.append(order_totals(star, by, sums))
    used = {*by, *slicers}
    if inputs & set(MARKETING) and used <= set(MARKETING_DIMENSIONS):
        parts.append(_sliced(_marketing_rows(star), slicers).groupBy(*by).agg(
            wide_sum("marketing_spend").alias("marketing_spend"), F.sum("conversions").alias("conversions")))
    if inputs & set(ACQUISITION) and used <= set(ACQUISITION_DIMENSIONS):
        parts.append(_sliced(_acquired_rows(star), slicers).groupBy(*by).agg(
            F.count(F.lit(1)).alias("new_customers")))
    if not parts:  # marketing or acquisition alone, by what they do not know
        parts.append(order_totals(star, by, []))
    return _side_by_side(parts, by, sorted(inputs)).select(*by, *[MEASURES[n][1]().alias(n) for n in names])


def customer_totals(star: Star, by: list[str], sums: list[str]) -> DataFrame:
    """:func:`order_totals` with the customers who ordered, and ordered twice or more, within the group.

    Lines go to one row per group, customer and order, then per customer, then per
    group: one pass over lines and orders for sums, orders and customers.
    """
    lines = star.sales(*dict.fromkeys([*by, "customer_id", "order_id", "returned_flag", *sums]))
    per_order = lines.groupBy(*by, "customer_id", "order_id").agg(
        F.max(F.when(F.col("order_id").isNotNull(), F.col("returned_flag"))).alias("returned"),
        *[F.sum(c).alias(c) for c in sums])
    per_customer = per_order.groupBy(*by, "customer_id").agg(
        F.count("order_id").alias("orders"), F.count_if(F.col("returned") == 1).alias("returned_orders"),
        *[wide_sum(c).alias(c) for c in sums])
    known = F.col("customer_id").isNotNull()
    return per_customer.groupBy(*by).agg(
        F.sum("orders").alias("orders"), F.sum("returned_orders").alias("returned_orders"),
        F.count_if(known).alias("customers_with_orders"),
        F.count_if(known & (F.col("orders") >= 2)).alias("repeat_customers"),
        *[F.sum(c).alias(c) for c in sums])


def growth(star: Star, by: Iterable[str] = (), slicers: Slicers | None = None) -> DataFrame:
    """Revenue and profit per month against the previous calendar month, within each group of ``by``."""
    return calendar_growth(star.sliced(slicers), list(by))


def _side_by_side(parts: list[DataFrame], by: list[str], inputs: list[str]) -> DataFrame:
    """Aggregates of several facts on shared dimensions. Each has at most one row per group, so max picks it."""
    stacked = reduce(lambda a, b: a.unionByName(b, allowMissingColumns=True), parts)
    present = [c for c in inputs if c in stacked.columns]
    absent = [F.lit(None).cast("bigint").alias(c) for c in inputs if c not in stacked.columns]
    grouped = stacked.groupBy(*by).agg(*[F.max(c).alias(c) for c in present])
    return grouped.select("*", *absent)


def _sliced(rows: DataFrame, slicers: Slicers) -> DataFrame:
    test = slicer_test(slicers)
    return rows if test is None else rows.filter(test)


def _with_time(rows: DataFrame, column: str) -> DataFrame:
    return rows.withColumns({
        "month_start": F.trunc(column, "MM"), "year": F.year(column), "year_month": year_month(column),
        "quarter": F.quarter(column), "month": F.month(column), "date": F.col(column)})


def sliced_marketing(star: Star, slicers: Slicers | None) -> DataFrame:
    """Marketing days under the slicers they know; others, such as a product category, do not touch them."""
    known = {c: v for c, v in (slicers or {}).items() if c in MARKETING_DIMENSIONS}
    return _sliced(_marketing_rows(star), known).select(*star.fact_marketing.columns)


def _marketing_rows(star: Star) -> DataFrame:
    return _with_time(star.fact_marketing.join(star.dim_channel, "channel_id"), "date")


def _acquired_rows(star: Star) -> DataFrame:
    """Customers acquired on a day of the calendar, by the channel that acquired them (matched by name)."""
    channels = star.dim_channel.select("channel_name", "channel_type")
    days = star.dim_date.select(F.col("date").alias("acquisition_date"))
    customers = star.dim_customer.join(days, "acquisition_date", "left_semi")
    joined = customers.join(channels, F.col("acquisition_channel") == F.col("channel_name"), "left")
    return _with_time(joined, "acquisition_date")


def measures_overall(star: Star) -> DataFrame:
    """All measures, in one row."""
    return measures(star)


def measures_by_month(star: Star) -> DataFrame:
    """All measures by month."""
    months = measures(star, ["month_start"])
    return months.select(year_month("month_start").alias("year_month"), *MEASURES).orderBy("year_month")


def measures_by_category(star: Star) -> DataFrame:
    """All measures by product category; marketing measures are null there."""
    return measures(star, ["category"])


def measures_by_channel(star: Star) -> DataFrame:
    """All measures by channel."""
    return measures(star, ["channel_name"])


def repeat_purchase_rate(star: Star) -> DataFrame:
    """Share of buyers with two or more orders, by acquisition channel and customer segment."""
    return measures(star, ["acquisition_channel", "customer_segment"],
                    [*BUYERS, "repeat_purchase_rate"])


def new_customers_by_month(star: Star) -> DataFrame:
    """Customers acquired per calendar month."""
    months = measures(star, ["month_start"], ["new_customers"])
    return months.select(year_month("month_start").alias("year_month"), "new_customers").orderBy("year_month")


def measures_sliced(star: Star) -> DataFrame:
    """Sales measures by brand for two categories and two regions: the slicers at work."""
    return measures(star, ["brand"], ["revenue", "gross_profit", "gross_margin", "orders", "units_sold"],
                    {"category": ["PROMO", "SMALL"], "region": ["ASIA", "EUROPE"], "active_flag": [1]})


def measures_in_date_range(star: Star) -> DataFrame:
    """All measures by month within three years: the date range at work, over all facts that have dates."""
    return measures(star, ["year_month"], slicers={"date": Between(date(1996, 7, 1), date(1999, 6, 30))})


def measures_by_segment(star: Star) -> DataFrame:
    """Sales measures by customer segment (quintile scores over all orders)."""
    names = ["revenue", "gross_profit", "orders", "customers_with_orders", "repeat_purchase_rate"]
    return measures(with_segments(star), ["segment"], names)


def growth_by_category(star: Star) -> DataFrame:
    """Monthly growth by product category."""
    return growth(star, ["category"])
