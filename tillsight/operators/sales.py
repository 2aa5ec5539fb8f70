"""Revenue, margin, returns, shipping and discount answers over order lines."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window, functions as F

from tillsight.functions.economics import year_month
from tillsight.functions.money import money, money_per, pct, pct2, ratio, wide_sum
from tillsight.sources.session import shared
from tillsight.sources.star import COLUMNS, Star

MARGIN_UNITS = 10**8  # a line margin is kept as a whole number of 1e-8, so its mean is order-independent


def order_totals(star: Star, keys: list[str], sums: list[str], how: str = "inner", where: Column | None = None,
                 where_columns: tuple[str, ...] = ()) -> DataFrame:
    """Per group: lines, distinct orders, orders with a returned line and sums.

    Lines are first reduced to one row per group and order. Map-side combine
    absorbs a hot group or a hot order before the shuffle, and one shuffle serves
    every distinct count.
    """
    if star.has("order_grain") and how == "inner" and where is None and {*keys} <= ORDER_KEYS and {*sums} <= {*ORDER_SUMS}:
        orders = star.table("order_grain").withColumn("month_start", F.trunc("order_date", "MM"))
        per_order = orders.groupBy(*keys, "order_id").agg(
            F.sum("lines").alias("lines"), F.max("returned").alias("returned"), *[F.sum(c).alias(c) for c in sums])
    else:
        inputs = list(dict.fromkeys([*keys, "order_id", "returned_flag", *sums]))
        lines = star.sales(*inputs, how=how, where=where, where_columns=where_columns)
        per_order = lines.groupBy(*keys, "order_id").agg(
            F.count(F.lit(1)).alias("lines"),
            F.max(F.when(F.col("order_id").isNotNull(), F.col("returned_flag"))).alias("returned"),
            *[F.sum(c).alias(c) for c in sums],
        )
    return per_order.groupBy(*keys).agg(
        F.sum("lines").alias("lines"),
        F.count("order_id").alias("orders"),
        F.count_if(F.col("returned") == 1).alias("returned_orders"),
        *[wide_sum(c).alias(c) for c in sums],
    )


ORDER_KEYS = frozenset({"customer_id", "channel_id", "order_date", "month_start"})
ORDER_SUMS = ("revenue", "gross_profit", "monetary")
PRODUCT_SUMS = ("quantity", "revenue", "gross_profit", "returned_flag", "refund_amount")


def rolled_up(star: Star) -> Star:
    """The star with its sales reduced once to orders and once to products, for a report of many answers.

    What is summed by month, channel or customer then starts from one row per order, what is summed by product,
    category or overall from one row per product, and the lines are read twice however many answers there are.
    """
    orders = star.sales("order_id", "customer_id", "channel_id", "order_date", "returned_flag", *ORDER_SUMS) \
        .groupBy("order_id", "customer_id", "channel_id", "order_date").agg(
            F.count(F.lit(1)).alias("lines"), F.max(F.when(F.col("order_id").isNotNull(), F.col("returned_flag"))).alias("returned"),
            *[F.sum(c).alias(c) for c in ORDER_SUMS])
    return star.with_tables(order_grain=lambda: shared(orders, "order_id"), product_grain=lambda: shared(product_grain(star), "product_id", joined=True))


def product_grain(star: Star) -> DataFrame:
    """One row per product, that of null included: lines, sums, and line margins with and without discount.

    Alone, a reader gets only the sums it takes: Spark leaves out the others, down to the scan.
    """
    if star.has("product_grain"):
        return star.table("product_grain")
    margin = _line_margin().cast("decimal(19,0)")
    known = (F.col("list_amount") > 0) & (F.col("revenue") > 0)
    by_sign = {"with_discount": F.col("discount_amount") > 0, "without_discount": F.col("discount_amount") == 0}
    return star.sales("product_id", "list_amount", "discount_amount", "shipping_revenue", "shipping_cost", *PRODUCT_SUMS).groupBy("product_id").agg(
        F.count(F.lit(1)).alias("lines"), *[F.sum(c).alias(c) for c in PRODUCT_SUMS],
        F.sum(F.col("shipping_revenue") - F.col("shipping_cost")).alias("net_shipping"),
        *[F.sum(F.when(known & test, margin)).alias(name) for name, test in by_sign.items()],
        *[F.count(F.when(known & test, margin)).alias(f"{name}_lines") for name, test in by_sign.items()])


def product_totals(star: Star, sums: tuple[str, ...] = ("quantity", "revenue", "gross_profit")) -> DataFrame:
    """Sums per product, then name and category: products are joined once each, not once per line."""
    totals = product_grain(star).select("product_id", *sums)
    return totals.join(star.dim_product.select("product_id", "product_name", "category"), "product_id")


def category_sums(star: Star) -> DataFrame:
    """Lines and sums per category, from product sums."""
    sums = ("revenue", "gross_profit", "returned_flag", "refund_amount")
    products = product_grain(star).select("product_id", "lines", *sums).join(star.dim_product.select("product_id", "category"), "product_id")
    return products.groupBy("category").agg(F.sum("lines").alias("lines"), *[wide_sum(c).alias(c) for c in sums])


# --- line level -----------------------------------------------------------------------------------

def sales_enriched(star: Star) -> DataFrame:
    """Lines with product, customer and channel attributes (left joins) and their economics."""
    fact = list(COLUMNS["fact_sales"])
    lines = star.sales(
        *fact, "product_name", "category", "region", "customer_segment", "channel_name", "channel_type",
        "revenue", "gross_profit", "year_month", "list_amount", how="left")
    cents = ("unit_price", "discount_amount", "shipping_revenue", "product_cost", "shipping_cost",
             "payment_fee", "refund_amount", "revenue", "gross_profit", "list_amount")
    return lines.withColumns({c: money(c) for c in cents})


def line_economics(star: Star) -> DataFrame:
    """Revenue and gross profit of every line."""
    lines = star.sales("order_id", "product_id", "quantity", "revenue", "gross_profit")
    return lines.withColumns({"revenue": money("revenue"), "gross_profit": money("gross_profit")})


def line_discount_margin(star: Star) -> DataFrame:
    """Discount rate, level and margin of every line with a positive list amount."""
    lines = star.sales("order_id", "product_id", "list_amount", "discount_amount", "revenue", "gross_profit",
                       "discount_level", where=F.col("list_amount") > 0)
    return lines.select(
        "order_id", "product_id", "discount_level",
        ratio("discount_amount", "list_amount").alias("discount_rate"),
        F.when(F.col("revenue") > 0, pct("gross_profit", "revenue")).alias("margin_pct"),
    )


def orphan_sales_rows(star: Star) -> DataFrame:
    """Lines whose customer, product, channel or date is in no dimension, one row per missing link.

    All links of a line are looked up in one pass over the lines; a null key is missing too.
    """
    links = {
        "channel": ("channel_id", star.dim_channel, "channel_id"),
        "date": ("order_date", star.dim_date, "date"),
        "product": ("product_id", star.dim_product, "product_id"),
        "customer": ("customer_id", star.dim_customer, "customer_id"),
    }
    lines = star.sales("order_id", "product_id", "customer_id", "channel_id", "order_date")
    for name, (key, parent, parent_key) in links.items():
        known = parent.select(F.col(parent_key).alias(f"known_{name}")).distinct()
        lines = lines.join(known, F.col(key) == F.col(f"known_{name}"), "left")
    missing = F.array_compact(F.array(*[
        F.when(F.col(f"known_{name}").isNull(), F.struct(F.lit(name).alias("missing"), F.col(key).cast("string").alias("key_value")))
        for name, (key, _, _) in links.items()]))
    return lines.select("order_id", "product_id", F.explode(missing).alias("link")).select("link.missing", "order_id", "product_id", "link.key_value")


# --- months ---------------------------------------------------------------------------------------

def monthly_totals(star: Star) -> DataFrame:
    """Orders, revenue and gross profit per month, in cents."""
    return order_totals(star, ["month_start"], ["revenue", "gross_profit"])


def _previous(column: str) -> Column:
    # One row per month: the window holds as many rows as there are months.
    return F.lag(column).over(Window.orderBy("month_start"))


def monthly_revenue(star: Star) -> DataFrame:
    """Monthly revenue, profit, margin and basket, with growth against the previous month present."""
    months = monthly_totals(star).withColumns({
        "revenue_before": _previous("revenue"), "profit_before": _previous("gross_profit")})
    return months.select(
        year_month("month_start").alias("year_month"),
        "orders",
        money("revenue").alias("revenue"),
        money("gross_profit").alias("gross_profit"),
        pct2("gross_profit", "revenue").alias("gross_margin_pct"),
        money_per("revenue", "orders").alias("avg_order_value"),
        pct2("revenue - revenue_before", "revenue_before").alias("revenue_mom_pct"),
        pct2("gross_profit - profit_before", "profit_before").alias("gross_profit_mom_pct"),
    ).orderBy("year_month")


def monthly_margin_py(star: Star) -> DataFrame:
    """Monthly totals with unrounded margin and revenue growth; growth from zero is null."""
    months = monthly_totals(star).withColumn("revenue_before", _previous("revenue"))
    return months.select(
        year_month("month_start").alias("year_month"),
        "orders",
        money("revenue").alias("revenue"),
        money("gross_profit").alias("gross_profit"),
        pct("gross_profit", "revenue").alias("gross_margin_pct"),
        pct("revenue - revenue_before", "revenue_before").alias("revenue_mom_pct"),
    ).orderBy("year_month")


def calendar_growth(star: Star, by: list[str]) -> DataFrame:
    """Growth of each group against its previous calendar month, as a fraction; null when that month has no sales."""
    within = Window.partitionBy(*by).orderBy("month_start")  # one row per group and month
    before = {c: F.lag(c).over(within) for c in ("month_start", "revenue", "gross_profit")}
    months = order_totals(star, [*by, "month_start"], ["revenue", "gross_profit"])
    follows = before["month_start"] == F.add_months("month_start", -1)
    months = months.withColumns({
        "revenue_pm": F.when(follows, before["revenue"]), "gross_profit_pm": F.when(follows, before["gross_profit"])})
    return months.select(
        *by,
        year_month("month_start").alias("year_month"),
        money("revenue").alias("revenue"),
        money("revenue_pm").alias("revenue_pm"),
        ratio("revenue - revenue_pm", "revenue_pm").alias("revenue_growth"),
        money("gross_profit").alias("gross_profit"),
        money("gross_profit_pm").alias("gross_profit_pm"),
        ratio("gross_profit - gross_profit_pm", "gross_profit_pm").alias("gross_profit_growth"),
    ).orderBy(*by, "year_month")


def mom_growth_calendar(star: Star) -> DataFrame:
    """Growth against the previous calendar month, as a fraction; null when that month has no sales."""
    return calendar_growth(star, [])


# --- categories and products ----------------------------------------------------------------------

def category_totals(star: Star) -> DataFrame:
    return order_totals(star, ["category"], ["quantity", "revenue", "gross_profit", "refund_amount"])


def margin_by_category(star: Star) -> DataFrame:
    """Orders, units, revenue, profit, margin and profit per unit by category."""
    return category_totals(star).orderBy(F.desc("gross_profit")).select(
        "category", "orders",
        F.col("quantity").cast("bigint").alias("units"),
        money("revenue").alias("revenue"),
        money("gross_profit").alias("gross_profit"),
        pct2("gross_profit", "revenue").alias("gross_margin_pct"),
        money_per("gross_profit", "quantity").alias("profit_per_unit"),
    )


def product_profitability(star: Star) -> DataFrame:
    """Units, revenue, profit and unrounded margin by product."""
    return product_totals(star).select(
        "product_id", "product_name", "category",
        F.col("quantity").alias("units"),
        money("revenue").alias("revenue"),
        money("gross_profit").alias("gross_profit"),
        pct("gross_profit", "revenue").alias("gross_margin_pct"),
    )


def scored_products(star: Star) -> DataFrame:
    """Product totals beside the unweighted averages of units and margin over all products.

    Margins are whole numbers of 1e-8 here, so that comparing with their average
    gives the same answer whatever order rows arrive in.
    """
    margin = F.expr(f"(CAST(gross_profit AS DECIMAL(38,0)) * {MARGIN_UNITS}) div nullif(revenue, 0)")
    products = product_totals(star).withColumn("margin", margin)
    average = products.agg(F.struct(
        F.count(F.lit(1)).alias("products"),
        wide_sum("quantity").alias("units"),
        F.count("margin").alias("margins"),
        wide_sum("margin").alias("margin"),
    )).scalar()
    return products.withColumn("all", average)


def _quadrant(star: Star, keep: Column) -> DataFrame:
    return scored_products(star).filter(keep).select(
        "product_id", "product_name", "category",
        F.col("quantity").alias("units"),
        money("revenue").alias("revenue"),
        money("gross_profit").alias("gross_profit"),
        pct2("gross_profit", "revenue").alias("gross_margin_pct"),
    )


def _against_average() -> tuple[Column, Column]:
    units = F.col("quantity") * F.col("all.products") - F.col("all.units")
    margin = F.col("margin") * F.col("all.margins") - F.col("all.margin")
    return units, margin


def high_volume_low_margin(star: Star) -> DataFrame:
    """Products at or above the average units and at or below the average margin."""
    units, margin = _against_average()
    return _quadrant(star, (units >= 0) & (margin <= 0)).orderBy(F.desc("units"), "gross_margin_pct")


def low_volume_high_margin(star: Star) -> DataFrame:
    """Products at or below the average units and at or above the average margin."""
    units, margin = _against_average()
    return _quadrant(star, (units <= 0) & (margin >= 0)).orderBy(F.desc("gross_margin_pct"), "units")


def top_products(star: Star, n: int = 10) -> DataFrame:
    """The ``n`` products with most profit and the total profit, in cents; ties by product."""
    products = product_totals(star)
    total = products.agg(wide_sum("gross_profit")).scalar()
    return products.withColumn("total", total).orderBy(F.desc("gross_profit"), "product_id").limit(n)


def top10_margin_contribution(star: Star) -> DataFrame:
    """Top ten products by profit with their share of the profit of all products."""
    return top_products(star).select(
        "product_id", "product_name", "category",
        money("gross_profit").alias("gross_profit"),
        pct2("gross_profit", "total").alias("pct_of_total_profit"),
    )


# --- returns, shipping, discounts -----------------------------------------------------------------

def returns_by_category(star: Star) -> DataFrame:
    """Line and order return rates and refunds by category."""
    totals = order_totals(star, ["category"], ["returned_flag", "refund_amount", "revenue"])
    return totals.select(
        "category", "lines",
        F.col("returned_flag").cast("bigint").alias("returned_lines"),
        pct2("returned_flag", "lines").alias("return_rate_line_pct"),
        pct2("returned_orders", "orders").alias("return_rate_order_pct"),
        money("refund_amount").alias("total_refund"),
        pct2("refund_amount", "revenue").alias("refund_pct_of_revenue"),
    ).orderBy(F.desc("return_rate_line_pct"))


def returns_by_category_line(star: Star) -> DataFrame:
    """Line-level returns by category, unrounded."""
    return category_sums(star).select(
        "category", "lines",
        F.col("returned_flag").cast("bigint").alias("returned_lines"),
        money("refund_amount").alias("total_refund"),
        money("revenue").alias("revenue"),
        pct("returned_flag", "lines").alias("return_rate_pct"),
        pct("refund_amount", "revenue").alias("refund_pct_of_revenue"),
    ).orderBy(F.desc("return_rate_pct"))


def shipping_by_region(star: Star) -> DataFrame:
    """Average and total shipping cost, shipping revenue and their difference by region.

    Lines are summed per customer first, so a hot customer or region is reduced
    before any join.
    """
    per_customer = star.sales("customer_id", "shipping_cost", "shipping_revenue").groupBy("customer_id").agg(
        F.count("shipping_cost").alias("lines"),
        F.sum("shipping_cost").alias("cost"), F.sum("shipping_revenue").alias("revenue"))
    per_region = per_customer.join(star.dim_customer.select("customer_id", "region"), "customer_id", "left") \
        .groupBy("region").agg(
            F.sum("lines").alias("lines"), wide_sum("cost").alias("cost"), wide_sum("revenue").alias("revenue"))
    return per_region.select(
        "region",
        ratio("cost", "lines * 100").alias("avg_shipping_cost"),
        money("cost").alias("total_shipping_cost"),
        money("revenue").alias("total_shipping_revenue"),
        money("revenue - cost").alias("net_shipping"),
    )


def line_margins(star: Star, *columns: str) -> DataFrame:
    """``columns`` and the margin of each line in 1e-8; null unless revenue is positive."""
    lines = star.sales(*dict.fromkeys([*columns, "list_amount", "revenue", "gross_profit"]),
                       where=F.col("list_amount") > 0)
    return lines.select(*columns, _line_margin().alias("margin"))


def _line_margin() -> Column:
    return F.expr(f"CASE WHEN revenue > 0 THEN (CAST(gross_profit AS DECIMAL(38,0)) * {MARGIN_UNITS}) div revenue END")


def mean_margin_pct(margin_sum: str, margin_count: str) -> Column:
    """Mean of line margins in percent, from their sum in 1e-8 and their count."""
    return ratio(margin_sum, f"{margin_count} * {MARGIN_UNITS // 100}L")


def margin_by_discount_bucket(star: Star) -> DataFrame:
    """Mean of line margins per discount level."""
    levels = line_margins(star, "discount_level").groupBy("discount_level").agg(
        F.sum(F.col("margin").cast("decimal(19,0)")).alias("total"), F.count("margin").alias("n"),
        F.count("discount_level").alias("lines"))
    return levels.filter("lines > 0").select("discount_level", mean_margin_pct("total", "n").alias("margin_pct"))


def discount_levels(star: Star) -> DataFrame:
    """Sums per discount level, in cents.

    Lines without a level go by their count, after grouping: a null filter on
    the level would be pushed down to the scan with the whole CASE in it.
    """
    sums = ("discount_amount", "list_amount", "revenue", "gross_profit")
    per_channel = star.sales("discount_level", "channel_id", *sums).groupBy("discount_level", "channel_id").agg(
        F.count("discount_level").alias("lines"), *[F.sum(c).alias(c) for c in sums])
    return per_channel.groupBy("discount_level").agg(
        F.sum("lines").alias("lines"), *[wide_sum(c).alias(c) for c in sums]).filter("lines > 0")


def table_totals(star: Star) -> DataFrame:
    """Row counts of the six tables, distinct orders, revenue and gross profit, in one row."""
    def rows(table: str) -> Column:
        return star.table(table).agg(F.count(F.lit(1))).scalar()

    facts = order_totals(star, [], ["revenue", "gross_profit"])
    return facts.select(
        rows("dim_date").alias("dim_date_rows"),
        rows("dim_product").alias("dim_product_rows"),
        rows("dim_customer").alias("dim_customer_rows"),
        rows("dim_channel").alias("dim_channel_rows"),
        F.coalesce("lines", F.lit(0)).alias("fact_sales_rows"),
        rows("fact_marketing").alias("fact_marketing_rows"),
        F.col("orders").alias("distinct_orders"),
        money("revenue").alias("total_revenue"),
        money("gross_profit").alias("total_gross_profit"),
    )
