"""The star schema as a view over the order, part, customer and event tables.

Every amount is an integer-cent expression, so other engines can recompute it
exactly. Nothing here is broadcast by hint: Spark broadcasts a side only when
its own size estimate is under ``spark.sql.autoBroadcastJoinThreshold``, and AQE
splits hot keys otherwise.
"""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import Column, DataFrame, SparkSession, functions as F

from tillsight.sources.calendar import data_calendar, whole_months
from tillsight.sources.session import prepare
from tillsight.sources.star import COLUMNS, Star

# The six sales channels.
CHANNELS = (
    (1, "Organic Search", "Organic"),
    (2, "Paid Search", "Paid"),
    (3, "Social Ads", "Paid"),
    (4, "Email", "Owned"),
    (5, "Referral", "Referral"),
    (6, "Direct", "Direct"),
)

ORDER_COLUMNS = frozenset({"order_date", "customer_id"})
PART_COLUMNS = frozenset({"product_cost", "product_name", "category", "subcategory", "brand", "active_flag"})
# Cents are floor(x * 100 + 0.5): round() on doubles goes through BigDecimal for every row.
COST_RATE = "(40 + p_partkey % 50 + CASE WHEN p_type = 'PROMO' THEN 12 ELSE 0 END)"


def channel_rows(spark: SparkSession) -> DataFrame:
    rows = ", ".join(f"({i}, '{name}', '{kind}')" for i, name, kind in CHANNELS)
    return spark.sql(f"SELECT * FROM VALUES {rows} AS t(channel_id, channel_name, channel_type)")


def open_star(spark: SparkSession, folder: str) -> Star:
    """Clean star over all orders. Turns on adaptive skew handling in the session, see ``prepare``."""
    prepare(spark)

    def narrow(columns: frozenset[str], how: str) -> DataFrame:
        return sales_lines(spark, folder, columns, how)

    return _star(spark, folder, narrow)


def open_raw_star(spark: SparkSession, folder: str) -> Star:
    """The same star with deterministic defects: nulls, padded text and repeated lines."""
    prepare(spark)

    def narrow(columns: frozenset[str], how: str) -> DataFrame:
        return _spoil_sales(sales_lines(spark, folder, columns | {"order_id", "line_number"}, how))

    clean = _star(spark, folder, narrow)

    def spoiled_customers() -> DataFrame:
        return clean.dim_customer.withColumns({
            "city": F.expr("CASE WHEN customer_id % 100 <> 3 THEN city END"),
            "region": F.expr("CASE WHEN customer_id % 200 <> 5 THEN region END"),
            "customer_segment": F.expr(r"CASE WHEN customer_id % 50 = 1 "
                                       r"THEN concat('\t ', customer_segment, '  ') ELSE customer_segment END"),
        })

    def spoiled_products() -> DataFrame:
        return clean.dim_product.withColumns({
            "brand": F.expr("CASE WHEN product_id % 100 <> 7 THEN brand END"),
            "subcategory": F.expr("CASE WHEN product_id % 100 <> 9 THEN subcategory END"),
        })

    return clean.with_tables(dim_customer=spoiled_customers, dim_product=spoiled_products)


def _star(spark: SparkSession, folder: str, narrow: Callable[[frozenset[str], str], DataFrame]) -> Star:
    sales = list(COLUMNS["fact_sales"])
    return Star(spark, {
        "dim_date": lambda: data_calendar(_order_dates(spark, folder), "order_date"),
        "dim_product": lambda: products(spark, folder),
        "dim_customer": lambda: customers(spark, folder),
        "dim_channel": lambda: channel_rows(spark),
        "fact_sales": lambda: narrow(frozenset(sales), "left").select(*sales),
        "fact_marketing": lambda: marketing(spark, folder),
    }, narrow)


# Declared, so that opening a table starts no job.
SOURCES = {
    "region": "r_regionkey int, r_name string",
    "nation": "n_nationkey int, n_name string, n_regionkey int",
    "customer": "c_custkey bigint, c_nationkey int, c_mktsegment string",
    "part": "p_partkey bigint, p_name string, p_brand string, p_type string, p_size int, p_retailprice double",
    "orders": "o_orderkey bigint, o_custkey bigint, o_orderdate timestamp_ntz",
    "lineitem": "l_orderkey bigint, l_partkey bigint, l_linenumber int, l_quantity double, "
                "l_extendedprice double, l_discount double, l_returnflag string",
    "events": "event_id bigint, user_id bigint, event_type string, value double",
}


def _parquet(spark: SparkSession, folder: str, table: str) -> DataFrame:
    return spark.read.schema(SOURCES[table]).parquet(f"{folder}/{table}.parquet")


def _order_dates(spark: SparkSession, folder: str) -> DataFrame:
    return _parquet(spark, folder, "orders").select(F.col("o_orderdate").cast("date").alias("order_date"))


def _order_days(spark: SparkSession, folder: str) -> Column:
    """(first, days) of the whole months with orders: acquisition and marketing are dealt over them."""
    return whole_months(_order_dates(spark, folder), "order_date").select(
        F.struct("first", (F.datediff("last", "first") + 1).alias("days"))).scalar()


def _product_columns() -> list[str]:
    return [
        "p_partkey AS product_id",
        "p_name AS product_name",
        "p_type AS category",
        "concat(p_type, ' ', p_size % 5) AS subcategory",
        "p_brand AS brand",
        "CAST(p_partkey % 10 <> 0 AS INT) AS active_flag",
    ]


def products(spark: SparkSession, folder: str) -> DataFrame:
    priced = _parquet(spark, folder, "part").selectExpr(
        "*", "floor(p_retailprice * 100 + 0.5D) AS list_price")
    return priced.selectExpr(
        *_product_columns(),
        "list_price",
        f"(list_price * {COST_RATE}) div 100 AS unit_cost",
        "concat('Supplier ', p_partkey % 6) AS supplier",
    ).select(*COLUMNS["dim_product"])


def customers(spark: SparkSession, folder: str) -> DataFrame:
    places = _parquet(spark, folder, "nation").join(
        _parquet(spark, folder, "region"), F.col("n_regionkey") == F.col("r_regionkey"))
    joined = _parquet(spark, folder, "customer").join(places, F.col("c_nationkey") == F.col("n_nationkey"))
    channel = "CASE c_custkey % 6 " + " ".join(f"WHEN {i - 1} THEN '{name}'" for i, name, _ in CHANNELS) + " END"
    # Some customers come before the first order: up to half a year.
    return joined.withColumn("span", _order_days(spark, folder)).selectExpr(
        "c_custkey AS customer_id",
        "c_mktsegment AS customer_segment",
        "n_name AS city",
        "r_name AS region",
        "date_add(span.first, CAST((c_custkey * 37) % (span.days + 180) - 180 AS INT)) AS acquisition_date",
        f"{channel} AS acquisition_channel",
    )


def marketing(spark: SparkSession, folder: str) -> DataFrame:
    """Event log rolled up to one row per channel and day."""
    events = _parquet(spark, folder, "events").withColumn("span", _order_days(spark, folder)).select(
        F.expr("CAST(2 + user_id % 4 AS INT) AS channel_id"),
        F.expr("date_add(span.first, CAST(event_id % span.days AS INT)) AS date"),
        "event_type",
        F.expr("floor(value * 100 + 0.5D) * 10 AS spend"),
    )
    days = events.groupBy("channel_id", "date").agg(
        (F.count(F.lit(1)) * 20).alias("impressions"),
        F.sum(F.expr("CASE WHEN event_type = 'click' THEN 4 ELSE 1 END")).alias("clicks"),
        F.count_if(F.col("event_type") == "signup").alias("leads"),
        F.count_if(F.col("event_type") == "purchase").alias("conversions"),
        F.sum("spend").alias("marketing_spend"),
    )
    channel = "CASE channel_id " + " ".join(f"WHEN {i} THEN '{name}'" for i, name, _ in CHANNELS) + " END"
    campaign = f"concat({channel}, ' ', year(date), 'Q', quarter(date)) AS campaign_name"
    return days.withColumn("campaign_name", F.expr(campaign)).select(*COLUMNS["fact_marketing"])


def sales_lines(spark: SparkSession, folder: str, columns: frozenset[str], how: str) -> DataFrame:
    """Order lines with the joins that ``columns`` need and the product attributes met on the way.

    Every line stays, also one without an order or part: what comes from there is
    null then. Only with ``how="inner"`` do lines without the product go whose
    attributes are asked for. Orders come last, so that a grouping by order needs
    no new shuffle.
    """
    lines = _parquet(spark, folder, "lineitem").selectExpr(
        "l_orderkey AS order_id",
        "l_partkey AS product_id",
        "l_linenumber AS line_number",
        "CAST(1 + l_orderkey % 6 AS INT) AS channel_id",
        "CAST(l_quantity AS INT) AS quantity",
        "floor(l_extendedprice * 100 + 0.5D) div nullif(CAST(l_quantity AS INT), 0) AS unit_price",
        "floor(l_discount * 100 + 0.5D) AS discount_points",
        "l_returnflag",
    ).selectExpr(
        "*",
        "quantity * unit_price AS gross_list",
        "(quantity * unit_price * discount_points * 4) div 100 AS discount_amount",
        "CASE WHEN (order_id * 7 + line_number * 3) % 10 < 4 THEN 0L "
        "ELSE 300 + (order_id * 13 + line_number) % 600 END AS shipping_revenue",
        "200 + (order_id * 11 + line_number * 5) % 500 + 40 * (quantity - 1) AS shipping_cost",
        "CASE WHEN l_returnflag = 'R' AND (order_id + line_number) % 4 = 0 THEN 1 ELSE 0 END AS returned_flag",
    ).selectExpr(
        "*",
        "((gross_list - discount_amount + shipping_revenue) * 29) div 1000 + 30 AS payment_fee",
        "CASE WHEN returned_flag = 1 THEN gross_list - discount_amount ELSE 0L END AS refund_amount",
    )
    found = ["order_id", "product_id", "line_number", "channel_id", "quantity", "unit_price", "discount_amount",
             "shipping_revenue", "shipping_cost", "payment_fee", "returned_flag", "refund_amount"]
    if columns & PART_COLUMNS:
        part = _parquet(spark, folder, "part").selectExpr(*_product_columns(), f"{COST_RATE} AS cost_rate")
        attributes = columns & (PART_COLUMNS - {"product_cost"})
        lines = lines.join(part, "product_id", how if attributes else "left").withColumn(
            "product_cost", F.expr("(gross_list * cost_rate) div 100"))
        found += sorted(PART_COLUMNS)
    if columns & ORDER_COLUMNS:
        orders = _parquet(spark, folder, "orders").select(
            F.col("o_orderkey").alias("order_id"),
            F.col("o_orderdate").cast("date").alias("order_date"),
            F.col("o_custkey").alias("customer_id"),
        )
        lines = lines.join(orders, "order_id", "left")
        found += sorted(ORDER_COLUMNS)
    return lines.select(*found)


def _spoil_sales(lines: DataFrame) -> DataFrame:
    """Null discounts and shipping costs, then repeat some lines, in one pass over the lines."""
    copies = F.expr("CASE WHEN (order_id * 29 + line_number * 7) % 1000 = 17 THEN array(0, 1) ELSE array(0) END")
    return lines.withColumns({
        "discount_amount": F.expr("CASE WHEN (order_id * 31 + line_number) % 200 <> 11 THEN discount_amount END"),
        "shipping_cost": F.expr("CASE WHEN (order_id * 17 + line_number) % 200 <> 13 THEN shipping_cost END"),
    }).withColumn("copy", F.explode(copies)).drop("copy")
