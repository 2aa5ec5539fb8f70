"""Scalar findings over the aggregates, and all of them as one long table."""

from __future__ import annotations

from functools import reduce

from pyspark.sql import Column, DataFrame, Window, functions as F

from tillsight.functions.money import money, pct, ratio, wide_sum
from tillsight.operators import marketing, rfm, sales
from tillsight.sources.star import Star

# The words of the report.
LOWER, HIGHER, LOSS, GAIN = "menor", "mayor", "pérdida", "ganancia"

NAMED_CATEGORY = "ECONOMY"  # the category the report singles out


def finding_totals(star: Star) -> DataFrame:
    """Revenue, profit, margin and orders overall."""
    return sales.order_totals(star, [], ["revenue", "gross_profit"]).select(
        money("revenue").alias("total_revenue"), money("gross_profit").alias("total_gross_profit"),
        pct("gross_profit", "revenue").alias("gross_margin_pct"), "orders")


def finding_loss_categories(star: Star, named: str = NAMED_CATEGORY) -> DataFrame:
    """Categories that lose money, the most profitable one and one named category."""
    everything = Window.partitionBy()  # one row per category
    categories = sales.category_sums(star)
    best = F.max_by("category", F.struct("gross_profit", "category")).over(everything)
    roles = F.array_compact(F.array(
        F.when(F.col("gross_profit") < 0, "loss"),
        F.when(F.col("category") == F.col("best"), "top"),
        F.when(F.col("category") == named, "named"),
    ))
    return categories.withColumn("best", best).withColumn("role", F.explode(roles)).select(
        "role", "category", money("revenue").alias("revenue"), money("gross_profit").alias("gross_profit"),
        pct("gross_profit", "revenue").alias("gross_margin_pct"))


def finding_peak_and_drop(star: Star) -> DataFrame:
    """The month with most revenue and the month with the steepest fall; the earliest on ties."""
    months = sales.monthly_margin_py(star)
    age = -F.unix_date(F.to_date(F.concat("year_month", F.lit("-01"))))
    fall = F.when(F.col("revenue_mom_pct").isNotNull(), F.struct(-F.col("revenue_mom_pct"), age))
    return months.agg(
        F.max_by(F.struct("year_month", "revenue", "gross_margin_pct"), F.struct("revenue", age)).alias("peak"),
        F.max_by(F.struct("year_month", "revenue_mom_pct"), fall).alias("drop"),
    ).select(
        F.col("peak.year_month").alias("peak_month"), F.col("peak.revenue").alias("peak_revenue"),
        F.col("peak.gross_margin_pct").alias("peak_margin_pct"),
        F.col("drop.year_month").alias("drop_month"), F.col("drop.revenue_mom_pct").alias("drop_mom_pct"))


def finding_concentration(star: Star) -> DataFrame:
    """Share of the ten best products and of the best one in total profit."""
    return sales.top_products(star).agg(
        F.sum("gross_profit").alias("top10"), F.max("gross_profit").alias("top1"), F.max("total").alias("total"),
        F.max_by("product_name", F.struct("gross_profit", -F.col("product_id"))).alias("top_product"),
    ).select(pct("top10", "total").alias("top10_share_pct"), "top_product", pct("top1", "total").alias("top1_share_pct"))


def finding_channels(star: Star) -> DataFrame:
    """The paid channel with the lowest net contribution, Email, and the profit of channels without spend."""
    channels = marketing.channel_facts(star).withColumns({
        "spend": F.coalesce("spend", F.lit(0)), "new_customers": F.coalesce("new_customers", F.lit(0))})
    channels = channels.withColumn("net", F.col("gross_profit") - F.col("spend"))
    row = F.struct("channel_name", "net", "revenue", "spend", "new_customers")
    worst = F.min_by(row, F.when((F.col("channel_type") == "Paid") & F.col("net").isNotNull(),
                                 F.struct("net", "channel_id")))
    picked = channels.agg(
        worst.alias("worst"),
        F.max(F.when(F.col("channel_name") == "Email", row)).alias("email"),
        F.coalesce(F.sum(F.when(F.col("spend") == 0, F.col("gross_profit"))), F.lit(0)).alias("unpaid"))
    return picked.select(
        F.col("worst.channel_name").alias("worst_paid_channel"),
        money("worst.net").alias("worst_net_contribution"),
        F.when(F.col("worst.new_customers") > 0,
               ratio("worst.spend", "worst.new_customers * 100")).alias("worst_cac"),
        ratio("worst.revenue", "worst.spend").alias("worst_roas"),
        ratio("email.revenue", "email.spend").alias("email_roas"),
        money("email.net").alias("email_net_contribution"),
        money("unpaid").alias("zero_spend_gross_profit"))


def finding_worst_return_category(star: Star) -> DataFrame:
    """The category with the highest share of returned lines; the first by name on ties."""
    ranked = sales.returns_by_category_line(star).orderBy(F.desc("return_rate_pct"), "category").limit(1)
    return ranked.select("category", "return_rate_pct", "refund_pct_of_revenue")


def finding_discount_gap(star: Star) -> DataFrame:
    """Mean line margin with and without discount, and which is lower."""
    sides = ("with_discount", "without_discount")
    margins = sales.product_grain(star).agg(*[wide_sum(c).alias(c) for side in sides for c in (side, f"{side}_lines")])
    gap = F.col("without_discount_pct") - F.col("with_discount_pct")
    return margins.select(*[sales.mean_margin_pct(side, f"{side}_lines").alias(f"{side}_pct") for side in sides]).select(
        "with_discount_pct", "without_discount_pct", gap.alias("gap_points"),
        F.when(gap > 0, LOWER).otherwise(HIGHER).alias("discounted_margin_is"))


def finding_net_shipping(star: Star) -> DataFrame:
    """Shipping revenue less shipping cost, and whether that is a loss."""
    return sales.product_grain(star).agg(wide_sum("net_shipping").alias("net")).select(
        money("net").alias("net_shipping"), F.when(F.col("net") < 0, LOSS).otherwise(GAIN).alias("outcome"))


def finding_segments(star: Star) -> DataFrame:
    """VIP customers, their share and value; customers at risk and their value, null when there are none."""
    totals = rfm.segment_totals(rfm.all_customers(star), "segment")

    def of(label: str, column: str) -> Column:
        return F.max(F.when(F.col("segment") == label, F.col(column)))

    return totals.agg(
        of(rfm.VIP, "customers").alias("vip"), F.sum("customers").alias("everyone"),
        of(rfm.VIP, "monetary").alias("vip_value"),
        of(rfm.AT_RISK, "customers").alias("at_risk"), of(rfm.AT_RISK, "monetary").alias("at_risk_value"),
    ).select(
        F.col("vip").alias("vip_customers"), pct("vip", "everyone").alias("vip_share_pct"),
        money("vip_value").alias("vip_monetary"), F.col("at_risk").alias("at_risk_customers"),
        money("at_risk_value").alias("at_risk_monetary"))


def findings_report(star: Star) -> DataFrame:
    """Every finding as (finding, metric, value, label), from two passes over the lines."""
    star = sales.rolled_up(star)
    found = {
        "totals": finding_totals(star),
        "loss_categories": finding_loss_categories(star).withColumn(
            "subject", F.concat_ws(":", "role", "category")).drop("role", "category"),
        "peak_and_drop": finding_peak_and_drop(star),
        "concentration": finding_concentration(star),
        "channels": finding_channels(star),
        "worst_return_category": finding_worst_return_category(star).withColumnRenamed("category", "subject"),
        "discount_gap": finding_discount_gap(star),
        "net_shipping": finding_net_shipping(star),
        "segments": finding_segments(star),
    }
    return reduce(DataFrame.unionByName, [_long(name, rows) for name, rows in found.items()])


def _long(name: str, rows: DataFrame) -> DataFrame:
    """Wide finding to (finding, subject, metric, value, label); numbers in ``value``, texts in ``label``."""
    texts = [f.name for f in rows.schema if f.dataType.typeName() == "string" and f.name != "subject"]
    numbers = [c for c in rows.columns if c not in texts and c != "subject"]
    cells = F.array(
        *[F.struct(F.lit(c).alias("metric"), F.col(c).cast("double").alias("value"),
                   F.lit(None).cast("string").alias("label")) for c in numbers],
        *[F.struct(F.lit(c).alias("metric"), F.lit(None).cast("double").alias("value"),
                   F.col(c).alias("label")) for c in texts])
    subject = F.col("subject") if "subject" in rows.columns else F.lit("")
    return rows.select(F.lit(name).alias("finding"), subject.alias("subject"), F.explode(cells).alias("c")).select(
        "finding", "subject", "c.metric", "c.value", "c.label")
