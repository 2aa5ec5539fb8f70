"""Indicators on two hand-computed lines, and edge cases of months, channels and discounts."""

from __future__ import annotations

import pytest
from pyspark.sql import functions as F

from stars import CHANNELS, by, line, star, two_lines
from tillsight.functions.money import money_per, pct2, ratio2
from tillsight.operators import marketing, sales


def test_line_formulas(spark):
    rows = by(sales.line_economics(two_lines(spark)).collect(), "order_id")
    assert (rows["O1"].revenue, rows["O1"].gross_profit) == (22.0, 13.5)
    assert (rows["O2"].revenue, rows["O2"].gross_profit) == (100.0, -88.0)


def test_enriched_lines_keep_orphans(spark):
    lines = star(spark, fact_sales=[line("O1", "2024-01-15", "C9", "P9", 9)], dim_channel=CHANNELS)
    row = sales.sales_enriched(lines).first()
    assert row.category is None and row.region is None and row.channel_name is None
    assert row.year_month == "2024-01" and row.list_amount == 10.0


def test_months(spark):
    january, february = sales.monthly_margin_py(two_lines(spark)).collect()
    assert january.gross_margin_pct == pytest.approx(100 * 13.5 / 22)
    assert january.revenue_mom_pct is None
    assert february.gross_margin_pct == pytest.approx(-88.0)
    assert february.revenue_mom_pct == pytest.approx(354.5454545)
    rounded = sales.monthly_revenue(two_lines(spark)).collect()
    assert [r.revenue_mom_pct for r in rounded] == [None, 354.55]
    assert [r.avg_order_value for r in rounded] == [22.0, 100.0]


def test_gap_month_counts_for_calendar_growth_only(spark):
    lines = star(spark, fact_sales=[line("O1", "2024-01-15", "C", "P", 1), line("O2", "2024-03-15", "C", "P", 1, 2)])
    present = sales.monthly_revenue(lines).collect()
    assert present[1].revenue_mom_pct == 100.0
    calendar = sales.mom_growth_calendar(lines).collect()
    assert calendar[1].revenue_pm is None and calendar[1].revenue_growth is None


def test_growth_from_zero_is_null_and_from_a_loss_keeps_its_sign(spark):
    lines = star(spark, fact_sales=[
        line("O1", "2024-01-15", "C", "P", 1, 1, 0, cost=10), line("O2", "2024-02-15", "C", "P", 1, 1, 10)])
    second = sales.monthly_revenue(lines).collect()[1]
    assert second.revenue_mom_pct is None
    assert second.gross_profit_mom_pct == -200.0  # (10 - -10) / -10


def test_partitions_add_up(spark):
    table = two_lines(spark)
    total = sales.line_economics(table).agg(F.sum("revenue"), F.sum("gross_profit")).first()
    for rows in (sales.margin_by_category(table), sales.product_profitability(table), sales.monthly_revenue(table)):
        assert tuple(rows.agg(F.sum("revenue"), F.sum("gross_profit")).first()) == tuple(total)


def test_channels(spark):
    rows = by(marketing.channel_performance_py(two_lines(spark)).collect(), "channel_name")
    paid, organic = rows["Paid Search"], rows["Organic Search"]
    assert (paid.cac, paid.roas, paid.net_marketing_contribution) == (25.0, 2.0, -138.0)
    assert organic.cac is None and organic.roas is None
    assert organic.net_marketing_contribution == organic.gross_profit


def test_channel_with_spend_but_no_sales_and_the_reverse(spark):
    table = star(
        spark, dim_channel=CHANNELS, dim_date=[dict(date="2024-01-01")],
        dim_customer=[dict(customer_id="C1", acquisition_date="2024-01-02", acquisition_channel="Organic Search")],
        fact_sales=[line("O1", "2024-01-15", "C1", "P", 1)],
        fact_marketing=[dict(date="2024-01-02", channel_id=2, campaign_name="x", marketing_spend=5, conversions=0,
                             impressions=0, clicks=0, leads=0)])
    sql, unrounded = (by(f(table).collect(), "channel_name")
                      for f in (marketing.channel_performance, marketing.channel_performance_py))
    assert sql["Organic Search"].cac is None and unrounded["Organic Search"].cac == 0.0
    assert sql["Paid Search"].net_marketing_contribution == -5.0
    assert unrounded["Paid Search"].net_marketing_contribution is None
    assert unrounded["Paid Search"].revenue is None and sql["Paid Search"].revenue == 0.0
    campaign = marketing.campaign_performance(table).first()
    assert campaign.ctr_pct is None and campaign.cvr_pct is None and campaign.cost_per_conversion is None


def test_returns(spark):
    rows = by(sales.returns_by_category_line(two_lines(spark)).collect(), "category")
    assert rows["Electronics"].return_rate_pct == 100.0
    assert rows["Home & Kitchen"].return_rate_pct == 0.0


def test_order_return_rate_counts_orders_once(spark):
    table = star(spark, dim_product=[dict(product_id="P", product_name="n", category="c")], fact_sales=[
        line("O1", "2024-01-15", "C", "P", 1, returned=1), line("O1", "2024-01-15", "C", "P", 1, returned=1),
        line("O2", "2024-01-15", "C", "P", 1)])
    row = sales.returns_by_category(table).first()
    assert (row.lines, row.returned_lines) == (3, 2)
    assert (row.return_rate_line_pct, row.return_rate_order_pct) == (66.67, 50.0)


@pytest.mark.parametrize("discount, level", [
    (0, "0%"), (0.01, "0%"), (0.02, "0-10%"), (10, "0-10%"), (10.01, "10-20%"), (20, "10-20%"), (30, "20-30%"),
    (30.01, ">30%"), (100, ">30%"), (100.01, None)])
def test_discount_level_edges(spark, discount, level):
    table = star(spark, fact_sales=[line("O1", "2024-01-15", "C", "P", 1, 1, 100, discount, ship_rev=50)])
    assert sales.line_discount_margin(table).first().discount_level == level


def test_tiny_discount_counts_as_none_in_levels_but_not_in_the_gap(spark):
    from tillsight.plans.findings import finding_discount_gap
    table = star(spark, fact_sales=[line("O1", "2024-01-15", "C", "P", 1, 1, 1000, 0.01, cost=499.99),
                                    line("O2", "2024-01-15", "C", "P", 1, 1, 1000, 0, cost=250)])
    assert sales.margin_by_discount_bucket(table).count() == 1
    gap = finding_discount_gap(table).first()
    assert gap.without_discount_pct == 75.0 and gap.with_discount_pct == pytest.approx(50.0005, abs=1e-4)


def test_margins_of_enormous_lines(spark):
    lines = [line("O1", "2024-01-15", "C", "P", 1, 1, 4e9, cost=1e9), line("O2", "2024-01-15", "C", "P", 1, 1, 4, cost=3)]
    assert sales.margin_by_discount_bucket(star(spark, fact_sales=lines)).first().margin_pct == 50.0


def test_exact_rounding(spark):
    row = spark.sql("SELECT 1L a, 800L b, -1L c, 0L z").select(
        pct2("a", "b").alias("up"), pct2("c", "b").alias("down"), pct2("a", "z").alias("none"),
        money_per("5L", "2L").alias("half"), ratio2("1L", "-8L").alias("negative")).first()
    assert tuple(row) == (0.13, -0.13, None, 0.03, -0.13)


def test_empty_star_gives_empty_or_zero_answers(spark):
    empty = star(spark, dim_channel=CHANNELS)
    assert sales.monthly_revenue(empty).count() == 0
    assert marketing.channel_performance(empty).count() == 2
    totals = sales.table_totals(empty).first()
    assert totals.fact_sales_rows == 0 and totals.distinct_orders == 0 and totals.total_revenue is None
