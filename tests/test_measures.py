"""Measures under dimensions and slicers."""

from __future__ import annotations

import pytest

from stars import by, line, star, two_lines
from tillsight.operators.measures import MEASURES, measures
from tillsight.plans import pages
from tillsight.operators import rfm
from tillsight.sources.star import Between
from tillsight.sources.tables import open_star


def test_overall(spark):
    row = measures(two_lines(spark)).first()
    assert list(row.asDict()) == list(MEASURES)
    assert (row.revenue, row.gross_profit, row.orders, row.units_sold) == (122.0, -74.5, 2, 3)
    assert row.average_order_value == 61.0 and row.return_rate == 0.5
    assert row.gross_margin == pytest.approx(-74.5 / 122)
    # Only C2 was acquired on a day of the two-day calendar.
    assert (row.new_customers, row.marketing_spend, row.cac) == (1, 50.0, 50.0)
    assert (row.customers_with_orders, row.repeat_purchase_rate, row.cost_per_conversion) == (2, 0.0, 5.0)
    assert row.average_discount == pytest.approx(1 / 120)


def test_marketing_is_not_counted_once_per_line(spark):
    rows = by(measures(two_lines(spark), ["channel_name"]).collect(), "channel_name")
    assert rows["Paid Search"].marketing_spend == 50.0 and rows["Paid Search"].roas == 2.0
    assert rows["Organic Search"].marketing_spend is None and rows["Organic Search"].roas is None
    assert rows["Organic Search"].net_marketing_contribution == 13.5


def test_marketing_by_product_is_null(spark):
    rows = measures(two_lines(spark), ["category"], ["revenue", "marketing_spend", "new_customers"]).collect()
    assert {r.marketing_spend for r in rows} == {None} and sum(r.revenue for r in rows) == 122.0


def test_slicers(spark):
    table = two_lines(spark)
    names = ["revenue", "orders", "marketing_spend"]
    paid = measures(table, [], names, {"channel_name": ["Paid Search"]}).first()
    assert (paid.revenue, paid.orders, paid.marketing_spend) == (100.0, 1, 50.0)
    january = measures(table, [], names, {"year_month": ["2024-01"], "category": ["Home & Kitchen"]}).first()
    assert (january.revenue, january.marketing_spend) == (22.0, None)
    assert measures(table, [], names, {"region": ["North"]}).first().revenue == 22.0


def test_repeat_customers_are_judged_within_the_group(spark):
    table = star(spark, fact_sales=[line("O1", "2024-01-15", "C1", "P", 1), line("O2", "2024-02-15", "C1", "P", 1),
                                    line("O2", "2024-02-15", "C1", "P", 1)])
    assert measures(table, [], ["repeat_purchase_rate"]).first()[0] == 1.0
    months = measures(table, ["year_month"], ["repeat_customers"]).collect()
    assert [r.repeat_customers for r in months] == [0, 0]


def test_months_add_up_to_the_whole(spark, folder):
    table = open_star(spark, folder)
    names = ["revenue", "gross_profit", "orders", "marketing_spend", "new_customers", "conversions"]
    whole = measures(table, [], names).first()
    months = measures(table, ["month_start"], names).collect()
    for name in names:
        assert sum(r[name] or 0 for r in months) == pytest.approx(whole[name])


def test_pages_agree_with_measures(spark, folder):
    table = open_star(spark, folder)
    shown = {r.category: r.gross_profit for r in pages.overview_category(table).collect()}
    counted = {r.category: r.gross_profit for r in measures(table, ["category"], ["gross_profit"]).collect()}
    assert shown == counted
    assert pages.product_top10(table).count() == 10


def test_time_slicers_and_ranges(spark):
    table = two_lines(spark)
    names = ["revenue", "marketing_spend"]
    assert tuple(measures(table, [], names, {"month": [1]}).first()) == (22.0, 50.0)
    assert tuple(measures(table, [], names, {"quarter": [2]}).first()) == (None, None)
    assert tuple(measures(table, [], names, {"date": Between("2024-01-10", "2024-02-10")}).first()) == (122.0, None)
    assert measures(table, [], ["revenue"], {"date": Between(None, "2024-02-09")}).first().revenue == 22.0


def test_segments_as_dimension_and_slicer(spark, folder):
    table = rfm.with_segments(open_star(spark, folder))
    parts = {r.segment: r.revenue for r in measures(table, ["segment"], ["revenue"]).collect()}
    assert sum(parts.values()) == pytest.approx(measures(table, [], ["revenue"]).first().revenue)
    assert measures(table, [], ["revenue"], {"segment": [rfm.VIP]}).first().revenue == pytest.approx(parts[rfm.VIP])
    with pytest.raises(ValueError, match="with_segments"):
        measures(two_lines(spark), ["segment"], ["revenue"])


def test_every_page_takes_slicers(spark, folder):
    table = open_star(spark, folder)
    category = {"category": ["PROMO"]}
    assert {r.category for r in pages.product_table(table, category).collect()} == {"PROMO"}
    assert {r.category for r in pages.product_top10(table, category).collect()} == {"PROMO"}
    assert {r.category for r in pages.ops_alerts(table, category).collect()} == {"PROMO"}
    assert {r.region for r in pages.ops_shipping(table, {"region": ["ASIA"]}).collect()} == {"ASIA"}
    assert {r.channel_name for r in pages.marketing_campaign(table, {"channel_name": ["Email"]}).collect()} == {"Email"}
    assert pages.overview_monthly(table, {"date": Between("1996-01-01", "1996-03-31")}).count() == 3
    assert {r.segment for r in pages.customer_scatter(table, {"segment": [rfm.VIP]}).collect()} == {rfm.VIP}
    assert pages.overview_kpis(table, category).first().revenue == pytest.approx(
        sum(r.revenue for r in pages.overview_monthly(table, category).collect()))
    with pytest.raises(ValueError):
        pages.customer_segments(table, {"brand": ["x"]})


def test_pages_agree_on_the_whole(spark, folder):
    table = open_star(spark, folder)
    assert pages.overview_kpis(table).first().revenue == pytest.approx(sum(r.revenue for r in pages.overview_monthly(table).collect()))
