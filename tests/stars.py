"""Small stars from rows written out by hand, amounts in currency units."""

from __future__ import annotations

from datetime import date

from tillsight.sources.star import CENTS, COLUMNS, Star

CHANNELS = [dict(channel_id=1, channel_name="Organic Search", channel_type="Organic"),
            dict(channel_id=2, channel_name="Paid Search", channel_type="Paid")]


def frame(spark, table: str, rows: list[dict]):
    def value(column, raw):
        if raw is None:
            return None
        if column in CENTS:
            return round(raw * 100)
        if COLUMNS[table][column] == "date":
            return date.fromisoformat(raw)
        return raw

    schema = ", ".join(f"`{c}` {kind}" for c, kind in COLUMNS[table].items())
    data = [tuple(value(c, row.get(c)) for c in COLUMNS[table]) for row in rows]
    return spark.createDataFrame(data, schema)


def star(spark, **tables: list[dict]) -> Star:
    """Star with the given rows; tables not given are empty."""
    return Star(spark, {
        name: (lambda name=name: frame(spark, name, tables.get(name, []))) for name in COLUMNS})


def line(order, day, customer, product, channel, quantity=1, price=10.0, discount=0.0, ship_rev=0.0, cost=0.0,
         ship_cost=0.0, fee=0.0, returned=0, refund=0.0) -> dict:
    return dict(order_id=order, order_date=day, customer_id=customer, product_id=product, channel_id=channel,
                quantity=quantity, unit_price=price, discount_amount=discount, shipping_revenue=ship_rev,
                product_cost=cost, shipping_cost=ship_cost, payment_fee=fee, returned_flag=returned,
                refund_amount=refund)


def two_lines(spark) -> Star:
    """Two orders whose economics are known: profits of 13.5 and -88."""
    return star(
        spark,
        dim_date=[dict(date_key=20240101, date="2024-01-01"), dict(date_key=20240201, date="2024-02-01")],
        dim_product=[dict(product_id="P1", product_name="Widget", category="Home & Kitchen"),
                     dict(product_id="P2", product_name="Gadget", category="Electronics")],
        dim_customer=[
            dict(customer_id="C1", region="North", customer_segment="Regular", acquisition_date="2024-01-05",
                 acquisition_channel="Paid Search"),
            dict(customer_id="C2", region="South", customer_segment="VIP", acquisition_date="2024-02-01",
                 acquisition_channel="Paid Search")],
        dim_channel=CHANNELS,
        fact_sales=[
            line("O1", "2024-01-15", "C1", "P1", 1, 2, 10, 1, 3, 6, 2, 0.5),
            line("O2", "2024-02-10", "C2", "P2", 2, 1, 100, 0, 0, 80, 5, 3, 1, 100)],
        fact_marketing=[dict(date="2024-01-03", channel_id=2, campaign_name="Paid Search 2024Q1", impressions=0,
                             clicks=0, leads=0, conversions=10, marketing_spend=50)],
    )


def by(rows, key: str) -> dict:
    return {r[key]: r for r in rows}
