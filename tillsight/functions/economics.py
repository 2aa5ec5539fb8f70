"""Line-level formulas on ``fact_sales`` columns, all in cents."""

from __future__ import annotations

from pyspark.sql import Column, functions as F

REVENUE = "quantity * unit_price - discount_amount + shipping_revenue"
COSTS = "product_cost + shipping_cost + payment_fee + refund_amount"

# Discount levels with the inclusive upper edge of their rate in ten-thousandths.
# A rate of -0.1 % or less, or above 100 %, belongs to no level.
DISCOUNT_LEVELS = (("0%", 1), ("0-10%", 1_000), ("10-20%", 2_000), ("20-30%", 3_000), (">30%", 10_000))

# Compared in integers, so that exactly 20 % is "10-20%".
DISCOUNT_LEVEL = (
    "CASE WHEN discount_amount * 1000 <= -(quantity * unit_price) THEN NULL "
    + " ".join(
        f"WHEN discount_amount * 10000 <= quantity * unit_price * {edge} THEN '{label}'"
        for label, edge in DISCOUNT_LEVELS
    )
    + " END"
)

_REVENUE_INPUTS = ("quantity", "unit_price", "discount_amount", "shipping_revenue")
_COST_INPUTS = ("product_cost", "shipping_cost", "payment_fee", "refund_amount")

# Derived sales columns: name -> (columns it reads, expression).
DERIVED: dict[str, tuple[tuple[str, ...], str]] = {
    "list_amount": (("quantity", "unit_price"), "quantity * unit_price"),
    "revenue": (_REVENUE_INPUTS, REVENUE),
    "gross_profit": (_REVENUE_INPUTS + _COST_INPUTS, f"{REVENUE} - ({COSTS})"),
    "monetary": (_REVENUE_INPUTS + ("refund_amount",), f"{REVENUE} - refund_amount"),
    "month_start": (("order_date",), "trunc(order_date, 'MM')"),
    "year_month": (("order_date",), "date_format(order_date, 'yyyy-MM')"),
    "year": (("order_date",), "year(order_date)"),
    "quarter": (("order_date",), "quarter(order_date)"),
    "month": (("order_date",), "month(order_date)"),
    "date": (("order_date",), "order_date"),
    "discount_level": (("quantity", "unit_price", "discount_amount"), DISCOUNT_LEVEL),
}


def year_month(month_start: Column | str) -> Column:
    """Label of a month given its first day; cheaper after grouping than on every line."""
    return F.date_format(month_start, "yyyy-MM")
