"""Exact money arithmetic.

Amounts are integer cents, so sums do not depend on the order in which tasks
finish. Ratios are rounded half away from zero with integer division and only
become doubles at the very end. Arguments are SQL expressions.
"""

from __future__ import annotations

from pyspark.sql import Column, functions as F

WIDE = "DECIMAL(38,0)"


def wide_sum(cents: str) -> Column:
    """Sum that may pass 9.2e18. Use it on pre-aggregated rows: decimals are slower than longs."""
    return F.expr(f"sum(CAST({cents} AS {WIDE}))")


def money(cents: str) -> Column:
    """Cents to currency units, for output columns."""
    return F.expr(f"CAST({cents} AS DOUBLE) / 100.0D")


def ratio(numerator: str, denominator: str, scale: float = 1.0) -> Column:
    """Unrounded ``scale * numerator / denominator``; null when the denominator is zero."""
    return F.expr(
        f"{scale}D * CAST({numerator} AS DOUBLE) / nullif(CAST({denominator} AS DOUBLE), 0.0D)")


def pct(numerator: str, denominator: str) -> Column:
    """Unrounded percentage."""
    return ratio(numerator, denominator, 100.0)


def rounded(numerator: str, denominator: str, factor: int, places: int) -> Column:
    """``factor / 10**places * numerator / denominator`` rounded exactly to ``places``."""
    above, below = f"CAST({numerator} AS {WIDE})", f"nullif(CAST({denominator} AS {WIDE}), 0)"
    units = f"({2 * factor} * abs({above}) + abs({below})) div (2 * abs({below}))"
    sign = f"CASE WHEN ({above} < 0) <> ({below} < 0) THEN -1L ELSE 1L END"
    return F.expr(f"CAST({sign} * ({units}) AS DOUBLE) / {float(10**places)}D")


def pct2(numerator: str, denominator: str) -> Column:
    """Percentage with two decimals."""
    return rounded(numerator, denominator, 10_000, 2)


def ratio2(numerator: str, denominator: str) -> Column:
    """Ratio of like quantities with two decimals."""
    return rounded(numerator, denominator, 100, 2)


def money_per(cents: str, count: str) -> Column:
    """Currency units per counted thing, with two decimals."""
    return rounded(cents, count, 1, 2)
