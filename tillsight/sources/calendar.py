"""Calendar dimension and period bounds."""

from __future__ import annotations

from datetime import date, timedelta

from pyspark.sql import Column, DataFrame, SparkSession, functions as F


def period_bounds(start: date | Column, n_months: int | Column) -> tuple[Column, Column]:
    """First and last day of ``n_months`` months from ``start``."""
    first = start if isinstance(start, Column) else F.lit(start)
    months = n_months if isinstance(n_months, Column) else F.lit(n_months)
    return first, F.date_sub(F.add_months(first, months), 1)


def period_days(start: date, n_months: int) -> tuple[date, date]:
    """:func:`period_bounds` of a constant period, for a start on the first of a month."""
    months = start.year * 12 + start.month - 1 + n_months
    return start, date(months // 12, months % 12 + 1, start.day) - timedelta(days=1)


def calendar_spine(bounds: DataFrame) -> DataFrame:
    """One row per day between ``first`` and ``last`` of the one-row ``bounds``."""
    return bounds.select(F.explode(F.sequence("first", "last")).alias("date")).select(
        F.date_format("date", "yyyyMMdd").cast("int").alias("date_key"),
        "date",
        F.year("date").alias("year"),
        F.quarter("date").alias("quarter"),
        F.month("date").alias("month"),
        F.date_format("date", "MMMM").alias("month_name"),
        F.weekofyear("date").alias("week"),
        F.date_format("date", "EEEE").alias("day_of_week"),
    )


def period_calendar(spark: SparkSession, start: date, n_months: int) -> DataFrame:
    first, last = period_bounds(start, n_months)
    return calendar_spine(spark.range(1).select(first.alias("first"), last.alias("last")))


def whole_months(dates: DataFrame, column: str) -> DataFrame:
    """One row: ``first`` and ``last`` day of the months that hold every value of a date column."""
    return dates.agg(
        F.trunc(F.min(column), "MM").alias("first"), F.last_day(F.max(column)).alias("last"))


def data_calendar(dates: DataFrame, column: str) -> DataFrame:
    """Whole months that cover every value of a date column."""
    return calendar_spine(whole_months(dates, column))
