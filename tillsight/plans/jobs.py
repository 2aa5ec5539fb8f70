"""Batch jobs: clean and gate raw CSV files, load tables, export segments, run the report queries."""

from __future__ import annotations

from collections.abc import Iterable
from dataclasses import dataclass

from pyspark.sql import DataFrame, Observation, SparkSession, functions as F

from tillsight.operators import cleaning, loading, quality, rfm
from tillsight.plans.registry import named_queries
from tillsight.sources.star import Star, read_star, typed, write_star
from tillsight.sources.versions import publish

# Report file names and the query behind each.
REPORTS = {
    "01_revenue_analysis__monthly_revenue": "monthly_revenue",
    "02_profitability_analysis__margin_by_category": "margin_by_category",
    "02_profitability_analysis__high_volume_low_margin": "high_volume_low_margin",
    "02_profitability_analysis__low_volume_high_margin": "low_volume_high_margin",
    "02_profitability_analysis__top10_margin_contribution": "top10_margin_contribution",
    "02_profitability_analysis__returns_by_category": "returns_by_category",
    "03_channel_performance__channel_performance": "channel_performance",
    "03_channel_performance__campaign_performance": "campaign_performance",
    "04_customer_rfm__rfm_scores": "rfm_scores_ntile",
    "04_customer_rfm__rfm_segment_summary": "rfm_segment_summary",
    "04_customer_rfm__customers_at_risk": "customers_at_risk",
    "05_data_quality__quality_checks": "quality_checks",
    "05_data_quality__table_totals": "table_totals",
}


@dataclass(frozen=True)
class CleanResult:
    """What a cleaning run wrote and found."""

    star: Star
    rows_written: dict[str, int]
    before: DataFrame
    after: DataFrame
    log: DataFrame
    reconciliation: DataFrame


def write_counted(rows: DataFrame, path: str, fmt: str = "parquet") -> int:
    """Overwrite ``path`` and return the number of rows, counted while writing."""
    seen = Observation()
    counted = rows.observe(seen, F.count(F.lit(1)).alias("rows"))
    counted.write.mode("overwrite").options(header=True).format(fmt).save(path)
    return seen.get["rows"]


def run_named_queries(spark: SparkSession, tables: str, out: str, reports: Iterable[str] = REPORTS,
                      fmt: str = "parquet") -> list[tuple[str, int]]:
    """Run report queries over the tables in a folder; (report, rows) for each one written."""
    queries = named_queries()
    return [(name, write_counted(queries[REPORTS[name]](spark, tables), f"{out}/{name}", fmt)) for name in reports]


def clean_raw_files(spark: SparkSession, raw_folder: str, out: str, period: quality.Period = None,
                    fmt: str = "parquet", **options) -> CleanResult:
    """Validate six raw CSV files, clean them, validate what was written and publish it.

    The clean tables are computed once, into a staging folder. While a critical
    rule fails there, nothing under ``out`` is touched; then all six are published
    together as the current version of ``out``. ``options`` go to the CSV reader.
    """
    text = read_star(spark, raw_folder, raw=True, **options)
    raw = text.with_tables(**{n: (lambda n=n: typed(text.table(n), n)) for n in text.tables()})
    before = quality.validate_all(text, period)
    staged = loading.load_star(cleaning.clean_star(raw))
    after = quality.require_unblocked(staged, period)
    _, written = publish(spark, out, lambda path: write_star(staged, path, fmt))
    return CleanResult(staged, written, before, after, cleaning.cleaning_log(raw), cleaning.reconcile_revenue(raw, staged))


def load_and_verify(star: Star, folder: str) -> tuple[Star, DataFrame]:
    """Load the tables into a new version of ``folder`` and compare them with their source."""
    loaded = loading.load_star(star, folder)
    return loaded, quality.load_verification(star, loaded)


def export_segments(star: Star, path: str, fmt: str = "parquet") -> int:
    """Write one row per customer with scores, segment and attributes."""
    return write_counted(rfm.rfm_all_customers(star), path, fmt)
