"""Every named query: (spark, folder with the given tables) -> DataFrame."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession

from tillsight.operators import cleaning, loading, marketing, measures, quality, rfm, sales
from tillsight.plans import findings, pages
from tillsight.sources.star import Star
from tillsight.sources.session import scratch_folder
from tillsight.sources.tables import open_raw_star, open_star
from tillsight.sources.versions import publish

Query = Callable[[SparkSession, str], DataFrame]

# Over the clean star.
CLEAN: dict[str, Callable[[Star], DataFrame]] = {
    "sales_enriched": sales.sales_enriched,
    "line_economics": sales.line_economics,
    "line_discount_margin": sales.line_discount_margin,
    "orphan_sales_rows": sales.orphan_sales_rows,
    "monthly_revenue": sales.monthly_revenue,
    "monthly_margin_py": sales.monthly_margin_py,
    "mom_growth_calendar": sales.mom_growth_calendar,
    "margin_by_category": sales.margin_by_category,
    "product_profitability": sales.product_profitability,
    "high_volume_low_margin": sales.high_volume_low_margin,
    "low_volume_high_margin": sales.low_volume_high_margin,
    "top10_margin_contribution": sales.top10_margin_contribution,
    "returns_by_category": sales.returns_by_category,
    "returns_by_category_line": sales.returns_by_category_line,
    "shipping_by_region": sales.shipping_by_region,
    "margin_by_discount_bucket": sales.margin_by_discount_bucket,
    "table_totals": sales.table_totals,
    "calendar_spine": lambda star: star.dim_date,
    "seed_channels": loading.seed_channels,
    "load_star_counts": loading.load_star_counts,
    "load_verification": lambda star: quality.load_verification(star, loading.load_star(star)),
    "quality_checks": quality.quality_checks,
    "measures_by_category": measures.measures_by_category,
    "measures_sliced": measures.measures_sliced,
    "measures_in_date_range": measures.measures_in_date_range,
    "measures_by_segment": measures.measures_by_segment,
    "growth_by_category": measures.growth_by_category,
    "page_overview_monthly": pages.overview_monthly,
    "page_overview_category": pages.overview_category,
    "page_product_table": pages.product_table,
    "page_product_table_sliced": pages.product_table_sliced,
    "page_product_top10": pages.product_top10,
    "page_ops_returns": pages.ops_returns,
    "page_ops_shipping": pages.ops_shipping,
    "page_ops_discount": pages.ops_discount,
    "page_ops_alerts": pages.ops_alerts,
    "finding_totals": findings.finding_totals,
    "finding_loss_categories": findings.finding_loss_categories,
    "finding_peak_and_drop": findings.finding_peak_and_drop,
    "finding_concentration": findings.finding_concentration,
    "finding_worst_return_category": findings.finding_worst_return_category,
    "finding_discount_gap": findings.finding_discount_gap,
    "finding_net_shipping": findings.finding_net_shipping,
    "channel_performance": marketing.channel_performance,
    "channel_performance_py": marketing.channel_performance_py,
    "campaign_performance": marketing.campaign_performance,
    "new_customers_by_channel": marketing.new_customers_by_channel,
    "spend_by_channel": marketing.spend_by_channel,
    "rfm_base": rfm.rfm_base,
    "rfm_quintile": rfm.rfm_quintile,
    "rfm_ntile": rfm.rfm_ntile,
    "rfm_scores_quintile": rfm.rfm_scores_quintile,
    "rfm_scores_ntile": rfm.rfm_scores_ntile,
    "rfm_all_customers": rfm.rfm_all_customers,
    "rfm_export": lambda star: _exported(star),
    "rfm_segment_summary": rfm.rfm_segment_summary,
    "segment_share": rfm.segment_share,
    "rfm_segment_summary_all": rfm.rfm_segment_summary_all,
    "rfm_distribution": rfm.rfm_distribution,
    "rfm_score_bounds": rfm.rfm_score_bounds,
    "customers_at_risk": rfm.customers_at_risk,
    "measures_overall": measures.measures_overall,
    "measures_by_month": measures.measures_by_month,
    "measures_by_channel": measures.measures_by_channel,
    "repeat_purchase_rate": measures.repeat_purchase_rate,
    "new_customers_by_month": measures.new_customers_by_month,
    "page_overview_kpis": pages.overview_kpis,
    "page_marketing_kpis": pages.marketing_kpis,
    "page_marketing_channel": pages.marketing_channel,
    "page_marketing_campaign": pages.marketing_campaign,
    "page_customer_kpis": pages.customer_kpis,
    "page_customer_segments": pages.customer_segments,
    "page_customer_scatter": pages.customer_scatter,
    "page_customer_at_risk": pages.customer_at_risk,
    "finding_channels": findings.finding_channels,
    "finding_segments": findings.finding_segments,
    "findings_report": findings.findings_report,
}


def _exported(star: Star) -> DataFrame:
    """The customer segments as written to a file and read back."""
    path, _ = publish(star.spark, f"{scratch_folder(star.spark)}/customer_rfm", rfm.rfm_all_customers(star).write.parquet)
    return star.spark.read.parquet(path)


def _kind(kind: str) -> Callable[[Star], DataFrame]:
    return lambda raw: quality.validate_kind(raw, kind)


# Over the raw star with its defects.
RAW: dict[str, Callable[[Star], DataFrame]] = {
    "constraint_violations": quality.constraint_violations,
    "check_duplicate_keys": _kind("duplicate_key"),
    "check_nulls": _kind("nulls"),
    "check_non_positive": _kind("non_positive"),
    "check_negative": _kind("negative"),
    "check_foreign_key": _kind("foreign_key"),
    "check_date_range": _kind("date_range"),
    "check_duplicate_rows": _kind("duplicate_rows"),
    "check_margin_sanity": _kind("margin_sanity"),
    "validate_all": quality.validate_all,
    "validation_summary": quality.validation_summary,
    "blocking_gate": quality.blocking_gate,
    "clean_normalize_text": cleaning.clean_normalize_text,
    "clean_fill_unknown": cleaning.clean_fill_unknown,
    "clean_dedup_sales": cleaning.clean_dedup_sales,
    "clean_fill_discount": cleaning.clean_fill_discount,
    "clean_fill_shipping_median": cleaning.clean_fill_shipping_median,
    "clean_star": cleaning.clean_lines,
    "reconcile_revenue": cleaning.reconcile_cleaning,
    "cleaning_log": cleaning.cleaning_log,
    "validation_before_after": lambda raw: cleaning.validation_before_after(raw, cleaning.clean_star(raw)),
    "source_null_report": cleaning.source_null_report,
}


def _on_clean(operator: Callable[[Star], DataFrame]) -> Query:
    return lambda spark, folder: operator(open_star(spark, folder))


def _on_raw(operator: Callable[[Star], DataFrame]) -> Query:
    return lambda spark, folder: operator(open_raw_star(spark, folder))


def named_queries() -> dict[str, Query]:
    return {
        **{name: _on_clean(op) for name, op in CLEAN.items()},
        **{name: _on_raw(op) for name, op in RAW.items()},
    }
