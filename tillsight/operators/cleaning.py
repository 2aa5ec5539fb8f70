"""Conservative cleaning: strip text, drop exact copies of lines, fill recoverable nulls."""

from __future__ import annotations

from functools import partial, reduce

from pyspark.sql import Column, DataFrame, functions as F

from tillsight.functions.money import money, wide_sum
from tillsight.functions.ranking import exact_median
from tillsight.operators.quality import run_rules, standard_rules, summarize
from tillsight.sources.star import TABLES, Star

# The columns to clean and the text for what is unknown.
TEXT_COLUMNS = {
    "dim_customer": ("customer_segment", "city", "region", "acquisition_channel"),
    "dim_product": ("product_name", "category", "subcategory", "brand", "supplier"),
    "dim_channel": ("channel_name", "channel_type"),
}
UNKNOWN_COLUMNS = {"dim_customer": ("city", "region"), "dim_product": ("brand", "subcategory")}
UNKNOWN = "Unknown"


def strip(column: str) -> Column:
    """Text without surrounding Unicode white space; ``trim`` would keep tabs."""
    return F.regexp_replace(column, r"(?U)^\s+|\s+$", "")


def strip_columns(rows: DataFrame, table: str) -> DataFrame:
    columns = [c for c in TEXT_COLUMNS.get(table, ()) if c in rows.columns]
    return rows.withColumns({c: strip(c) for c in columns}) if columns else rows


def fill_unknown(rows: DataFrame, table: str) -> DataFrame:
    columns = [c for c in UNKNOWN_COLUMNS.get(table, ()) if c in rows.columns]
    return rows.fillna(UNKNOWN, subset=columns) if columns else rows


def clean_dimension(raw: Star, table: str) -> DataFrame:
    return fill_unknown(strip_columns(raw.table(table), table), table)


def dedup_sales(raw: Star) -> DataFrame:
    """Sales without exact copies. Copies are equal in every column, so it does not matter which one stays."""
    return raw.fact_sales.dropDuplicates()


def median_shipping(lines: DataFrame) -> Column:
    """Median of the shipping costs present, to the cent."""
    return exact_median(lines, "shipping_cost")


def clean_sales(raw: Star) -> DataFrame:
    """Deduplicated sales with missing discounts at 0 and missing shipping costs at the median."""
    lines = dedup_sales(raw)
    return lines.withColumns({
        "discount_amount": F.coalesce("discount_amount", F.lit(0)),
        "shipping_cost": F.coalesce("shipping_cost", median_shipping(lines)),
    })


def clean_star(raw: Star) -> Star:
    """All cleaning rules over the six tables."""
    return raw.with_tables(
        fact_sales=lambda: clean_sales(raw), **{t: partial(clean_dimension, raw, t) for t in TEXT_COLUMNS})


# --- what cleaning did ----------------------------------------------------------------------------

def _counted(rows: DataFrame, tests: dict[str, Column]) -> DataFrame:
    counts = rows.agg(*[F.count_if(t).alias(n) for n, t in tests.items()])
    pairs = F.array(*[F.struct(F.lit(n).alias("column_name"), F.col(n).alias("n")) for n in tests])
    return counts.select(F.explode(pairs).alias("p")).select("p.column_name", "p.n")


def text_changes(raw: Star) -> DataFrame:
    """How many values stripping changes, per column that has any."""
    parts = []
    for table, columns in TEXT_COLUMNS.items():
        rows = raw.table(table)
        counted = _counted(rows, {c: strip(c) != F.col(c) for c in columns if c in rows.columns})
        parts.append(counted.select(F.concat(F.lit(f"{table}."), "column_name").alias("column_name"), "n"))
    return reduce(DataFrame.unionByName, parts).filter("n > 0")


def clean_normalize_text(raw: Star) -> DataFrame:
    return text_changes(raw).select("column_name", F.col("n").alias("normalized"))


def clean_fill_unknown(raw: Star) -> DataFrame:
    """Descriptive columns after filling, one row per table row and column."""
    parts = []
    for table, key in (("dim_customer", "customer_id"), ("dim_product", "product_id")):
        rows = fill_unknown(raw.table(table), table)
        values = rows.select(F.col(key).alias("id"), *UNKNOWN_COLUMNS[table]).unpivot(
            "id", list(UNKNOWN_COLUMNS[table]), "column_name", "value")
        parts.append(values.select(F.lit(table).alias("table_name"), "id", "column_name", "value"))
    return reduce(DataFrame.unionByName, parts)


def clean_dedup_sales(raw: Star) -> DataFrame:
    return dedup_sales(raw)


def clean_fill_discount(raw: Star) -> DataFrame:
    """Deduplicated lines with missing discounts at 0."""
    return dedup_sales(raw).select(
        "order_id", "product_id", "quantity", F.coalesce("discount_amount", F.lit(0)).alias("discount_amount"))


def clean_fill_shipping_median(raw: Star) -> DataFrame:
    """Deduplicated lines with missing shipping costs at the median."""
    return clean_sales(raw).select("order_id", "product_id", "quantity", "shipping_cost")


def clean_lines(raw: Star) -> DataFrame:
    """The cleaned star seen from its lines: repaired amounts and descriptions."""
    return clean_star(raw).sales(
        "order_id", "product_id", "customer_id", "quantity", "discount_amount", "shipping_cost",
        "brand", "subcategory", "city", "region", "customer_segment", how="left")


def reconcile_revenue(raw: Star, clean: Star) -> DataFrame:
    """Revenue before and after cleaning, a missing discount counting as 0."""
    def revenue(lines: DataFrame) -> DataFrame:
        per_channel = lines.groupBy("channel_id").agg(F.sum(
            F.col("quantity") * F.col("unit_price") - F.coalesce("discount_amount", F.lit(0))
            + F.col("shipping_revenue")).alias("revenue"))
        return per_channel.agg(wide_sum("revenue").alias("revenue"))

    columns = ("channel_id", "quantity", "unit_price", "discount_amount", "shipping_revenue")
    before = revenue(raw.sales(*columns)).scalar()
    return revenue(clean.sales(*columns)).withColumn("before", before).select(
        money("before").alias("raw_revenue"), money("revenue").alias("processed_revenue"),
        money("before - revenue").alias("difference"))


def reconcile_cleaning(raw: Star) -> DataFrame:
    """:func:`reconcile_revenue` of a star with its cleaned self, from one pass over the grouped lines.

    Cleaning changes revenue only by dropping copies: a missing discount counts
    as 0 on both sides.
    """
    columns = raw.fact_sales.columns
    lines = raw.fact_sales.groupBy(*columns).agg(F.count(F.lit(1)).alias("copies"))
    revenue = (F.col("quantity") * F.col("unit_price") - F.coalesce("discount_amount", F.lit(0))
               + F.col("shipping_revenue")).cast("decimal(38,0)")
    return lines.agg(F.sum(revenue * F.col("copies")).alias("before"), F.sum(revenue).alias("revenue")).select(
        money("before").alias("raw_revenue"), money("revenue").alias("processed_revenue"),
        money("before - revenue").alias("difference"))


def cleaning_log(raw: Star) -> DataFrame:
    """Rows in and out, copies removed, nulls filled and text stripped, as (metric, item, value).

    One aggregate per table gives all of its entries. Entries that count as a
    correction also feed the total.
    """
    lines = raw.fact_sales.groupBy(*raw.fact_sales.columns).agg(F.count(F.lit(1)).alias("copies"))
    parts = []
    for table in TABLES:
        sales = table == "fact_sales"
        rows = lines if sales else raw.table(table)
        rows_in = F.sum("copies") if sales else F.count(F.lit(1))
        fills = ("discount_amount", "shipping_cost") if sales else UNKNOWN_COLUMNS.get(table, ())
        texts = [c for c in TEXT_COLUMNS.get(table, ()) if c in rows.columns]
        counts = rows.agg(
            F.coalesce(rows_in, F.lit(0)).alias("rows_in"), F.count(F.lit(1)).alias("rows_out"),
            *[F.count_if(F.col(c).isNull()).alias(f"filled_{c}") for c in fills],
            *[F.count_if(strip(c) != F.col(c)).alias(f"stripped_{c}") for c in texts])
        entries = [_entry("rows_in", table, "rows_in"), _entry("rows_out", table, "rows_out"),
                   _entry("delta", table, "rows_out - rows_in")]
        if sales:
            entries += [_entry(m, i, "rows_in - rows_out") for m, i in (("duplicates_removed", table), TOTAL)]
        for c in fills:
            entries += [_entry(m, i, f"nullif(filled_{c}, 0)") for m, i in (("nulls_filled", f"{table}.{c}"), TOTAL)]
        entries += [_entry("text_normalized", f"{table}.{c}", f"nullif(stripped_{c}, 0)") for c in texts]
        parts.append(counts.select(F.explode(F.array(*entries)).alias("e")).select("e.*"))
    return reduce(DataFrame.unionByName, parts).filter("value IS NOT NULL") \
        .groupBy("metric", "item").agg(F.sum("value").alias("value"))


TOTAL = ("corrected", "all")


def _entry(metric: str, item: str, value: str) -> Column:
    return F.struct(F.lit(metric).alias("metric"), F.lit(item).alias("item"), F.expr(value).alias("value"))


def validation_before_after(raw: Star, clean: Star) -> DataFrame:
    """The validation summary of the raw and the cleaned star side by side."""
    def summary(star: Star, label: str) -> DataFrame:
        counts = summarize(run_rules(star, standard_rules()))
        return counts.unpivot([], counts.columns, "metric", label)

    return summary(raw, "before").join(summary(clean, "after"), "metric")


def source_null_report(raw: Star) -> DataFrame:
    """Columns with nulls before cleaning, their number and severity."""
    rules = [r for r in standard_rules() if r.kind == "nulls"]
    names = F.element_at(F.array(*[F.lit(f"{r.table}.{r.column}") for r in rules]), F.col("position") + 1)
    return run_rules(raw, rules).filter("n_errors > 0").select(
        names.alias("column_name"), F.col("n_errors").alias("nulls"), "severity")
