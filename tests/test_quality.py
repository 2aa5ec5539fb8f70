"""Single rules, the gate, database checks and cleaning."""

from __future__ import annotations

from datetime import date
from functools import reduce

import pytest
from pyspark.sql import DataFrame, functions as F

from stars import CHANNELS, by, line, star
from tillsight.operators import cleaning, loading, quality, sales
from tillsight.sources.star import Star
from tillsight.sources.tables import open_raw_star, open_star


def only(spark, table: str, rows: list[tuple], schema: str) -> Star:
    """Star with one table of any shape."""
    return Star(spark, {table: lambda: spark.createDataFrame(rows, schema)})


def run(table: Star, rule: quality.Rule):
    return quality.run_rules(table, [rule]).first()


def test_duplicate_keys(spark):
    table = only(spark, "dim_product", [(1,), (2,), (2,), (3,), (None,), (None,)], "id int")
    result = run(table, quality.check_duplicate_keys("id", "dim_product"))
    assert result.n_errors == 2 and result.blocking  # a null key is a key too
    assert run(only(spark, "dim_product", [(1,), (2,)], "id int"),
               quality.check_duplicate_keys("id", "dim_product")).passed


def test_nulls_as_warning_do_not_block(spark):
    table = only(spark, "dim_customer", [("A",), (None,), (None,)], "city string")
    result = run(table, quality.check_nulls("city", "dim_customer", "warning"))
    assert (result.n_errors, result.severity, result.blocking) == (2, "warning", False)
    assert result.message == "2 values of 'city' are missing."


def test_non_positive(spark):
    table = only(spark, "dim_product", [("1",), ("0",), ("-3",), ("5",), ("x",)], "quantity string")
    result = run(table, quality.check_non_positive("quantity", "dim_product"))
    assert result.n_errors == 2 and result.blocking


def test_negative(spark):
    table = only(spark, "dim_product", [(10.0,), (-1.0,), (0.0,), (None,)], "unit_price double")
    assert run(table, quality.check_negative("unit_price", "dim_product")).n_errors == 1


def test_foreign_key_ignores_null_children(spark):
    table = Star(spark, {
        "fact_marketing": lambda: spark.createDataFrame([("P1",), ("P2",), ("P9",), (None,)], "product_id string"),
        "dim_product": lambda: spark.createDataFrame([("P1",), ("P2",)], "product_id string")})
    result = run(table, quality.check_foreign_key("product_id", "dim_product", "product_id", "fact_marketing"))
    assert result.n_errors == 1 and result.blocking


def test_orphan_checks_count_null_children(spark):
    child = spark.createDataFrame([("P1",), ("P9",), (None,)], "k string")
    parent = spark.createDataFrame([("P1",)], "p string")
    assert quality.unmatched_rows(child, "k", parent, "p", with_nulls=True).first().n == 2
    assert quality.unmatched_rows(child, "k", parent, "p").first().n == 1


def test_date_range(spark):
    rows = [("2024-01-05",), ("2019-01-01",), ("bad-date",), (None,), ("2025-06-30",), ("2025-07-01",)]
    table = only(spark, "fact_marketing", rows, "date string")
    rule = quality.check_date_range("date", "fact_marketing", (date(2024, 1, 1), 18))
    result = run(table, rule)
    assert result.n_errors == 4
    assert result.message == "4 values of 'date' are no date from 2024-01-01 to 2025-06-30."


def test_duplicate_rows(spark):
    table = only(spark, "fact_marketing", [(1, 2), (1, 2), (1, None), (1, None)], "a int, b int")
    result = run(table, quality.check_duplicate_rows("fact_marketing"))
    assert (result.n_errors, result.severity) == (2, "warning")


def test_margin_above_revenue(spark):
    table = star(spark, fact_sales=[line("O1", "2024-01-01", "C", "P", 1, cost=-1, discount=None),
                                    line("O2", "2024-01-01", "C", "P", 1)])
    assert run(table, quality.check_margin_sanity("fact_sales")).n_errors == 1
    assert by(quality.quality_checks(table).collect(), "check_name")["margin_gt_100pct"].issues == 0


def dirty(spark) -> Star:
    """Three lines, one an exact copy, with nulls that can be repaired."""
    copied = line("O1", "2024-01-01", "C1", "P1", 1, 1, 10, None, 0, 6, None, 0.6)
    return star(
        spark, dim_date=[dict(date_key=1, date="2024-01-01"), dict(date_key=2, date="2024-02-01")],
        dim_product=[dict(product_id="P1", product_name="a", category="c", brand="B", subcategory="S"),
                     dict(product_id="P2", product_name="b", category="c", brand=None, subcategory="S")],
        dim_customer=[
            dict(customer_id="C1", city="X", region="R", customer_segment="New", acquisition_channel="Direct"),
            dict(customer_id="C2", city=None, region="R", customer_segment=" \tVIP ", acquisition_channel="Email")],
        dim_channel=CHANNELS,
        fact_sales=[copied, dict(copied), line("O2", "2024-02-01", "C2", "P2", 2, 2, 20, 5, 3, 12, 4, 1.2)],
        fact_marketing=[dict(channel_id=1, date="2024-01-01")])


def test_cleaning(spark):
    raw = dirty(spark)
    clean = cleaning.clean_star(raw)
    lines = by(clean.fact_sales.collect(), "order_id")
    assert clean.fact_sales.count() == 2
    assert lines["O1"].discount_amount == 0 and lines["O1"].shipping_cost == 400
    assert by(clean.dim_customer.collect(), "customer_id")["C2"].city == "Unknown"
    assert by(clean.dim_customer.collect(), "customer_id")["C2"].customer_segment == "VIP"
    assert by(clean.dim_product.collect(), "product_id")["P2"].brand == "Unknown"
    rules = [quality.check_nulls("customer_id", "fact_sales", "critical"),
             quality.check_non_positive("quantity", "fact_sales")]
    assert quality.run_rules(clean, rules).filter("blocking").count() == 0


def test_reconciliation_explains_the_difference(spark):
    raw = dirty(spark)
    row = cleaning.reconcile_revenue(raw, cleaning.clean_star(raw)).first()
    assert (row.raw_revenue, row.processed_revenue, row.difference) == (58.0, 48.0, 10.0)


def test_cleaning_log(spark):
    log = {(r.metric, r["item"]): r.value for r in cleaning.cleaning_log(dirty(spark)).collect()}
    assert log["rows_in", "fact_sales"] == 3 and log["rows_out", "fact_sales"] == 2
    assert log["duplicates_removed", "fact_sales"] == 1
    assert log["nulls_filled", "fact_sales.discount_amount"] == 1  # after copies are gone
    assert log["text_normalized", "dim_customer.customer_segment"] == 1
    assert log["corrected", "all"] == 1 + 4
    assert ("nulls_filled", "dim_customer.region") not in log


def test_median_of_an_even_count_rounds_half_a_cent_up(spark):
    lines = [line(f"O{i}", "2024-01-01", "C", "P", 1, ship_cost=c) for i, c in enumerate((4.12, 4.13, None))]
    filled = cleaning.clean_sales(star(spark, fact_sales=lines)).filter(F.col("order_id") == "O2").first()
    assert filled.shipping_cost == 413


def test_gate(spark, folder):
    with pytest.raises(quality.BlockedByValidation, match="date_range"):
        quality.require_unblocked(open_star(spark, folder), (date(2000, 1, 1), 18))
    assert quality.require_unblocked(open_star(spark, folder)).count() == 31
    raw = open_raw_star(spark, folder)
    summary = quality.validation_summary(raw).first()
    assert summary.rules == 31 and summary.passed + summary.failed == 31


def test_cleaned_tables_have_no_warnings_left(spark, folder):
    clean = cleaning.clean_star(open_raw_star(spark, folder))
    after = quality.validate_all(clean).collect()
    assert {r.rule for r in after if not r.passed} == set()


def test_load_round_trip(spark, folder, tmp_path):
    source = open_star(spark, folder)
    loaded = loading.load_star(source, str(tmp_path / "star"))
    again = loading.load_star(source, str(tmp_path / "star"))  # rebuilding changes nothing
    assert loading.table_counts(loaded).collect() == loading.table_counts(again).collect()
    assert quality.load_verification(source, loaded).filter("NOT passed").count() == 0


@pytest.fixture
def broken(spark, folder, tmp_path):
    """The given tables with one line without an order, one without a part and one of no quantity."""
    for name in ("part", "orders", "customer", "nation", "region", "events"):
        spark.read.parquet(f"{folder}/{name}.parquet").write.parquet(f"{tmp_path}/{name}.parquet")
    lines = spark.read.parquet(f"{folder}/lineitem.parquet")
    one = lines.orderBy("l_orderkey", "l_linenumber").limit(1)
    far = F.lit(10**9)
    extra = [one.withColumn("l_orderkey", far.cast(lines.schema["l_orderkey"].dataType)),
             one.withColumn("l_partkey", far.cast(lines.schema["l_partkey"].dataType)),
             one.withColumn("l_quantity", F.lit(0).cast(lines.schema["l_quantity"].dataType))]
    reduce(DataFrame.unionByName, [lines, *extra]).write.parquet(f"{tmp_path}/lineitem.parquet")
    return str(tmp_path), lines.count() + 3


def test_broken_lines_stay_and_are_reported(spark, broken):
    folder, n = broken
    source = open_star(spark, folder)
    assert source.fact_sales.count() == n
    assert sales.sales_enriched(source).count() == n
    assert sales.table_totals(source).first().fact_sales_rows == n
    counted = by(loading.load_star_counts(source).collect(), "table_name")
    assert counted["fact_sales"].row_count == n
    rules = {r.rule: r.n_errors for r in quality.validate_all(source).collect()}
    assert rules["nulls[order_date]"] == rules["nulls[customer_id]"] == rules["foreign_key[product_id->product_id]"] == 1
    assert rules["non_positive[quantity]"] == rules["nulls[unit_price]"] == 1
    checks = {r.check_name: r.issues for r in quality.quality_checks(source).collect()}
    assert checks["orphan_sales_customer"] == checks["orphan_sales_product"] == checks["orphan_sales_date"] == checks["quantity_le_zero"] == 1
    found = {(r.table_name, r.constraint_name): r.violations for r in quality.constraint_violations(source).collect()}
    assert found["fact_sales", "not_null[order_date]"] == found["fact_sales", "check[quantity > 0]"] == 1
    assert found["fact_sales", "foreign_key[product_id -> dim_product.product_id]"] == 1
    assert sorted(r.missing for r in sales.orphan_sales_rows(source).collect()) == ["customer", "date", "product"]


def test_seed_keeps_existing_rows(spark):
    existing = spark.createDataFrame([(1, "Mine", "X")], "channel_id int, channel_name string, channel_type string")
    seed = spark.createDataFrame([(1, "Theirs", "Y"), (2, "New", "Z")], existing.schema)
    once = loading.seed_rows(existing, seed, "channel_id")
    assert {tuple(r) for r in once.collect()} == {(1, "Mine", "X"), (2, "New", "Z")}
    assert loading.seed_rows(once, seed, "channel_id").count() == 2


def test_digests_tell_rows_apart_that_differ_in_where_a_null_is(spark):
    rows = spark.createDataFrame([(1, None, "a"), (None, 1, "a"), (1, 1, None), (1, None, "a"), (None, None, None)], "a bigint, b bigint, c string")
    found = quality.grouped_rows(rows.select(*quality.row_digests(rows, rows.columns)), "digest_1", "digest_2").collect()
    assert sorted(r.copies for r in found) == [1, 1, 1, 2] and len({r.digest_1 for r in found} | {r.digest_2 for r in found}) == 8
