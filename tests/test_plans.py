"""Plans: no single task or cross join over large tables, pruned scans, shared shuffles, hot keys split."""

from __future__ import annotations

import re

import pytest
from pyspark.sql import functions as F

from tillsight.operators import cleaning, marketing, measures, quality, rfm, sales
from tillsight.plans import findings, pages
from tillsight.plans.registry import named_queries
from tillsight.sources.session import shared
from tillsight.sources.star import Between
from tillsight.sources.tables import open_raw_star, open_star


def plan(rows) -> str:
    return rows._jdf.queryExecution().executedPlan().toString()


def final_plan(rows) -> str:
    """The plan AQE ended with, initial plans left out."""
    rows.collect()
    kept, depth = [], None
    for text in plan(rows).splitlines():
        indent = len(text) - len(text.lstrip(" :+-"))
        if depth is not None and indent > depth:
            continue
        depth = indent - 1 if "== Initial Plan ==" in text else None
        if depth is None:
            kept.append(text)
    return "\n".join(kept)


def line_scans(rows) -> int:
    return len(re.findall(r"FileScan parquet \[l_", final_plan(rows)))


LARGE = ("sales_enriched", "monthly_revenue", "margin_by_category", "high_volume_low_margin", "channel_performance",
         "measures_by_category", "quality_checks", "clean_star", "orphan_sales_rows", "page_ops_alerts")


@pytest.mark.parametrize("name", LARGE)
def test_no_cross_join(spark, folder, name):
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", "-1")
    try:
        text = plan(named_queries()[name](spark, folder))
    finally:
        spark.conf.unset("spark.sql.autoBroadcastJoinThreshold")
    assert "NestedLoop" not in text and "Cartesian" not in text
    assert "BroadcastExchange" not in text  # nothing is broadcast that Spark has not measured


@pytest.mark.parametrize("operator", [rfm.rfm_quintile, rfm.rfm_ntile, rfm.rfm_all_customers])
def test_scoring_sorts_no_customers(spark, folder, operator):
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", "-1")
    try:
        rows = operator(open_star(spark, folder))
        text = final_plan(rows)
    finally:
        spark.conf.unset("spark.sql.autoBroadcastJoinThreshold")
    assert "rangepartitioning" not in text and "WriteFiles" not in text and "RDDScan" not in text
    assert len(re.findall(r"FileScan parquet \[l_", text)) == 1  # the customers are shuffled once for all readers
    for window in re.findall(r"Window \[.*", text):
        assert "(metric#" in window  # only rows near an edge
    for block in re.findall(r"Exchange SinglePartition.*\n(.*)", text):
        assert "partial_" in block, block  # only partial aggregates meet in one task


WRITING = {"load_star_counts", "load_verification", "rfm_export"}  # what they answer about is a table they write


@pytest.mark.parametrize("name", [n for n in named_queries() if n not in WRITING])
def test_building_a_query_starts_no_job(spark, folder, name):
    context = spark.sparkContext
    context.setJobGroup(f"build {name}", name)
    try:
        rows = named_queries()[name](spark, folder)
        plan(rows)
        assert context.statusTracker().getJobIdsForGroup(f"build {name}") == []
    finally:
        context.setLocalProperty("spark.jobGroup.id", None)


def test_scans_read_only_needed_columns(spark, folder):
    text = plan(sales.returns_by_category_line(open_star(spark, folder)))
    read = " ".join(re.findall(r"ReadSchema: struct<(.*)", text))
    for column in ("l_shipdate", "l_tax", "l_suppkey", "o_orderdate"):
        assert column not in read
    assert "orders.parquet" not in text  # no column of the orders is asked for


def test_order_dates_are_never_cut_unless_asked(spark, folder):
    whole = open_star(spark, folder)
    assert "PushedFilters: [IsNotNull(o_orderdate)" not in plan(rfm._customers(whole))
    assert "o_orderdate" in plan(measures.measures(whole, [], ["orders"], {"date": Between("1996-01-01")}))


def test_each_answer_scans_the_lines_once(spark, folder):
    whole = open_star(spark, folder)
    assert line_scans(sales.high_volume_low_margin(whole)) == 1
    assert line_scans(sales.top10_margin_contribution(whole)) == 1
    assert line_scans(cleaning.clean_lines(open_raw_star(spark, folder))) == 1
    assert line_scans(marketing.channel_performance(whole)) == 1
    assert line_scans(measures.measures_by_channel(whole)) == 1
    assert line_scans(cleaning.reconcile_cleaning(open_raw_star(spark, folder))) == 1


def test_checks_scan_the_lines_once(spark, folder):
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", "-1")
    try:
        assert line_scans(quality.validate_all(open_raw_star(spark, folder))) == 1
        assert line_scans(quality.quality_checks(open_star(spark, folder))) == 1
        assert line_scans(quality.constraint_violations(open_raw_star(spark, folder))) == 1
    finally:
        spark.conf.unset("spark.sql.autoBroadcastJoinThreshold")


def test_scans_of_reports(spark, folder):
    """Lines once where one pass does, twice for all findings; the orders are joined once, beside the calendar made of them."""
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", "-1")
    try:
        whole = open_star(spark, folder)
        orphans = sales.orphan_sales_rows(whole)
        assert line_scans(orphans) == 1
        assert len(re.findall(r"FileScan parquet \[o_orderkey", final_plan(orphans))) == 1
        assert line_scans(findings.findings_report(whole)) == 2
        assert line_scans(pages.ops_alerts(whole)) == 1
    finally:
        spark.conf.unset("spark.sql.autoBroadcastJoinThreshold")


@pytest.mark.parametrize("joined", [False, True])
def test_shared_rows_are_shuffled_once_for_unlike_readers(spark, joined):
    """Readers that take other columns, filter, join and group: one scan, equal rows."""
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", "-1")
    try:
        base = spark.range(1000).selectExpr("id % 50 AS k", "id AS a", "id * 2 AS b").withColumn("c", F.rand(3))
        rows = shared(base, "k", joined)
        top = rows.groupBy("k").agg(F.max("a").alias("a"))
        if joined:
            top = top.join(spark.range(40).withColumnRenamed("id", "k"), "k")
        both = top.select("a").unionAll(rows.filter("b > 100").agg(F.sum("b")))
        assert final_plan(both).count("Range (0, 1000") == 1
        plain = base.groupBy("k").agg(F.max("a").alias("a")).filter("k < 40" if joined else "true").select("a").unionAll(base.filter("b > 100").agg(F.sum("b")))
        assert sorted(both.collect()) == sorted(plain.collect())
        assert rows.columns == (base.columns) and rows.exceptAll(base).count() == 0
    finally:
        spark.conf.unset("spark.sql.autoBroadcastJoinThreshold")


def test_validation_shuffles_digests_and_keys(spark, folder):
    text = plan(quality.validate_all(open_raw_star(spark, folder)))
    grouped = [k for k in re.findall(r"Exchange hashpartitioning\((.*?), \d+\)", text) if "digest_1" in k]
    assert grouped and all(re.findall(r"(\w+)#", k) == ["digest_1", "digest_2", "customer_id", "product_id", "channel_id", "failed"] for k in grouped)
    assert not re.search(r"hashpartitioning\([^)]*refund_amount", text)


def test_category_answer_needs_no_shuffle_by_order_after_the_order_join(spark, folder):
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", "-1")
    try:
        text = plan(sales.monthly_totals(open_star(spark, folder)))
    finally:
        spark.conf.unset("spark.sql.autoBroadcastJoinThreshold")
    # Lines and parts by part, lines and orders by order, months: the grouping by order reuses its join.
    assert text.count("Exchange hashpartitioning") == 5


@pytest.fixture
def hot(spark, folder, tmp_path):
    """The given tables with one product and one order on a third of all lines each, and thresholds low
    enough to notice it."""
    low = {"spark.sql.autoBroadcastJoinThreshold": "-1", "spark.sql.adaptive.autoBroadcastJoinThreshold": "-1",
           "spark.sql.adaptive.skewJoin.skewedPartitionThresholdInBytes": "16KB",
           "spark.sql.adaptive.skewJoin.skewedPartitionFactor": "2",
           "spark.sql.adaptive.advisoryPartitionSizeInBytes": "8KB",
           "spark.sql.adaptive.coalescePartitions.enabled": "false"}
    for table in ("part", "orders", "customer", "nation", "region", "events"):
        spark.read.parquet(f"{folder}/{table}.parquet").write.parquet(f"{tmp_path}/{table}.parquet")
    lines = spark.read.parquet(f"{folder}/lineitem.parquet")
    spread = lines.withColumn("l_partkey", F.when(F.col("l_linenumber") % 3 == 0, F.lit(7).cast("bigint"))
                              .otherwise(F.col("l_partkey"))) \
        .withColumn("l_orderkey", F.when(F.col("l_linenumber") % 3 == 1, F.lit(11).cast("bigint"))
                    .otherwise(F.col("l_orderkey")))
    # Several map outputs, so that a hot partition can be cut between them.
    spread.repartition(16).write.parquet(f"{tmp_path}/lineitem.parquet")
    before = {k: spark.conf.get(k, None) for k in low}
    for key, value in low.items():
        spark.conf.set(key, value)
    yield str(tmp_path)
    for key, value in before.items():
        spark.conf.unset(key) if value is None else spark.conf.set(key, value)


def test_hot_product_is_split(spark, hot):
    whole = open_star(spark, hot)
    rows = sales.margin_by_category(whole)
    text = final_plan(rows)
    assert "skew=true" in text
    split = {r.category: r.gross_profit for r in rows.collect()}
    spark.conf.set("spark.sql.adaptive.skewJoin.enabled", "false")
    lines = sales.line_economics(whole).join(whole.dim_product, "product_id")
    plain = {r.category: r.p for r in lines.groupBy("category").agg(F.sum("gross_profit").alias("p")).collect()}
    spark.conf.set("spark.sql.adaptive.skewJoin.enabled", "true")
    assert split == pytest.approx(plain)


def test_hot_product_totals_are_split_too(spark, hot):
    # Grouping by the join key: only the forced split applies here.
    assert "skew=true" in final_plan(sales.product_profitability(open_star(spark, hot)))


def test_hot_order_is_split_before_orders_are_counted(spark, hot):
    # Grouping starts with the join key here as well.
    whole = open_star(spark, hot)
    months = sales.monthly_totals(whole)
    assert "skew=true" in final_plan(months)
    counted = whole.sales("month_start", "order_id").groupBy("month_start").agg(F.countDistinct("order_id").alias("n"))
    assert {r.month_start: r.orders for r in months.collect()} == {r.month_start: r.n for r in counted.collect()}


def test_measures_reduce_before_they_shuffle(spark, folder):
    text = plan(measures.measures_by_category(open_star(spark, folder)))
    for block in re.findall(r"Exchange hashpartitioning\(category.*\n(.*)", text):
        assert "partial_" in block or "HashAggregate" in block, block
