"""Files in and out: CSV readers, cleaning job, report queries, segment export."""

from __future__ import annotations

from datetime import date
from pathlib import Path

import pytest
from pyspark.sql import functions as F

from stars import by, line, star, two_lines
from test_quality import dirty
from tillsight.operators import loading, quality
from tillsight.plans import jobs, registry as contract
from tillsight.sources import versions
from tillsight.sources.calendar import calendar_spine, period_bounds, period_calendar, period_days
from tillsight.sources.star import COLUMNS, NULL_TOKENS, TABLES, open_parquet_star, read_star, write_star
from tillsight.sources.tables import open_star

PERIOD = (date(2000, 1, 1), 18)


def test_csv_round_trip(spark, tmp_path):
    table = dirty(spark)
    write_star(table, str(tmp_path / "raw"), "csv")
    back = read_star(spark, str(tmp_path / "raw"))
    for name in COLUMNS:
        assert back.table(name).exceptAll(table.table(name)).count() == 0, name
        assert back.table(name).count() == table.table(name).count()


def test_null_tokens_and_bad_values(spark, tmp_path):
    folder = tmp_path / "raw"
    folder.mkdir()
    for name, columns in COLUMNS.items():
        (folder / f"{name}.csv").write_text(",".join(columns) + "\n")
    header = ",".join(COLUMNS["dim_channel"])
    rows = "\n".join(f"{i},{token},x" for i, token in enumerate(NULL_TOKENS))
    (folder / "dim_channel.csv").write_text(f'{header}\n{rows}\n3.0,"a ""b"", c",y\nbad,n,z\n')
    found = read_star(spark, str(folder)).dim_channel
    assert found.filter("channel_name IS NULL").count() == len(NULL_TOKENS)
    assert found.filter("channel_type = 'y'").first()[:2] == (3, 'a "b", c')
    assert found.filter("channel_type = 'z'").first().channel_id is None
    assert read_star(spark, str(folder), raw=True).dim_channel.filter("channel_id = 'bad'").count() == 1


def write_csv(folder, **texts: str) -> str:
    folder.mkdir()
    for name, columns in COLUMNS.items():
        (folder / f"{name}.csv").write_text(texts.get(name, ",".join(columns) + "\n"))
    return str(folder)


def test_csv_columns_go_by_name(spark, tmp_path):
    path = write_csv(tmp_path / "raw", dim_channel="channel_name,extra,channel_id,channel_type\nEmail,x,4,Owned\n")
    assert [tuple(r) for r in read_star(spark, path).dim_channel.collect()] == [(4, "Email", "Owned")]
    path = write_csv(tmp_path / "less", dim_channel="channel_id,channel_type\n4,Owned\n")
    with pytest.raises(ValueError, match="channel_name"):
        read_star(spark, path).dim_channel


def test_csv_line_breaks_in_quotes(spark, tmp_path):
    path = write_csv(tmp_path / "raw", dim_channel='channel_id,channel_name,channel_type\n4,"E\nmail",Owned\n5,Direct,Direct\n')
    assert sorted(tuple(r) for r in read_star(spark, path, multiLine=True).dim_channel.collect()) == [(4, "E\nmail", "Owned"), (5, "Direct", "Direct")]
    with pytest.raises(Exception, match="(?i)malformed"):
        read_star(spark, path).dim_channel.collect()


def test_cleaning_job_writes_only_what_passes(spark, tmp_path):
    period = (period_days(*PERIOD)[0].replace(year=2024), 18)
    raw = dirty(spark).with_tables(dim_date=lambda: period_calendar(spark, *period))
    orphan = raw.with_tables(fact_sales=lambda: star(spark, fact_sales=[
        line("O1", "2024-01-01", "C1", "P1", 9)]).fact_sales)
    write_star(orphan, str(tmp_path / "raw"), "csv")
    with pytest.raises(quality.BlockedByValidation, match="foreign_key.channel_id"):
        jobs.clean_raw_files(spark, str(tmp_path / "raw"), str(tmp_path / "out"), period)
    assert not (tmp_path / "out").exists()
    write_star(two_lines(spark), str(tmp_path / "out"))
    with pytest.raises(quality.BlockedByValidation):
        jobs.clean_raw_files(spark, str(tmp_path / "raw"), str(tmp_path / "out"), period)
    assert open_parquet_star(spark, str(tmp_path / "out")).fact_sales.count() == 2  # the old output is whole

    write_star(raw, str(tmp_path / "good"), "csv")
    result = jobs.clean_raw_files(spark, str(tmp_path / "good"), str(tmp_path / "out"), period)
    assert result.rows_written["fact_sales"] == 2
    assert result.reconciliation.first().difference == 10.0
    assert result.before.filter("rule = 'duplicate_rows'").first().n_errors == 1
    assert result.after.filter("NOT passed").count() == 0
    written = open_parquet_star(spark, str(tmp_path / "out"))
    assert written.fact_sales.count() == 2
    assert by(written.dim_customer.collect(), "customer_id")["C2"].customer_segment == "VIP"


def test_report_queries(spark, folder, tmp_path):
    wanted = ["01_revenue_analysis__monthly_revenue", "05_data_quality__table_totals"]
    written = jobs.run_named_queries(spark, folder, str(tmp_path), wanted, "csv")
    assert written == [(wanted[0], 80), (wanted[1], 1)]
    assert spark.read.csv(str(tmp_path / wanted[0]), header=True).count() == 80
    assert len(jobs.REPORTS) == 13


def test_segment_export(spark, folder, tmp_path):
    rows = jobs.export_segments(open_star(spark, folder), str(tmp_path / "rfm"))
    assert rows == 150 and spark.read.parquet(str(tmp_path / "rfm")).count() == 150


def test_load_and_verify(spark, folder, tmp_path):
    loaded, checks = jobs.load_and_verify(open_star(spark, folder), str(tmp_path / "db"))
    assert checks.filter("NOT passed").count() == 0 and checks.count() == 19
    months = (Path(versions.current(spark, str(tmp_path / "db"))) / "fact_sales").glob("year_month=*")
    assert len(list(months)) == 80


def test_calendar(spark):
    rows = period_calendar(spark, *PERIOD).orderBy("date").collect()
    assert len(rows) == 547 and rows[0].date_key == 20000101 and rows[0].day_of_week == "Saturday"
    assert rows[0].week == 52 and rows[-1].month_name == "June"  # ISO week of 1 January 2000
    first, last = period_bounds(*PERIOD)
    assert tuple(spark.range(1).select(first, last).first()) == period_days(*PERIOD)
    one = spark.sql("SELECT DATE'2024-02-28' AS first, DATE'2024-03-01' AS last")
    assert calendar_spine(one).agg(F.count("*")).first()[0] == 3


def channels(spark, name: str):
    return two_lines(spark).with_tables(dim_channel=lambda: spark.createDataFrame([(1, name, "Paid")], TABLES["dim_channel"]))


def test_two_loads_and_one_that_fails(spark, tmp_path):
    """Readers of a version keep it, new readers get the last whole one, a failing load changes nothing."""
    folder = str(tmp_path / "db")
    name = lambda table: table.dim_channel.first().channel_name
    first = loading.load_star(channels(spark, "one"), folder)
    opened = open_parquet_star(spark, folder)
    broken = channels(spark, "broken").with_tables(fact_marketing=lambda: spark.range(1).select(F.raise_error(F.lit("no"))))
    with pytest.raises(Exception):
        loading.load_star(broken, folder)
    assert name(open_parquet_star(spark, folder)) == "one" and len(versions.published(spark, folder)) == 1
    second = loading.load_star(channels(spark, "two"), folder)
    assert [name(t) for t in (first, opened, second, open_parquet_star(spark, folder))] == ["one", "one", "two", "two"]
    assert first.fact_sales.count() == 2  # built only now, from its own version
    assert versions.drop_old(spark, folder) == versions.published(spark, folder)[:1]
    assert name(open_parquet_star(spark, folder)) == "two" and versions.drop_old(spark, folder) == []


def test_loads_at_the_same_time(spark, tmp_path):
    folder = str(tmp_path / "db")

    def outer(path: str) -> str:
        inner, _ = versions.publish(spark, folder, lambda other: spark.range(3).write.parquet(other))
        spark.range(5).write.parquet(path)
        return inner

    path, inner = versions.publish(spark, folder, outer)
    assert [spark.read.parquet(p).count() for p in (path, inner, versions.current(spark, folder))] == [5, 3, 5]


def test_queries_that_load_keep_apart(spark, folder):
    query = contract.named_queries()["load_star_counts"]
    one, two = query(spark, folder), query(spark, folder)
    assert sorted(one.collect()) == sorted(two.collect())
    exports = [contract.named_queries()["rfm_export"](spark, folder) for _ in range(2)]
    assert [e.count() for e in exports] == [150, 150]
    assert exports[0].inputFiles() != exports[1].inputFiles()
    assert all(spark.sparkContext.applicationId in f for f in exports[0].inputFiles())
