"""Customer scoring against pandas, every rung of the ladder, and non-buyers."""

from __future__ import annotations

from datetime import date, timedelta

import pandas as pd
import pytest
from pyspark.sql import functions as F

from stars import by, line, star
from tillsight.operators import rfm
from tillsight.sources.tables import open_star


@pytest.mark.parametrize("r, f, m, segment", [
    (3, 4, 4, "VIP"), (5, 5, 5, "VIP"), (2, 3, 1, "Clientes en riesgo"), (2, 1, 4, "Clientes en riesgo"),
    (2, 5, 5, "Clientes en riesgo"), (1, 2, 3, "Clientes inactivos"), (3, 2, 5, "Nuevos clientes"),
    (3, 3, 5, "Clientes frecuentes"), (5, 4, 3, "Clientes frecuentes")])
def test_ladder(spark, r, f, m, segment):
    row = spark.range(1).select(F.lit(r).alias("r_score"), F.lit(f).alias("f_score"), F.lit(m).alias("m_score"))
    assert row.select(rfm.segment().alias("s")).first().s == segment


def shop(spark, n: int):
    """``n`` buyers with many ties and two customers who never bought."""
    lines, day = [], date(2024, 1, 1)
    for i in range(n):
        for order in range(1 + i % 3):
            lines.append(line(f"O{i}-{order}", str(day + timedelta(days=(i * 5 + order) % 7)), f"C{i:03d}", "P", 1,
                              1, 10 + i % 4, refund=1))
    customers = [dict(customer_id=f"C{i:03d}", acquisition_date="2024-01-01", customer_segment="New", city="X",
                      region="R", acquisition_channel="Email") for i in range(n + 2)]
    return star(spark, fact_sales=lines, dim_customer=customers)


@pytest.mark.parametrize("n", [5, 7, 23])
def test_quintiles_equal_pandas(spark, n):
    table = shop(spark, n)
    base = rfm.rfm_base(table).toPandas().sort_values("customer_id").reset_index(drop=True)
    assert len(base) == n

    def bucket(column: str, labels: list[int]) -> list[int]:
        return pd.qcut(base[column].rank(method="first"), 5, labels=labels).astype(int).tolist()

    found = rfm.rfm_scores_quintile(table).toPandas().sort_values("customer_id")
    assert found["r_score"].tolist() == bucket("recency_days", [5, 4, 3, 2, 1])
    assert found["f_score"].tolist() == bucket("frequency", [1, 2, 3, 4, 5])
    assert found["m_score"].tolist() == bucket("monetary", [1, 2, 3, 4, 5])
    assert (found["rfm_cell"].astype(int) == found["rfm_score"]).all()


def test_one_buyer(spark):
    row = rfm.rfm_scores_quintile(shop(spark, 1)).first()
    assert (row.r_score, row.f_score, row.m_score) == (5, 1, 1)


def test_non_buyers_get_the_lowest_scores(spark):
    rows = by(rfm.rfm_all_customers(shop(spark, 7)).collect(), "customer_id")
    assert len(rows) == 9
    never = rows["C008"]
    assert (never.segment, never.rfm_cell, never.has_purchase, never.frequency, never.monetary) == (
        "Clientes inactivos", "111", 0, 0, 0.0)
    assert never.last_order_date is None and never.recency_days == 6
    assert list(rows["C000"].asDict()) == list(rfm.EXPORT_COLUMNS)


def test_segments_cover_everyone_and_all_value(spark, folder):
    table = open_star(spark, folder)
    summary = rfm.rfm_segment_summary_all(table).collect()
    assert sum(r.customers for r in summary) == table.dim_customer.count()
    net = table.sales("monetary").agg(F.sum("monetary")).first()[0] / 100
    assert sum(r.total_monetary for r in summary) == pytest.approx(net)
    assert sum(r.pct_value for r in rfm.rfm_distribution(table).collect()) == pytest.approx(100)
