"""Distributed ranks and medians against brute force, with heavy ties."""

from __future__ import annotations

import math
import random
import statistics

import pandas as pd
import pytest
from hypothesis import HealthCheck, given, settings, strategies as st
from pyspark.sql import functions as F

from tillsight.functions.ranking import bucket_edges, bucket_of, exact_median, ntile_last_rank, numbered, quintile_last_rank
from tillsight.operators.loading import with_surrogate_key


def ntile(rank: int, n: int) -> int:
    size, larger = divmod(n, 5)
    if rank <= larger * (size + 1):
        return (rank - 1) // (size + 1) + 1
    return larger + (rank - 1 - larger * (size + 1)) // size + 1


def quintile(n: int) -> list[int]:
    if n == 1:
        return [1]
    return [int(x) for x in pd.qcut(pd.Series(range(1, n + 1), dtype=float), 5, labels=[1, 2, 3, 4, 5])]


def scores(spark, values: list[int], rule, ids=None) -> dict:
    ids = ids or list(range(len(values)))
    rows = spark.createDataFrame(list(zip(ids, values)), f"id {'string' if isinstance(ids[0], str) else 'bigint'}, v bigint")
    edged = rows.withColumn("edges", bucket_edges(rows, "id", ["v"], rule))
    return {r.id: r.b for r in edged.select("id", bucket_of(0, "v", "id", "edges").alias("b")).collect()}


@pytest.mark.parametrize("n", [1, 2, 3, 5, 6, 7, 8, 9, 23])
def test_buckets_match_brute_force(spark, n):
    random.seed(n)
    values = [random.choice([1, 1, 1, 2, 9]) for _ in range(n)]
    order = sorted(range(n), key=lambda i: (values[i], i))
    expected = {i: ntile(rank, n) for rank, i in enumerate(order, 1)}
    assert scores(spark, values, ntile_last_rank) == expected
    expected = dict(zip(order, quintile(n)))
    assert scores(spark, values, quintile_last_rank) == expected


def test_one_value_for_everyone_and_text_ids(spark):
    ids = [f"C{i:05d}" for i in range(1003)]
    found = scores(spark, [7] * 1003, ntile_last_rank, ids)
    assert [found[i] for i in ids] == [ntile(r, 1003) for r in range(1, 1004)]


@pytest.mark.parametrize("ids", [
    [i - 500 for i in range(1000)], [2**62 - 3 * i for i in range(1000)], [str(i) for i in range(1000)], [f"c/{i * 7919 % 1000}/é{i}" for i in range(1000)],
    ["same-beginning-of-many-letters-" + "x" * (i % 40) + str(i) for i in range(1000)], [""] + ["a" * i for i in range(1, 300)],
])
def test_ids_of_any_kind_decide_ties(spark, ids):
    """Nulls, negative and huge values; ids with signs, common beginnings, and beginnings of each other."""
    random.seed(len(ids[0]) if isinstance(ids[0], str) else 1)
    values = [random.choice([None, 0, 0, 0, 5, -1, -(2**40), 2**60, random.randrange(50)]) for _ in ids]
    order = sorted(range(len(ids)), key=lambda i: (-(2**63) if values[i] is None else values[i], ids[i]))
    expected = {ids[i]: ntile(rank, len(ids)) for rank, i in enumerate(order, 1)}
    assert scores(spark, values, ntile_last_rank, ids) == expected


def test_several_metrics_at_once_and_no_rows(spark):
    random.seed(8)
    table = [(i, random.randrange(3), random.randrange(-9, 9), random.randrange(10**6)) for i in range(700)]
    rows = spark.createDataFrame(table, "id bigint, a bigint, b bigint, c bigint")
    for frame, data in ((rows, table), (rows.limit(0), [])):
        edged = frame.withColumn("edges", bucket_edges(frame, "id", ["a", "b", "c"], ntile_last_rank))
        found = {r.id: (r.a, r.b, r.c) for r in edged.select("id", *[bucket_of(i, m, "id", "edges").alias(m) for i, m in enumerate("abc")]).collect()}
        ranks = [{row[0]: ntile(rank, len(data)) for rank, row in enumerate(sorted(data, key=lambda r: (r[k], r[0])), 1)} for k in (1, 2, 3)]
        assert found == {row[0]: tuple(r[row[0]] for r in ranks) for row in data}


def test_last_ranks_for_many_sizes(spark):
    sizes = spark.range(1, 400).withColumnRenamed("id", "n")
    for rule, expected in ((quintile_last_rank, quintile), (ntile_last_rank, lambda n: [ntile(r, n) for r in range(1, n + 1)])):
        rows = sizes.select("n", *[F.expr(rule(b, "n")).alias(f"b{b}") for b in range(1, 5)]).collect()
        for row in rows:
            buckets = expected(row.n)
            for b in range(1, 5):
                assert row[f"b{b}"] == sum(x <= b for x in buckets), (row.n, b)


@settings(max_examples=12, deadline=None, suppress_health_check=[HealthCheck.function_scoped_fixture])
@given(st.lists(st.one_of(st.none(), st.integers(-3, 3), st.integers(-2**50, 2**50)), min_size=1, max_size=40))
def test_median(spark, values):
    rows = spark.createDataFrame([(v,) for v in values], "v bigint")
    present = [v for v in values if v is not None]
    found = spark.range(1).select(exact_median(rows, "v").alias("m")).first().m
    expected = None
    if present:
        expected = math.floor((statistics.median_low(present) + statistics.median_high(present) + 1) // 2)
    assert found == expected


def test_numbers_are_dense_and_in_order(spark):
    rows = spark.range(0, 5000).select(((F.col("id") * 7919) % 5003).alias("k"))
    found = [(r.k, r.number) for r in numbered(rows, ["k"], "number").orderBy("k").collect()]
    assert [n for _, n in found] == list(range(1, 5001))
    assert with_surrogate_key(rows, "sale_id", ["k"]).columns == ["sale_id", "k"]
    assert with_surrogate_key(rows, "sale_id").select("sale_id").distinct().count() == 5000
