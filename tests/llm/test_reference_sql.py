"""Operators 1, 6 and 7 against their reference SQL, verdicts included, on odd rows, none and the given ones."""

from __future__ import annotations

import duckdb
import pandas as pd
import pytest

from tillsight.llm import decontamination, quality_rules, reference_sql, substring_dedup
from tillsight.llm.common import table

ITEMS = ("n_words", "n_hit", "n_items", "items_sha256", "contaminated")


def register(database, name, frame, number):
    pandas = pd.DataFrame([tuple(r) for r in frame.collect()], columns=frame.columns, dtype=object)
    database.register(name, pandas.astype({c: "Int64" if c == number else "string" for c in frame.columns}))


@pytest.fixture(scope="module")
def benchmark(spark, odd):
    texts = [t for _, t, *_ in odd if t]
    some = [(1, " ".join(texts[3].split()[4:30])), (2, " ".join(texts[3].split()[10:16])), (3, "A B"), (4, None), (None, "no id HERE"), (5, "no id here"), (10, ""), (6, "日本語" * 300)]
    return spark.createDataFrame(some, "item_id long, text string")


@pytest.fixture(scope="module", params=["odd", "none", "given"])
def tables(request, spark, docs, no_docs, benchmark, folder):
    """Documents, benchmark and a database that holds both."""
    frame, items = {"odd": (docs, benchmark), "none": (no_docs, benchmark.limit(0)), "given": (table(spark, folder, "documents"), table(spark, folder, "benchmark"))}[request.param]
    database = duckdb.connect()
    register(database, "documents", frame.select("doc_id", "text", "lang", "source"), "doc_id")
    register(database, "benchmark", items.select("item_id", "text"), "item_id")
    return frame, items, database


def check(found, database, sql):
    answer = database.execute(sql)
    names = [d[0] for d in answer.description]
    assert sorted(names) == sorted(found.columns)
    assert sorted((tuple(r[n] for n in names) for r in found.collect()), key=repr) == sorted(answer.fetchall(), key=repr)


def test_quality(tables):
    frame, _, database = tables
    check(quality_rules.quality_verdicts(frame), database, reference_sql.quality_sql())


def test_substrings(tables):
    frame, _, database = tables
    check(substring_dedup.repeated_substrings(frame, texts=False), database, reference_sql.substrings_sql())


def test_benchmark(tables):
    frame, items, database = tables
    check(decontamination.mark(frame, items, keep=["doc_id"]).select("doc_id", *ITEMS), database, reference_sql.benchmark_sql())
