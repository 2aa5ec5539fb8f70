"""The pipeline's stages and the queries' contract."""

from __future__ import annotations

import __spark_entry__ as contract
import corpus_pipeline
from tillsight.llm import queries, simhash
from tillsight.llm.common import table

def test_stages_keep_the_columns_and_take_effect(spark, folder):
    docs = start = table(spark, folder, "documents")
    for name, stage in corpus_pipeline.STAGES:
        before, docs = docs, stage(spark, docs, folder).cache()
        if name != "bpe_encoding":
            assert docs.columns == start.columns
        assert docs.count() <= before.count()
        assert docs.select("doc_id").subtract(before.select("doc_id")).count() == 0
    assert 0 < docs.count() < start.count()
    assert docs.where("size(ids) <> n_tokens or not round_trip").count() == 0
    assert corpus_pipeline.run(spark, folder).count() == docs.count()

def test_the_near_dedup_stage_is_the_operator(spark, folder, docs):
    """One document of each component that the query of operator 5 finds, the one with the smallest id."""
    for frame in (docs.where("doc_id is not null"), table(spark, folder, "documents")):
        kept = [r.doc_id for r in corpus_pipeline.near_dedup(spark, frame, folder).collect()]
        assert sorted(kept) == sorted(r.component_id for r in simhash.near_duplicates(frame).select("component_id").distinct().collect())


def test_stages_take_odd_and_empty_tables(spark, docs, no_docs, folder):
    for frame in (docs, no_docs):
        for _, stage in corpus_pipeline.STAGES:
            assert stage(spark, frame, folder).count() <= frame.count()

def test_registered_queries():
    registered = contract.queries()
    assert set(queries.queries()) <= set(registered) and registered["pipeline"] is corpus_pipeline.run
    assert set(queries.oracle_sql()) <= set(contract.oracle_sql())
    numbers = [q.split("_")[0] for q in queries.queries()]
    assert numbers == [f"op{n}" for n in range(1, 14)]
