"""The pipeline over a small folder: every stage against its operator, and the registered queries."""

import pytest

import __spark_entry__ as entry_points
import corpus_pipeline
from barlab.llm import queries

SF = "/root/testdata/sf0.001"


def test_every_stage_keeps_the_columns_and_decides(spark):
    pytest.importorskip("public_tokenizers")
    docs = queries.documents(spark, SF)
    columns, before, counts = docs.columns, docs.count(), []
    for name, stage in corpus_pipeline.STAGES:
        docs = stage(spark, docs, SF)
        if name != "best_fit_packing":
            assert docs.columns == columns
            counts.append(docs.count())
    rules, near, hidden, mixed = counts
    assert before > rules > near == hidden
    assert mixed != hidden
    assert {"doc_id", "piece", "sequence_id", "offset"} <= set(docs.columns)
    assert corpus_pipeline.run(spark, SF).count() == docs.count()


def test_all_are_registered():
    names = entry_points.queries()
    assert {f"op{n}" for n in range(1, 14)} == {q.split("_")[0] for q in names if q.startswith("op")}
    assert "pipeline" in names and "op3_source_mixing" in entry_points.oracle_sql()
