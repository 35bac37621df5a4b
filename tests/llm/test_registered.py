"""The registered queries over whole tables, and the pipeline."""

from __future__ import annotations

import pytest
from compare import connect, difference
from conftest import SF_DIR
from awkward import SCHEMA, empty, frame, texts

import corpus_pipeline
from tidemark.llm.queries import ORACLES, QUERIES


def test_one_query_for_each_operator():
    assert sorted(int(q[2:].split("_")[0]) for q in QUERIES) == list(range(1, 14))


@pytest.mark.parametrize("name", sorted(ORACLES))
def test_equals_sql(spark, name):
    assert difference(QUERIES[name](spark, SF_DIR), connect(SF_DIR), ORACLES[name]) is None


@pytest.mark.parametrize("name", ["op2_quality_rules", "op3_mixing", "op5_ngram_join", "op8_quality_classifier", "op9_secrets", "op10_toxicity", "op12_decontamination"])
def test_a_row_for_each_document(spark, name):
    docs = spark.read.parquet(f"{SF_DIR}/documents.parquet")
    got = QUERIES[name](spark, SF_DIR)
    assert sorted(r.doc_id for r in got.select("doc_id").collect()) == sorted(r.doc_id for r in docs.select("doc_id").collect())


def test_pipeline_stages(spark, tmp_path):
    """Each stage on what the one before kept; ids and columns stay those of documents."""
    spark.createDataFrame([(12, 1, 0), (1, 1, 0), (15, 0, 0), (16, 0, 0)], "doc_id long, quality int, toxic int").write.parquet(str(tmp_path / "labels.parquet"))
    docs = frame(spark)
    ids = [{i for i, _, _ in texts()}]
    for name, stage in corpus_pipeline.STAGES:
        out = stage(spark, docs, str(tmp_path))
        rows = out.collect()
        if name != "curve_packing":
            assert out.columns == docs.columns
            docs = spark.createDataFrame(rows, docs.schema)
        ids.append({r.doc_id for r in rows})
        assert ids[-1] <= ids[-2], name
    assert 15 not in ids[1] and {1, 12} <= ids[1] and not {2, 3, 4} & ids[2] and ids[3] == ids[2] and ids[5] == ids[4]


def test_pipeline_on_an_empty_table(spark, tmp_path):
    spark.createDataFrame([], "doc_id long, quality int, toxic int").write.parquet(str(tmp_path / "labels.parquet"))
    empty(spark).write.parquet(str(tmp_path / "documents.parquet"))
    assert corpus_pipeline.run(spark, str(tmp_path)).collect() == [] and SCHEMA
