"""Registered queries against SQL, the pipeline against its stages."""

import pytest
from oracle_check import compare, connect

import corpus_pipeline
from conftest import SMALL
from ebbtide.llm import catalog
from ebbtide.llm.toxicity import score_documents


@pytest.mark.parametrize("key", list(catalog.QUERIES))
def test_query(spark, key):
    df = catalog.QUERIES[key](spark, SMALL)
    if key in catalog.ORACLE_SQL:
        assert compare(df, connect(SMALL).sql(catalog.ORACLE_SQL[key])) == []
    else:
        assert len(df.columns) == len(set(df.columns)) and df.count() > 0


def test_pipeline_stages(spark):
    docs = spark.read.parquet(f"{SMALL}/documents.parquet")
    seen = docs
    for name, stage in corpus_pipeline.STAGES[:-1]:
        out = stage(spark, seen, SMALL).cache()
        assert out.columns == docs.columns and out.schema.simpleString() == docs.schema.simpleString(), name
        if name == "toxicity":
            scores = {r["doc_id"]: r["score"] for r in score_documents(seen, spark.read.parquet(f"{SMALL}/labels.parquet")).collect()}
            assert {r["doc_id"] for r in out.collect()} == {i for i, s in scores.items() if s < 0.5}
        if name == "line_dedup":
            assert out.count() == seen.count()
        if name == "near_duplicates":
            assert 0 < out.count() <= seen.count() and out.count() == out.select("doc_id").distinct().count()
        seen = out
    packed = corpus_pipeline.STAGES[-1][1](spark, seen, SMALL)
    assert packed.select("doc_id").distinct().count() == seen.select("doc_id").distinct().count()


def test_stages_bear_null_and_repeated_rows(spark):
    schema = spark.read.parquet(f"{SMALL}/documents.parquet").schema.simpleString()[7:-1]
    names = [f.split(":")[0] for f in schema.split(",")]
    row = lambda i, t: tuple({"doc_id": i, "text": t}.get(n) for n in names)
    docs = spark.createDataFrame([row(1, None), row(2, ""), row(None, "some words of a text here"), row(3, "one two three"), row(3, "one two three"), row(4, "x " * 3000)], schema)
    for name, stage in corpus_pipeline.STAGES:
        docs = stage(spark, docs, SMALL)
        assert docs.count() > 0, name
