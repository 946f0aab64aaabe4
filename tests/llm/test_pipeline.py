"""The pipeline over the smallest tables: every stage's decision against the operator or brute force."""

import duckdb

import corpus_pipeline

SF = "/root/testdata/sf0.001"


def test_stages(spark):
    docs = spark.read.parquet(f"{SF}/documents.parquet")
    seen = {}
    for name, stage in corpus_pipeline.STAGES[:-1]:
        out = stage(spark, docs, SF)
        assert out.columns == docs.columns, name
        rows = out.collect()
        assert {r["doc_id"] for r in rows} <= {r["doc_id"] for r in docs.collect()}, name
        seen[name] = len(rows)
        docs = spark.createDataFrame(rows, out.schema)
    pieces = corpus_pipeline.STAGES[-1][1](spark, docs, SF).collect()
    assert {p["doc_id"] for p in pieces} == {r["doc_id"] for r in docs.collect()}
    items = [t for (t,) in duckdb.sql(f"SELECT text FROM '{SF}/benchmark.parquet'").fetchall()]
    assert not any(item in (r["text"] or "") for r in docs.collect() for item in items)
    run = corpus_pipeline.run(spark, SF)
    assert {r["doc_id"] for r in run.select("doc_id").collect()} == {r["doc_id"] for r in docs.collect()}
    assert seen["quality rules"] > seen["benchmark decontamination"] > 50
