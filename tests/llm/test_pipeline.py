"""The pipeline's stages, each against its operator or brute force, and the queries against their SQL."""

import os

import pytest
from pyspark.sql import functions as F

import corpus_pipeline
from oracle import compare, connect
from rastergrid.llm.queries import ORACLES, QUERIES

SF_DIR = os.environ.get("TEST_SF_DIR", "/root/testdata/sf0.001")


@pytest.mark.parametrize("name", sorted(ORACLES))
def test_query_equals_sql(llm_spark, name):
    assert compare(llm_spark, QUERIES[name], ORACLES[name], SF_DIR, connect(SF_DIR)) is None


def test_stages(llm_spark):
    docs = llm_spark.read.parquet(f"{SF_DIR}/documents.parquet")
    before, counts = docs, {}
    for name, stage in corpus_pipeline.STAGES:
        after = stage(llm_spark, before, SF_DIR).cache()
        counts[name] = after.count()
        if name != "sentencepiece":
            assert after.columns == docs.columns
            # Rows come as they were.
            assert after.exceptAll(before).distinct().join(before.select("doc_id"), "doc_id", "left_anti").isEmpty()
            assert after.distinct().exceptAll(before.distinct()).isEmpty()
        if name == "exact dedup":
            best = before.groupBy(F.coalesce("text", F.lit(""))).agg(F.max("doc_id").alias("doc_id"))
            assert sorted(r.doc_id for r in after.collect()) == sorted(r.doc_id for r in best.collect())
        if name == "near dedup":
            assert after.select("doc_id").distinct().count() == counts[name] < counts["exact dedup"]
        before = after
    assert counts["sentencepiece"] == counts["mixing"] > 0
    assert {"n_tokens", "ids_sha256", "decoded_sha256"} <= set(before.columns)


def test_stages_on_odd_rows(llm_spark):
    rows = [(1, None, None, None, None), (1, None, None, None, None), (2, "", "en", "a", 0), (None, "words here", "en", "a", 10)]
    docs = llm_spark.createDataFrame(rows, "doc_id long, text string, lang string, source string, n_chars long")
    docs = docs.withColumn("kept", F.lit("mine"))
    exact = corpus_pipeline.exact_stage(llm_spark, docs, SF_DIR).collect()
    assert sorted(str(r.doc_id) for r in exact) == ["2", "None"]
    near = corpus_pipeline.near_stage(llm_spark, docs, SF_DIR).collect()
    assert sorted(str(r.doc_id) for r in near) == ["1", "2", "None"]
    for _, stage in corpus_pipeline.STAGES[1:]:
        assert stage(llm_spark, docs.limit(0), SF_DIR).count() == 0


def test_stages_pass_columns_of_any_name_through(llm_spark):
    """Columns named like those that stages or operators use come out as they went in."""
    names = ["text_key", "copy", "score", "position", "kept", "keep_id", "component_id", "taken", "size", "label", "__key", "__id", "__at", "row"]
    rows = [(k, f"some words of document {k} " * 8, "en", f"s{k % 2}", 9, *[f"{n}{k}" for n in names]) for k in range(12)] + [
        (50, "some words of document 3 " * 8, "en", "s0", 9, *["x"] * len(names))
    ]
    docs = llm_spark.createDataFrame(rows, "doc_id long, text string, lang string, source string, n_chars long, " + ", ".join(f"`{n}` string" for n in names))
    given = {r[0]: r for r in rows}
    for name, stage in corpus_pipeline.STAGES[1:4]:
        out = stage(llm_spark, docs, SF_DIR)
        assert out.columns == docs.columns
        found = out.collect()
        assert found and all(tuple(r) == given[r.doc_id] for r in found), name
    assert sorted(r.doc_id for r in corpus_pipeline.exact_stage(llm_spark, docs, SF_DIR).collect()) == [0, 1, 2, *range(4, 12), 50]
    encoded = corpus_pipeline.sentencepiece_stage(llm_spark, docs.withColumnRenamed("copy", "n_tokens").withColumnRenamed("row", "ids_sha256"), SF_DIR)
    assert encoded.where("n_tokens > 0 and length(ids_sha256) = 64").count() == 13
    assert [c for c in encoded.columns if c in names] == [n for n in names if n not in ("copy", "row")]
