"""Registered training-data queries on the smallest tables."""

import os
import sys

import duckdb
import pytest

import corpus_pipeline
from tidelog.llm.queries import QUERIES, SQL

sys.path.insert(0, os.path.join(os.path.dirname(os.path.dirname(os.path.dirname(os.path.abspath(__file__)))), "tools"))

from check_oracle import TABLES, canonical


@pytest.mark.parametrize("name", sorted(SQL))
def test_query_matches_sql(spark, small_sf, name):
    db = duckdb.connect()
    for t in TABLES:
        db.execute(f"CREATE VIEW {t} AS SELECT * FROM '{small_sf}/{t}.parquet'")
    assert canonical(QUERIES[name](spark, small_sf).toArrow()) == canonical(db.sql(SQL[name]).to_arrow_table())


@pytest.mark.parametrize("name", sorted(set(QUERIES) - set(SQL) - {"op12_neighbours"}))
def test_query_has_a_row_per_document(spark, small_sf, name):
    docs = spark.read.parquet(f"{small_sf}/documents.parquet")
    ids = [r.doc_id for r in QUERIES[name](spark, small_sf).select("doc_id").collect()]
    assert set(ids) == {r.doc_id for r in docs.select("doc_id").collect()}
    assert name == "op3_packing" or len(ids) == docs.count()


def test_pipeline_stages(spark, small_sf):
    docs = spark.read.parquet(f"{small_sf}/documents.parquet")
    assert [name for name, _ in corpus_pipeline.STAGES] == ["language", "quality", "near_dedup", "mixing", "packing"]
    before = {r.doc_id for r in docs.collect()}
    for name, stage in corpus_pipeline.STAGES[:-1]:
        kept = stage(spark, docs, small_sf).cache()
        assert kept.columns == docs.columns and {r.doc_id for r in kept.collect()} <= before, name
        docs, before = kept, {r.doc_id for r in kept.select("doc_id").collect()}
    assert corpus_pipeline.run(spark, small_sf).count() > 0


@pytest.mark.parametrize("texts", [[], [None, "", "?"]])
def test_pipeline_stages_on_empty_tables(spark, small_sf, texts):
    docs = spark.read.parquet(f"{small_sf}/documents.parquet")
    rows = [(i, t, None, None, 0) for i, t in enumerate(texts)]
    odd = spark.createDataFrame(rows, "doc_id long, text string, lang string, source string, n_chars long").select(*docs.columns)
    for name, stage in corpus_pipeline.STAGES:
        assert stage(spark, odd, small_sf).count() >= 0, name
