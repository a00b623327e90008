"""Registered queries and the pipeline over the small given tables."""

import re
from collections import Counter

import duckdb
import pytest

import __spark_entry__ as entry
import corpus_pipeline
from tidewater.llm import queries
from tidewater.llm.sql import SQL

SF = "/root/testdata/sf0.001"
TABLES = ("documents", "embeddings", "pages", "benchmark", "labels")


@pytest.fixture(scope="module")
def con():
    c = duckdb.connect()
    for name in TABLES:
        c.execute(f"CREATE VIEW {name} AS SELECT * FROM read_parquet('{SF}/{name}.parquet')")
    return c


@pytest.mark.parametrize("name", sorted(SQL))
def test_query_matches_sql(spark, con, name):
    cur = con.execute(SQL[name])
    columns = [d[0] for d in cur.description]
    got = queries.QUERIES[name](spark, SF)
    assert sorted(got.columns) == sorted(columns)
    assert Counter(map(tuple, got.select(*columns).collect())) == Counter(map(tuple, cur.fetchall()))


def test_every_dealt_operator_is_registered_once():
    names = list(entry.queries())
    assert [sum(bool(re.match(rf"op{n}_", x)) for x in names) for n in range(1, 14)] == [1] * 13
    assert "pipeline" in names and set(SQL) <= set(entry.oracle_sql())


@pytest.mark.parametrize("name", sorted(set(queries.QUERIES) - {"op12_spelling_variants"}))
def test_one_row_for_each_row_of_the_table(spark, name):
    got = queries.QUERIES[name](spark, SF)
    key = {"op1": "vec_id", "op6": "page_id"}.get(name.split("_")[0], "doc_id")
    table = {"vec_id": "embeddings", "page_id": "pages", "doc_id": "documents"}[key]
    ids = [r[0] for r in got.select(key).collect()]
    assert sorted(ids) == sorted(r[0] for r in spark.read.parquet(f"{SF}/{table}.parquet").select(key).collect())


def test_pipeline_stage_by_stage(spark):
    docs = spark.read.parquet(f"{SF}/documents.parquet")
    columns = docs.columns
    labels = {r.doc_id: r.quality for r in spark.read.parquet(f"{SF}/labels.parquet").collect()}
    first = {r.doc_id for r in docs.collect()}
    docs = corpus_pipeline.stage(corpus_pipeline.quality(spark, docs, SF), "t")
    kept = {r.doc_id for r in docs.collect()}
    good = [i for i in first if labels.get(i) == 1]
    assert docs.columns == columns and len(kept & set(good)) >= 0.95 * len(good)
    for step in (corpus_pipeline.near_duplicates, corpus_pipeline.decontamination, corpus_pipeline.personal_data):
        before = {r.doc_id: r.text for r in docs.collect()}
        docs = corpus_pipeline.stage(step(spark, docs, SF), "t")
        after = {r.doc_id: r.text for r in docs.collect()}
        assert docs.columns == columns and set(after) <= set(before)
        if step is corpus_pipeline.personal_data:
            assert set(after) == set(before) and any(after[i] != before[i] for i in after)
            assert all(r.n_chars == len(r.text) for r in docs.collect())
        else:
            assert all(after[i] == before[i] for i in after) and len(after) < len(before)
    out = corpus_pipeline.segmentation(spark, docs, SF)
    rows = out.collect()
    assert out.columns[: len(columns)] == columns and all(r.lossless and r.n_pieces == len(r.pieces) for r in rows)
    ran = {r.doc_id: r.pieces for r in corpus_pipeline.run(spark, SF).collect()}
    assert ran == {r.doc_id: r.pieces for r in rows}
