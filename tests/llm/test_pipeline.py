"""Registered queries against their SQL, and the pipeline on the smallest tables."""

from __future__ import annotations

import duckdb
import pytest

import corpus_pipeline
from tidemark.llm import queries

COLUMNS = ["doc_id", "text", "lang", "source", "n_chars"]


@pytest.mark.parametrize("name", sorted(queries.ORACLES))
def test_query_equals_twin(spark, sf_dir, name):
    con = duckdb.connect()
    for t in ("documents", "labels", "embeddings"):
        con.execute(f"create view {t} as select * from '{sf_dir}/{t}.parquet'")
    got = queries.QUERIES[name](spark, sf_dir).toPandas()
    expected = con.execute(queries.ORACLES[name]).df()
    order = sorted(got.columns)
    assert order == sorted(expected.columns)
    got, expected = (d[order].sort_values(order).reset_index(drop=True) for d in (got, expected))
    assert got.astype(str).equals(expected.astype(str))


def test_stages(spark, sf_dir):
    docs = spark.read.parquet(f"{sf_dir}/documents.parquet")
    assert [n for n, _ in corpus_pipeline.STAGES] == [
        "toxicity", "exact_dedup", "simhash_near_dedup", "substring_dedup", "packing"]
    whole = docs.select("doc_id", "text").toPandas()
    for name, stage in corpus_pipeline.STAGES[:-1]:
        kept = stage(spark, docs, sf_dir)
        assert kept.columns == COLUMNS, name
        left = kept.toPandas()
        assert set(left.doc_id) <= set(whole.doc_id) and left.doc_id.is_unique
        docs = spark.createDataFrame(left, docs.schema)
    assert left.text.str.lower().is_unique or (left.text == "").sum() > 1
    packed = corpus_pipeline.STAGES[-1][1](spark, docs, sf_dir)
    assert {r[0] for r in packed.select("doc_id").distinct().collect()} == set(left.doc_id)
    assert corpus_pipeline.STAGES[0][1](spark, docs.limit(0), sf_dir).count() == 0
