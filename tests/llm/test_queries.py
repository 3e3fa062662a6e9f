"""Registered queries against their DuckDB SQL, and the pipeline's stages."""

import duckdb
import pytest

import corpus_pipeline
from tallybayes.llm import queries
from tallybayes.llm.storage import documents

SF = "/root/testdata/sf0.001"


@pytest.mark.parametrize("name", sorted(queries.ORACLE))
def test_query_matches_duckdb(spark, name):
    con = duckdb.connect()
    for t in ("documents", "conversations", "pages", "benchmark"):
        con.execute(f"CREATE VIEW {t} AS SELECT * FROM read_parquet('{SF}/{t}.parquet')")
    res = con.execute(queries.ORACLE[name])
    columns = [d[0] for d in res.description]
    df = queries.QUERIES[name](spark, SF)
    assert sorted(df.columns) == sorted(columns)
    assert sorted(map(tuple, df.select(*columns).collect()), key=repr) == sorted(map(tuple, res.fetchall()), key=repr)


def test_pipeline_stages_keep_the_schema_and_pack_what_is_left(spark):
    docs = documents(spark, SF)
    schema = docs.columns
    ids = {r["doc_id"] for r in docs.collect()}
    for name, stage in corpus_pipeline.STAGES[:-1]:
        docs = stage(spark, docs, SF)
        assert docs.columns == schema, name
        left = {r["doc_id"] for r in docs.select("doc_id").collect()}
        assert left <= ids and len(left) > 0.5 * len(ids)
        ids = left
    packed = corpus_pipeline.STAGES[-1][1](spark, docs, SF).collect()
    assert {r["doc_id"] for r in packed} == ids


@pytest.mark.parametrize("at", range(len(corpus_pipeline.STAGES)))
def test_stages_take_empty_tables(spark, at):
    name, stage = corpus_pipeline.STAGES[at]
    assert stage(spark, documents(spark, SF).limit(0), SF).collect() == []
