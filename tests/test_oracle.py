"""Every registered plan against its DuckDB oracle on the smallest tables."""

import math

import duckdb
import pytest

import __spark_entry__ as E
from tallybayes.plans import catalog
from tests.conftest import SF_SMALL

TABLES = ("region nation customer supplier part orders lineitem events documents "
          "embeddings pages benchmark labels conversations").split()
ORACLE = catalog.oracle_sql()


def _norm(v):
    if isinstance(v, float):
        return "nan" if math.isnan(v) else (str(v) if math.isinf(v) else round(v, 9))
    return v


def _rows(cols, rows):
    order = sorted(range(len(cols)), key=lambda i: cols[i])
    return sorted((tuple(_norm(r[i]) for i in order) for r in rows), key=repr)


@pytest.fixture(scope="module")
def con():
    c = duckdb.connect()
    for t in TABLES:
        c.execute(f"CREATE VIEW {t} AS SELECT * FROM read_parquet('{SF_SMALL}/{t}.parquet')")
    return c


def test_every_query_has_an_oracle():
    assert set(catalog.queries()) == set(ORACLE) <= set(E.queries())


@pytest.mark.parametrize("name", sorted(ORACLE))
def test_query_matches_oracle(spark, con, name):
    df = catalog.queries()[name](spark, SF_SMALL)
    res = con.execute(ORACLE[name])
    ocols = [d[0] for d in res.description]
    assert sorted(df.columns) == sorted(ocols)
    assert _rows(df.columns, df.collect()) == _rows(ocols, res.fetchall())


def test_entry_runs(spark):
    df = E.entry(spark)
    assert df.columns == ["doc_id", "label", "prediction", "score"]
    assert df.count() >= 0
