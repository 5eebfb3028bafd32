"""Every registered query against its DuckDB oracle on the smallest tables."""
import math

import duckdb
import pytest

import __spark_entry__ as entry

SF = "/root/testdata/sf0.001"
TABLES = ("region nation customer supplier part orders lineitem events documents embeddings "
          "pages benchmark labels conversations").split()
SLOW = {"cv_tuning"}
SPARK_TO_DUCKDB = {"IntegerType()": "INTEGER", "LongType()": "BIGINT", "DoubleType()": "DOUBLE",
                   "StringType()": "VARCHAR", "BooleanType()": "BOOLEAN", "DateType()": "DATE"}


def _norm(v):
    if isinstance(v, float):
        return "nan" if math.isnan(v) else round(v, 8)
    return v


@pytest.fixture(scope="module")
def con():
    c = duckdb.connect()
    for t in TABLES:
        c.execute(f"CREATE VIEW {t} AS SELECT * FROM read_parquet('{SF}/{t}.parquet')")
    return c


@pytest.mark.parametrize("name", sorted(entry.oracle_sql()))
def test_query_matches_oracle(spark, con, name):
    df = entry.queries()[name](spark, SF)
    rows, cols = df.collect(), df.columns
    rel = con.sql(entry.oracle_sql()[name])
    dtypes = dict(zip(rel.columns, [str(t) for t in rel.types]))
    stypes = {f.name: SPARK_TO_DUCKDB.get(repr(f.dataType), repr(f.dataType))
              for f in df.schema.fields}
    assert stypes == dtypes
    cur = con.execute(entry.oracle_sql()[name])
    drows, dcols = cur.fetchall(), [d[0] for d in cur.description]
    assert sorted(cols) == sorted(dcols)
    order = sorted(cols)
    a = sorted((tuple(_norm(r[c]) for c in order) for r in rows), key=repr)
    idx = [dcols.index(c) for c in order]
    b = sorted((tuple(_norm(r[i]) for i in idx) for r in drows), key=repr)
    assert a == b


@pytest.mark.parametrize("name", sorted(set(entry.queries()) - set(entry.oracle_sql()) - SLOW))
def test_rows_only_queries_run(spark, name):
    assert entry.queries()[name](spark, SF).count() > 0


def test_entry_smoke(spark):
    out = entry.entry(spark)
    assert out.columns == ["issue_order", "column", "description", "affected_rows", "severity"]
    assert out.count() >= 0
