"""Every registered query against its DuckDB oracle on sf0.001 (the driver does sf0.01)."""

import math

import duckdb
import pytest

import __spark_entry__ as E
from conftest import SF_SMALL
from vigil.plans import registry

TABLES = ("region nation customer supplier part orders lineitem events documents embeddings "
          "pages benchmark labels conversations").split()


def _norm(v):
    if isinstance(v, float):
        return "nan" if math.isnan(v) else round(v, 6)
    if hasattr(v, "isoformat"):
        return v.isoformat()
    return v


def _canon(cols, rows):
    order = sorted(range(len(cols)), key=lambda i: cols[i])
    return sorted(repr(tuple(_norm(r[i]) for i in order)) for r in rows)


@pytest.fixture(scope="module")
def con():
    c = duckdb.connect()
    for t in TABLES:
        c.execute(f"CREATE VIEW {t} AS SELECT * FROM read_parquet('{SF_SMALL}/{t}.parquet')")
    return c


# the queries of vigil.llm have their own tests
@pytest.mark.parametrize("name", sorted(registry.QUERIES))
def test_query_matches_oracle(spark, con, name):
    df = E.queries()[name](spark, SF_SMALL)
    rows = df.collect()
    res = con.execute(E.oracle_sql()[name])
    ocols = [d[0] for d in res.description]
    orows = res.fetchall()
    assert sorted(df.columns) == sorted(ocols)
    assert _canon(df.columns, rows) == _canon(ocols, orows)


@pytest.mark.parametrize("name, by, descending", [
    ("sql_sort", ["place"], False), ("sql_distinct_float", ["temperature"], True),
    ("distinct_float", ["temperature"], True), ("batch_sort", ["batch", "sensor", "x"], False),
    ("string_sort", ["batch", "sensor", "x_text"], False)])
def test_row_order(spark, name, by, descending):
    rows = [tuple(r[c] for c in by) for r in E.queries()[name](spark, SF_SMALL).collect()]
    assert rows == sorted(rows, reverse=descending) and len(rows) > 10


def test_entry(spark):
    df = E.entry(spark)
    assert df.count() > 0
