"""Every query with a SQL twin gives the same rows in DuckDB; the others run and give rows."""

import datetime
import decimal
import math

import duckdb
import pytest

from labflow.plans import registry

TABLES = "region nation customer supplier part orders lineitem events documents embeddings pages benchmark labels conversations".split()


@pytest.fixture(scope="module")
def duck(sf):
    con = duckdb.connect()
    con.execute("SET timezone = 'UTC'")
    for t in TABLES:
        con.execute(f"CREATE VIEW {t} AS SELECT * FROM '{sf}/{t}.parquet'")
    return con


def plain(v):
    if isinstance(v, float):
        return "nan" if math.isnan(v) else repr(v)
    if isinstance(v, decimal.Decimal):
        return str(int(v)) if v == int(v) else repr(float(v))
    if isinstance(v, (list, tuple)):
        return str([plain(x) for x in v])
    if isinstance(v, datetime.datetime):
        return v.replace(tzinfo=None).isoformat()
    return str(v)


@pytest.mark.parametrize("name", sorted(registry.SQL))
def test_sql_twin(spark, sf, duck, name):
    df = registry.QUERIES[name](spark, sf)
    columns = sorted(df.columns)
    got = sorted(tuple(plain(r[c]) for c in columns) for r in df.collect())
    result = duck.execute(registry.SQL[name])
    names = [d[0] for d in result.description]
    assert sorted(names) == columns
    assert sorted(tuple(plain(r[names.index(c)]) for c in columns) for r in result.fetchall()) == got


@pytest.mark.parametrize("name", sorted(set(registry.QUERIES) - set(registry.SQL)))
def test_rows_only(spark, sf, name):
    """Their values are compared with brute force in test_operators."""
    rows = registry.QUERIES[name](spark, sf).collect()
    assert rows and all(any(v is not None for v in r) for r in rows)


def test_flagship(spark, sf):
    assert registry.flagship(spark, sf).count() > 0


def test_entry_imports_without_the_text_operators():
    import __spark_entry__ as entry

    assert set(registry.QUERIES) <= set(entry.queries()) and set(entry.oracle_sql()) <= set(entry.queries())
