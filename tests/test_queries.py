"""Every registered query against its DuckDB statement on the smallest fixture; the flagship returns rows.

The training-data queries have their own tests in ``tests/llm``.
"""

import duckdb
import pytest

import __spark_entry__ as E
from strata.plans import registry
from tools.oracle_check import TABLES, digest

SF = "/root/testdata/sf0.001"
registry.load_all()


@pytest.fixture(scope="module")
def con():
    c = duckdb.connect()
    c.sql("SET TimeZone='UTC'")
    for t in TABLES:
        c.sql(f"CREATE VIEW {t} AS SELECT * FROM read_parquet('{SF}/{t}.parquet')")
    return c


def test_entry_has_rows(spark):
    assert E.entry(spark).count() > 0


def test_every_query_has_a_statement():
    assert set(registry.QUERIES) == set(registry.ORACLE) <= set(E.queries())


@pytest.mark.parametrize("name", sorted(registry.QUERIES))
def test_query_agrees_with_its_statement(spark, con, name):
    df = registry.QUERIES[name](spark, SF)
    assert len(df.columns) == len(set(df.columns))
    rel = con.sql(registry.ORACLE[name])
    assert sorted(df.columns) == sorted(rel.columns)
    got, want = [tuple(r) for r in df.collect()], rel.fetchall()
    assert len(got) == len(want)
    assert digest(df.columns, got, False)[0] == digest(rel.columns, want, False)[0]
