"""Every registered query against its DuckDB oracle on the sf0.001 tables
(the driver runs the same check at sf0.01)."""

import re

import duckdb
import pytest

import __spark_entry__ as entry
from oracle_check import TABLES, rows_of

SF = "/root/testdata/sf0.001"


@pytest.fixture(scope="module")
def duck():
    con = duckdb.connect()
    for t in TABLES:
        con.execute(f"CREATE VIEW {t} AS SELECT * FROM read_parquet('{SF}/{t}.parquet')")
    return con


def test_only_corpus_queries_lack_an_oracle():
    assert all(re.match(r"op\d+_|pipeline$", q) for q in set(entry.queries()) - set(entry.oracle_sql()))


@pytest.mark.parametrize("name", sorted(entry.oracle_sql()))
def test_query_matches_oracle(spark, duck, name):
    df = entry.queries()[name](spark, SF)
    s_cols, s_rows = df.columns, [tuple(r) for r in df.collect()]
    res = duck.execute(entry.oracle_sql()[name])
    d_cols = [c[0] for c in res.description]
    d_rows = res.fetchall()
    assert sorted(s_cols) == sorted(d_cols)
    assert len(s_rows) == len(d_rows)
    assert rows_of(s_cols, s_rows) == rows_of(d_cols, d_rows)


def test_entry_smoke(spark):
    df = entry.entry(spark)
    assert df.count() >= 0
    assert len(df.columns) == 84
