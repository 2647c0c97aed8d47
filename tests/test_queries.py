"""Every registered query against its DuckDB oracle on sf0.001 (the driver does sf0.01)."""

from __future__ import annotations

import duckdb
import pytest

from __spark_entry__ import ORACLE, QUERIES, STREAM_ORACLE, STREAM_QUERIES, entry
from pulsemart.sources.tables import TABLE_NAMES
from tools.check_oracle import _rows

# The training-data operators have their own tests (tests/llm).
ALL = {**QUERIES, **STREAM_QUERIES}
SQL = {**ORACLE, **STREAM_ORACLE}
SF = "/root/testdata/sf0.001"


@pytest.fixture(scope="module")
def con():
    c = duckdb.connect()
    for t in TABLE_NAMES:
        c.execute(f"CREATE VIEW {t} AS SELECT * FROM read_parquet('{SF}/{t}.parquet')")
    return c


def test_entry_runs(spark):
    df = entry(spark)
    assert df.columns == ["logdate", "lh", "ct"]
    assert df.count() > 0


def test_every_query_has_an_oracle():
    assert set(ALL) == set(SQL)


@pytest.mark.parametrize("name", sorted(ALL))
def test_query_matches_oracle(spark, con, name):
    df = ALL[name](spark, SF)
    got = [tuple(r) for r in df.collect()]
    sql = SQL.get(name)
    if sql is None:
        assert len(got) > 0
        return
    cur = con.execute(sql)
    cols = [d[0] for d in cur.description]
    assert sorted(df.columns) == sorted(cols)
    assert _rows(df.columns, got) == _rows(cols, cur.fetchall())
