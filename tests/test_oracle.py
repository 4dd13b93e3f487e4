"""Every registered query equals its DuckDB oracle (sf0.001, fast); the
driver runs the same comparison at sf0.01 (``python -m checks.compare``)."""

import duckdb
import pytest

import __spark_entry__ as E
from checks.compare import TABLES, _rows

SF = "/root/testdata/sf0.001"


@pytest.fixture(scope="module")
def con():
    c = duckdb.connect()
    c.execute("SET TimeZone='UTC'")
    for t in TABLES:
        c.execute(f"CREATE VIEW {t} AS SELECT * FROM read_parquet('{SF}/{t}.parquet')")
    return c


def test_entry_runs(spark):
    df = E.entry(spark)
    assert df.columns == ["fk_pays", "nb_aeronefs"]
    assert 0 < df.count() <= 10


def test_every_query_has_oracle():
    assert set(E.oracle_sql()) >= {q for q in E.queries() if q in E._QUERIES}


@pytest.mark.parametrize("name", sorted(E.oracle_sql()))
def test_query_matches_oracle(spark, con, name):
    df = E.queries()[name](spark, SF)
    s_cols, s_rows = df.columns, [tuple(r) for r in df.collect()]
    cur = con.execute(E.oracle_sql()[name])
    d_cols, d_rows = [d[0] for d in cur.description], cur.fetchall()
    assert sorted(s_cols) == sorted(d_cols)
    assert len(s_rows) == len(d_rows)
    assert _rows(s_cols, s_rows) == _rows(d_cols, d_rows)
