"""Every registered query against its SQL on the smallest tables, compared exactly."""

import inspect
from pathlib import Path

import duckdb
import pytest

import __spark_entry__ as entry
from gridloom.plans import workload
from tools.compare import rows_of

DATA = Path("/root/testdata/sf0.001")
pytestmark = pytest.mark.skipif(not DATA.is_dir(), reason="test tables are not here")


@pytest.fixture(scope="module")
def duck():
    con = duckdb.connect()
    for path in DATA.glob("*.parquet"):
        con.execute(f"CREATE VIEW {path.stem} AS SELECT * FROM '{path}'")
    return con


def test_entry(spark):
    assert entry.entry(spark).columns == ["var", "time_idx", "lev", "cell", "value"]
    assert set(entry.oracle_sql()) <= set(entry.queries())
    assert set(workload.QUERIES) == set(workload.ORACLES)


def test_queries_take_session_and_folder():
    for fn in entry.queries().values():
        assert len(inspect.signature(fn).parameters) == 2


@pytest.mark.parametrize("name", sorted(entry.oracle_sql()))
def test_query_agrees_with_sql(spark, duck, name):
    df = entry.queries()[name](spark, str(DATA))
    relation = duck.sql(entry.oracle_sql()[name])
    assert sorted(df.columns) == sorted(relation.columns)
    assert rows_of(df.columns, df.collect()) == rows_of(relation.columns, relation.fetchall())
