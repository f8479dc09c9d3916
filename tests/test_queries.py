"""Every registered query against its SQL, over whole tables."""

import duckdb
import pandas as pd
import pytest

import __spark_entry__ as contract
from tidemark.plans import catalog

TABLES = (
    "region nation customer supplier part orders lineitem events documents embeddings pages"
    " benchmark labels conversations"
).split()
QUERIES, SQL = catalog.queries(), catalog.oracle_sql()


@pytest.fixture(scope="module")
def oracle(sf_dir):
    con = duckdb.connect()
    for table in TABLES:
        con.execute(f"create view {table} as select * from '{sf_dir}/{table}.parquet'")
    return con


def _comparable(frame: pd.DataFrame) -> pd.DataFrame:
    out = pd.DataFrame()
    for name in sorted(frame.columns):
        column = frame[name]
        if str(column.dtype).startswith("datetime"):
            column = column.astype("datetime64[us]")
        out[name] = column.map(str)
    return out.sort_values(list(out.columns), ignore_index=True)


def test_every_query_has_sql():
    assert QUERIES.keys() == SQL.keys()
    assert QUERIES.keys() <= contract.queries().keys()
    assert SQL.items() <= contract.oracle_sql().items()


@pytest.mark.parametrize("name", QUERIES)
def test_query_equals_sql(name, spark, sf_dir, oracle):
    got = QUERIES[name](spark, sf_dir).toPandas()
    expected = oracle.sql(SQL[name]).df()
    assert len(got) > 0
    pd.testing.assert_frame_equal(_comparable(got), _comparable(expected))


def test_flagship(spark):
    assert contract.entry(spark).count() == 46
