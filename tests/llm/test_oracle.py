"""The training-data queries that have SQL, against DuckDB on the smallest driver tables."""

import os

import duckdb
import pytest

from formsieve.llm.queries import ORACLE_SQL, QUERIES
from tools.check_oracle import TABLES, table_hash

SF = "/root/testdata/sf0.001"

pytestmark = pytest.mark.skipif(not os.path.isdir(SF), reason="driver tables not present")


@pytest.fixture(scope="module")
def con():
    c = duckdb.connect()
    for t in TABLES:
        c.execute(f"CREATE VIEW {t} AS SELECT * FROM read_parquet('{SF}/{t}.parquet')")
    return c


@pytest.mark.parametrize("name", sorted(ORACLE_SQL))
def test_query_matches_sql(spark, con, name):
    s = QUERIES[name](spark, SF).toPandas()
    d = con.execute(ORACLE_SQL[name]).df()
    assert sorted(s.columns) == sorted(d.columns)
    assert len(s) == len(d)
    assert table_hash(s)[0] == table_hash(d)[0]
