"""Every query of the core against its DuckDB oracle on the smallest driver tables."""

import hashlib
import os

import duckdb
import pytest

import __spark_entry__ as entry
from formsieve.plans.registry import ORACLE_SQL, QUERIES
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
def test_query_matches_oracle(spark, con, name):
    s = QUERIES[name](spark, SF).toPandas()
    d = con.execute(ORACLE_SQL[name]).df()
    assert sorted(s.columns) == sorted(d.columns)
    assert len(s) == len(d)
    assert table_hash(s)[0] == table_hash(d)[0]


def test_every_core_query_is_registered_and_has_sql():
    assert set(QUERIES) == set(ORACLE_SQL)
    assert set(QUERIES) <= set(entry.queries()) and set(ORACLE_SQL) <= set(entry.oracle_sql())


def test_entry_smoke(spark):
    df = entry.entry(spark)
    assert df.columns[:9] == ["uuid", "agency", "area", "variable", "issue", "old_value", "new_value", "fix",
                              "checked_by"]
    assert df.count() >= 0
