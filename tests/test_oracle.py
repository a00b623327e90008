"""Every registered query against its DuckDB oracle (the driver's gate), at sf0.001."""

from collections import Counter

import duckdb
import pytest

import oracle
from tidewater.plans import queries

SF = "/root/testdata/sf0.001"
BASES = ["region", "nation", "customer", "supplier", "part", "orders", "lineitem", "events"]


@pytest.fixture(scope="module")
def con():
    c = duckdb.connect()
    for b in BASES:
        c.execute(f"CREATE VIEW {b} AS SELECT * FROM read_parquet('{SF}/{b}.parquet')")
    return c


@pytest.mark.parametrize("name", oracle.names())
def test_query_matches_oracle(spark, con, name):
    sdf = queries.run(name, spark, SF)
    cur = con.execute(oracle.sql(name))
    assert [d[0] for d in cur.description] == sdf.columns
    want = Counter(tuple(r) for r in cur.fetchall())
    got = Counter(tuple(r) for r in sdf.collect())
    assert got == want


def test_every_query_has_an_oracle():
    assert set(queries.QUERIES) == set(oracle.names())
