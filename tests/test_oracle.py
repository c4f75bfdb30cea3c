"""Every registered query against its independent DuckDB SQL (sf0.001).

Row count, column names and the order-insensitive multiset of values must
match, as in the driver's correctness gate (which runs at sf0.01; see
``check_oracle.py``).
"""

import os

import pytest

from ticketflow.plans.oracle import oracle_sql
from ticketflow.plans.registry import QUERIES
from check_oracle import TABLES, digest

from conftest import SF0001

pytestmark = pytest.mark.skipif(not os.path.exists(SF0001), reason="driver tables not present")

NAMES = sorted(QUERIES)


@pytest.fixture(scope="module")
def duck():
    duckdb = pytest.importorskip("duckdb")
    con = duckdb.connect()
    for t in TABLES:
        p = os.path.join(SF0001, f"{t}.parquet")
        if os.path.exists(p):
            con.execute(f"CREATE VIEW {t} AS SELECT * FROM read_parquet('{p}')")
    return con


def test_every_query_has_an_oracle():
    assert set(QUERIES) == set(oracle_sql())


@pytest.mark.parametrize("name", NAMES)
def test_query_matches_oracle(spark, duck, name):
    df = QUERIES[name](spark, SF0001)
    rows = [tuple(r) for r in df.collect()]
    rel = duck.sql(oracle_sql()[name])
    orows = rel.fetchall()
    assert sorted(df.columns) == sorted(rel.columns)
    assert len(rows) == len(orows)
    assert digest(df.columns, rows)[0] == digest(rel.columns, orows)[0]
