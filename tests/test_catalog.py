"""Every registered query against its SQL on the smallest test tables."""

import os
import sys

import duckdb
import pytest

sys.path.insert(0, os.path.dirname(os.path.dirname(os.path.abspath(__file__))))
from check_queries import rows  # noqa: E402
from haulbook.catalog import ORACLES, QUERIES  # noqa: E402
from haulbook.sources.tables import TABLES  # noqa: E402

SMALL = os.environ.get("TEST_SF_DIR", "/root/testdata/sf0.001")
pytestmark = pytest.mark.skipif(not os.path.isdir(SMALL), reason="no test tables")


@pytest.fixture(scope="module")
def duck():
    con = duckdb.connect()
    for t in TABLES:
        con.execute(f"create view {t} as select * from '{SMALL}/{t}.parquet'")
    return con


def test_every_query_has_sql():
    assert set(QUERIES) == set(ORACLES)


@pytest.mark.parametrize("name", sorted(QUERIES))
def test_query(spark, duck, name):
    df = QUERIES[name](spark, SMALL)
    cur = duck.execute(ORACLES[name])
    want = cur.fetchall()
    assert sorted(df.columns) == sorted(d[0] for d in cur.description)
    assert rows(df.columns, [tuple(r) for r in df.collect()]) == rows([d[0] for d in cur.description], want)
