"""Every registered query against its DuckDB oracle on the smallest tables."""

import os

import duckdb
import pytest

import __spark_entry__ as entry
from bookshift.plans.catalog import ORACLE, QUERIES
from tools.oracle_check import TABLES, key, norm

SF = os.environ.get("BOOKSHIFT_TEST_SF", "/root/testdata/sf0.001")
pytestmark = pytest.mark.skipif(not os.path.isdir(SF), reason="driver tables not present")

NAMES = sorted(QUERIES)


@pytest.fixture(scope="module")
def con():
    c = duckdb.connect()
    for t in TABLES:
        p = f"{SF}/{t}.parquet"
        if os.path.exists(p):
            c.execute(f"CREATE VIEW {t} AS SELECT * FROM read_parquet('{p}')")
    return c


def test_every_query_has_an_oracle():
    missing = set(QUERIES) - set(ORACLE)
    assert not missing, missing


@pytest.mark.parametrize("name", NAMES)
def test_query_matches_oracle(spark, con, name):
    sdf = QUERIES[name](spark, SF)
    srows = [tuple(r) for r in sdf.collect()]
    rel = con.execute(ORACLE[name])
    dcols = [d[0] for d in rel.description]
    assert sorted(sdf.columns) == sorted(dcols)
    order = [dcols.index(c) for c in sdf.columns]
    drows = [tuple(r[i] for i in order) for r in rel.fetchall()]
    assert len(srows) == len(drows)
    a = sorted((tuple(norm(x) for x in r) for r in srows), key=key)
    b = sorted((tuple(norm(x) for x in r) for r in drows), key=key)
    assert a == b


def test_entry_smoke(spark):
    df = entry.entry(spark)
    assert df.columns == ["id", "copies", "payload"]
    assert df.count() > 0
