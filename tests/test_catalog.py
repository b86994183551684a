"""Every catalogue query against its SQL in DuckDB."""

import glob
import math
import os

import pytest

from siltstone.plans import catalog

SF = os.environ.get("TEST_SF_DIR", "/root/testdata/sf0.001")
pytestmark = pytest.mark.skipif(not os.path.isdir(SF), reason="test tables are not here")


@pytest.fixture(scope="module")
def duck():
    import duckdb

    con = duckdb.connect()
    for f in glob.glob(f"{SF}/*.parquet"):
        con.execute(f"CREATE VIEW {os.path.basename(f)[:-8]} AS SELECT * FROM read_parquet('{f}')")
    return con


def plain(v):
    if isinstance(v, float):
        return "nan" if math.isnan(v) else round(v, 6)
    return v


@pytest.mark.parametrize("name", sorted(catalog.oracle_sql()))
def test_query(spark, duck, name):
    df = catalog.queries()[name](spark, SF)
    cols = sorted(df.columns)
    got = sorted(repr([plain(r[c]) for c in cols]) for r in df.collect())
    rel = duck.sql(catalog.oracle_sql()[name])
    assert sorted(rel.columns) == cols
    at = [rel.columns.index(c) for c in cols]
    assert got == sorted(repr([plain(r[i]) for i in at]) for r in rel.fetchall())


@pytest.mark.parametrize("name", sorted(set(catalog.queries()) - set(catalog.oracle_sql())))
def test_rows(spark, name):
    assert catalog.queries()[name](spark, SF).count() > 0
