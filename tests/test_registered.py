"""Every registered query of the change-data operators against its SQL on the smallest tables."""

import glob
import math
import os

import duckdb
import pandas as pd
import pytest

from deltaloom.plans import extended, registry  # noqa: F401

DATA = "/root/testdata/sf0.001"
pytestmark = pytest.mark.skipif(not os.path.isdir(DATA), reason="the tables are not here")


@pytest.fixture(scope="module")
def duck():
    con = duckdb.connect()
    for path in glob.glob(f"{DATA}/*.parquet"):
        con.sql(f"CREATE VIEW {os.path.basename(path)[:-8]} AS SELECT * FROM '{path}'")
    return con


def plain(v):
    if v is None or v is pd.NA or v is pd.NaT or (isinstance(v, float) and math.isnan(v)):
        return "null"
    if isinstance(v, bool) or type(v).__name__.startswith("bool"):
        return str(bool(v))
    if isinstance(v, int | float) or type(v).__module__ == "numpy":
        return f"{float(v):.6f}"
    return str(v)


def normal(frame):
    return sorted(tuple(map(plain, r)) for r in frame[sorted(frame.columns)].astype(object).itertuples(index=False))


@pytest.mark.parametrize("name", sorted(registry.ORACLE_SQL))
def test_same_rows_as_sql(spark, duck, name):
    found = registry.QUERIES[name](spark, DATA).toPandas()
    expected = duck.sql(registry.ORACLE_SQL[name]).df()
    assert len(expected), "no rows prove nothing"
    assert sorted(found.columns) == sorted(expected.columns)
    assert normal(found) == normal(expected)


