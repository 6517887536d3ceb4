"""Every registered table query against its SQL twin on the smallest tables."""

import math
import os

import duckdb
import pandas as pd
import pytest

from terrakern import plans

DATA = "/root/testdata/sf0.001"


@pytest.fixture(scope="module")
def con():
    c = duckdb.connect()
    for name in os.listdir(DATA):
        c.sql(f"CREATE VIEW {name.split('.')[0]} AS SELECT * FROM '{DATA}/{name}'")
    return c


def plain(value):
    if value is None or value is pd.NaT or value is pd.NA or (isinstance(value, float) and math.isnan(value)):
        return "null"
    if hasattr(value, "year"):
        return str(pd.Timestamp(value))
    return f"{float(value):.9g}" if isinstance(value, int | float) and not isinstance(value, bool) or hasattr(value, "dtype") and value.dtype.kind in "iuf" else str(value)


def rows(frame):
    return sorted(tuple(map(plain, r)) for r in frame[sorted(frame.columns)].astype(object).itertuples(index=False, name=None))


@pytest.mark.parametrize("name", sorted(plans.QUERIES))
def test_equals_sql(spark, con, name):
    got = plans.QUERIES[name](spark, DATA).toPandas()
    if name in plans.ORACLE_SQL:
        assert rows(got) == rows(con.sql(plans.ORACLE_SQL[name]).df())
    else:
        assert len(got)
