import datetime as dt
import glob
import os

import duckdb
import pandas as pd
import pytest

from millrace.plans import catalogue

DIR = "/root/testdata/sf0.001"


@pytest.fixture(scope="module")
def duck():
    con = duckdb.connect()
    for f in glob.glob(f"{DIR}/*.parquet"):
        con.execute(f"CREATE VIEW {os.path.basename(f)[:-8]} AS SELECT * FROM '{f}'")
    return con


def rows(df: pd.DataFrame) -> list[tuple]:
    def plain(x):
        if x is None or x is pd.NaT or x is pd.NA or (isinstance(x, float) and x != x):
            return "-"
        return f"{float(x):.6f}" if isinstance(x, (int, float)) and not isinstance(x, bool) else str(pd.Timestamp(x)) if isinstance(x, (dt.datetime, pd.Timestamp)) else str(x)

    return sorted(tuple(plain(x) for x in r) for r in df[sorted(df.columns)].itertuples(index=False))


@pytest.mark.parametrize("name", sorted(catalogue.QUERIES))
def test_query(spark, duck, name):
    got = catalogue.QUERIES[name](spark, DIR).toPandas()
    if name in catalogue.SQL:
        want = duck.execute(catalogue.SQL[name]).df()
        assert sorted(got.columns) == sorted(want.columns)
        assert rows(got) == rows(want)
    else:
        assert len(got) > 0 and not got.duplicated(subset=[c for c in got.columns if not got[c].map(lambda x: isinstance(x, (list, dict))).any()]).any()
