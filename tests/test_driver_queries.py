"""Every registered driver query against its DuckDB oracle on sf0.001."""
import math
import os

import pytest

SF = "/root/testdata/sf0.001"
pytestmark = pytest.mark.skipif(not os.path.isdir(SF), reason="driver test data not present")


def _rows(df):
    import pandas as pd
    cols = sorted(df.columns)
    out = []
    for r in df[cols].itertuples(index=False):
        row = []
        for x in r:
            if x is None or x is pd.NA or (isinstance(x, float) and math.isnan(x)):
                row.append(None)
            elif hasattr(x, "item"):
                row.append(x.item())
            else:
                row.append(x)
        out.append(tuple(round(v, 9) if isinstance(v, float) else v for v in row))
    return sorted(out, key=repr)


@pytest.fixture(scope="module")
def duck():
    duckdb = pytest.importorskip("duckdb")
    con = duckdb.connect()
    for t in "region nation customer supplier part orders lineitem events".split():
        con.execute(f"create view {t} as select * from '{SF}/{t}.parquet'")
    return con


def _names():
    from seamstat.plans.queries import ORACLE
    return sorted(ORACLE)


@pytest.mark.parametrize("name", _names())
def test_query_matches_oracle(spark, duck, name):
    from seamstat.plans.queries import ORACLE, QUERIES
    got = QUERIES[name](spark, SF).toPandas()
    exp = duck.execute(ORACLE[name]).df()
    assert sorted(got.columns) == sorted(exp.columns)
    assert _rows(got) == _rows(exp)


def test_entry_smoke(spark):
    import __spark_entry__ as E
    df = E.entry(spark)
    assert df.count() > 0 and "wrc_plus" in df.columns
    assert set(E.oracle_sql()) <= set(E.queries())
