"""Every registered query against its SQL, on the smallest tables."""

import duckdb
import pandas as pd
import pytest

import __spark_entry__

SF = "/root/testdata/sf0.001"
TABLES = "region nation customer supplier part orders lineitem events documents embeddings pages benchmark labels conversations".split()


@pytest.fixture(scope="module")
def duck():
    con = duckdb.connect()
    for t in TABLES:
        con.sql(f"create view {t} as select * from '{SF}/{t}.parquet'")
    return con


def canonical(df: pd.DataFrame) -> list[str]:
    def cell(v):
        if isinstance(v, (list, tuple)) or hasattr(v, "tolist") and getattr(v, "ndim", 0):
            return str([cell(x) for x in v])
        if v is None or v is pd.NaT or v is pd.NA or v != v:
            return ""
        if isinstance(v, (int, float)) and not isinstance(v, bool) or hasattr(v, "dtype") and v.dtype.kind in "iuf":
            return f"{float(v):.6f}"
        return str(pd.Timestamp(v)) if hasattr(v, "year") else str(v)

    return sorted("|".join(cell(v) for v in r) for r in df[sorted(df.columns)].itertuples(index=False))


@pytest.mark.parametrize("name", sorted(__spark_entry__.oracle_sql()))
def test_oracle(spark, duck, name):
    got, want = __spark_entry__.queries()[name](spark, SF).toPandas(), duck.sql(__spark_entry__.oracle_sql()[name]).df()
    assert sorted(got.columns) == sorted(want.columns)
    assert canonical(got) == canonical(want)


def test_entry(spark):
    assert __spark_entry__.entry(spark).count() > 0
