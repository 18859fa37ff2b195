"""Every query with SQL gives DuckDB's rows on the smallest tables."""

import math

import duckdb
import pandas as pd
import pytest

from histoweave.plans import ORACLE_SQL, QUERIES

SF = "/root/testdata/sf0.001"
TABLES = "region nation customer supplier part orders lineitem events documents embeddings pages benchmark labels conversations".split()


@pytest.fixture(scope="session")
def duck():
    c = duckdb.connect()
    for t in TABLES:
        c.sql(f"create view {t} as select * from '{SF}/{t}.parquet'")
    return c


def value(v) -> str:
    if v is None or v is pd.NaT or v is pd.NA or (isinstance(v, float) and math.isnan(v)):
        return "null"
    if isinstance(v, (bool, int)) or type(v).__name__.startswith(("int", "bool", "uint")):
        return repr(float(int(v)))
    return repr(round(float(v), 6)) if isinstance(v, float) else str(v)


def rows(df) -> list[tuple]:
    return sorted(tuple(value(v) for v in r) for r in df[sorted(df.columns)].itertuples(index=False))


@pytest.mark.parametrize("key", sorted(ORACLE_SQL))
def test_matches_duckdb(spark, duck, key):
    got, want = QUERIES[key](spark, SF).toPandas(), duck.sql(ORACLE_SQL[key]).df()
    assert sorted(got.columns) == sorted(want.columns)
    assert rows(got) == rows(want)


@pytest.mark.parametrize("key", sorted(set(QUERIES) - set(ORACLE_SQL)))
def test_gives_rows(spark, key):
    assert QUERIES[key](spark, SF).limit(1).count() == 1
