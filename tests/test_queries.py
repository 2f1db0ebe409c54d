"""Every query with checking SQL against DuckDB, over the smallest tables."""

from pathlib import Path

import duckdb
import pandas as pd
import pytest

from tramline.plans import queries

DATA = Path("/root/testdata/sf0.001")
TABLES = "region nation customer supplier part orders lineitem events".split()


@pytest.fixture(scope="module")
def duck():
    if not DATA.exists():
        pytest.skip("no test data here")
    con = duckdb.connect()
    for t in TABLES:
        con.execute(f"CREATE VIEW {t} AS SELECT * FROM read_parquet('{DATA}/{t}.parquet')")
    return con


def rows(df):
    def plain(v):
        if v is None or pd.isna(v):
            return None
        if isinstance(v, str | bool):
            return str(v)
        return round(float(v), 5) if isinstance(v, int | float) or hasattr(v, "dtype") else pd.Timestamp(v).isoformat()

    return sorted((tuple(map(plain, r)) for r in df[sorted(df.columns)].itertuples(index=False)), key=repr)


@pytest.mark.parametrize("name", sorted(queries.SQL))
def test_query(spark, duck, name):
    got, expected = queries.QUERIES[name](spark, str(DATA)).toPandas(), duck.execute(queries.SQL[name]).df()
    assert sorted(got.columns) == sorted(expected.columns)
    assert rows(got) == rows(expected)
