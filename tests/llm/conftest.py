import duckdb
import pandas as pd
import pytest

from plumbmart.llm.sql import SQL

SF = "/root/testdata/sf0.001"


@pytest.fixture(scope="session")
def oracle():
    """The rows of a query's SQL over the smallest tables, or over given frames in their place."""

    def rows(name, **frames):
        con = duckdb.connect()
        for t in ("documents", "pages", "embeddings", "labels"):
            if t in frames:
                con.register(t, frames[t])
            else:
                con.execute(f"create view {t} as select * from read_parquet('{SF}/{t}.parquet')")
        return con.sql(SQL[name]).df()

    return rows


@pytest.fixture(scope="session")
def same():
    """Whether two frames have the same rows in any order, nulls and floats included."""

    def compare(got, want):
        assert sorted(got.columns) == sorted(want.columns)
        columns = sorted(want.columns)
        value = lambda v: None if pd.isna(v) else v if isinstance(v, str) else round(float(v), 9)
        plain = lambda f: sorted((tuple(map(value, r)) for r in f[columns].itertuples(index=False)), key=str)
        assert plain(got) == plain(want)

    return compare
