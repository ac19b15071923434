"""Every registered query with SQL gives DuckDB's rows on the smallest tables."""

from pathlib import Path

import duckdb
import pandas as pd
import pytest

from tidemark.plans import registry

SF = "/root/testdata/sf0.001"


def _rows(df: pd.DataFrame) -> list[tuple]:
    def plain(v):
        if v is None or v is pd.NaT or v is pd.NA or (isinstance(v, float) and v != v):
            return ""
        if type(v).__name__.startswith("bool"):
            return str(bool(v))
        return v if isinstance(v, str) else f"{float(v):.5g}"

    return sorted(tuple(plain(v) for v in row) for row in df[sorted(df.columns)].astype(object).itertuples(index=False, name=None))


@pytest.fixture(scope="module")
def duck():
    con = duckdb.connect()
    for path in Path(SF).glob("*.parquet"):
        con.execute(f"CREATE VIEW {path.stem} AS SELECT * FROM '{path}'")
    return con


@pytest.mark.parametrize("name", sorted(registry.ORACLE_SQL))
def test_against_sql(spark, duck, name):
    got, want = registry.QUERIES[name](spark, SF).toPandas(), duck.sql(registry.ORACLE_SQL[name]).df()
    assert sorted(got.columns) == sorted(want.columns)
    assert _rows(got) == _rows(want)


def test_flagship_runs(spark):
    import __spark_entry__

    assert __spark_entry__.entry(spark).columns
