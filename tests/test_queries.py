"""Registered queries against DuckDB on the smallest tables, the numbered operators apart."""

import duckdb
import pandas as pd
import pytest

import __spark_entry__ as entry

SF = "/root/testdata/sf0.001"
NAMES = [n for n in entry.queries() if n in entry.oracle_sql() and not n.startswith("op")]


@pytest.fixture(scope="session")
def duck():
    con = duckdb.connect()
    for t in "region nation customer supplier part orders lineitem events documents embeddings pages benchmark labels conversations".split():
        con.execute(f"CREATE VIEW {t} AS SELECT * FROM '{SF}/{t}.parquet'")
    return con


def _rows(frame: pd.DataFrame) -> list:
    def plain(v):
        if v is None or v is pd.NA or v != v:
            return ""
        return f"{round(float(v), 6) + 0.0:.6f}" if isinstance(v, (int, float)) or hasattr(v, "dtype") and v.dtype.kind in "iuf" else str(v)[:10] if hasattr(v, "year") else str(v)

    return sorted(tuple(plain(v) for v in row) for row in frame[sorted(frame.columns)].itertuples(index=False))


@pytest.mark.parametrize("name", NAMES)
def test_query_matches_sql(spark, duck, name):
    assert _rows(entry.queries()[name](spark, SF).toPandas()) == _rows(duck.execute(entry.oracle_sql()[name]).df())


def test_entry(spark):
    assert entry.entry(spark).count() > 0
