"""Every registered core query against its SQL in DuckDB, on the smallest tables."""

import duckdb
import pandas as pd
import pytest

from roadweave.queries import oracle_sql, queries

TABLES = "region nation customer supplier part orders lineitem events documents embeddings pages benchmark labels conversations".split()


@pytest.fixture(scope="module")
def duck(sf):
    con = duckdb.connect()
    con.execute("set timezone='UTC'")
    for t in TABLES:
        con.execute(f"create view {t} as select * from '{sf}/{t}.parquet'")
    return con


def rows(df: pd.DataFrame) -> list[tuple]:
    text = lambda v: str(list(v)) if hasattr(v, "__iter__") and not isinstance(v, str) else "" if pd.isna(v) else f"{v:.6g}" if isinstance(v, float) else str(v)
    return sorted(tuple(text(v) for v in r) for r in df[sorted(df.columns)].astype(object).itertuples(index=False))


@pytest.mark.parametrize("name", sorted(oracle_sql()))
def test_against_sql(spark, duck, sf, name):
    ours, theirs = queries()[name](spark, sf).toPandas(), duck.execute(oracle_sql()[name]).df()
    assert sorted(ours.columns) == sorted(theirs.columns)
    assert rows(ours) == rows(theirs)


def test_all_queries_have_sql_or_a_reason():
    assert set(queries()) - set(oracle_sql()) == {"graph_cleanup", "split_propagation", "region_graphs", "lane_search"}


def test_entry(spark):
    import __spark_entry__ as e

    assert e.entry(spark).count() > 0
    assert set(e.oracle_sql()) <= set(e.queries())
