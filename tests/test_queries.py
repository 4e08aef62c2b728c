"""Every registered query runs; those with oracle SQL return what DuckDB returns."""

import math
from pathlib import Path

import duckdb
import pandas as pd
import pytest

import __spark_entry__ as entry
from tarazi.plans import feeds, feeds_sql, marts, marts_sql, problem_sql, problems

QUERIES, SQL = {**marts.QUERIES, **feeds.QUERIES, **problems.QUERIES}, {**marts_sql.ORACLES, **feeds_sql.ORACLES, **problem_sql.ORACLES}


def canonical(pdf):
    def value(v):
        if v is None or v is pd.NaT or isinstance(v, float) and math.isnan(v):
            return None
        if isinstance(v, (bool, str)):
            return v
        if hasattr(v, "year"):
            return str(pd.Timestamp(v))
        try:
            return float(f"{float(v):.9g}")
        except (TypeError, ValueError):
            return str(v)

    cols = sorted(pdf.columns)
    return sorted((tuple(None if pd.api.types.is_scalar(x) and pd.isna(x) else value(x) for x in r) for r in pdf[cols].itertuples(index=False, name=None)), key=repr)


@pytest.fixture(scope="module")
def duck(folder):
    con = duckdb.connect()
    con.execute("set timezone = 'UTC'")
    for p in Path(folder).glob("*.parquet"):
        con.execute(f"create view {p.stem} as select * from read_parquet('{p}')")
    return con


@pytest.mark.parametrize("name", sorted(SQL))
def test_oracle(spark, folder, duck, name):
    got, want = QUERIES[name](spark, folder).toPandas(), duck.execute(SQL[name]).df()
    assert sorted(got.columns) == sorted(want.columns)
    assert canonical(got) == canonical(want)


@pytest.mark.parametrize("name", sorted(set(QUERIES) - set(SQL)))
def test_runs(spark, folder, name):
    df = QUERIES[name](spark, folder)
    assert df.columns and df.count() >= 0


def test_entry(spark):
    assert entry.entry(spark).count() > 0
    assert set(entry.oracle_sql()) <= set(entry.queries())


def test_found_columns(spark, folder):
    want = {"p1_found": ["batch_id", "row_num"], "p2_found": ["tab", "id1", "id2"], "p3_found": ["entity", "entity_id", "valid_from"], "p4_found": ["store_item_id", "price_point_key", "obs_day"], "p6_found": ["batch_id", "row_num"]}
    for name, columns in want.items():
        assert problems.QUERIES[name](spark, folder).columns == columns
