"""Every query of the mart against its SQL, on the smallest tables."""

import glob
import os

import duckdb
import pandas as pd
import pytest

from tessera.plans.queries import QUERIES, SQL


@pytest.fixture(scope="module")
def con(sf_dir):
    c = duckdb.connect()
    for f in glob.glob(f"{sf_dir}/*.parquet"):
        c.execute(f"CREATE VIEW {os.path.basename(f)[:-8]} AS SELECT * FROM '{f}'")
    return c


def same(a: pd.DataFrame, b: pd.DataFrame) -> None:
    assert sorted(a) == sorted(b)
    columns = sorted(a)
    a, b = (x[columns].sort_values(columns).reset_index(drop=True) for x in (a, b))
    pd.testing.assert_frame_equal(a, b, check_dtype=False)


@pytest.mark.parametrize("name", sorted(QUERIES))
def test_query_equals_sql(spark, sf_dir, con, name):
    same(QUERIES[name](spark, sf_dir).toPandas(), con.execute(SQL[name]).df())


@pytest.mark.parametrize("name", ["table_rows", "dashboard_composed"])
def test_shared_tables_are_computed_once(spark, sf_dir, name):
    """Queries of many tables find the entities of the line items once, and read them as written."""
    assert not any("lineitem" in f for f in QUERIES[name](spark, sf_dir).inputFiles())
