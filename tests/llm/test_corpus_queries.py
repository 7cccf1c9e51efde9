"""The registered corpus queries that SQL can express, on the smallest test tables."""

from pathlib import Path

import duckdb
import pandas as pd
import pytest

from lendspan.llm import queries

FOLDER = Path("/root/testdata/sf0.001")

pytestmark = pytest.mark.skipif(not FOLDER.exists(), reason="test tables are not here")


@pytest.mark.parametrize("name", sorted(queries.ORACLES))
def test_query_matches_sql(spark, name):
    connection = duckdb.connect()
    for table in ("documents", "pages", "benchmark", "labels"):
        connection.execute(f"CREATE VIEW {table} AS SELECT * FROM '{FOLDER / table}.parquet'")
    expected = connection.execute(queries.ORACLES[name]).df()
    columns = sorted(expected.columns)
    found = queries.QUERIES[name](spark, str(FOLDER)).toPandas()
    assert sorted(found.columns) == columns and len(found) > 0
    tidy = lambda df: df[columns].sort_values(columns).reset_index(drop=True)
    pd.testing.assert_frame_equal(tidy(found), tidy(expected))


def test_every_operator_has_one_query():
    numbers = [int(name[2:].split("_")[0]) for name in queries.QUERIES]
    assert sorted(numbers) == list(range(1, 14))
