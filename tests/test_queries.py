"""Every registered query against its SQL on the smallest test tables."""

from datetime import date
from pathlib import Path

import duckdb
import pandas as pd
import pytest

import __spark_entry__ as registry

FOLDER = Path("/root/testdata/sf0.001")
# the corpus queries have tests of their own
QUERIES, ORACLES = {n: q for n, q in registry.queries().items() if n in registry.BUILDERS}, registry.ORACLES
WITHOUT_SQL = {"model_scores", "model_metrics"}  # a fitted model has no SQL form

pytestmark = pytest.mark.skipif(not FOLDER.exists(), reason="test tables are not here")


@pytest.fixture(scope="module")
def database():
    connection = duckdb.connect()
    for file in FOLDER.glob("*.parquet"):
        connection.execute(f"CREATE VIEW {file.stem} AS SELECT * FROM '{file}'")
    yield connection
    connection.close()


def comparable(df: pd.DataFrame) -> pd.DataFrame:
    df = df[sorted(df.columns)].copy()
    for name in df.columns:
        filled = df[name].dropna()
        if len(filled) and (isinstance(filled.iloc[0], (date, pd.Timestamp))):
            df[name] = pd.to_datetime(df[name]).dt.strftime("%Y-%m-%d")
    return df.sort_values(list(df.columns)).reset_index(drop=True)


def test_only_the_model_has_no_sql():
    assert set(QUERIES) - set(ORACLES) == WITHOUT_SQL
    assert set(ORACLES) <= set(QUERIES)


@pytest.mark.parametrize("name", sorted(ORACLES))
def test_query_matches_sql(spark, database, name):
    found = comparable(QUERIES[name](spark, str(FOLDER)).toPandas())
    expected = comparable(database.execute(ORACLES[name]).df())
    assert len(found) > 0
    pd.testing.assert_frame_equal(found, expected, check_dtype=False, check_exact=True)


def test_entry_has_rows(spark):
    assert registry.entry(spark).count() > 0
