"""Every catalogue query against its SQL on the same parquet files."""

import os
from pathlib import Path

import duckdb
import pandas as pd
import pytest

from __spark_entry__ import entry, oracle_sql, queries
from helio.plans.catalogue import QUERIES

SF_DIR = os.environ.get("ORACLE_SF_DIR", "/root/testdata/sf0.01")
INTEGERS = {"int": "INTEGER", "bigint": "BIGINT"}


@pytest.fixture(scope="module")
def duck():
    con = duckdb.connect()
    for path in Path(SF_DIR).glob("*.parquet"):
        con.execute(f"CREATE VIEW {path.stem} AS SELECT * FROM read_parquet('{path}')")
    return con


def canonical(frame: pd.DataFrame) -> list[tuple]:
    frame = frame[sorted(frame.columns)]
    rows = [tuple(None if pd.isna(v) else v for v in row) for row in frame.itertuples(index=False)]
    return sorted(rows, key=lambda row: tuple((v is None, str(v)) for v in row))


def test_every_query_has_an_oracle():
    # text queries that SQL cannot express are tested with their operators
    assert QUERIES.keys() <= oracle_sql().keys() <= queries().keys()


def test_entry(spark):
    assert entry(spark).count() == 30


@pytest.mark.parametrize("name", oracle_sql())
def test_oracle(spark, duck, name):
    found = queries()[name](spark, SF_DIR)
    relation = duck.sql(oracle_sql()[name])
    types = dict(zip(relation.columns, map(str, relation.types), strict=True))
    for column, dtype in found.dtypes:
        if dtype in INTEGERS:
            assert types[column] == INTEGERS[dtype], column
    expected = relation.df()
    actual = found.toPandas()
    assert sorted(actual.columns) == sorted(expected.columns)
    assert len(actual) == len(expected)
    for column, dtype in found.dtypes:
        if dtype == "date":
            actual[column] = pd.to_datetime(actual[column])
            expected[column] = pd.to_datetime(expected[column])
    assert canonical(actual) == canonical(expected)
