"""Every named query against its SQL, on the given tables."""

from __future__ import annotations

from pathlib import Path

import duckdb
import pandas as pd
import pytest

import __spark_entry__ as entry_points
from footfall.plans import CATALOGUE as QUERIES
from footfall.plans import ORACLE



@pytest.fixture(scope="module")
def duck(sf_dir):
    connection = duckdb.connect()
    for file in sorted(Path(sf_dir).glob("*.parquet")):
        connection.execute(f"CREATE VIEW {file.stem} AS SELECT * FROM '{file}'")
    return connection


def comparable(frame: pd.DataFrame) -> list[tuple]:
    frame = frame[sorted(frame.columns)]
    rows = [tuple(_plain(v) for v in row) for row in frame.itertuples(index=False)]
    return sorted(rows, key=repr)


def _plain(value):
    if hasattr(value, "isoformat"):
        return value.isoformat()[:10]
    return value.item() if hasattr(value, "item") else value


def test_every_query_has_sql_or_another_test():
    assert set(QUERIES) == set(ORACLE)
    assert set(QUERIES) <= set(entry_points.queries())


@pytest.mark.parametrize("name", sorted(ORACLE))
def test_query_equals_sql(spark, sf_dir, duck, name):
    ours = QUERIES[name](spark, sf_dir).toPandas()
    result = duck.execute(ORACLE[name]).df()
    assert sorted(ours.columns) == sorted(result.columns)
    assert comparable(ours) == comparable(result)
    assert len(ours) > 0 or name == "cvr_over_100"


def test_entry_has_rows(spark):
    assert entry_points.entry(spark).count() > 0
