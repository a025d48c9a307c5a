from __future__ import annotations

import duckdb
import pytest

import __spark_entry__ as entry_points
from footfall.llm.queries import ORACLE, QUERIES


def test_all_are_registered():
    names = entry_points.queries()
    assert {f"op{n}_" for n in range(1, 14)} == {k.split("_")[0] + "_" for k in QUERIES if k.startswith("op")}
    assert set(QUERIES) | {"pipeline"} <= set(names)
    assert set(ORACLE) <= set(entry_points.oracle_sql())


@pytest.mark.parametrize("name", sorted(ORACLE))
def test_query_equals_sql(spark, sf_dir, name):
    connection = duckdb.connect()
    for table in ("documents", "benchmark", "conversations"):
        connection.execute(f"CREATE VIEW {table} AS SELECT * FROM '{sf_dir}/{table}.parquet'")
    frame = QUERIES[name](spark, sf_dir)
    columns = sorted(frame.columns)
    ours = sorted(tuple(row[c] for c in columns) for row in frame.collect())
    result = connection.execute(ORACLE[name])
    assert sorted(c[0] for c in result.description) == columns
    order = [[c[0] for c in result.description].index(c) for c in columns]
    assert ours == sorted(tuple(row[i] for i in order) for row in result.fetchall())
