"""Queries with SQL give what DuckDB gives on the same tables."""

from pathlib import Path

import duckdb
import pytest

from starloom.llm.queries import oracle_sql, queries

SF = "/root/testdata/sf0.001"


@pytest.mark.parametrize("name", sorted(oracle_sql()))
def test_same_as_sql(spark, name):
    con = duckdb.connect()
    for p in Path(SF).glob("*.parquet"):
        con.execute(f"CREATE VIEW {p.stem} AS SELECT * FROM '{p}'")
    found = con.execute(oracle_sql()[name])
    names = [c[0] for c in found.description]
    df = queries()[name](spark, SF)
    assert sorted(df.columns) == sorted(names)
    assert sorted(map(tuple, df.select(names).collect())) == sorted(found.fetchall())
