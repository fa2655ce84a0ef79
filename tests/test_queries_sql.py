"""Every query with SQL gives what DuckDB gives."""

import math
from pathlib import Path

import duckdb
import pytest

from starloom.plans import frame_queries, image_queries, mask_queries, state_queries, survey_queries
from starloom.plans.queries import QUERIES, SQL

SF = "/root/testdata/sf0.001"


@pytest.fixture(scope="module")
def duck():
    con = duckdb.connect()
    for p in Path(SF).glob("*.parquet"):
        con.execute(f"CREATE VIEW {p.stem} AS SELECT * FROM '{p}'")
    return con


def plain(value):
    if value is None or (isinstance(value, float) and math.isnan(value)):
        return ""
    return f"{float(value):.5g}" if isinstance(value, (int, float)) and not isinstance(value, bool) else str(value)


@pytest.mark.parametrize("name", sorted(SQL))
def test_same_as_sql(spark, duck, name):
    df = QUERIES[name](spark, SF)
    names = sorted(df.columns)
    ours = sorted(tuple(map(plain, r)) for r in df.select(names).collect())
    found = duck.execute(SQL[name])
    at = sorted(range(len(names)), key=[c[0] for c in found.description].__getitem__)
    assert [found.description[i][0] for i in at] == names
    assert ours == sorted(tuple(plain(r[i]) for i in at) for r in found.fetchall())


def test_all_registered():
    for f in (image_queries.kernel_subtract, survey_queries.aperture_flux, frame_queries.frame_names, state_queries.state_promote, mask_queries.catalogue_mask):
        assert f in QUERIES.values()
