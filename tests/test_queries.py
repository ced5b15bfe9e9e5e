"""Every registered raster query against its SQL in DuckDB, on the smallest tables."""

import math
import os

import duckdb
import pytest

from rastrum.plans import registry

SF = "/root/testdata/sf0.001"


@pytest.fixture(scope="module")
def duck():
    con = duckdb.connect()
    for f in os.listdir(SF):
        con.execute(f"CREATE VIEW {f.removesuffix('.parquet')} AS SELECT * FROM '{SF}/{f}'")
    return con


def plain(v):
    if v is None or (isinstance(v, float) and math.isnan(v)):
        return None
    return round(float(v), 6) if isinstance(v, (int, float)) and not isinstance(v, bool) else str(v)


@pytest.mark.parametrize("name", sorted(registry.oracle_sql()))
def test_same_as_sql(spark, duck, name):
    df = registry.queries()[name](spark, SF)
    columns = sorted(df.columns)
    got = sorted(repr([plain(v) for v in r]) for r in df.select(*columns).collect())
    want = sorted(repr([plain(v) for v in r]) for r in duck.sql(f"SELECT {', '.join(chr(34) + c + chr(34) for c in columns)} FROM ({registry.oracle_sql()[name]})").fetchall())
    assert got == want


@pytest.mark.parametrize("name", ["tile_codec_roundtrip", "wgs84_bounds_projected"])
def test_without_sql(spark, name):
    rows = registry.queries()[name](spark, SF).collect()
    assert rows
    if name == "tile_codec_roundtrip":
        assert all(r["same"] and r["status"] is None for r in rows)
