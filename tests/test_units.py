"""Codec, lattices and predicates on small cases."""

import numpy as np
import pytest
from pyspark.sql import functions as F

from rastrum.functions import grid as G
from rastrum.operators import raster as R
from rastrum.operators import tiles as T
from rastrum.sources import codec


@pytest.mark.parametrize("kind", ["u1", "i1", "u2", "i2", "u4", "i4", "f4", "f8"])
@pytest.mark.parametrize("shape", [(1, 1), (7, 5), (64, 64)])
def test_codec_keeps_every_bit(kind, shape):
    rng = np.random.default_rng(1)
    a = rng.integers(0, 255, shape).astype(kind) if kind[0] in "ui" else rng.standard_normal(shape).astype(kind)
    if kind[0] == "f":
        a[0, 0] = -0.0
        a.flat[-1] = np.nan
    got, nodata, place = codec.decode(codec.encode(a, -1, 10.0, 300000.0, 4100000.0))
    assert got.dtype == a.dtype and got.tobytes() == a.tobytes() and nodata == -1 and place == (10.0, 300000.0, 4100000.0)


def test_codec_names_damage():
    blob = codec.encode(np.arange(256, dtype="u2").reshape(16, 16))
    for bad in (b"", blob[:50], b"MM" + blob[2:], blob[:-4], blob[:8] + b"\xff\xff" + blob[10:]):
        with pytest.raises(codec.TileError):
            codec.decode(bad)


def test_bbox_is_checked():
    for box in ((1, 0, 0, 1), (0, 1, 1, 0), (float("nan"), 0, 1, 1)):
        with pytest.raises(ValueError):
            T.bbox_intersects(box)


def test_grid(spark):
    df = spark.createDataFrame([(-0.1, -0.1), (0.0, 0.0), (49.9, 25.0)], "x double, y double")
    x, y = G.Grid(0.25, 100).tile_of_point(F.col("x"), F.col("y"))
    assert [tuple(r) for r in df.select(x, y).collect()] == [(-1, -1), (0, 0), (1, 1)]
    tiles = G.Grid(20.0, 256).tiles(spark.sql("SELECT 0D w, 0D s, 10240D e, 5120D n UNION ALL SELECT 5D, 5D, 5D, 5D"), F.col("w"), F.col("s"), F.col("e"), F.col("n"))
    assert sorted((r["tx"], r["ty"]) for r in tiles.where("e > 5").collect()) == [(0, 0), (1, 0)]


def test_zones_and_projections(spark):
    df = spark.createDataFrame([(5.0, 60.0), (20.0, 75.0), (179.9, 10.0), (-180.0, -10.0), (33.0, 38.0)], "lon double, lat double")
    lon, lat = F.col("lon"), F.col("lat")
    assert [r[0] for r in df.select(G.mgrs_epsg(lon, lat)).collect()] == [32632, 32633, 32660, 32701, 32636]
    x, y = G.sinusoidal(lon, lat)
    back = df.withColumns({"sx": x, "sy": y})
    a, b = G.sinusoidal_inverse(F.col("sx"), F.col("sy"))
    assert all(abs(r[0] - r["lon"]) < 1e-9 and abs(r[1] - r["lat"]) < 1e-9 for r in back.select(a, b, "lon", "lat").collect())
    e, n = G.utm(F.lit(33.0), F.lit(38.0), F.lit(36))
    r = df.limit(1).select(e, n).first()
    assert abs(r[0] - 500000) < 1e-6 and abs(r[1] - 4205848.0) < 300


def test_nodata(spark):
    df = spark.createDataFrame([(1.0,), (float("nan"),), (0.0,)], "v double")
    seen = lambda nodata: [r[0] for r in df.select(R.observed(F.col("v"), nodata)).collect()]
    assert seen(None) == [True] * 3 and seen(float("nan")) == [True, False, True] and seen(0.0) == [True, True, False]


def test_merge_ignores_order(spark):
    rows = [(0, s, p, -9999 if (p + k) % 3 else k * 100 + p) for k, s in enumerate(("a", "b", "c")) for p in range(9)]
    one = sorted(map(tuple, R.merge(spark.createDataFrame(rows, "tile_id long, scene_id string, pos int, dn int"), -9999).collect()))
    two = sorted(map(tuple, R.merge(spark.createDataFrame(rows[::-1], "tile_id long, scene_id string, pos int, dn int"), -9999).collect()))
    assert one == two and [r[2] for r in one] != [-9999] * 9


def test_projected_bounds(spark):
    from rastrum.functions import bounds as B

    # Ground inside a tile lies inside its bounds; the inverse undoes the forward series.
    e, n = G.utm(F.col("lon"), F.col("lat"), F.lit(36))
    points = spark.createDataFrame([(30.0 + i % 7, -60.0 + 5 * i) for i in range(28)], "lon double, lat double")
    for r in points.select("lon", "lat", e.alias("e"), n.alias("n")).collect():
        lon, lat = B.utm_inverse(r["e"], r["n"], 36, r["lat"] < 0)
        assert abs(lon - r["lon"]) < 1e-7 and abs(lat - r["lat"]) < 1e-7
    tiles = spark.createDataFrame([("EPSG:32660", 832000.0, 200000.0, 834560.0, 202560.0), ("sinusoidal", 0.0, 0.0, 222389.85, 222389.85), ("EPSG:9999", 0.0, 0.0, 1.0, 1.0), (None, 0.0, 0.0, 1.0, 1.0)], "crs string, west double, south double, east double, north double")
    got = B.wgs84_bounds(tiles).collect()
    assert got[0]["lon_w"] > 179 and got[0]["lon_e"] < got[0]["lon_w"]
    assert abs(got[1]["lon_w"]) < 1e-9 and abs(got[1]["lon_e"] - 2.0012) < 1e-3 and abs(got[1]["lat_n"] - 2.0) < 1e-4
    assert got[2]["lon_w"] is None and got[3]["lon_w"] is None


def test_codec_reads_strips_and_names_their_damage():
    a = np.arange(256 * 40, dtype="u2").reshape(256, 40)
    blob = codec.encode(a, 0, 10.0, 1.0, 2.0, strip_rows=100)
    got, nodata, place = codec.decode(blob)
    assert (got == a).all() and nodata == 0 and place == (10.0, 1.0, 2.0) and len(blob) > len(codec.encode(a, 0, 10.0, 1.0, 2.0))
    for bad in (blob[:-1], blob + b"", codec.encode(a, strip_rows=100)[:-30]):
        if bad != blob:
            with pytest.raises(codec.TileError):
                codec.decode(bad)


def test_bounds_of_outlines():
    from rastrum.functions import bounds as Z

    walk = lambda *p: Z.bounds_of(np.array([[q[0] for q in p]], float), np.array([[q[1] for q in p]], float))[0].tolist()
    assert walk((1, 2), (5, 2), (5, 4), (1, 4)) == [1, 2, 5, 4]
    assert walk((179, 2), (-178, 2), (-178, 4), (179, 4)) == [179, 2, -178, 4]
    assert walk((-150, 70), (-60, 80), (30, 75), (120, 72)) == [-180, 70, 180, 90]
    assert walk((120, -72), (30, -75), (-60, -80), (-150, -70)) == [-180, -90, 180, -70]
    assert np.isnan(walk((1, 2), (np.nan, 2), (5, 4), (1, 4))).all()


def test_matches_are_checked(spark):
    keys = ["band", "acq"]
    rows = spark.createDataFrame([("A", None), ("B", "o")], "band string, acq string")
    tiles = lambda *r: spark.createDataFrame(list(r), "band string, acq string, data int")
    assert sorted(r["data"] for r in T.checked_matches(rows, tiles(("A", None, 1), ("B", "o", 2), ("C", None, 3)), keys).collect()) == [1, 2]
    for stored in (tiles(("A", None, 1)), tiles(("A", None, 1), ("A", None, 4), ("B", "o", 2))):
        with pytest.raises(Exception, match="a catalog row has"):
            T.checked_matches(rows, stored, keys).collect()


def test_required_fields_are_named(spark):
    from rastrum.functions import scalars as S

    df = spark.createDataFrame([("s1", None)], "id string, orbit string")
    with pytest.raises(Exception, match="s1 lacks the property 'orbit'"):
        df.select(S.required(F.col("orbit"), F.col("id"), "orbit")).collect()
