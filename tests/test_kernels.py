"""Array kernels against plain loops: polygons, composition by owner, chunked arrays, zones."""

import json
import math
import random

import numpy as np
import pytest
from pyspark.sql import functions as F

from rastrum.functions import grid as G
from rastrum.functions import zones
from rastrum.functions.bounds import wgs84_bounds
from rastrum.operators import chunks as C
from rastrum.operators import compose, rasterise


def crossed(ring, x, y):
    odd = False
    for (x0, y0), (x1, y1) in zip(ring, ring[1:] + ring[:1]):
        if (y0 > y) != (y1 > y) and x < x0 + (y - y0) * (x1 - x0) / (y1 - y0):
            odd = not odd
    return odd


def meets(x0, y0, x1, y1, c, r):
    """Whether an edge shares a point with a pixel."""
    low, high = 0.0, 1.0
    for d, a, lo in ((x1 - x0, x0, c), (y1 - y0, y0, r)):
        if d == 0:
            if not lo <= a <= lo + 1:
                return False
        else:
            p, q = sorted(((lo - a) / d, (lo + 1 - a) / d))
            low, high = max(low, p), min(high, q)
    return low <= high


def brute_masks(parts, edge):
    points = [p for part in parts for ring in part for p in ring]
    spans = [range(math.floor(min(p[k] for p in points)), math.floor(max(p[k] for p in points)) + 1) for k in (0, 1)]
    out = {}
    for c in spans[0]:
        for r in spans[1]:
            centre = any(sum(crossed(ring, c + 0.5, r + 0.5) for ring in part) % 2 for part in parts)
            touched = centre or any(meets(*a, *b, c, r) for part in parts for ring in part for a, b in zip(ring, ring[1:] + ring[:1]))
            if touched:
                own = out.setdefault((c // edge, r // edge), [set(), set()])
                at = (r % edge) * edge + c % edge
                own[1].add(at)
                if centre:
                    own[0].add(at)
    return out


def random_polygons(n, seed):
    rnd = random.Random(seed)
    out = []
    for k in range(n):
        cx, cy = rnd.uniform(-20, 20), rnd.uniform(-20, 20)
        parts = []
        for _ in range(rnd.randrange(1, 4)):
            ring = [[cx + rnd.uniform(-9, 9), cy + rnd.uniform(-9, 9)] for _ in range(rnd.randrange(3, 8))]
            hole = [[cx + rnd.uniform(-3, 3), cy + rnd.uniform(-3, 3)] for _ in range(3)]
            parts.append([ring, hole] if rnd.random() < 0.5 else [ring])
            cx += rnd.uniform(-12, 12)
        out.append((k, parts))
    return out


def test_thousand_polygons_by_both_rules(spark):
    polygons = random_polygons(1000, 7)
    got = {}
    for r in rasterise.masks(spark.createDataFrame(polygons, f"poly long, parts {rasterise.PARTS}").repartition(8), 8).collect():
        bits = lambda m: set(np.flatnonzero(np.unpackbits(np.frombuffer(m, np.uint8))).tolist())
        got.setdefault(r["poly"], {})[r["x"], r["y"]] = [bits(r["centre"]), bits(r["touched"])]
    assert all(got[k] == brute_masks(parts, 8) for k, parts in polygons)


def test_odd_polygons(spark):
    rows = [(1, [[[[1.0, 1.0], [3.0, 1.0]]]]), (2, []), (3, None), (4, [[[[0.2, 0.2], [0.4, 0.2], [0.3, 0.4]]]]), (5, [[[[1.5, 1.5], [1.5, 1.5], [2.6, 1.5], [2.6, 2.7]]]])]
    got = {r["poly"]: r for r in rasterise.masks(spark.createDataFrame(rows, f"poly long, parts {rasterise.PARTS}"), 4).collect()}
    # Rings of fewer than three points hold nothing; a speck holds no centre, but touches its pixel.
    assert set(got) == {4, 5} and got[4]["centre"] == b"\0\0" and got[4]["touched"] == b"\x80\0"
    assert rasterise.masks(spark.createDataFrame([], f"poly long, parts {rasterise.PARTS}"), 4).collect() == []


def test_geojson(spark):
    square = lambda x: [[[x, 0], [x + 2, 0], [x + 2, 2], [x, 2], [x, 0]]]
    poly = {"type": "Polygon", "coordinates": square(0) + [[[0.5, 0.5], [1.5, 0.5], [1.5, 1.5], [0.5, 0.5]]]}
    multi = {"type": "MultiPolygon", "coordinates": [square(0), square(5)]}
    texts = [poly, multi, {"type": "Feature", "properties": {"a": "{"}, "geometry": poly}, {"type": "FeatureCollection", "features": [{"type": "Feature", "geometry": poly}, {"type": "Feature", "geometry": multi}]}]
    df = spark.createDataFrame([(json.dumps(t),) for t in texts] + [(None,)], "t string")
    got = [r[0] for r in df.select(rasterise.geojson_parts(F.col("t"))).collect()]
    assert [None if p is None else [len(part) for part in p] for p in got] == [[2], [1, 1], [2], [2, 1, 1], None]
    assert got[0][0][1][1] == [1.5, 0.5]
    with pytest.raises(Exception, match="not a polygon: Point"):
        spark.createDataFrame([('{"type":"Point","coordinates":[1,2]}',)], "t string").select(rasterise.geojson_parts(F.col("t"))).collect()


def test_tiles_in_a_hole_are_not_touched(spark):
    big = [[[0.5, 0.5], [99.5, 0.5], [99.5, 99.5], [0.5, 99.5]], [[20.0, 20.0], [80.0, 20.0], [80.0, 80.0], [20.0, 80.0]]]
    got = {(r["tx"], r["ty"]) for r in rasterise.tiles_touched(spark.createDataFrame([(1, [big])], f"poly long, parts {rasterise.PARTS}"), 0.0, 100.0, 10.0).collect()}
    inner = {(x, -1 - y) for x in range(3, 7) for y in range(3, 7)}
    assert got & inner == set() and len(got) >= 100 - 36 and (0, -1) in got and (9, -10) in got


def test_clips_keep_other_columns(spark):
    tiles = spark.createDataFrame([(0, 0, [1, 2, 3, 4], "a"), (1, 0, [5, 6, 7, 8], "b"), (9, 9, [1, 1, 1, 1], "c")], "x long, y long, px array<int>, name string")
    found = rasterise.masks(spark.createDataFrame([(7, [[[[0.6, 0.1], [2.4, 0.1], [2.4, 1.2], [0.6, 1.2]]]])], f"poly long, parts {rasterise.PARTS}"), 2)
    of = lambda touched: {r["name"]: r["px"] for r in rasterise.clipped(tiles, found, -1, touched).collect()}
    assert of(False) == {"a": [-1, 2, -1, 4], "b": [-1, -1, -1, -1]} or of(False) == {"a": [-1, 2, -1, -1], "b": [-1, -1, -1, -1]}
    assert of(True) == {"a": [1, 2, 3, 4], "b": [5, -1, 7, -1]}


def test_composition_across_a_meridian(spark):
    grid = G.Grid(100.0, 4, 0.0, 0.0)
    # 35 E at 38.5 N lies at about easting 674,400 of zone 36.
    x, y = next((x, y) for y in range(10_640, 10_700, 7) for x in range(1676, 1696) if len(np.unique(compose.owners(grid, 36, False, x, y)[0])) == 2)
    lon, lat = compose.owners(grid, 36, False, x, y)
    assert set(lon.ravel().tolist()) == {34, 35} and set(lat.ravel().tolist()) == {38} and (np.diff(lon, axis=1) >= 0).all()
    tiles = spark.createDataFrame([(x, y), (x, y), (x - 1, y)], "x long, y long")
    full = lambda v: [float(v)] * 16
    sources = spark.createDataFrame([(34, 38, x, y, full(34)), (35, 38, x, y, [float("nan")] * 8 + full(35)[:8]), (35, 38, x - 1, y, full(99)), (36, 38, x, y, full(36))], "cell_lon long, cell_lat long, x long, y long, px array<double>")
    got = {r["x"]: r for r in compose.composed(tiles, sources, grid, 36).collect()}
    px = np.array(got[x]["px"]).reshape(4, 4)
    assert got[x]["cells"] == ["N38E034", "N38E035"] and (px[lon == 34] == 34).all()
    assert np.isnan(px[:2][lon[:2] == 35]).all() and (px[2:][lon[2:] == 35] == 35).all()
    assert got[x - 1]["cells"] == [] and np.isnan(got[x - 1]["px"]).all()  # its own cell is absent
    with pytest.raises(Exception, match="N38E03.: 3 pixels"):
        compose.composed(tiles, sources.withColumn("px", F.slice("px", 1, 3)), grid, 36).collect()
    assert compose.composed(tiles.limit(0), sources, grid, 36).collect() == []


def test_chunks_at_seams_and_poles(spark):
    rnd = np.random.default_rng(3)
    lay = C.Layout(7, 10, 12, 3, 4, 5)  # chunks lap over the ends of all three axes
    whole = rnd.random((9, 12, 15)).astype(np.float32)
    absent = {(1, 0, 1), (0, 2, 2)}
    chunks, known = [], np.full((7, 10, 12), np.nan, np.float32)
    for tc in range(3):
        for rc in range(3):
            for cc in range(3):
                if (tc, rc, cc) not in absent:
                    part = whole[tc * 3 : tc * 3 + 3, rc * 4 : rc * 4 + 4, cc * 5 : cc * 5 + 5]
                    chunks.append((tc, rc, cc, part.ravel().tolist()))
                    known[tc * 3 : tc * 3 + 3, rc * 4 : rc * 4 + 4, cc * 5 : cc * 5 + 5] = part[:, :10, :12][: min(3, 7 - tc * 3), : min(4, 10 - rc * 4), : min(5, 12 - cc * 5)]
    tiles = [(0, 0, -2, -3, 0, 7), (1, 0, 8, 10, 2, 5), (2, 0, 4, 25, -1, 99), (3, 0, 10, 0, 0, 7), (4, 0, 0, 0, 5, 5)]
    df = spark.createDataFrame(tiles, "x long, y long, row0 long, col0 long, t0 long, t1 long")
    got = {(r["x"], r["step"]): np.array(r["px"], np.float32).reshape(4, 4) for r in C.assembled(df, spark.createDataFrame(chunks, "tc long, rc long, cc long, data array<float>"), lay, 4).collect()}
    want = {}
    for x, _, row0, col0, t0, t1 in tiles:
        for t in range(max(t0, 0), min(t1, 7)):
            a = np.array([[known[t, row0 + i, (col0 + j) % 12] if 0 <= row0 + i < 10 else np.nan for j in range(4)] for i in range(4)])
            if np.isfinite(a).any():
                want[x, t] = a
    assert got.keys() == want.keys() and all(np.array_equal(got[k], want[k].astype(np.float32), equal_nan=True) for k in want)
    with pytest.raises(Exception, match="isn't 3 x 4 x 5"):
        C.assembled(df, spark.createDataFrame([(0, 0, 0, [1.0])], "tc long, rc long, cc long, data array<float>"), lay, 4).collect()


REGIONS = [
    ([35.9 + 0.02 * i for i in range(11)], [36 + 0.37 * i for i in range(17)]), ([29.9 + 0.02 * i for i in range(11)], [-30 + 0.41 * i for i in range(15)]),
    ([179.9 + 0.02 * i for i in range(5)] + [-180 + 0.02 * i for i in range(5)], [-50 + 4.3 * i for i in range(24)]), ([33 + 0.05 * i for i in range(7)], [-0.05 + 0.011 * i for i in range(10)]),
    ([-0.2 + 0.4 * i for i in range(32)], [55.8 + 0.39 * i for i in range(22)]), ([-0.5 + i for i in range(44)], [71.8 + 0.62 * i for i in range(20)]),
]


@pytest.mark.parametrize("res", [10.0, 60.0])
def test_every_place_is_in_a_kept_tile_of_its_zone(spark, res):
    points = [(lon, lat) for lons, lats in REGIONS for lon in lons for lat in lats]
    df = zones.zone_plan(spark.createDataFrame(points, "lon double, lat double"), "lon", "lat")
    rows = df.select("*", G.mgrs_epsg(F.col("lon"), F.col("lat")).alias("rule")).collect()
    assert len(rows) == len(points) and all(r["epsg"] == r["rule"] for r in rows)
    x, y = G.utm(F.col("lon"), F.col("lat"), F.col("epsg") % 100)
    # A southern zone's northing at a northern place, and the reverse, has the other zone's false northing: here each is in its own.
    tx, ty = G.Grid(res, 256).tile_of_point(x, y)
    w, s, e, n = G.Grid(res, 256).bounds(tx, ty)
    tiles = wgs84_bounds(df.select("lon", "lat", F.concat(F.lit("EPSG:"), F.col("epsg").cast("string")).alias("crs"), w.alias("west"), s.alias("south"), e.alias("east"), n.alias("north")))
    assert zones.canonical(tiles).count() == len(points)


def test_zones_that_do_not_exist_keep_nothing(spark):
    box = lambda crs, w, s: (crs, w, s, w + 1.0, s + 1.0)
    rows = [box("EPSG:32632", 10.0, 75.0), box("EPSG:32633", 10.0, 75.0), box("EPSG:32631", 4.0, 60.0), box("EPSG:32632", 4.0, 60.0), box("EPSG:32732", 10.0, 5.0), box("sinusoidal", 4.0, 60.0), box(None, 1.0, 1.0), ("EPSG:32660", 179.5, 5.0, -179.5, 6.0), ("EPSG:32601", 179.5, 5.0, -179.5, 6.0), ("EPSG:32636", None, None, None, None)]
    got = zones.canonical(spark.createDataFrame(rows, "crs string, lon_w double, lat_s double, lon_e double, lat_n double")).collect()
    assert sorted((r["crs"] or "", r["lon_w"]) for r in got) == [("", 1.0), ("EPSG:32601", 179.5), ("EPSG:32632", 4.0), ("EPSG:32633", 10.0), ("EPSG:32660", 179.5), ("sinusoidal", 4.0)]


def test_buffers_around_points(spark):
    from rastrum.functions import footprints as P

    rows = [(1, 33.0, 38.0), (2, -70.5, -33.4), (3, 179.999, 1.0), (4, 10.0, 88.0), (5, None, 3.0)]
    got = {r["id"]: r["parts"] for r in P.point_buffers(spark.createDataFrame(rows, "id long, lon double, lat double"), 500.0).collect()}
    assert got[4] is None and got[5] is None
    for i, lon, lat in rows[:2]:
        ring = np.array(got[i][0][0])
        wide, high = math.radians(1) * 6378137 * math.cos(math.radians(lat)), 111_000
        away = np.hypot((ring[:, 0] - lon) * wide, (ring[:, 1] - lat) * high)
        assert np.allclose(away, 500 * 2**0.5, rtol=0.01) and ((ring[:, 0] < lon) == [True, False, False, True]).all()
    assert max(x for x, _ in got[3][0][0]) > 180  # the ring goes on over the antimeridian
    aligned = spark.range(1).select(*(G.Grid(10.0, 256).aligned_with(F.lit(v)).alias(str(k)) for k, v in enumerate((5120.0, 5120.002, 5130.0)))).first()
    assert tuple(aligned) == (True, True, False)
