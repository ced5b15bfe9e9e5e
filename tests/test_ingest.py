"""Scenes cut into tiles, plans of what to fetch, and flushes of a stream that fail and come again."""

import numpy as np
import pytest

from rastrum.functions import grid as G
from rastrum.operators import cutting
from rastrum.sources import store
from rastrum.streaming import ingest
from test_store import SCHEMA, tile

BLOCK = "scene string, west double, north double, high int, wide int, px array<int>"


def test_blocks_make_tiles(spark):
    rng = np.random.default_rng(2)
    whole = rng.integers(1, 99, (10, 13)).astype(int)
    whole[:4, :5] = -1
    # Two strips of a scene that lap over by a row, whose corner lies 2 pixels west of the anchor and 3 north.
    rows = [("s", -20.0, 30.0, 6, 13, whole[:6].ravel().tolist()), ("s", -20.0, -20.0, 5, 13, whole[5:].ravel().tolist()), ("t", 0.0, 0.0, 1, 1, [-1])]
    got = {(r["scene"], r["x"], r["y"]): (np.array(r["px"]).reshape(4, 4), r["valid_px"]) for r in cutting.cut(spark.createDataFrame(rows, BLOCK), G.Grid(10.0, 4), -1).collect()}
    want = {}
    for (r, c), v in np.ndenumerate(whole):
        gx, gy = c - 2, r - 3
        a = want.setdefault(("s", gx // 4, -(gy // 4) - 1), np.full((4, 4), -1))
        a[gy % 4, gx % 4] = v
    want = {k: v for k, v in want.items() if (v != -1).any()}
    assert got.keys() == want.keys() and all((got[k][0] == want[k]).all() and got[k][1] == (want[k] != -1).sum() for k in want)
    with pytest.raises(Exception, match="off the lattice"):
        cutting.cut(spark.createDataFrame([("s", 3.0, 0.0, 1, 1, [1])], BLOCK), G.Grid(10.0, 4), -1).collect()
    assert cutting.cut(spark.createDataFrame([], BLOCK), G.Grid(10.0, 4), -1).collect() == []


def test_plans(spark):
    grid = G.Grid(10.0, 256)
    # 36 E, where zones 36 and 37 meet: about 763 km east in one, 237 in the other, at 38 N.
    scene = lambda crs, west: ("s1", crs, "B", "2024-06-01", west, 4_200_000.0, west and west + 6000, 4_203_000.0)
    scenes = spark.createDataFrame([scene("EPSG:32636", 760_000.0), scene("EPSG:32637", 220_000.0), scene("EPSG:32636", None)], "scene string, crs string, band string, date string, west double, south double, east double, north double")
    none = spark.createDataFrame([], "band string, date string, x long, y long, scenes string, complete boolean")
    planned = lambda held=none, area=None, zone=True: sorted((r["crs"], r["x"], r["y"]) for r in cutting.plan(scenes, grid, held, area, zone).collect())
    every, own = planned(zone=False), planned()
    assert set(own) < set(every) and any(c == "EPSG:32636" for c, _, _ in own)
    assert not any(c == "EPSG:32637" and x * 2560 + 2560 < 230_000 for c, x, _ in own)
    x, y = own[0][1:]
    assert planned(spark.createDataFrame([("B", "2024-06-01", x, y, "s0|s1", False)], none.schema)) == own[1:]
    assert planned(spark.createDataFrame([("B", "2024-06-01", x, y, "s0", True)], none.schema)) == own[1:]
    assert planned(spark.createDataFrame([("B", "2024-06-01", x, y, "s0", False)], none.schema)) == own
    assert planned(area=spark.createDataFrame([(x, y)], "tx long, ty long")) == own[:1]


def test_a_flush_that_comes_again_adds_nothing(spark, tmp_path, monkeypatch):
    path = f"file://{tmp_path}/tiles"
    sink = ingest.append_to(spark, path, "run", compact_above=3)
    batch = lambda *rows: spark.createDataFrame(list(rows), SCHEMA)
    both = batch(tile("s1"), tile("s1", month="07"))
    real, calls = store.Log.add, []

    def failing(log, folder, files):
        calls.append(folder)
        if len(calls) == 2:
            raise OSError("disk full")
        return real(log, folder, files)

    monkeypatch.setattr(store.Log, "add", failing)
    with pytest.raises(OSError):
        sink(both, 0)
    assert store.scan(spark, path).count() == 1  # one month has its part, the other has not
    sink(both, 0)
    assert store.scan(spark, path).count() == 2
    sink(both, 0)
    assert store.scan(spark, path).count() == 2
    for k in range(1, 4):
        sink(batch(tile("s1", at=k + 1)), k)
    assert store.scan(spark, path, "2024-06").count() == 1 and store.open_months(spark, path) == ["res_group=10/ym=2024-07"]
