"""Places in groups that span files; waves, levels and SQL functions on odd input."""

import numpy as np
import pytest
from pyspark.sql import functions as F

from rastrum import sql
from rastrum.functions import grid as G
from rastrum.operators import pyramid, ranks, waves
from rastrum.sources import codec, store


def test_places_over_many_files(spark):
    rows = [(g, k, k % 7) for g, n in (("a", 3000), ("b", 1), (None, 40)) for k in range(n)]
    df = spark.createDataFrame(rows, "g string, k int, v int").repartition(5)
    got = {(r["g"], r["k"]): r["place"] for r in ranks.ranked(df, ["g"], [F.desc("v"), "k"]).collect()}
    for g in ("a", "b", None):
        own = sorted((r for r in rows if r[0] == g), key=lambda r: (-r[2], r[1]))
        assert [got[g, k] for _, k, _ in own] == list(range(1, len(own) + 1))
    after = {(r["g"], r["k"]): r["next"] for r in ranks.with_next(df, ["g"], ["k"], "v").collect()}
    assert after["a", 10] == 11 % 7 and after["a", 2999] is None and after["b", 0] is None and after[None, 38] == 39 % 7
    assert ranks.ranked(df.limit(0), ["g"], ["k"]).collect() == []


def test_levels(spark):
    px = np.arange(64, dtype=np.int32).reshape(8, 8)
    px[:4, :4] = -1
    px[4:, :4] = [[-1, -1, -1, -1]] * 3 + [[-1, 5, 6, -1]]
    small = pyramid.reduced(px, -1)
    assert small[0, 0] == -1 and small[1, 0] == 6 and small[0, 1] == int(np.floor(px[:4, 4:].mean() + 0.5))
    tiles = spark.createDataFrame([(5, 2, px.ravel().tolist()), (4, 2, [3] * 64)], "x long, y long, px array<int>")
    got = pyramid.coarser(tiles, 8, -1).collect()
    a = np.array(got[0]["px"]).reshape(8, 8)
    assert len(got) == 1 and (got[0]["x"], got[0]["y"]) == (1, 0) and (a[4:6, 2:4] == small).all() and (a[4:6, :2] == 3).all() and (a[:4] == -1).all()
    assert [pyramid.level_for(10.0, w, 2) for w in (1.0, 10.0, 39.9, 40.0, 160.0, 1e9)] == [0, 0, 0, 1, 2, 2]


def test_only_one_level_is_read(spark, tmp_path):
    tiles = spark.createDataFrame([(x, y, [x + y] * 64) for x in range(8) for y in range(4)], "x long, y long, px array<int>")
    pyramid.publish(tiles, f"{tmp_path}/p", 8, -1, 2)
    read = pyramid.read(spark, f"{tmp_path}/p", 10.0, 50.0, 2)
    assert read.count() == 2 and {r["level"] for r in read.collect()} == {1}
    files = read.inputFiles()
    assert files and all("/level=1/" in f for f in read.select(F.col("_metadata.file_path")).distinct().rdd.map(lambda r: r[0]).collect())
    assert "PartitionFilters: [isnotnull(level" in read._jdf.queryExecution().executedPlan().toString()


def test_waves(spark):
    kind = "x long, y long, scene_id string, px array<int>"
    stored = spark.createDataFrame([(0, 0, "a|b", [8, 0, 4, 0]), (0, 0, "c", [1, 1, 1, 0]), (1, 0, "c", [9] * 4), (2, 0, None, [9] * 4)], kind)
    masks = waves.rebuilt(stored, "b")
    assert [(r["x"], r["px"]) for r in masks.collect()] == [(0, [1, 1, 1, 0])]  # the fullest part first, though it isn't the scene's
    fresh = spark.createDataFrame([(1, 0, [4, 4, 8, 8])], "x long, y long, px array<int>")
    both = waves.fresh_first(fresh, masks)
    band, mask = G.Grid(10.0, 2), G.Grid(20.0, 2)
    tiles = spark.createDataFrame([(x, y) for x in range(6) for y in range(2)], "x long, y long")
    seen = {(r["x"], r["y"]): (r["n_valid"], r["cloud_pct"]) for r in waves.judged(tiles, both, band, mask).collect()}
    # Rows of a mask count from the north: its first row is the upper tiles'.
    assert seen[0, 1] == (4, 100.0) and seen[1, 0] == (0, None) and seen[2, 1] == (4, 0.0) and seen[3, 0] == (4, 100.0) and seen[5, 1] == (0, None)
    judged = waves.judged(tiles, both, band, mask)
    assert sorted(map(tuple, waves.second_wave(tiles, judged, 50.0).collect())) == [(2, 1), (3, 1)]
    assert [r[0] for r in spark.createDataFrame([("SCL",), ("B04",)], "b string").select(waves.wave_of(F.col("b"), ("SCL",))).collect()] == [1, 2]


def test_sql_functions_on_odd_blobs(spark):
    blob = codec.write(codec.Tile(np.array([[1, -1], [3, 4]], "i2"), -1, beyond=codec.beyond(32636, 0.5, 2.0)))
    columns = "file string, band string, date string, x long, y long, crs string, west double, south double, east double, north double, cloud_pct double, scene_id string, size_bytes long, acq string, valid_px int"
    rows = [("f", "B", "2024-06-01", 1, 1, "c", 179.0, 0.0, -179.0, 1.0, None, "s", 1, None, 3), ("f", "B", "2024-07-01", 2, 1, "c", 1.0, 0.0, 2.0, 1.0, None, "s", 1, None, 3)]
    sql.register(spark, spark.createDataFrame(rows, columns), spark.createDataFrame([(1, blob), (2, b"junk"), (3, None)], "x long, data binary"))
    got = {r["x"]: tuple(r)[1:] for r in spark.sql("SELECT x, tile_value(data, 0, 0) a, tile_value(data, 0, 1) b, tile_value(data, 5, 0) c, tile_decode(data) d FROM tiles").collect()}
    assert got == {1: (1.0, None, None, [1.0, -1.0, 3.0, 4.0]), 2: (None,) * 4, 3: (None,) * 4}
    assert spark.sql("SELECT tile_scaling(data) FROM tiles WHERE x = 1").first()[0] == [0.5, 2.0]
    box = lambda *a: [r["x"] for r in spark.sql(f"SELECT x FROM tiles_for_bbox({', '.join(map(str, a))})").collect()]
    assert box("'B'", "'2024'", "-179.5D", "0D", "-179.2D", "1D") == [1] and box("'B'", "'2024-07'", "-180D", "-90D", "180D", "90D") == [2] and box("'Q'", "''", "-180D", "-90D", "180D", "90D") == []


def test_reading_by_the_catalog(spark, tmp_path):
    from test_store import put, tile

    path = f"file://{tmp_path}/tiles"
    put(spark, path, tile("s1"), tile("s1", x=2, month="07"))
    catalog = store.rebuild_catalog(spark, path, f"file://{tmp_path}/catalog")
    keys = ["band", "date", "x", "y", "crs", "acq", "scene_id"]
    june = catalog.where("date like '2024-06%'")
    found = store.read_rows(spark, path, june, keys)
    assert [r["x"] for r in found.collect()] == [1] and found.first()["data"]
    assert store.read_rows(spark, path, catalog.where("x > 90"), keys).count() == 0
    with pytest.raises(Exception, match="no stored tile"):
        store.read_rows(spark, path, june.withColumn("x", F.col("x") + 7), keys).collect()
