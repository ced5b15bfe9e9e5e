"""The store's commit log: nothing is lost or seen by halves, whoever writes meanwhile; merging, codec and catalog on stored tiles."""

import json
import os
import subprocess
import sys
import time

import numpy as np
import pytest
from pyspark.sql import functions as F

from rastrum.operators import blobs as B
from rastrum.sources import codec, store
from rastrum.sources.manifest import Conflict, File, Log

SCHEMA = "band string, date string, x long, y long, crs string, res double, tile_px int, west double, south double, east double, north double, cloud_pct double, scene_id string, size_bytes long, fetched_at long, acq string, valid_px int, data binary"
MONTH = "res_group=10/ym=2024-06"


def tile(scene, x=1, month="06", values=(5, 5, 5), cloud=10.0, at=1, acq="orbit", **more):
    a = np.full((4, 4), -1, "i2")
    a.flat[: len(values)] = values
    data = codec.write(codec.Tile(a, -1, beyond=codec.beyond(**more)))
    return ("B", f"2024-{month}-01", x, 0, "EPSG:32636", 10.0, 4, 0.0, 0.0, 1.0, 1.0, cloud, scene, len(data), at, acq, len(values), data)


@pytest.fixture
def path(tmp_path):
    return f"file://{tmp_path}/tiles"


def put(spark, path, *rows, **k):
    return store.append(spark.createDataFrame(list(rows), SCHEMA), path, **k)


def test_months_are_merged_and_sealed(spark, path):
    put(spark, path, tile("s1", values=[5] * 3), tile("s1", month="07", values=[7] * 3, cloud=None))
    put(spark, path, tile("s2", values=[9] * 10, cloud=30.0, at=2), tile("s1", values=[6] * 3, at=3))
    assert store.open_months(spark, path) == [MONTH, "res_group=10/ym=2024-07"]
    done, left = store.compact(spark, path)
    assert [c.folder for c in done] == [MONTH, "res_group=10/ym=2024-07"] and all(c.sealed for c in done) and left == []
    assert store.compact(spark, path) == ([], []) and store.open_months(spark, path) == []
    r = store.scan(spark, path, "2024-06").first()
    # The second part adds no pixel, so its cloud doesn't weigh.
    assert (r["scene_id"], r["valid_px"], r["cloud_pct"], r["fetched_at"]) == ("s1|s2", 10, 30.0, 3) and r["file"].endswith(".parquet")
    assert codec.decode(r["data"])[0].ravel().tolist() == [9] * 10 + [-1] * 6


def test_rows_appended_during_a_compaction_stay(spark, path, monkeypatch):
    put(spark, path, tile("s1"), tile("s1", x=2))
    put(spark, path, tile("s1", at=2))
    real = Log.write

    def slow(log, rows, batch=None):
        made = real(log, rows, batch)
        if not slow.done:
            slow.done = True
            put(spark, path, *(tile("s9", x=10 + i) for i in range(33)))
        return made

    slow.done = False
    monkeypatch.setattr(Log, "write", slow)
    done, left = store.compact(spark, path)
    assert [c.sealed for c in done] == [False] and left == []
    assert store.scan(spark, path).count() == 2 + 33 and store.open_months(spark, path) == [MONTH]
    store.compact(spark, path)
    assert store.scan(spark, path).count() == 35 and store.open_months(spark, path) == []


def test_a_replaced_month_is_compacted_anew(spark, path, monkeypatch):
    put(spark, path, tile("s1"), tile("s2", x=2))
    put(spark, path, tile("s1", at=2))
    real, tried = Log.replace, []

    def other_first(log, folder, old, files):
        tried.append(folder)
        if len(tried) == 1:  # another process compacts the same month in between
            real(log, folder, log.latest(folder), log.write(log.read({folder: log.latest(folder)}).drop("file"))[folder])
        return real(log, folder, old, files)

    monkeypatch.setattr(Log, "replace", other_first)
    done, left = store.compact(spark, path)
    # The other one sealed the month, so there is nothing left to do; no row came twice or went.
    assert (done, left) == ([], []) and len(tried) == 1 and store.scan(spark, path).count() == 3


def test_conflicts_are_told(spark, path):
    put(spark, path, tile("s1"))
    log = Log(spark, path)
    old = log.latest(MONTH)
    log.replace(MONTH, old, [])
    with pytest.raises(Conflict):
        log.replace(MONTH, old, [File("x", 1, "b")])
    assert log.put_new("_log/x/1.json", "a") and not log.put_new("_log/x/1.json", "b") and log._text("_log/x/1.json") == "a"


def test_unfinished_work_is_not_seen(spark, path):
    put(spark, path, tile("s1"))
    log = Log(spark, path)
    log.write(store.with_partitions(spark.createDataFrame([tile("s2", x=5)], SCHEMA)))  # written, never committed
    assert store.scan(spark, path).count() == 1
    assert store.compact(spark, path)[0][0].files_after == 1 and store.scan(spark, path).count() == 1
    local = path.removeprefix("file://")
    files = lambda: [f for f in os.listdir(f"{local}/{MONTH}") if f.endswith(".parquet")]
    assert len(files()) == 3
    assert log.vacuum(3600) == 0 and len(files()) == 3
    time.sleep(1.1)
    assert log.vacuum(0) > 0 and len(files()) == 1 and store.scan(spark, path).count() == 1


def test_locks_end(spark, path):
    put(spark, path, tile("s1"))
    log = Log(spark, path)
    with store.month_lock(log, MONTH):
        with pytest.raises(store.Locked), store.month_lock(log, MONTH):
            pass
        assert store.compact(spark, path) == ([], [MONTH])
    log.put_new(f"_locks/{MONTH.replace('/', '-')}", json.dumps({"owner": "dead", "until": time.time() - 1}))
    done, left = store.compact(spark, path)
    assert len(done) == 1 and left == []


def test_crowded_months_are_compacted_at_once(spark, path):
    for i in range(3):
        put(spark, path, tile("s1", at=i), compact_above=2)
    assert store.scan(spark, path).first()["fetched_at"] == 2 and store.open_months(spark, path) == []
    put(spark, path, tile("s1", at=9))
    assert store.compact(spark, path, least_batches=3) == ([], [])


def test_two_processes_lose_no_row(spark, path):
    """One process appends while this one appends and compacts."""
    put(spark, path, tile("s0", x=0))
    code = (
        f"import sys; sys.path[:0] = {[os.getcwd(), os.path.join(os.getcwd(), 'tests')]!r}\n"
        "from pyspark.sql import SparkSession\nimport test_store as t\n"
        "s = SparkSession.builder.master('local[1]').config('spark.ui.enabled', 'false').config('spark.sql.shuffle.partitions', '2').getOrCreate()\n"
        f"for i in range(6): t.put(s, {path!r}, *(t.tile('p', x=1000 + 10 * i + k) for k in range(10)))\n"
    )
    other = subprocess.Popen([sys.executable, "-c", code], stdout=subprocess.DEVNULL, stderr=subprocess.DEVNULL)
    n = 0
    while other.poll() is None:
        put(spark, path, tile("q", x=10 + n))
        n += 1
        store.compact(spark, path)
    assert other.returncode == 0
    store.compact(spark, path)
    assert store.scan(spark, path).count() == store.scan(spark, path).select("x").distinct().count() == 1 + 60 + n


def test_blobs_written_anew(spark, path):
    a = np.tile(np.arange(64, dtype="i2"), (64, 1))
    fat = codec.write(codec.Tile(a, -1, beyond=codec.beyond(32636, 0.1, -5.0)), strip_rows=1)
    put(spark, path, tile("s1")[:-1] + (fat,))
    store.compact(spark, path)
    done, _ = store.compact(spark, path, smaller=True)
    r = store.scan(spark, path).first()
    t = codec.read(r["data"])
    assert done[0].bytes_after < done[0].bytes_before and len(r["data"]) == r["size_bytes"] < len(fat)
    assert (t.px == a).all() and t.epsg == 32636 and t.scaling == (0.1, -5.0)


def test_merging_keeps_what_tiles_say(spark):
    one, two = tile("a", values=[1] * 4, epsg=32636, scale=0.5), tile("b", values=[2] * 2, cloud=None)
    rows = [dict(zip([c.split()[0] for c in SCHEMA.split(", ")], r)) for r in (two, one)]
    m = B.merged_parts(rows)
    assert m["data"] == one[-1] and m["cloud_pct"] == 10.0 and m["scene_id"] == "a|b"  # nothing was added: the same bytes
    rows[0]["data"] = codec.write(codec.Tile(np.where(np.arange(16).reshape(4, 4) > 13, 7, -1).astype("i2"), -1))
    m = B.merged_parts(rows)
    t = codec.read(m["data"])
    assert t.epsg == 32636 and t.scaling == (0.5, 0.0) and m["valid_px"] == 6 and t.px.ravel()[[0, 15]].tolist() == [1, 7]
    assert B.merged_parts([{**rows[0], "data": b"junk"}, rows[1]]) is None
    left = B.merged(spark.createDataFrame([tile("a"), tile("b")[:-1] + (b"junk",), tile("c", acq=None), tile("d", acq=None)], SCHEMA))
    assert left.count() == 4


def test_what_counts_as_observed():
    a = np.array([np.nan, 1, -9999])
    assert B.observed(a, None).tolist() == [True] * 3 and B.observed(a, np.nan).tolist() == [False, True, True] and B.observed(a, -9999).tolist() == [True, True, False]


def test_layouts_beyond_the_codec_are_named():
    import struct

    a = np.arange(12, dtype="i2").reshape(3, 4)
    good = codec.encode(a, 0, 10.0, 5.0, 6.0)

    def patched(tag, index, value, letter="d"):
        n, size = struct.unpack_from("<H", good, 8)[0], struct.calcsize(letter)
        for at in range(10, 10 + 12 * n, 12):
            if struct.unpack_from("<H", good, at)[0] == tag:
                where = struct.unpack_from("<I", good, at + 8)[0] if letter == "d" else at + 8
                return good[: where + index * size] + struct.pack(f"<{letter}", value) + good[where + (index + 1) * size :]

    for bad in (patched(33922, 0, 2.0), patched(33922, 1, 3.0), patched(33550, 1, 20.0), patched(277, 0, 3, "H"), patched(259, 0, 5, "H")):
        with pytest.raises(codec.TileError):
            codec.decode(bad)
    for beyond in ({34735: (3, (1, 1, 0, 1, 1025, 0, 1, 2))}, {42112: (2, b'<GDALMetadata><Item name="PIXELTYPE">SIGNEDBYTE</Item></GDALMetadata>\0')}, {305: (2, b"other\0")}):
        with pytest.raises(codec.TileError):
            codec.decode(codec.write(codec.Tile(a, 0, beyond=beyond)))
    assert codec.read(codec.write(codec.Tile(a, 0, (1.0, 2.0, 3.0), codec.beyond(4326, geographic=True)))).epsg == 4326


def test_encoding_checks_numbers(spark):
    df = lambda *px: spark.createDataFrame([(1, list(px))], "x int, px array<int>")
    row = codec.encode_tiles(df(1, None, 3, -4), 2, -1).first()
    assert codec.decode(row["data"])[0].ravel().tolist() == [1, -1, 3, -4]
    for bad in (df(1, 2, 3, 40_000), df(1, 2, 3)):
        with pytest.raises(Exception, match="TileError"):
            codec.encode_tiles(bad, 2, -1).collect()


def test_catalog_is_published_whole(spark, path, tmp_path):
    catalog = f"file://{tmp_path}/catalog"
    assert store.read_catalog(spark, catalog, SCHEMA).count() == 0
    put(spark, path, tile("s1"))
    first = store.rebuild_catalog(spark, path, catalog)
    put(spark, path, tile("s1", x=2))
    assert first.count() == 1
    rows = store.rebuild_catalog(spark, path, catalog).collect()
    assert sorted(r["x"] for r in rows) == [1, 2] and store.read_catalog(spark, catalog).count() == 2
    assert {r["file"] for r in rows} == {r["file"] for r in store.scan(spark, path).collect()} and rows[0].asDict().keys() == set(store.CATALOG)
