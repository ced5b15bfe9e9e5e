"""Pages of items: repeated ones, lone ones, odd ones."""

import json

import pytest

from rastrum.sources import stac


def item(name, asset="red", **properties):
    return {"type": "Feature", "id": name, "properties": {"datetime": "2024-06-01T10:00:00Z", "platform": "Sentinel-1A", "odd": {"deep": [1]}} | properties, "assets": {asset: {"href": f"x/{name}", "extra": True}}, "links": []}


def pages(spark, *texts):
    return spark.createDataFrame([(f"p{i}", t if isinstance(t, str) else json.dumps(t)) for i, t in enumerate(texts)], "page string, text string")


def collection(*items):
    return {"type": "FeatureCollection", "features": list(items), "links": [{"rel": "next", "href": "?page=2"}]}


def test_items_come_once_and_are_read(spark):
    square = {"proj:transform": [10.0, 0.0, 500.0, 0.0, -10.0, 900.0], "proj:shape": [4, 6]}
    df = pages(spark, collection(item("a", **{"sat:absolute_orbit": 7, "eo:cloud_cover": 12.5, "proj:epsg": 32636} | square), item("b", "other")), collection(item("a", **{"eo:cloud_cover": 99}), item("c", **{"s2:datatake_id": "GS2C_1_N05.11", "proj:code": "EPSG:32637"})), item("d", **{"landsat:wrs_path": "175", "platform": "LANDSAT_9"} | square | {"proj:transform": [10.0, 1.0, 500.0, 0.0, -10.0, 900.0]}), collection())
    got = {r["scene"]: r for r in stac.scenes(stac.items(df), "red").collect()}
    assert set(got) == {"a", "c", "d"}
    a, c, d = got["a"], got["c"], got["d"]
    assert (a["acq"], a["cloud_pct"], a["crs"], a["date"], a["href"]) == ("sentinel-1a_7", 12.5, "EPSG:32636", "2024-06-01", "x/a")
    assert [a[k] for k in ("west", "south", "east", "north")] == [500.0, 860.0, 560.0, 900.0]
    assert (c["acq"], c["crs"], c["west"]) == ("GS2C_1", "EPSG:32637", None)
    assert d["acq"] == "landsat_9_175" and d["west"] is None  # a rotated raster has no extent
    assert stac.items(pages(spark, collection())).count() == 0


@pytest.mark.parametrize("text, says", [("{}", "no STAC page: p0"), ("not json", "no STAC page: p0"), (collection(item(None)), "an item without an id: p0"), (collection(item("a", datetime=None)), "a lacks the property 'datetime'"), (collection(item("a", platform=None, **{"sat:absolute_orbit": 3})), "a lacks the property 'platform'")])
def test_what_is_missing_is_named(spark, text, says):
    with pytest.raises(Exception, match=says):
        stac.scenes(stac.items(pages(spark, text)), "red").collect()


def test_bands_are_checked(spark):
    known = spark.createDataFrame([("s2", "B04", "red"), ("s1", "vv", "vv")], "dataset string, band string, asset string")
    asked = lambda *rows: spark.createDataFrame(list(rows), "dataset string, band string")
    assert [r["asset"] for r in stac.checked_bands(asked(("s2", "B04")), known).collect()] == ["red"]
    with pytest.raises(Exception, match="s1 has no band B04"):
        stac.checked_bands(asked(("s2", "B04"), ("s1", "B04")), known).collect()
