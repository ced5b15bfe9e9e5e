"""Registered queries of names, dates, pixel values, footprints, predicates, joins and orders, with their SQL."""

from __future__ import annotations

from pyspark.sql import Window
from pyspark.sql import functions as F

from rastrum.functions import footprints as P
from rastrum.functions import grid as G
from rastrum.functions import scalars as S
from rastrum.operators import tiles as T
from rastrum.operators import choice
from rastrum.operators import ranks as N
from rastrum.plans.registry import RING, query

TEN = G.Grid(0.25, 40, -0.125, -0.125)
SINU = G.Grid(G.SCENE_SIZE / 1200, 240)
AREA = (-20.0, -10.0, 25.0, 30.0)


def _long(c):
    return c.cast("long")


# Names and dates.
@query(r"SELECT o_orderkey, regexp_replace(id || CASE WHEN o_orderkey % 2 = 0 THEN '_N05.09' ELSE '' END, '_N\d+\.\d+$', '') AS acq FROM scenes", "scenes")
def baseline_dropped(s):
    return s.select("o_orderkey", S.without_baseline(F.concat("id", F.when(F.col("o_orderkey") % 2 == 0, "_N05.09").otherwise(""))).alias("acq"))


@query("SELECT o_orderkey, CASE WHEN kind IS NOT NULL THEN lower('S1' || upper(kind)) || '_' || h || '_' || v END AS acq FROM scenes", "scenes")
def pass_names(s):
    return s.select("o_orderkey", S.pass_name(F.when(F.col("kind").isNotNull(), F.concat(F.lit("S1"), F.upper("kind"))), F.col("h"), F.col("v")).alias("acq"))


@query("SELECT o_orderkey, start_date AS date, CASE WHEN o_orderkey % 3 = 0 THEN 'EPSG:' || (32601 + h) WHEN o_orderkey % 3 = 1 THEN 'EPSG:' || (32701 + v) ELSE 'EPSG:' END AS crs FROM scenes", "scenes")
def scene_date_epsg(s):
    k = F.col("o_orderkey") % 3
    return s.select("o_orderkey", S.utc_date(F.concat("start_date", F.lit("T10:20:30Z"))).alias("date"), S.epsg_name(F.when(k == 0, 32601 + F.col("h")), F.when(k == 1, F.concat(F.lit("EPSG:"), 32701 + F.col("v")))).alias("crs"))


@query("SELECT event_id, CASE WHEN event_id % 4 > 0 THEN band || CASE WHEN event_id % 4 = 2 THEN '_b' ELSE '' END END AS var, CASE WHEN event_id % 4 > 0 THEN 'max' END AS stat FROM sensors", "sensors")
def band_statistic(s):
    k = F.col("event_id") % 4
    var, stat = S.variable_statistic(F.when(k == 0, F.regexp_replace("band", "_", "")).when(k == 2, F.concat("band", F.lit("_b_max"))).otherwise(F.concat("band", F.lit("_max"))))
    return s.select("event_id", var.alias("var"), stat.alias("stat"))


@query("SELECT o_orderkey, CASE WHEN o_orderkey % 5 > 0 THEN start_date END AS date FROM scenes", "scenes")
def date_in_file_name(s):
    name = F.when(F.col("o_orderkey") % 5 > 0, F.concat(F.lit("agera5_"), F.regexp_replace("start_date", "-", ""), F.lit("_final_12.nc"))).otherwise(F.lit("readme_1234567.txt"))
    return s.select("o_orderkey", S.date_in_name(name).alias("date"))


@query("SELECT event_id, CASE event_id % 3 WHEN 0 THEN TIMESTAMP '1999-01-01' + INTERVAL (event_id) MINUTE WHEN 1 THEN TIMESTAMP '2020-02-28 12:00:00' + INTERVAL (event_id) HOUR END AS t FROM sensors", "sensors")
def cf_times(s):
    k = F.col("event_id") % 3
    units = F.when(k == 0, "minutes since 1999-01-01 00:00:00").when(k == 1, " hours since 2020-02-28T12:00:00 ").otherwise("months since 1999-01-01 00:00:00")
    return s.select("event_id", S.cf_time(units, F.col("event_id")).alias("t"))


@query("SELECT event_id, CAST(floor((epoch(ts) + 2208988800) / 3600) AS BIGINT) AS hour_index FROM sensors", "sensors")
def hour_index(s):
    return s.select("event_id", _long(S.hours_since_1900(F.col("ts"))).alias("hour_index"))


@query("SELECT event_id, CASE WHEN s >= 3600 THEN (s // 3600) || 'h' || lpad(CAST(s % 3600 // 60 AS VARCHAR), 2, '0') || 'm' WHEN s >= 60 THEN (s // 60) || 'm' || lpad(CAST(s % 60 AS VARCHAR), 2, '0') || 's' ELSE s || 's' END AS took FROM (SELECT event_id, greatest(0, event_id * 7 % 9000 - 50) AS s FROM sensors)", "sensors")
def durations(s):
    return s.select("event_id", S.duration(F.col("event_id") * 7 % 9000 - 50).alias("took"))


_CORNER = "c AS (SELECT c_custkey, CAST(floor(lat) AS BIGINT) AS la, CAST(floor(lon) AS BIGINT) AS lo, CAST(floor(floor(lat) / 10) * 10 AS BIGINT) AS la10, CAST(floor(floor(lon) / 10) * 10 AS BIGINT) AS lo10 FROM aoi_pts)"
_NS = "CASE WHEN {0} >= 0 THEN 'N' ELSE 'S' END || printf('%02d', abs({0}))"
_EW = "CASE WHEN {0} >= 0 THEN 'E' ELSE 'W' END || printf('%03d', abs({0}))"
_M = "CASE WHEN {0} < 0 THEN 'm' ELSE '{1}' END || abs({0})"


@query(f""", {_CORNER} SELECT c_custkey, 'Copernicus_DSM_COG_10_' || {_NS.format('la')} || '_00_' || {_EW.format('lo')} || '_00_DEM.tif' AS degree_file,
  {_NS.format('la10')} || {_EW.format('lo10')} || '-' || {_NS.format('la10 + 10')} || CASE WHEN lo10 = 170 THEN 'W180' ELSE {_EW.format('lo10 + 10')} END || '_FABDEM_V1-2.zip' AS archive,
  'w' || {_M.format('lo', '')} || 's' || {_M.format('la', '')} AS cell, {_M.format('la10', 'p')} || '_' || {_M.format('lo10', 'p')} AS folder FROM c""", "aoi_pts")
def degree_names(p):
    la, lo = _long(F.floor("lat")), _long(F.floor("lon"))
    return p.select("c_custkey", S.degree_file(la, lo).alias("degree_file"), S.archive_name(la, lo).alias("archive"), S.cell_name(la, lo).alias("cell"), S.group_name(la, lo).alias("folder"))


@query(f", {_CORNER} SELECT c_custkey, la AS lat, lo AS lon FROM c", "aoi_pts")
def corners_of_names(p):
    la, lo = _long(F.floor("lat")), _long(F.floor("lon"))
    lat, lon = S.corner_of_name(F.concat(S.signed(la, "N", "S", 3), S.signed(lo, "E", "W", 3), F.lit("_tile")))
    return p.select("c_custkey", lat.alias("lat"), lon.alias("lon"))


@query("SELECT c_custkey, CASE WHEN c_custkey % 2 = 0 THEN 10 + c_custkey % 9 END AS zone, c_custkey % 90 AS cx, 300 + c_custkey % 200 AS cy, (c_custkey % 90) * 10000.0::DOUBLE AS west, (300 + c_custkey % 200) * 10000.0::DOUBLE AS north FROM aoi_pts", "aoi_pts")
def ten_km_cells(p):
    name = F.concat(F.lit("USGS_1M_"), F.when(F.col("c_custkey") % 2 == 0, F.concat((10 + F.col("c_custkey") % 9).cast("string"), F.lit("_"))).otherwise(""), F.lit("x"), F.col("c_custkey") % 90, F.lit("y"), 300 + F.col("c_custkey") % 200, F.lit("_CA_Some_2018.tif"))
    zone, x, y = S.ten_km_name(name)
    return p.select("c_custkey", zone.alias("zone"), x.alias("cx"), y.alias("cy"), (x * 10000.0).alias("west"), (y * 10000.0).alias("north"))


@query("SELECT o_orderkey, h, v FROM scenes", "scenes")
def scene_of_id(s):
    given = F.col("o_orderkey") % 2 == 0
    h, v = S.scene_of(F.when(given, F.col("h")), F.when(given, F.col("v")), F.col("id"))
    return s.select("o_orderkey", h.alias("h"), v.alias("v"))


@query("SELECT o_orderkey, CASE o_orderkey % 3 WHEN 0 THEN 'lwir11' WHEN 1 THEN 'lwir' END AS asset FROM scenes", "scenes")
def first_present_asset(s):
    assets = F.when(F.col("o_orderkey") % 3 == 0, F.create_map(F.lit("lwir"), F.lit(1), F.lit("lwir11"), F.lit(2))).when(F.col("o_orderkey") % 3 == 1, F.create_map(F.lit("lwir"), F.lit(1))).otherwise(F.create_map(F.lit("red"), F.lit(3)))
    return s.select("o_orderkey", S.first_asset(assets, "lwir11", "lwir").alias("asset"))


# The region that a name ends with comes from the scene's key.
_TIER = "CASE CAST(o_orderkey % 3 AS INTEGER) WHEN 0 THEN '_EUROPE' WHEN 1 THEN '_AFRICA' ELSE '' END"


@query(f"SELECT o_orderkey, id FROM (SELECT *, id || {_TIER} AS name FROM scenes) WHERE ends_with(name, '_EUROPE') AND tier IN ('1-URGENT', '2-HIGH')", "scenes")
def suffix_and_tier(s):
    region = F.when(F.col("o_orderkey") % 3 == 0, "_EUROPE").when(F.col("o_orderkey") % 3 == 1, "_AFRICA").otherwise("")
    return T.of_tier(s, F.concat("id", region), "_EUROPE", ("1-URGENT", "2-HIGH")).select("o_orderkey", "id")


@query("SELECT band, CASE band WHEN 'A' THEN 'MOD_day' WHEN 'N' THEN 'MYD_night' END AS asset, count(*) AS n FROM obs WHERE band IN ('A', 'N') GROUP BY ALL", "obs")
def band_routing(obs):
    routes = obs.sparkSession.createDataFrame([("A", "MOD", "day"), ("N", "MYD", "night"), ("Z", "MOD", "night")], "band string, satellite string, suffix string")
    return obs.join(F.broadcast(routes), "band").groupBy("band", F.concat_ws("_", "satellite", "suffix").alias("asset")).agg(F.count("*").alias("n"))


@query("SELECT event_id, event_id % 7 = 3 AS prelim FROM sensors", "sensors")
def expver_prelim(s):
    versions = F.transform(F.sequence(F.lit(0), F.lit(3)), lambda i: F.when((i == 2) & (F.col("event_id") % 7 == 3), "0005").otherwise("0001"))
    return s.select("event_id", F.exists(versions, lambda v: v == "0005").alias("prelim"))


# Pixel values.
@query("SELECT vec_id, pos, CASE WHEN dn <> -9999 THEN dn * 0.0000275::DOUBLE - 0.2::DOUBLE END AS value FROM px", "px")
def physical_values(px):
    return px.select("vec_id", "pos", S.physical(F.col("dn"), F.lit(0.0000275), F.lit(-0.2), F.lit(-9999)).alias("value"))


@query("SELECT vec_id, pos, CASE WHEN pos % 9 IN (1, 4) OR dn = -9999 THEN -1.0::DOUBLE ELSE CAST(dn AS DOUBLE) END AS value FROM px", "px")
def voids(px):
    raw = F.when(F.col("pos") % 9 == 1, F.lit(float("nan"))).when(F.col("pos") % 9 == 4, F.lit(float("-inf"))).otherwise(F.col("dn").cast("double"))
    return px.select("vec_id", "pos", S.void(raw, F.lit(-9999.0), -1.0).alias("value"))


@query("SELECT vec_id, CAST((7 - pos // 8) * 8 + pos % 8 AS BIGINT) AS pos, dn FROM px", "px")
def north_up(px):
    rows = px.groupBy("vec_id").agg(F.transform(F.array_sort(F.collect_list(F.struct("pos", "dn"))), lambda p: p["dn"]).alias("dns"))
    return rows.select("vec_id", F.posexplode(S.flipped(F.col("dns"), 8)).alias("pos", "dn")).select("vec_id", _long(F.col("pos")).alias("pos"), "dn")


_SCL = "scl AS (SELECT vec_id, abs(dn) % 12 AS cls FROM px)"


@query(f", {_SCL} SELECT vec_id, CASE WHEN count(*) FILTER (cls <> 0) > 0 THEN round_even(count(*) FILTER (cls IN (1, 3, 8, 9, 10))::DOUBLE / count(*) FILTER (cls <> 0)::DOUBLE * 100.0::DOUBLE, 2) END AS cloud_pct FROM scl GROUP BY vec_id", "px")
def cloud_share_of_classes(px):
    cls = F.abs("dn") % 12
    return px.groupBy("vec_id").agg(S.share(F.count_if(cls.isin(*S.CLOUD_CLASSES)), F.count_if(cls != 0)).alias("cloud_pct"))


@query(", q AS (SELECT vec_id, abs(dn) % 4 AS cls FROM px) SELECT vec_id, count(*) FILTER (cls > 2) AS processed FROM q GROUP BY vec_id HAVING count(*) FILTER (cls > 2) > 20", "px")
def processed_tiles(px):
    tile = px.groupBy("vec_id").agg(F.collect_list((F.abs("dn") % 4).cast("int")).alias("cls"))
    seen = F.filter("cls", lambda c: ~c.isin(*S.UNPROCESSED))
    return tile.where(F.exists("cls", lambda c: ~c.isin(*S.UNPROCESSED)) & (F.size(seen) > 20)).select("vec_id", _long(F.size(seen)).alias("processed"))


@query("SELECT vec_id FROM px GROUP BY vec_id HAVING count(*) FILTER (dn > 0) > 0", "px")
def observed_tiles(px):
    return px.groupBy("vec_id").agg(F.count_if(F.col("dn") > 0).alias("valid_px")).where("valid_px > 0").select("vec_id")


# Footprints.
@query("SELECT DISTINCT x, y, 0.25::DOUBLE AS a, x * 10.0::DOUBLE - 0.125 AS c, -0.25::DOUBLE AS e, (y + 1) * 10.0::DOUBLE - 0.125 AS f FROM obs", "obs")
def tile_transforms(obs):
    t = P.tile_transform(TEN, F.col("x"), F.col("y"))
    return obs.select("x", "y", t["a"].alias("a"), t["c"].alias("c"), t["e"].alias("e"), t["f"].alias("f")).distinct()


@query("SELECT c_custkey, round(lon * 100 - 2560 * floor(lon * 100 / 2560 + 0.5), 6) AS ox FROM aoi_pts", "aoi_pts")
def lattice_anchor(p):
    return p.select("c_custkey", F.round(P.anchor(F.col("lon") * 100, 2560.0), 6).alias("ox"))


@query("SELECT c_custkey, CAST(600000 + floor(lon) * 10 - 30 + 30 AS DOUBLE) AS west, CAST(4100000 + floor(lat) * 10 + 30 - 30 AS DOUBLE) AS north, 1000 AS cols, 1000 AS n_rows FROM aoi_pts", "aoi_pts")
def owned_windows(p):
    w, n = 600000.0 + F.floor("lon") * 10, 4100000.0 + F.floor("lat") * 10
    west, north, cols, rows = P.owned_window(w - 30.0, n + 30.0, 10.0, (w + 2.0, n - 10000.0, w + 10003.0, n))
    return p.select("c_custkey", west.alias("west"), north.alias("north"), cols.alias("cols"), rows.alias("n_rows"))


@query("SELECT DISTINCT x, y FROM obs WHERE (x + 1) * 10 - 0.125 > 9.875 + 0.0025 AND x * 10 - 0.125 < 29.875 - 0.0025 AND (y + 1) * 10 - 0.125 > 0 + 0.0025 AND y * 10 - 0.125 < 30 - 0.0025", "obs")
def inside_owned_extent(obs):
    extent = (F.lit(9.875), F.lit(0.0), F.lit(29.875), F.lit(30.0))
    return obs.select("x", "y").distinct().where(P.inside_owned(TEN.bounds(F.col("x"), F.col("y")), *extent, TEN.res))


@query("SELECT o_orderkey, CASE WHEN o_orderkey % 5 > 0 THEN h * 1000.0::DOUBLE END AS west, CASE WHEN o_orderkey % 5 > 0 THEN 5000.0::DOUBLE - v * 10 - 600 END AS south, CASE WHEN o_orderkey % 5 > 0 THEN h * 1000.0::DOUBLE + 800 END AS east, CASE WHEN o_orderkey % 5 > 0 THEN 5000.0::DOUBLE - v * 10 END AS north FROM scenes", "scenes")
def scene_extents(s):
    t = F.array(F.lit(10.0), F.when(F.col("o_orderkey") % 5 > 0, 0.0).otherwise(0.5), F.col("h") * 1000.0, F.lit(0.0), F.lit(-10.0), 5000.0 - F.col("v") * 10)
    return s.select("o_orderkey", *(c.alias(n) for c, n in zip(P.scene_extent(t, F.lit(60), F.lit(80)), ("west", "south", "east", "north"))))


@query("SELECT DISTINCT h, v, i AS tx, CAST((4 - j) * 240 AS BIGINT) AS row_in, CAST(i * 240 AS BIGINT) AS col_in FROM scenes, range(0, 5) a(i), range(0, 5) b(j)", "scenes")
def modis_pixel_offset(scenes):
    five = F.sequence(F.lit(0), F.lit(4))
    s = scenes.select("h", "v").distinct().withColumn("i", F.explode(five)).withColumn("j", F.explode(five))
    row, col = P.scene_offset(SINU, F.col("h"), F.col("v"), F.col("h") * 5 - 90 + F.col("i"), 40 - F.col("v") * 5 + F.col("j"), G.SCENE_WEST, G.SCENE_NORTH, G.SCENE_SIZE)
    return s.select("h", "v", _long(F.col("i")).alias("tx"), row.alias("row_in"), col.alias("col_in"))


@query("SELECT DISTINCT x, y, k, round((y + 1) * 10.0::DOUBLE - 0.125 - 0.125 - k * 0.25::DOUBLE, 4) AS lat, round(x * 10.0::DOUBLE - 0.125 + 0.125 + k * 0.25::DOUBLE, 4) AS lon FROM obs, range(0, 40) t(k)", "obs")
def tile_centres(obs):
    west, _, _, north = TEN.bounds(F.col("x"), F.col("y"))
    t = obs.select("x", "y").distinct().select("x", "y", F.posexplode(F.arrays_zip(P.centres(north, TEN.res, 40, True).alias("lat"), P.centres(west, TEN.res, 40).alias("lon"))).alias("k", "p"))
    return t.select("x", "y", _long(F.col("k")).alias("k"), "p.lat", "p.lon")


@query("SELECT band, round(max(y + 1) * 10.0::DOUBLE - 0.25 + 0.25, 3) AS n, round(min(x) * 10.0::DOUBLE - 0.25, 3) AS w, round(min(y) * 10.0::DOUBLE, 3) AS s, round(max(x + 1) * 10.0::DOUBLE - 0.25, 3) AS e FROM obs GROUP BY band", "obs")
def request_areas(obs):
    return P.request_area(obs.select("band", F.col("x").alias("tx"), F.col("y").alias("ty")), TEN, 1, 1, ("band",))


_R = "0.017453292519943295::DOUBLE"
_EDGES = f"""boxes AS (SELECT c_custkey AS part, lon AS west, lat AS south, lon + 0.1 + (c_custkey % 3) * 0.03 AS east, lat + 0.05 AS north FROM aoi_pts),
 n AS (SELECT *, greatest(1, CAST(ceil(greatest(east - west, north - south) / 0.02) AS BIGINT)) AS k FROM boxes),
 t AS (SELECT part, west, south, east, north, i / k::DOUBLE AS t FROM n, range(0, 20) r(i) WHERE i <= k),
 pts AS (SELECT part, west + (east - west) * t AS lon, south AS lat FROM t UNION ALL SELECT part, west + (east - west) * t, north FROM t UNION ALL SELECT part, west, south + (north - south) * t FROM t UNION ALL SELECT part, east, south + (north - south) * t FROM t),
 proj AS (SELECT part, min(lon * {_R} * 6371007.181::DOUBLE * cos(lat * {_R})) AS west, min(lat * {_R} * 6371007.181::DOUBLE) AS south, max(lon * {_R} * 6371007.181::DOUBLE * cos(lat * {_R})) AS east, max(lat * {_R} * 6371007.181::DOUBLE) AS north FROM pts GROUP BY part)"""


def _boxes(p):
    west, south = F.col("lon"), F.col("lat")
    return p.select(F.col("c_custkey").alias("part"), west.alias("west"), south.alias("south"), (west + 0.1 + (F.col("c_custkey") % 3) * 0.03).alias("east"), (south + 0.05).alias("north"))


@query(f", {_EDGES} SELECT part, round(west, 3) AS west, round(south, 3) AS south, round(east, 3) AS east, round(north, 3) AS north FROM proj", "aoi_pts")
def bbox_projected(p):
    return P.projected_boxes(_boxes(p), G.sinusoidal).select("part", *(F.round(c, 3).alias(c) for c in ("west", "south", "east", "north")))


@query(f", {_EDGES}, b AS (SELECT CAST(floor(west / 20000.0::DOUBLE) AS BIGINT) AS x0, CAST(ceil(east / 20000.0::DOUBLE) AS BIGINT) AS x1, CAST(floor(south / 20000.0::DOUBLE) AS BIGINT) AS y0, CAST(ceil(north / 20000.0::DOUBLE) AS BIGINT) AS y1 FROM proj) SELECT DISTINCT x0 + i AS tx, y0 + j AS ty FROM b, range(0, 20) a(i), range(0, 20) c(j) WHERE x0 + i < x1 AND y0 + j < y1", "aoi_pts")
def aoi_candidate_tiles(p):
    return P.candidate_tiles(G.Grid(100.0, 200), _boxes(p), G.sinusoidal)


@query(f", {_EDGES}, b AS (SELECT CAST(floor(west / 20000.0::DOUBLE) AS BIGINT) AS x0, CAST(ceil(east / 20000.0::DOUBLE) AS BIGINT) AS x1, CAST(floor(south / 20000.0::DOUBLE) AS BIGINT) AS y0, CAST(ceil(north / 20000.0::DOUBLE) AS BIGINT) AS y1 FROM proj), c AS (SELECT DISTINCT x0 + i AS tx, y0 + j AS ty FROM b, range(0, 20) a(i), range(0, 20) c(j) WHERE x0 + i < x1 AND y0 + j < y1) SELECT tx, ty FROM c WHERE ty * 20000.0 > -3000000 AND (tx, ty) NOT IN (SELECT x * 10, y * 10 FROM obs)", "obs", "aoi_pts")
def planned_tiles(obs, p):
    grid = G.Grid(100.0, 200)
    held = obs.select((F.col("x") * 10).alias("x"), (F.col("y") * 10).alias("y"))
    return T.plan_tiles(P.candidate_tiles(grid, _boxes(p), G.sinusoidal), held, grid.bounds(F.col("tx"), F.col("ty"))[1] > -3000000)


@query("SELECT c_custkey AS part, lon + (i + 0.5::DOUBLE) / 8 * 2 AS lon, lat + (j + 0.5::DOUBLE) / 10 AS lat FROM aoi_pts, range(0, 8) a(i), range(0, 10) b(j)", "aoi_pts")
def request_sample_points(p):
    boxes = p.select(F.col("c_custkey").alias("part"), F.col("lon").alias("west"), F.col("lat").alias("south"), (F.col("lon") + 2).alias("east"), (F.col("lat") + 1).alias("north"))
    return P.request_lattice(boxes, 0.5, 0.1, least=8)


_RING = ", ".join(f"({x1}, {y1}, {x2}, {y2})" for (x1, y1), (x2, y2) in zip(RING, RING[1:] + RING[:1]))
_TOUCH = f"""edges(x1, y1, x2, y2) AS (SELECT CAST(a AS DOUBLE), CAST(b AS DOUBLE), CAST(c AS DOUBLE), CAST(d AS DOUBLE) FROM (VALUES {_RING}) e(a, b, c, d)),
 boxes AS (SELECT DISTINCT x, y, west, south, east, north FROM obs WHERE west <= east),
 cut AS (SELECT b.*, greatest(0, least((west - x1) / (x2 - x1), (east - x1) / (x2 - x1)), least((south - y1) / (y2 - y1), (north - y1) / (y2 - y1))) AS low, least(1, greatest((west - x1) / (x2 - x1), (east - x1) / (x2 - x1)), greatest((south - y1) / (y2 - y1), (north - y1) / (y2 - y1))) AS high,
   CAST(least(y1, y2) <= south AND south < greatest(y1, y2) AND west < (south - y1) * (x2 - x1) / (y2 - y1) + x1 AS INTEGER) AS crossed FROM boxes b, edges)"""


@query(f", {_TOUCH} SELECT x, y, west, south, east, north FROM cut GROUP BY ALL HAVING bool_or(low <= high) OR sum(crossed) % 2 = 1", "obs")
def aoi_tile_filter(obs):
    t = obs.select("x", "y", "west", "south", "east", "north").distinct().where("west <= east")
    return t.where(P.ring_touches(RING, *(F.col(c) for c in ("west", "south", "east", "north"))))


@query("SELECT o_orderkey, o_orderkey % 4 = 0 OR (w < 30.2 AND w + 5 > 1.5 AND s < 30 AND s + 5 > 1 AND inside) AS kept FROM (SELECT o_orderkey, h * 10.0::DOUBLE AS w, v * 10.0::DOUBLE AS s, h * 10 BETWEEN 0 AND 20 AND v * 10 BETWEEN 0 AND 20 AS inside FROM scenes)", "scenes")
def item_box_touches(s):
    w, b = F.col("h") * 10.0, F.col("v") * 10.0
    missing = F.col("o_orderkey") % 4 == 0
    ring = [(0.0, 0.0), (24.0, 0.0), (24.0, 24.0), (0.0, 24.0)]
    return s.select("o_orderkey", (missing | P.ring_touches(ring, w, b, w + 5, b + 5)).alias("kept"))


@query("SELECT DISTINCT x, y FROM obs WHERE east > -80 AND west < 30 AND south < 12 AND north > -30", "obs")
def extent_clip(obs):
    return obs.where((F.col("east") > -80) & (F.col("west") < 30) & (F.col("south") < 12) & (F.col("north") > -30)).select("x", "y").distinct()


@query("SELECT DISTINCT x, y FROM obs WHERE x BETWEEN 1 AND 2", "obs")
def column_range(obs):
    return obs.where(F.col("x").between(1, 2)).select("x", "y").distinct()


@query("SELECT DISTINCT acq, band FROM obs WHERE acq = 'orbit_1'", "obs")
def acquisition_filter(obs):
    return obs.where(F.col("acq") == "orbit_1").select("acq", "band").distinct()


# Joins.
_WANT = [("A", "1995-03-01", 1, 2), ("N", "1996-07-01", 0, 4), ("R", "1994-01-01", 3, 3), ("A", "1997-05-01", 2, 0)]
_WANTED = "want(band, date, x, y) AS (VALUES " + ", ".join(f"('{b}', '{d}', {x}, {y})" for b, d, x, y in _WANT) + ")"


@query(f", {_WANTED} SELECT o.band, o.date, o.x, o.y, count(*) AS n FROM obs o JOIN want w USING (band, date, x, y) GROUP BY ALL", "obs")
def keys_with_prefilter(obs):
    want = obs.sparkSession.createDataFrame(_WANT, "band string, date string, x long, y long")
    return T.read_keys(obs, want, [r[0] for r in _WANT], [r[2] for r in _WANT], [r[3] for r in _WANT], min(r[1] for r in _WANT), max(r[1] for r in _WANT)).groupBy("band", "date", "x", "y").agg(F.count("*").alias("n"))


@query(", b AS (SELECT c_custkey, lon AS w, lat AS s, lon + 15 AS e, lat + 8 AS n FROM aoi_pts), t AS (SELECT DISTINCT x, y, west, south, east, north FROM obs) SELECT c_custkey, x, y FROM b JOIN t ON north > s AND south < n AND CASE WHEN west <= east THEN east > w AND west < e ELSE east > w OR west < e END", "obs", "aoi_pts")
def tiles_of_boxes(obs, p):
    tiles = choice.unwrapped(obs.select("x", "y", "west", "south", "east", "north").distinct())
    boxes = p.select("c_custkey", F.col("lon").alias("w"), F.col("lat").alias("s"), (F.col("lon") + 15).alias("e"), (F.col("lat") + 8).alias("n"))
    return T.range_join(tiles, boxes, 30.0).select("c_custkey", "x", "y").distinct()


@query(", m AS (SELECT DISTINCT tile_id FROM px), b AS (SELECT tile_id AS b, tile_id * 8 AS c0, tile_id * 8 + 8 AS c1 FROM m) SELECT m.tile_id AS mask, b.b AS band_tile FROM m JOIN b ON m.tile_id * 20 < b.c1 AND m.tile_id * 20 + 20 > b.c0", "px")
def mask_over_band(px):
    ids = px.select("tile_id").distinct()
    blocks = ids.select(F.col("tile_id").alias("mask"), F.explode(F.sequence(F.floor(F.col("tile_id") * 20 / 8), F.ceil((F.col("tile_id") * 20 + 20) / 8) - 1)).alias("band_tile"))
    return blocks.join(ids.select(F.col("tile_id").alias("band_tile")), "band_tile").select("mask", "band_tile")


@query(", a AS (SELECT x, y, min(size_bytes) AS qa FROM obs WHERE band = 'A' AND x < 2 GROUP BY ALL), b AS (SELECT x, y, count(*) AS n FROM obs WHERE band = 'R' GROUP BY ALL) SELECT b.x, b.y, n, qa FROM b LEFT JOIN a USING (x, y)", "obs")
def same_key_lookup(obs):
    qa = obs.where("band = 'A' and x < 2").groupBy("x", "y").agg(F.min("size_bytes").alias("qa"))
    return obs.where("band = 'R'").groupBy("x", "y").agg(F.count("*").alias("n")).join(qa, ["x", "y"], "left").select("x", "y", "n", "qa")


@query(", f AS (SELECT x, y, max(size_bytes) AS m FROM obs WHERE fetched_at > 500 AND x < 3 GROUP BY ALL), s AS (SELECT x, y, max(size_bytes) AS m FROM obs WHERE fetched_at <= 500 AND x > 0 GROUP BY ALL) SELECT x, y, coalesce(f.m, s.m) AS mask FROM f FULL JOIN s USING (x, y)", "obs")
def fresh_over_stored(obs):
    side = lambda w, name: obs.where(w).groupBy("x", "y").agg(F.max("size_bytes").alias(name))
    return side("fetched_at > 500 and x < 3", "fresh").join(side("fetched_at <= 500 and x > 0", "kept"), ["x", "y"], "full").select("x", "y", F.coalesce("fresh", "kept").alias("mask"))


@query(", c AS (SELECT x, y, min(size_bytes) AS value FROM obs GROUP BY ALL) SELECT event_id, value FROM sensors s JOIN c ON c.x = CAST(floor(s.lon) AS BIGINT) % 4 AND c.y = CAST(floor(s.lat) AS BIGINT)", "obs", "sensors")
def pixel_owner(obs, s):
    cells = obs.groupBy("x", "y").agg(F.min("size_bytes").alias("value"))
    return s.withColumns({"x": _long(F.floor("lon")) % 4, "y": _long(F.floor("lat"))}).join(cells, ["x", "y"]).select("event_id", "value")


@query(", t AS (SELECT DISTINCT h AS x, v AS y FROM scenes) SELECT DISTINCT x, y, band FROM obs WHERE (x, y) IN (SELECT x, y FROM t)", "obs", "scenes")
def cells_in_scene(obs, s):
    return obs.select("x", "y", "band").distinct().join(s.select(F.col("h").alias("x"), F.col("v").alias("y")).distinct(), ["x", "y"], "left_semi")


# Groups, windows, orders, sets.
@query("SELECT strftime(ts, '%Y-%m') AS month, string_agg(DISTINCT strftime(ts, '%d'), ',' ORDER BY strftime(ts, '%d')) AS days FROM sensors GROUP BY 1", "sensors")
def month_batches(s):
    return s.groupBy(F.date_format("ts", "yyyy-MM").alias("month")).agg(F.array_join(F.array_sort(F.collect_set(F.date_format("ts", "dd"))), ",").alias("days"))


@query("SELECT band, string_agg(DISTINCT CAST(x AS VARCHAR) || '/' || CAST(y AS VARCHAR), ',' ORDER BY CAST(x AS VARCHAR) || '/' || CAST(y AS VARCHAR)) AS tiles FROM obs GROUP BY band", "obs")
def tiles_by_variable(obs):
    return obs.groupBy("band").agg(F.array_join(F.array_sort(F.collect_set(F.concat_ws("/", "x", "y"))), ",").alias("tiles"))


_FULL = "valid_px IS NOT NULL AND scene_id IS NOT NULL"


@query(f"SELECT band, date, x, y, valid_px, scene_id FROM (SELECT *, row_number() OVER (PARTITION BY band, date, x, y ORDER BY valid_px DESC, scene_id) AS r FROM obs WHERE {_FULL}) WHERE r = 1", "obs")
def buffer_replacement(obs):
    w = Window.partitionBy("band", "date", "x", "y").orderBy(F.desc("valid_px"), "scene_id")
    return obs.where(_FULL).withColumn("r", F.row_number().over(w)).where("r = 1").select("band", "date", "x", "y", "valid_px", "scene_id")


@query("SELECT event_id, CAST(max(epoch_us(ts) // 1000 - r) OVER (PARTITION BY band, day ORDER BY event_id ROWS UNBOUNDED PRECEDING) + r AS BIGINT) AS stamp FROM (SELECT event_id, band, ts, CAST(ts AS DATE) AS day, row_number() OVER (PARTITION BY band, CAST(ts AS DATE) ORDER BY event_id) AS r FROM sensors)", "sensors")
def rising_stamp(s):
    # Later of the clock and the stamp before plus one: the clock less the row's number, as high as it ever was, plus that number.
    w = Window.partitionBy("band", F.to_date("ts")).orderBy("event_id")
    late = F.max(F.unix_millis(F.col("ts").cast("timestamp")) - F.col("r")).over(w.rowsBetween(Window.unboundedPreceding, 0))
    return s.withColumn("r", F.row_number().over(w)).select("event_id", (late + F.col("r")).alias("stamp"))


@query("SELECT band, count(*) FILTER (ts <= before) AS not_rising FROM (SELECT band, ts, lag(ts) OVER (PARTITION BY band ORDER BY event_id) AS before FROM sensors) GROUP BY band", "sensors")
def ascending_check(s):
    following = N.with_next(s.select("band", "event_id", "ts"), ["band"], ["event_id"], "ts")
    return following.groupBy("band").agg(F.count_if(F.col("next") <= F.col("ts")).alias("not_rising"))


@query("SELECT band, lon AS at, gap FROM (SELECT band, lon, lead(lon) OVER (PARTITION BY band ORDER BY lon) - lon AS gap FROM (SELECT DISTINCT band, lon FROM sensors)) QUALIFY row_number() OVER (PARTITION BY band ORDER BY round(gap, 9) DESC NULLS LAST, lon) = 1", "sensors")
def widest_gap(s):
    gap = F.col("next") - F.col("lon")
    lons = N.with_next(s.select("band", "lon").distinct(), ["band"], ["lon"], "lon").where("next is not null")
    widest = F.max(F.struct(F.round(gap, 9).alias("r"), (-F.col("lon")).alias("o"), gap.alias("gap")))
    return lons.groupBy("band").agg(widest.alias("g")).select("band", (-F.col("g.o")).alias("at"), "g.gap")


_RANKED = "SELECT band, date, x, y, l_orderkey, l_linenumber, l_partkey, l_suppkey, row_number() OVER (PARTITION BY band ORDER BY {}, l_orderkey, l_linenumber, l_partkey, l_suppkey) AS place FROM obs"
_TIES = ("l_orderkey", "l_linenumber", "l_partkey", "l_suppkey")


def _ranked(obs, *order):
    keep = ["band", "date", "x", "y", *_TIES]
    return N.ranked(obs.select(*keep, "acq", "crs", "cloud_pct"), ["band"], [*order, *_TIES]).select(*keep, "place")


@query(_RANKED.format("date, coalesce(acq, ''), crs"), "obs")
def series_order(obs):
    return _ranked(obs, "date", F.coalesce("acq", F.lit("")), "crs")


@query(_RANKED.format("coalesce(cloud_pct, 1e9), date, x, y"), "obs")
def cleanest_first(obs):
    return _ranked(obs, F.coalesce("cloud_pct", F.lit(1e9)), "date", "x", "y")


@query(_RANKED.format("date, x, y"), "obs")
def catalog_order(obs):
    return _ranked(obs, "date", "x", "y")


@query(_RANKED.format("y DESC, x"), "obs")
def row_major_order(obs):
    return _ranked(obs, F.desc("y"), "x")


@query("SELECT true AS any_rows, false AS any_far FROM obs LIMIT 1", "obs")
def probe(obs):
    one = lambda df, name: df.limit(1).agg((F.count("*") > 0).alias(name))
    return one(obs, "any_rows").crossJoin(one(obs.where("x > 100"), "any_far"))


@query("SELECT x, y, band FROM obs WHERE band <> 'A' EXCEPT SELECT x, y, band FROM obs WHERE size_bytes > 90000", "obs")
def skip_minus_prelim(obs):
    return obs.where("band <> 'A'").select("x", "y", "band").subtract(obs.where("size_bytes > 90000").select("x", "y", "band"))


@query("SELECT start_date FROM scenes WHERE kind = 'final' INTERSECT SELECT start_date FROM scenes WHERE kind = 'prelim'", "scenes")
def ready_and_asked(s):
    return s.where("kind = 'final'").select("start_date").intersect(s.where("kind = 'prelim'").select("start_date"))


@query("SELECT band, sum(size_bytes)::BIGINT AS before, CAST(sum(CASE WHEN r = 1 THEN size_bytes ELSE 0 END) AS BIGINT) AS after FROM (SELECT band, size_bytes, row_number() OVER (PARTITION BY band, date, x, y ORDER BY fetched_at DESC, size_bytes, l_orderkey, l_linenumber, l_partkey, l_suppkey) AS r FROM obs) GROUP BY band", "obs")
def bytes_before_after(obs):
    w = Window.partitionBy("band", "date", "x", "y").orderBy(F.desc("fetched_at"), "size_bytes", *_TIES)
    return obs.withColumn("r", F.row_number().over(w)).groupBy("band").agg(F.sum("size_bytes").alias("before"), F.sum(F.when(F.col("r") == 1, F.col("size_bytes")).otherwise(0)).alias("after"))


# Ground that only a dropped projection saw.
@query(", p AS (SELECT DISTINCT crs, x, y FROM obs WHERE valid_px > 40 AND band = 'A' AND date < '1992-06'), k AS (SELECT x, y FROM p WHERE crs = 'EPSG:32635') SELECT DISTINCT x, y FROM p WHERE crs <> 'EPSG:32635' AND (x, y) NOT IN (SELECT x, y FROM k)", "obs")
def left_out(obs):
    seen = obs.where("valid_px > 40 and band = 'A' and date < '1992-06'").select("crs", "x", "y").distinct()
    kept = seen.where("crs = 'EPSG:32635'").select("x", "y")
    return seen.where("crs <> 'EPSG:32635'").select("x", "y").distinct().join(kept, ["x", "y"], "left_anti")


@query(", o AS (SELECT tile_id, pos // 8 AS r, pos % 8 AS c FROM px WHERE dn <> -9999 AND scene_id = 'scene_0'), q AS (SELECT DISTINCT tile_id, 3 + k AS r, 4 AS c FROM px, range(0, 3) t(k)) SELECT q.tile_id, q.r AS row_at, bool_or(o.r IS NOT NULL) AS seen FROM q LEFT JOIN o ON o.tile_id = q.tile_id AND abs(o.r - q.r) <= 1 AND abs(o.c - q.c) <= 1 GROUP BY ALL", "px")
def seen_at(px):
    place = px.where("dn <> -9999 and scene_id = 'scene_0'").select("tile_id", _long(F.floor(F.col("pos") / 8)).alias("r"), _long(F.col("pos") % 8).alias("c"))
    asked = px.select("tile_id").distinct().withColumn("row_at", F.explode(F.array(*(F.lit(k).cast("long") for k in (3, 4, 5)))))
    near = F.sequence(F.lit(-1), F.lit(1))
    around = asked.withColumn("dr", F.explode(near)).withColumn("dc", F.explode(near)).withColumns({"r": F.col("row_at") + F.col("dr"), "c": F.lit(4) + F.col("dc")})
    return around.join(place.withColumn("hit", F.lit(True)), ["tile_id", "r", "c"], "left").groupBy("tile_id", "row_at").agg(F.bool_or(F.coalesce("hit", F.lit(False))).alias("seen"))
