"""Registered queries of the raster engine and their SQL for DuckDB."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from rastrum.functions import grid as G
from rastrum.functions.views import duck, view
from rastrum.operators import raster as R
from rastrum.operators import tiles as T
from rastrum.sources import store

_QUERIES: dict[str, Callable] = {}
_SQL: dict[str, str] = {}
NODATA = -9999
BOX, SEAM = (30.0, -40.0, 60.0, 10.0), (175.0, -60.0, 179.0, 60.0)
RING = [(1.5, 1.0), (30.2, 4.0), (26.0, 27.3), (9.0, 30.0), (3.1, 15.5)]


def query(sql: str | None, *views: str, name: str | None = None):
    """Registers a function of views. sql: the closing query, after the CTEs of the same views."""

    def register(f):
        key = name or f.__name__
        _QUERIES[key] = lambda spark, sf_dir: f(*(view(spark, sf_dir, v) for v in views))
        if sql:
            _SQL[key] = f"{duck(*views)} {sql}" if views else sql
        return f

    return register


def query_of(sql: str | None, *views: str, name: str | None = None):
    """Registers a function of the session and the tables' folder."""

    def register(f):
        key = name or f.__name__
        _QUERIES[key] = f
        if sql:
            _SQL[key] = f"{duck(*views)} {sql}" if views else sql
        return f

    return register


def _bbox_sql(w, s, e, n):
    return f"north > {s} AND south < {n} AND CASE WHEN west <= east THEN east > {w} AND west < {e} ELSE east > {w} OR west < {e} END"


_COVER = "SELECT date, band, count(*) AS n, floor(avg(cloud_pct) * 10 + 0.5) / 10 AS mean_cloud FROM obs WHERE {} GROUP BY date, band"
for _name, _where, _sql in (("coverage_all", lambda: F.lit(True), "true"), ("coverage_bbox", lambda: T.bbox_intersects(BOX), _bbox_sql(*BOX)), ("coverage_antimeridian", lambda: T.bbox_intersects(SEAM), _bbox_sql(*SEAM)), ("coverage_date_prefix", lambda: T.date_prefix("1995"), "date LIKE '1995%'")):
    query(_COVER.format(_sql), "obs", name=_name)(lambda obs, w=_where: T.coverage(obs.where(w())))

_KEYS = "band, date, acq, crs, x, y"
_SAME = " AND ".join(f"a.{c} IS NOT DISTINCT FROM b.{c}" for c in T.KEY)
_RESOLVED = f"""resolved AS (SELECT * FROM (SELECT *, row_number() OVER (PARTITION BY {_KEYS}, CASE WHEN acq IS NOT NULL THEN scene_id END
  ORDER BY fetched_at DESC, valid_px DESC NULLS LAST, scene_id NULLS LAST, size_bytes, l_orderkey, l_linenumber, l_partkey, l_suppkey) AS r FROM obs) WHERE r = 1)"""
_SPLIT = f"dup AS (SELECT {_KEYS}, count(*) AS n FROM obs WHERE acq IS NOT NULL GROUP BY {_KEYS} HAVING count(*) > 1)"
_ROW = ["l_orderkey", "l_linenumber", "l_partkey", "l_suppkey"]
_ROWS = ", ".join(f"o.{c}" for c in _ROW)
_HELD = "parts AS (SELECT band, date, x, y, tile_px, valid_px, unnest(CASE WHEN scene_id IS NULL THEN [NULL] ELSE string_split(scene_id, '|') END) AS scene FROM obs), held AS (SELECT band, date, x, y, coalesce(string_agg(DISTINCT scene, '|' ORDER BY scene), '') AS scenes, coalesce(bool_or(valid_px >= tile_px * tile_px), false) AS complete FROM parts GROUP BY band, date, x, y)"


@query(f"SELECT band, date, x, y, crs, acq, scene_id FROM obs WHERE {_bbox_sql(*BOX)} AND band = 'A'", "obs")
def tiles_for_bbox(obs):
    return obs.where(T.bbox_intersects(BOX) & (F.col("band") == "A")).select("band", "date", "x", "y", "crs", "acq", "scene_id").orderBy("band", "date", "x", "y")


@query("SELECT band, date, x, y, l_orderkey, l_linenumber, l_partkey, l_suppkey FROM obs WHERE date LIKE '1996-0%' AND (date = '1996-03-01' OR NOT EXISTS (SELECT 1 FROM obs WHERE date = '1996-03-01'))".replace("date LIKE '1996-0%'", "date LIKE '1996-03-01%'"), "obs")
def exact_else_prefix(obs):
    return T.exact_else_prefix(obs, "1996-03-01").select("band", "date", "x", "y", *_ROW)


@query(f"SELECT a.band, count(*) AS n FROM (SELECT DISTINCT {_KEYS} FROM obs WHERE scene_id IS NULL) a JOIN (SELECT DISTINCT {_KEYS} FROM obs WHERE valid_px IS NULL) b ON {_SAME} GROUP BY a.band", "obs")
def null_safe_key_match(obs):
    a, b = obs.where("scene_id is null").select(*T.KEY).distinct().alias("a"), obs.where("valid_px is null").select(*T.KEY).distinct().alias("b")
    on = F.lit(True)
    for c in T.KEY:
        on = on & F.col(f"a.{c}").eqNullSafe(F.col(f"b.{c}"))
    return a.join(b, on).groupBy(F.col("a.band").alias("band")).agg(F.count("*").alias("n"))


@query(f", {_RESOLVED} SELECT {_ROWS} FROM resolved o", "obs")
def resolve_tiles(obs):
    return T.resolve(obs, tuple(_ROW)).select(*_ROW)


@query(f", {_SPLIT} SELECT * FROM dup", "obs")
def split_tiles(obs):
    return T.split_keys(obs)


@query(f", {_SPLIT} SELECT {_ROWS} FROM obs o WHERE acq IS NOT NULL AND ({_KEYS}) IN (SELECT {_KEYS} FROM dup)", "obs")
def split_semi(obs):
    return T.split_rows(obs).select(*_ROW)


@query(f", {_SPLIT} SELECT {_ROWS} FROM obs o WHERE acq IS NULL OR ({_KEYS}) NOT IN (SELECT {_KEYS} FROM dup)", "obs")
def month_rest_anti(obs):
    return T.rest_rows(obs).select(*_ROW)


_MERGED = f"""merged AS (SELECT {_KEYS}, count(*) AS n, (SELECT nullif(array_to_string(list_sort(list_distinct(flatten(list(string_split(s, '|'))))), '|'), '') FROM unnest(list(scene_id)) u(s) WHERE s IS NOT NULL) AS scene_id, CAST(sum(valid_px) AS BIGINT) AS valid_px,
  sum(CASE WHEN cloud_pct IS NOT NULL AND coalesce(valid_px, 0) > 0 THEN cloud_pct * valid_px END) AS cloud_sum, CAST(sum(CASE WHEN cloud_pct IS NOT NULL AND coalesce(valid_px, 0) > 0 THEN valid_px END) AS BIGINT) AS cloud_px, max(fetched_at) AS fetched_at
  FROM obs WHERE acq IS NOT NULL GROUP BY {_KEYS} HAVING count(*) > 1)"""
_MERGED = _MERGED.replace("(SELECT nullif(array_to_string(list_sort(list_distinct(flatten(list(string_split(s, '|'))))), '|'), '') FROM unnest(list(scene_id)) u(s) WHERE s IS NOT NULL)", "nullif(array_to_string(list_sort(list_distinct(flatten(list(string_split(scene_id, '|')) FILTER (WHERE scene_id IS NOT NULL)))), '|'), '')")


@query(f", {_MERGED} SELECT * FROM merged", "obs")
def merge_meta(obs):
    return T.merge_rows(obs)


@query(f", {_SPLIT}, {_MERGED} SELECT {_KEYS}, scene_id FROM obs o WHERE acq IS NULL OR ({_KEYS}) NOT IN (SELECT {_KEYS} FROM dup) UNION ALL SELECT {_KEYS}, scene_id FROM merged", "obs")
def month_union(obs):
    cols = [*T.KEY, "scene_id"]
    return T.rest_rows(obs).select(*cols).unionByName(T.merge_rows(obs).select(*cols))


@query(f", {_HELD} SELECT * FROM held", "obs")
def existing_scenes(obs):
    return T.held_scenes(obs)


def _upto(n):
    return F.sequence(F.lit(0).cast("long"), F.lit(n).cast("long"))


def _plan(obs):
    return obs.select("band", "date").distinct().select("band", "date", F.explode(_upto(4)).alias("x")).select("*", F.explode(_upto(4)).alias("y"), F.lit("scene_3").alias("scene"))


_PLAN = "plan AS (SELECT band, date, CAST(tx.x AS BIGINT) AS x, CAST(ty.y AS BIGINT) AS y, 'scene_3' AS scene FROM (SELECT DISTINCT band, date FROM obs), range(0, 5) tx(x), range(0, 5) ty(y))"


@query(f", {_PLAN} SELECT band, date, x, y FROM plan p WHERE NOT EXISTS (SELECT 1 FROM obs o WHERE o.band = p.band AND o.date = p.date AND o.x = p.x AND o.y = p.y)", "obs")
def skip_set_anti(obs):
    return T.unstored(_plan(obs), obs, ["band", "date", "x", "y"]).select("band", "date", "x", "y")


@query(f", {_PLAN}, {_HELD} SELECT p.* FROM plan p LEFT JOIN held h USING (band, date, x, y) WHERE NOT coalesce(h.complete, false) AND NOT list_contains(string_split(coalesce(h.scenes, ''), '|'), p.scene)", "obs")
def scene_aware_skip(obs):
    return T.to_fetch(_plan(obs), T.held_scenes(obs))


@query(f", {_PLAN} SELECT band, count(*) AS n FROM plan p WHERE NOT EXISTS (SELECT 1 FROM obs o WHERE o.band = p.band AND o.date = p.date AND o.x = p.x AND o.y = p.y) GROUP BY band", "obs")
def plan_counts(obs):
    return skip_set_anti(obs).groupBy("band").agg(F.count("*").alias("n"))


@query(f", {_PLAN} SELECT count(*) AS missing, count(DISTINCT date) AS dates FROM plan p WHERE NOT EXISTS (SELECT 1 FROM obs o WHERE o.band = p.band AND o.date = p.date AND o.x = p.x AND o.y = p.y)", "obs")
def dry_run_missing(obs):
    return skip_set_anti(obs).agg(F.count("*").alias("missing"), F.count_distinct("date").alias("dates"))


@query("SELECT DISTINCT acq FROM obs WHERE acq IS NOT NULL AND date LIKE '1998%'", "obs")
def acquisitions_list(obs):
    return obs.where(T.date_prefix("1998") & F.col("acq").isNotNull()).select("acq").distinct()


@query("SELECT band, date, acq, cover FROM (SELECT *, row_number() OVER (PARTITION BY band, date ORDER BY cover DESC, acq NULLS LAST) AS r FROM (SELECT band, date, acq, CAST(coalesce(sum(valid_px), 0) AS BIGINT) AS cover FROM obs GROUP BY band, date, acq)) WHERE r = 1", "obs")
def best_acquisition(obs):
    return T.best_acquisition(obs)


@query("SELECT date, crs FROM (SELECT date, crs, row_number() OVER (PARTITION BY date ORDER BY count(*) DESC, crs) AS r FROM obs GROUP BY date, crs) WHERE r = 1", "obs")
def majority_crs(obs):
    return T.majority_crs(obs, "date")


@query(f"SELECT CAST(NULL AS VARCHAR) AS {', '.join(store.CATALOG)} FROM obs", "obs")
def catalog_project(obs):
    return store.catalog_of(obs)


@query("SELECT CASE WHEN date = '' THEN 'static' ELSE substr(date, 1, 7) END AS ym, CAST(floor(res) AS BIGINT) AS res_group, count(*) AS n FROM obs GROUP BY ALL", "obs")
def partition_ym(obs):
    return store.with_partitions(obs).groupBy("ym", "res_group").agg(F.count("*").alias("n"))


@query("SELECT DISTINCT CAST(floor(res) AS BIGINT) AS res_group, CASE WHEN date = '' THEN '' ELSE substr(date, 1, 7) || '-01' END AS month FROM obs", "obs")
def month_groups(obs):
    return store.with_partitions(obs).select("res_group", F.when(F.col("ym") == "static", "").otherwise(F.concat("ym", F.lit("-01"))).alias("month")).distinct()


@query("SELECT count(*) AS n_tiles, CAST(sum(size_bytes) AS BIGINT) AS n_bytes, min(x) AS x0, max(x) AS x1, min(y) AS y0, max(y) AS y1 FROM obs", "obs")
def store_totals(obs):
    return obs.agg(F.count("*").alias("n_tiles"), F.sum("size_bytes").alias("n_bytes"), F.min("x").alias("x0"), F.max("x").alias("x1"), F.min("y").alias("y0"), F.max("y").alias("y1"))


@query("SELECT l_orderkey, l_linenumber, l_partkey, l_suppkey, CASE WHEN fetched_at * 37 % size_bytes < size_bytes AND fetched_at * 37 < size_bytes THEN fetched_at * 37 ELSE size_bytes END AS kept_bytes FROM obs", "obs")
def reencode_choice(obs):
    new = F.col("fetched_at") * 37
    return obs.select(*_ROW, F.when(new < F.col("size_bytes"), new).otherwise(F.col("size_bytes")).alias("kept_bytes"))


@query("SELECT DISTINCT month FROM (SELECT date AS month FROM obs UNION SELECT substr(start_date, 1, 7) || '-01' FROM scenes)", "obs", "scenes")
def skip_months_union(obs, scenes):
    return obs.select(F.col("date").alias("month")).union(scenes.select(F.concat(F.substring("start_date", 1, 7), F.lit("-01")))).distinct()


# Pixels.
_COUNTS = "counts AS (SELECT tile_id, scene_id, CAST(sum(CASE WHEN dn <> -9999 THEN 1 ELSE 0 END) AS BIGINT) AS n_observed FROM px GROUP BY tile_id, scene_id)"
_MERGE = f"{_COUNTS}, m AS (SELECT tile_id, pos, coalesce(first(dn ORDER BY n_observed DESC, scene_id) FILTER (WHERE dn <> -9999), -9999) AS dn, first(scene_id ORDER BY n_observed DESC, scene_id) FILTER (WHERE dn <> -9999) AS scene_id FROM px JOIN counts USING (tile_id, scene_id) GROUP BY tile_id, pos)"
_PLACE = "CAST(floor(tile_id / 16) * 8 + floor(pos / 8) AS BIGINT) AS \"row\", CAST(tile_id % 16 * 8 + pos % 8 AS BIGINT) AS col"


@query(f", {_COUNTS} SELECT * FROM counts", "px")
def tile_observed_px(px):
    return R.observed_counts(px, NODATA)


@query(f", {_MERGE} SELECT * FROM m", "px")
def merge_tiles(px):
    return R.merge(px, NODATA)


@query(f", {_MERGE} SELECT tile_id, scene_id, count(*) AS n_px FROM m WHERE scene_id IS NOT NULL GROUP BY tile_id, scene_id", "px")
def merge_contributions(px):
    return R.contributions(R.merge(px, NODATA))


@query(f", {_MERGE} SELECT {_PLACE}, dn FROM m", "px")
def mosaic_pixels(px):
    return R.mosaic(R.merge(px, NODATA), 16, 8)


@query(f", {_MERGE} SELECT {_PLACE}, CASE WHEN dn <> -9999 THEN dn END AS value, dn <> -9999 AS observed FROM m", "px")
def mosaic_masked(px):
    return R.mosaic(R.merge(px, NODATA), 16, 8).select("row", "col", F.when(R.observed(F.col("dn"), NODATA), F.col("dn")).alias("value"), R.observed(F.col("dn"), NODATA).alias("observed"))


_IN = " + ".join(f"CASE WHEN (({y0} > py) <> ({y1} > py)) AND px < CAST({x1 - x0} AS DOUBLE) * (py - CAST({y0} AS DOUBLE)) / CAST({y1 - y0} AS DOUBLE) + CAST({x0} AS DOUBLE) THEN 1 ELSE 0 END" for (x0, y0), (x1, y1) in zip(RING, RING[1:] + RING[:1]))


@query(f", {_MERGE}, c AS (SELECT {_PLACE}, dn FROM m), p AS (SELECT \"row\", col, dn, CAST(col AS DOUBLE) + 0.5 AS px, CAST(\"row\" AS DOUBLE) + 0.5 AS py FROM c) SELECT \"row\", col, CASE WHEN ({_IN}) % 2 = 1 THEN dn ELSE -9999 END AS dn FROM p", "px")
def clip_polygon(px):
    x, y = F.col("col").cast("double") + F.lit(0.5), F.col("row").cast("double") + F.lit(0.5)
    return R.mosaic(R.merge(px, NODATA), 16, 8).select("row", "col", F.when(R.inside(x, y, RING), F.col("dn")).otherwise(NODATA).alias("dn"))


_CLS = "c AS (SELECT *, CASE WHEN dn = -9999 THEN 255 ELSE abs(dn) % 12 END AS cls FROM px)"


def _cls(px):
    return px.withColumn("cls", F.when(F.col("dn") == NODATA, 255).otherwise(F.abs("dn") % 12))


def _share_sql(name, good, valid):
    return f", {_CLS} SELECT tile_id, scene_id, CASE WHEN sum(CASE WHEN {valid} THEN 1 ELSE 0 END) > 0 THEN round_even(sum(CASE WHEN ({good}) AND ({valid}) THEN 1 ELSE 0 END)::DOUBLE / sum(CASE WHEN {valid} THEN 1 ELSE 0 END)::DOUBLE * 100.0::DOUBLE, 2) END AS {name} FROM c GROUP BY tile_id, scene_id"


for _name, _good, _valid in (("cloud_from_classes", "cls IN (1, 3, 8, 9, 10)", "cls <> 0"), ("qa_bits", "(cls & 30) <> 0", "(cls & 1) = 0"), ("fill_share", "cls = 255", "true"), ("fire_unobserved", "cls IN (0, 1, 2, 4, 6)", "true")):
    query(_share_sql("pct", _good, _valid), "px", name=_name)(lambda px, g=_good, v=_valid: R.share(_cls(px), F.expr(g), F.expr(v), "pct"))


@query(f", {_CLS} SELECT tile_id, scene_id, CAST(floor(floor(pos / 8) / 4) AS BIGINT) AS brow, CAST(floor(pos % 8 / 4) AS BIGINT) AS bcol, CASE WHEN sum(CASE WHEN cls <> 255 THEN 1 ELSE 0 END) = 0 THEN 255 ELSE CAST(round_even(100.0 * CAST(sum(CASE WHEN cls <> 255 AND cls <= 1 THEN 1 ELSE 0 END) AS DOUBLE) / sum(CASE WHEN cls <> 255 THEN 1 ELSE 0 END), 0) AS BIGINT) END AS good FROM c GROUP BY ALL", "px")
def good_share_blocks(px):
    return R.block_share(_cls(px), 8, 4, 255)


@query(", " + _MERGE + " SELECT s.event_id, s.ts, m.dn FROM sensors s JOIN m ON m.tile_id = CAST(floor(s.lon / 8.0) AS BIGINT) % 100 AND m.pos = CAST(floor(s.lat) AS BIGINT) % 8 * 8 + CAST(floor(s.lon) AS BIGINT) % 8 WHERE m.dn <> -9999", "sensors", "px")
def point_series(sensors, px):
    g = G.Grid(1.0, 8)
    tile, _ = g.tile_of_point(F.col("lon"), F.col("lat"))
    at = sensors.select("event_id", "ts", (tile % 100).alias("tile_id"), (F.floor("lat") % 8 * 8 + F.floor("lon") % 8).cast("int").alias("pos"))
    return at.join(R.merge(px, NODATA), ["tile_id", "pos"]).where(R.observed(F.col("dn"), NODATA)).select("event_id", "ts", "dn")


# Lattices, zones, projections.
_GRID = G.Grid(0.25, 100, -0.125, -0.125)
_SIZE = "(0.25 * 100)::DOUBLE"


@query("SELECT c_custkey, CAST(floor((lon + 0.125) / 25.0::DOUBLE) AS BIGINT) AS tx, CAST(floor((lat + 0.125) / 25.0::DOUBLE) AS BIGINT) AS ty FROM aoi_pts", "aoi_pts")
def tile_of_point(p):
    tx, ty = _GRID.tile_of_point(F.col("lon"), F.col("lat"))
    return p.select("c_custkey", tx.alias("tx"), ty.alias("ty"))


@query("SELECT DISTINCT x, y, x * 25.0::DOUBLE - 0.125 AS w, y * 25.0::DOUBLE - 0.125 AS s, (x + 1) * 25.0::DOUBLE - 0.125 AS e, (y + 1) * 25.0::DOUBLE - 0.125 AS n FROM obs", "obs")
def tile_bounds(obs):
    w, s, e, n = _GRID.bounds(F.col("x"), F.col("y"))
    return obs.select("x", "y", w.alias("w"), s.alias("s"), e.alias("e"), n.alias("n")).distinct()


@query("SELECT c_custkey, CAST(tx AS BIGINT) AS tx, CAST(ty AS BIGINT) AS ty FROM aoi_pts, range(-9, 9) a(tx), range(-5, 5) b(ty) WHERE tx BETWEEN floor((lon + 0.125) / 25.0::DOUBLE) AND ceil((lon + 30 + 0.125) / 25.0::DOUBLE) - 1 AND ty BETWEEN floor((lat + 0.125) / 25.0::DOUBLE) AND ceil((lat + 10 + 0.125) / 25.0::DOUBLE) - 1", "aoi_pts")
def tiles_for_bounds(p):
    lon, lat = F.col("lon"), F.col("lat")
    return _GRID.tiles(p, lon, lat, lon + 30, lat + 10).select("c_custkey", "tx", "ty")


@query("SELECT c_custkey, CAST(x AS BIGINT) AS cell_x, CAST(y AS BIGINT) AS cell_y FROM aoi_pts, range(-180, 200, 10) a(x), range(-90, 100, 10) b(y) WHERE x BETWEEN floor(lon / 10.0::DOUBLE) * 10 AND floor((lon + 15) / 10.0::DOUBLE) * 10 AND y BETWEEN floor(lat / 10.0::DOUBLE) * 10 AND floor((lat + 5) / 10.0::DOUBLE) * 10", "aoi_pts")
def degree_cells(p):
    low = lambda c: (F.floor(c / 10.0) * 10).cast("long")
    p = p.withColumn("cell_x", F.explode(F.sequence(low(F.col("lon")), low(F.col("lon") + 15), F.lit(10).cast("long"))))
    return p.withColumn("cell_y", F.explode(F.sequence(low(F.col("lat")), low(F.col("lat") + 5), F.lit(10).cast("long")))).select("c_custkey", "cell_x", "cell_y")


@query("SELECT c_custkey, CAST(floor((lon + 180) / 6.0::DOUBLE) AS BIGINT) + 1 AS zone FROM aoi_pts", "aoi_pts")
def utm_zone(p):
    return p.select("c_custkey", G.utm_zone(F.col("lon")).alias("zone"))


@query("""SELECT c_custkey, CAST(CASE WHEN lat >= 56 AND lat < 64 AND lon >= 3 AND lon < 12 THEN 32 WHEN lat >= 72 AND lat < 84 AND lon >= 0 AND lon < 42 THEN CASE WHEN lon < 9 THEN 31 WHEN lon < 21 THEN 33 WHEN lon < 33 THEN 35 ELSE 37 END
  ELSE CAST(floor((lon + 180) / 6.0::DOUBLE) AS BIGINT) + 1 END + CASE WHEN lat < 0 THEN 32700 ELSE 32600 END AS BIGINT) AS epsg FROM aoi_pts""", "aoi_pts")
def mgrs_zone(p):
    return p.select("c_custkey", G.mgrs_epsg(F.col("lon"), F.col("lat")).alias("epsg"))


@query("SELECT DISTINCT x, crs, CASE WHEN west <= east THEN west < z.e AND east > z.w ELSE west < z.e OR east > z.w END AS touches FROM (SELECT *, CAST(substr(crs, 9) AS INTEGER) * 6 - 186 AS w0 FROM obs) o, LATERAL (SELECT CAST(w0 AS DOUBLE) AS w, CAST(w0 + 6 AS DOUBLE) AS e) z", "obs")
def zone_touch(obs):
    west = (F.substring("crs", 9, 10).cast("int") * 6 - 186).cast("double")
    return obs.select("x", "crs", G.lon_overlap(F.col("west"), F.col("east"), west, west + 6).alias("touches")).distinct()


@query("SELECT c_custkey, round(lon * (pi() / 180) * 6371007.181::DOUBLE * cos(lat * (pi() / 180)), 3) AS sx, round(lat * (pi() / 180) * 6371007.181::DOUBLE, 3) AS sy FROM aoi_pts", "aoi_pts")
def sinusoidal_fwd(p):
    x, y = G.sinusoidal(F.col("lon"), F.col("lat"))
    return p.select("c_custkey", F.round(x, 3).alias("sx"), F.round(y, 3).alias("sy"))


_KR = {"n": G._N, "e": G._E, "k": 0.9996 * G._RECT}
_UTM_SQL = """, a AS (SELECT c_custkey, lat, lat * (pi() / 180) AS phi, (lon - (zone * 6 - 183)) * (pi() / 180) AS dl FROM (SELECT *, CAST(floor((lon + 180) / 6.0::DOUBLE) AS BIGINT) + 1 AS zone FROM aoi_pts)),
b AS (SELECT *, sinh(ln((1 + sin(phi)) / (1 - sin(phi))) / 2 - {e!r}::DOUBLE * (ln((1 + {e!r}::DOUBLE * sin(phi)) / (1 - {e!r}::DOUBLE * sin(phi))) / 2)) AS t FROM a),
c AS (SELECT *, atan2(t, cos(dl)) AS xi, ln((1 + sin(dl) / sqrt(1 + t * t)) / (1 - sin(dl) / sqrt(1 + t * t))) / 2 AS eta FROM b)
SELECT c_custkey, round(500000 + {k!r}::DOUBLE * (eta + {s1}), 2) AS easting, round({k!r}::DOUBLE * (xi + {s2}) + CASE WHEN lat < 0 THEN 10000000.0::DOUBLE ELSE 0.0::DOUBLE END, 2) AS northing FROM c"""
_UTM_SQL = _UTM_SQL.format(e=G._E, k=0.9996 * G._RECT, s1=" + ".join(f"{a!r}::DOUBLE * cos({2 * j} * xi) * sinh({2 * j} * eta)" for j, a in enumerate(G._ALPHA, 1)), s2=" + ".join(f"{a!r}::DOUBLE * sin({2 * j} * xi) * cosh({2 * j} * eta)" for j, a in enumerate(G._ALPHA, 1)))


@query(_UTM_SQL, "aoi_pts")
def utm_fwd(p):
    e, n = G.utm(F.col("lon"), F.col("lat"), G.utm_zone(F.col("lon")))
    return p.select("c_custkey", F.round(e, 2).alias("easting"), F.round(n, 2).alias("northing"))


@query("SELECT DISTINCT h, v, CAST(h * 5 - 90 + i AS BIGINT) AS tx, CAST(44 - v * 5 - j AS BIGINT) AS ty FROM scenes, range(0, 5) a(i), range(0, 5) b(j)", "scenes")
def modis_scene_tiles(scenes):
    s = scenes.select("h", "v").distinct().withColumn("i", F.explode(F.sequence(F.lit(0), F.lit(4)))).withColumn("j", F.explode(F.sequence(F.lit(0), F.lit(4))))
    return s.select("h", "v", (F.col("h") * 5 - 90 + F.col("i")).cast("long").alias("tx"), (44 - F.col("v") * 5 - F.col("j")).cast("long").alias("ty"))


@query("SELECT DISTINCT x, y, r AS k, CAST(((x * 100 + r) % 1440 + 1440) % 1440 AS BIGINT) AS col, CAST(360 - (y * 100 + 100 - r) + 1 AS BIGINT) AS \"row\", 360 - (y * 100 + 100 - r) + 1 BETWEEN 0 AND 720 AS valid FROM obs, range(0, 100) t(r)", "obs")
def era5_window(obs):
    t = obs.select("x", "y").distinct().withColumn("k", F.explode(_upto(99)))
    row = 360 - (F.col("y") * 100 + 100 - F.col("k")) + 1
    return t.select("x", "y", "k", F.pmod(F.col("x") * 100 + F.col("k"), F.lit(1440)).cast("long").alias("col"), row.cast("long").alias("row"), row.between(0, 720).alias("valid"))


@query("SELECT DISTINCT x, y, CAST(((x * 50 - 1800) % 3600 + 3600) % 3600 AS BIGINT) AS col, CAST(900 + y * 50 AS BIGINT) AS \"row\" FROM obs", "obs")
def pardig_window(obs):
    return obs.select("x", "y", F.pmod(F.col("x") * 50 - 1800, F.lit(3600)).cast("long").alias("col"), (900 + F.col("y") * 50).cast("long").alias("row")).distinct()


# Scenes.
@query("SELECT id, strftime(m, '%Y-%m-01') AS month FROM scenes, LATERAL (SELECT unnest(generate_series(date_trunc('month', CAST(start_date AS TIMESTAMP)), date_trunc('month', CAST(end_date AS TIMESTAMP)), INTERVAL 1 MONTH)) AS m)", "scenes")
def scene_months(s):
    return s.select("id", F.explode(F.expr("sequence(trunc(to_date(start_date), 'MM'), trunc(to_date(end_date), 'MM'), interval 1 month)")).alias("m")).select("id", F.date_format("m", "yyyy-MM-dd").alias("month"))


@query("SELECT id, i AS layer, strftime(CAST(start_date AS TIMESTAMP) + i * INTERVAL 1 DAY, '%Y-%m-%d') AS date FROM scenes, range(0, 8) t(i) WHERE kind = 'final'", "scenes")
def layer_dates(s):
    days = F.expr("sequence(to_date(start_date), to_date(end_date), interval 1 day)")
    return s.where("kind = 'final'").select("id", F.posexplode(days).alias("layer", "d")).select("id", F.col("layer").cast("long").alias("layer"), F.date_format("d", "yyyy-MM-dd").alias("date"))


@query("SELECT prefix, max(id) AS id FROM (SELECT id, array_to_string(string_split(id, '.')[1:4], '.') AS prefix FROM scenes) GROUP BY prefix", "scenes")
def newest_production(s):
    return s.groupBy(F.array_join(F.slice(F.split("id", "[.]"), 1, 4), ".").alias("prefix")).agg(F.max("id").alias("id"))


@query(", d AS (SELECT start_date AS day, max(id) FILTER (WHERE kind = 'final') AS f, max(id) FILTER (WHERE kind = 'prelim') AS p FROM scenes WHERE kind IS NOT NULL GROUP BY start_date) SELECT day, coalesce(f, p) AS id, f IS NULL AS preliminary FROM d", "scenes")
def final_over_prelim(s):
    side = lambda k: s.where(F.col("kind") == k).groupBy(F.col("start_date").alias("day")).agg(F.max("id").alias(k))
    return side("final").join(side("prelim"), "day", "full_outer").select("day", F.coalesce("final", "prelim").alias("id"), F.col("final").isNull().alias("preliminary"))


@query("SELECT id FROM scenes p WHERE kind = 'prelim' AND NOT EXISTS (SELECT 1 FROM scenes f WHERE f.kind = 'final' AND f.start_date = p.start_date)", "scenes")
def prelim_refetch(s):
    return s.where("kind = 'prelim'").join(s.where("kind = 'final'").select("start_date"), "start_date", "left_anti").select("id")


@query("SELECT h, v, o_orderkey, start_date, end_date, greatest(start_date, coalesce(max(end_date) OVER (PARTITION BY h, v ORDER BY start_date, o_orderkey ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING), start_date)) AS from_date FROM scenes", "scenes")
def segment_cover(s):
    before = Window.partitionBy("h", "v").orderBy("start_date", "o_orderkey").rowsBetween(Window.unboundedPreceding, -1)
    return s.select("h", "v", "o_orderkey", "start_date", "end_date", F.greatest(F.col("start_date"), F.coalesce(F.max("end_date").over(before), F.col("start_date"))).alias("from_date"))


@query("SELECT h, v, id FROM (SELECT *, row_number() OVER (PARTITION BY h, v ORDER BY cloud_cover < 50 DESC, CASE WHEN cloud_cover < 50 THEN start_date END DESC NULLS LAST, cloud_cover, id) AS r FROM scenes) WHERE r = 1", "scenes")
def pick_newest_complete(s):
    full = F.col("cloud_cover") < 50
    return R.newest(s, ["h", "v"], [full.desc(), F.when(full, F.col("start_date")).desc_nulls_last(), F.col("cloud_cover"), F.col("id")]).select("h", "v", "id")


@query("SELECT id, start_date FROM scenes WHERE cloud_cover <= 20 AND start_date < '1996-01-01' AND end_date >= '1995-06-01' ORDER BY start_date, id LIMIT 100", "scenes")
def scene_search(s):
    return s.where("cloud_cover <= 20 and start_date < '1996-01-01' and end_date >= '1995-06-01'").orderBy("start_date", "id").limit(100).select("id", "start_date")


@query("SELECT id, cloud_cover FROM scenes ORDER BY cloud_cover NULLS LAST, start_date, id LIMIT 50", "scenes")
def cloud_max_topk(s):
    return s.orderBy(F.col("cloud_cover").asc_nulls_last(), "start_date", "id").limit(50).select("id", "cloud_cover")


# Time.
@query("SELECT band, date_trunc('month', ts) AS month, CASE WHEN day(ts) < 11 THEN 1 WHEN day(ts) < 21 THEN 11 ELSE 21 END AS dekad, count(*) AS n, CAST(sum(cents) AS BIGINT) AS cents FROM sensors GROUP BY ALL", "sensors")
def dekad_bucket(s):
    return s.groupBy("band", F.date_trunc("month", "ts").cast("timestamp_ntz").alias("month"), F.when(F.day("ts") < 11, 1).when(F.day("ts") < 21, 11).otherwise(21).alias("dekad")).agg(F.count("*").alias("n"), F.sum("cents").alias("cents"))


@query("SELECT band, time_bucket(INTERVAL '15 minutes', ts) AS t, count(*) AS n, CAST(sum(cents) AS BIGINT) AS cents FROM sensors GROUP BY ALL", "sensors")
def window_15min(s):
    return s.groupBy("band", F.window("ts", "15 minutes").alias("w")).agg(F.count("*").alias("n"), F.sum("cents").alias("cents")).select("band", F.col("w.start").cast("timestamp_ntz").alias("t"), "n", "cents")


@query("SELECT band, strftime(ts, '%Y-%m-%d') AS day, CAST(sum(cents) AS DOUBLE) / count(*) AS mean_cents, min(cents) AS min_cents, max(cents) AS max_cents FROM sensors GROUP BY ALL", "sensors")
def daily_mean(s):
    return s.groupBy("band", F.date_format("ts", "yyyy-MM-dd").alias("day")).agg((F.sum("cents").cast("double") / F.count("*")).alias("mean_cents"), F.min("cents").alias("min_cents"), F.max("cents").alias("max_cents"))


@query(", q AS (SELECT band, time_bucket(INTERVAL '15 minutes', ts) AS t, CAST(sum(cents) AS BIGINT) AS cents FROM sensors GROUP BY ALL) SELECT band, date_trunc('hour', t) AS hour, count(*) AS quarters, CAST(sum(cents) AS DOUBLE) / count(*) AS mean_cents FROM q GROUP BY ALL", "sensors")
def hourly_from_15min(s):
    return window_15min(s).groupBy("band", F.date_trunc("hour", "t").cast("timestamp_ntz").alias("hour")).agg(F.count("*").alias("quarters"), (F.sum("cents").cast("double") / F.count("*")).alias("mean_cents"))


@query("SELECT event_id, band, cents - coalesce(lag(cents) OVER (PARTITION BY band, CAST(ts AS DATE) ORDER BY ts, event_id), 0) AS step FROM sensors", "sensors")
def accum_diff(s):
    w = Window.partitionBy("band", F.to_date("ts")).orderBy("ts", "event_id")
    return s.select("event_id", "band", (F.col("cents") - F.coalesce(F.lag("cents").over(w), F.lit(0))).alias("step"))


query_of(f", early AS (SELECT * FROM obs WHERE l_linenumber <= 5), {_RESOLVED.replace('FROM obs)', 'FROM early)')}, now AS (SELECT date, band, cloud_pct FROM resolved UNION ALL SELECT date, band, cloud_pct FROM obs WHERE l_linenumber > 5) {_COVER.format('true').replace('FROM obs', 'FROM now')}", "obs", name="catalog_publish")(store.publish_query)


# Not expressible in SQL.
def _codec(spark: SparkSession, sf_dir: str) -> DataFrame:
    from rastrum.sources import codec

    return codec.roundtrip(view(spark, sf_dir, "px"))


def _bounds(spark: SparkSession, sf_dir: str) -> DataFrame:
    from rastrum.functions.bounds import wgs84_bounds

    tiles = view(spark, sf_dir, "obs").select("crs", "x", "y").distinct()
    w, s, e, n = G.Grid(10.0, 256).bounds(F.col("x") * 40 + 100, F.col("y") * 60 + 1500)
    return wgs84_bounds(tiles.select("crs", "x", "y", w.alias("west"), s.alias("south"), e.alias("east"), n.alias("north")))


def queries() -> dict:
    from rastrum.plans import decisions, kernels, scalars, searches, stored, streams  # noqa: F401  they register their own

    return _QUERIES | {"wgs84_bounds_projected": _bounds, "tile_codec_roundtrip": _codec}


def oracle_sql() -> dict[str, str]:
    from rastrum.plans import decisions, kernels, scalars, searches, stored, streams  # noqa: F401

    return dict(_SQL)
