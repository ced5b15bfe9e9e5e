"""Registered queries that read, merge and compact stored tiles, with their SQL on the same pixels."""

from __future__ import annotations

from pyspark.sql import functions as F

from rastrum import sql
from rastrum.functions import grid as G
from rastrum.operators import blobs as B
from rastrum.operators import pyramid as L
from rastrum.operators import tiles as T
from rastrum.operators import waves as W
from rastrum.plans.registry import RING, query
from rastrum.sources import codec, store
from rastrum.sources.shared import work_dir

EDGE, ACROSS, NODATA = 8, 10, -9999
_RING = [(x * 2.0, y * 2.0) for x, y in RING]
#: Cloud of a scene's tile, from its numbers; some are not known.
_CLOUD = "CASE WHEN (tile_id * 7 + vec_id % 5 * 3) % 11 = 10 THEN NULL ELSE CAST((tile_id * 7 + vec_id % 5 * 3) % 11 AS DOUBLE) END"
_T = f"t AS (SELECT *, {_CLOUD} AS cloud FROM px)"
_CLEANEST = f"{_T}, r AS (SELECT *, dense_rank() OVER (PARTITION BY tile_id ORDER BY coalesce(cloud, 1e9), scene_id) AS k FROM t), m AS (SELECT tile_id, pos, coalesce(arg_min(dn, k) FILTER (dn <> -9999), -9999) AS dn FROM r GROUP BY ALL), g AS (SELECT tile_id % 10 * 8 + pos % 8 AS col, tile_id // 10 * 8 + pos // 8 AS \"row\", dn FROM m)"


def stored(px):
    """Rows of a store of 8 x 8 tiles: one for each scene's part of a tile."""
    tiles = px.groupBy("tile_id", "vec_id", "scene_id").agg(F.transform(F.array_sort(F.collect_list(F.struct("pos", "dn"))), lambda s: s["dn"]).alias("px"), F.count_if(F.col("dn") != NODATA).cast("int").alias("valid_px"))
    x, y = F.col("tile_id") % ACROSS, F.floor(F.col("tile_id") / ACROSS).cast("long")
    named = tiles.select(
        F.lit("B").alias("band"), F.lit("2024-06-01").alias("date"), x.alias("x"), y.alias("y"), F.lit("EPSG:32636").alias("crs"), F.lit(10.0).alias("res"), F.lit(EDGE).alias("tile_px"),
        *((v.cast("double") / 1000).alias(k) for k, v in (("west", x), ("south", y), ("east", x + 1), ("north", y + 1))),
        F.lit("orbit_1").alias("acq"), "scene_id", "valid_px", F.expr(_CLOUD).alias("cloud_pct"), F.col("vec_id").cast("long").alias("fetched_at"), F.lit(0).cast("long").alias("size_bytes"), "px")
    return codec.encode_tiles(named, EDGE, NODATA)


def published(px):
    """(path, catalog) of these tiles in a store that also has another band and another month, and of what its catalog says."""
    spark, path = px.sparkSession, work_dir(px.sparkSession)
    tiles = stored(px)
    store.append(tiles, f"{path}/tiles")
    store.append(tiles.where("x < 5").withColumn("date", F.lit("2024-07-01")).unionByName(tiles.where("x >= 5").withColumn("band", F.lit("Q"))), f"{path}/tiles")
    return f"{path}/tiles", store.rebuild_catalog(spark, f"{path}/tiles", f"{path}/catalog")


def _found(px, where: str = "true"):
    """Blobs of band B in June: the catalog's rows, then the files that these name."""
    path, catalog = published(px)
    rows = catalog.where((F.col("band") == "B") & T.date_prefix("2024-06") & F.expr(where))
    return store.read_rows(px.sparkSession, path, rows, [*B.KEY, "scene_id"])


def _pixels(rasters):
    """One row for each pixel, to be compared."""
    p = rasters.select("x", "y", F.posexplode("px").alias("pos", "dn"))
    return p.select((F.col("y") * EDGE + F.floor(F.col("pos") / EDGE)).cast("long").alias("row"), (F.col("x") * EDGE + F.col("pos") % EDGE).cast("long").alias("col"), F.col("dn").cast("long").alias("dn"))


@query("SELECT tile_id, scene_id, CAST(pos AS BIGINT) AS pos, CAST(dn AS BIGINT) AS dn FROM px WHERE scene_id = 'scene_2'", "px")
def tiles_read(px):
    back = codec.decode_tiles(_found(px, "scene_id = 'scene_2'"))
    return back.select((F.col("y") * ACROSS + F.col("x")).alias("tile_id"), "scene_id", F.posexplode("px").alias("pos", "dn")).select("tile_id", "scene_id", F.col("pos").cast("long").alias("pos"), F.col("dn").cast("long").alias("dn"))


@query(f", {_CLEANEST} SELECT \"row\", col, dn FROM g", "px")
def mosaic_of_store(px):
    return _pixels(B.mosaic(_found(px), EDGE))


_CROSSED = " + ".join(f"CAST(({y0} > \"row\" + 0.5) <> ({y1} > \"row\" + 0.5) AND col + 0.5 < {x1 - x0}::DOUBLE * (\"row\" + 0.5 - {y0}) / {y1 - y0}::DOUBLE + {x0} AS INTEGER)" for (x0, y0), (x1, y1) in zip(_RING, _RING[1:] + _RING[:1]) if y0 != y1)


@query(f", {_CLEANEST} SELECT \"row\", col, CASE WHEN ({_CROSSED}) % 2 = 1 THEN dn ELSE -9999 END AS dn FROM g", "px")
def clip_of_store(px):
    return _pixels(B.mosaic(_found(px), EDGE, _RING))


@query("SELECT tile_id, scene_id, CASE WHEN dn <> -9999 THEN CAST(dn AS DOUBLE) END AS value FROM px WHERE pos = 3 * 8 + 5", "px")
def series_of_store(px):
    found = B.series(_found(px), 3, 5)
    return found.orderBy("date", F.coalesce("acq", F.lit("")), "crs").select((F.col("y") * ACROSS + F.col("x")).alias("tile_id"), "scene_id", "value")


_PARTS = f"{_T}, s AS (SELECT tile_id, vec_id, scene_id, cloud, count(*) FILTER (dn <> -9999) AS n FROM t GROUP BY ALL)"
# A part's cloud weighs by the pixels that it gives, not by those that it has.


@query(f""", {_PARTS}, u AS (SELECT t.*, row_number() OVER (PARTITION BY t.tile_id, t.pos ORDER BY s.n DESC, s.scene_id) AS k FROM t JOIN s USING (vec_id)),
  m AS (SELECT tile_id, pos, coalesce(arg_min(dn, k) FILTER (dn <> -9999), -9999) AS dn, min(k) FILTER (dn <> -9999) AS k FROM u GROUP BY ALL),
  w AS (SELECT tile_id, k, count(*) AS n FROM m WHERE k IS NOT NULL GROUP BY ALL), o AS (SELECT DISTINCT tile_id, k, cloud FROM u),
  h AS (SELECT tile_id, round_even(sum(cloud * n) / sum(n) FILTER (cloud IS NOT NULL), 2) AS cloud_pct FROM w JOIN o USING (tile_id, k) GROUP BY tile_id),
  c AS (SELECT tile_id, string_agg(scene_id, '|' ORDER BY scene_id) AS scenes, max(vec_id) AS fetched_at, cloud_pct FROM s LEFT JOIN h USING (tile_id) GROUP BY tile_id, cloud_pct)
  SELECT tile_id, scenes, fetched_at, cloud_pct, CAST(count(*) FILTER (dn <> -9999) AS BIGINT) AS valid_px, CAST(sum(dn * (pos + 1)) AS BIGINT) AS digest FROM m JOIN c USING (tile_id) GROUP BY ALL""", "px")
def merged_of_store(px):
    path, _ = published(px)
    store.compact(px.sparkSession, path)
    m = codec.decode_tiles(store.scan(px.sparkSession, path, "2024-06").where("band = 'B'"))
    digest = F.aggregate(F.transform("px", lambda v, i: v.cast("long") * (i + 1)), F.lit(0).cast("long"), lambda a, v: a + v)
    return m.select((F.col("y") * ACROSS + F.col("x")).alias("tile_id"), F.col("scene_id").alias("scenes"), "fetched_at", "cloud_pct", F.col("valid_px").cast("long").alias("valid_px"), digest.alias("digest"))


@query(f""", {_T}, s AS (SELECT tile_id, vec_id, scene_id, CAST(sum(dn * (pos + 1)) AS BIGINT) AS digest FROM px WHERE vec_id % 5 = 1 GROUP BY ALL) SELECT tile_id, scene_id, digest, true AS smaller, true AS sealed FROM s""", "px")
def reencoded_store(px):
    """Tiles written in strips of a row each, then their month written anew."""
    spark, path = px.sparkSession, f"{work_dir(px.sparkSession)}/tiles"
    tiles = stored(px.where("vec_id % 5 = 1"))
    thin = F.pandas_udf(lambda v: v.map(lambda b: codec.write(codec.read(b), strip_rows=1)), "binary")
    store.append(tiles.withColumn("data", thin("data")).withColumn("size_bytes", F.length("data").cast("long")), path)
    before = store.scan(spark, path).select("x", "y", F.length("data").alias("was"))
    done, _ = store.compact(spark, path, smaller=True)
    m = codec.decode_tiles(store.scan(spark, path).withColumn("now", F.length("data"))).join(before, ["x", "y"])
    digest = F.aggregate(F.transform("px", lambda v, i: v.cast("long") * (i + 1)), F.lit(0).cast("long"), lambda a, v: a + v)
    whole = all(c.sealed and c.bytes_after < c.bytes_before for c in done)
    return m.select((F.col("y") * ACROSS + F.col("x")).alias("tile_id"), "scene_id", digest.alias("digest"), ((F.col("now") < F.col("was")) & (F.col("now") == F.col("size_bytes"))).alias("smaller"), F.lit(whole).alias("sealed"))


def _in_sql(px, text: str):
    """A SQL text over the published tiles and the engine's functions."""
    spark = px.sparkSession
    path, catalog = published(px)
    sql.register(spark, catalog, store.scan(spark, path, "2024-06"))
    return spark.sql(text)


_BOX = "'B', '2024-06', 0.0015D, 0.0005D, 0.0065D, 0.0035D"
_INSIDE = "tile_id % 10 BETWEEN 1 AND 6 AND tile_id // 10 BETWEEN 0 AND 3"


@query(f"SELECT DISTINCT tile_id % 10 AS x, tile_id // 10 AS y, scene_id FROM px WHERE {_INSIDE}", "px")
def sql_tiles_for_bbox(px):
    return _in_sql(px, f"SELECT x, y, scene_id FROM tiles_for_bbox({_BOX})")


@query(f"SELECT tile_id % 10 AS x, tile_id // 10 AS y, scene_id, CASE WHEN dn <> -9999 THEN CAST(dn AS DOUBLE) END AS value FROM px WHERE pos = 2 * 8 + 6 AND {_INSIDE}", "px")
def sql_tile_values(px):
    return _in_sql(px, f"SELECT c.x, c.y, c.scene_id, tile_value(t.data, 2, 6) AS value FROM tiles_for_bbox({_BOX}) c JOIN tiles t ON t.band = c.band AND t.date = c.date AND t.x = c.x AND t.y = c.y AND t.scene_id = c.scene_id")


@query("SELECT scene_id, count(*) FILTER (dn <> -9999) AS n_observed, CAST(sum(CASE WHEN dn <> -9999 THEN dn END) AS DOUBLE) AS total FROM px GROUP BY scene_id", "px")
def sql_scene_totals(px):
    return _in_sql(px, "SELECT scene_id, count_if(v <> -9999) AS n_observed, sum(CASE WHEN v <> -9999 THEN v END) AS total FROM (SELECT scene_id, explode(tile_decode(data)) AS v FROM tiles WHERE band = 'B') GROUP BY scene_id")


# Two waves: masks of 20 m, read anew for every third tile and otherwise stored, some in two rows; bands of 10 m on a lattice of their own.
MASKS, BANDS = G.Grid(20.0, EDGE), G.Grid(10.0, EDGE, 30.0, -50.0)
_CLASS = "CASE WHEN dn = -9999 THEN 0 ELSE abs(dn) % 12 END"


@query(f""", f AS (SELECT tile_id, pos, {_CLASS} AS cls FROM px WHERE vec_id % 5 = 0 AND tile_id % 3 = 0),
  a AS (SELECT tile_id, pos, {_CLASS} AS cls, CASE vec_id % 5 WHEN 3 THEN 'scene_0|scene_3' ELSE scene_id END AS scenes FROM px WHERE vec_id % 5 = 1 OR vec_id % 5 = 3 AND tile_id % 7 <> 2),
  n AS (SELECT tile_id, scenes, count(*) FILTER (cls <> 0) AS seen FROM a GROUP BY ALL),
  s AS (SELECT tile_id, pos, coalesce(arg_min(cls, (-seen, scenes)) FILTER (cls <> 0), 0) AS cls FROM a JOIN n USING (tile_id, scenes) WHERE tile_id % 7 <> 2 GROUP BY ALL),
  m AS (SELECT * FROM f UNION ALL SELECT * FROM s WHERE tile_id NOT IN (SELECT tile_id FROM f)),
  g AS (SELECT tile_id % 10 * 8 + pos % 8 AS gx, tile_id // 10 * 8 + 7 - pos // 8 AS gy, cls FROM m),
  t AS (SELECT x, y FROM range(0, 20) a(x), range(0, 500) b(y) WHERE y < 2 * (SELECT max(tile_id) // 10 + 1 FROM px)),
  p AS (SELECT x, y, CAST(floor((30 + (x * 8 + i + 0.5::DOUBLE) * 10) / 20) AS BIGINT) AS gx, CAST(floor((-50 + (y * 8 + j + 0.5::DOUBLE) * 10) / 20) AS BIGINT) AS gy FROM t, range(0, 8) c(i), range(0, 8) d(j)),
  r AS (SELECT x, y, count(*) FILTER (cls <> 0) AS n_valid, count(*) FILTER (cls IN (1, 3, 8, 9, 10)) AS bad FROM p LEFT JOIN g ON g.gx = p.gx AND g.gy = p.gy GROUP BY ALL)
  SELECT CAST(x AS BIGINT) AS x, CAST(y AS BIGINT) AS y, n_valid, CASE WHEN n_valid > 0 THEN round_even(bad::DOUBLE / n_valid * 100, 2) END AS cloud_pct, n_valid > 0 AND bad * 100 <= 40 * n_valid AS fetched FROM r""", "px")
def two_waves(px):
    cls = F.when(F.col("dn") == NODATA, 0).otherwise(F.abs("dn") % 12)
    x, y = (F.col("tile_id") % 10).alias("x"), F.floor(F.col("tile_id") / 10).cast("long").alias("y")
    maps = px.groupBy("tile_id", "vec_id", "scene_id").agg(F.transform(F.array_sort(F.collect_list(F.struct("pos", cls.alias("c")))), lambda s: s["c"].cast("int")).alias("px"))
    part = F.col("vec_id") % 5
    fresh = maps.where((part == 0) & (F.col("tile_id") % 3 == 0)).select(x, y, "px")
    # As in the SQL, a seventh of the tiles isn't rebuilt, and the others are from whichever of both parts is there: the last tile may lack one.
    held = maps.where(part.isin(1, 3) & (F.col("tile_id") % 7 != 2)).select(x, y, F.when(part == 3, "scene_0|scene_3").otherwise(F.col("scene_id")).alias("scene_id"), "px")
    masks = W.fresh_first(fresh, W.rebuilt(held, ("scene_0", "scene_1")))
    rows = px.agg(F.max("tile_id")).first()[0] // 10 + 1
    planned = px.sparkSession.range(20).select(F.col("id").alias("x"), F.explode(F.sequence(F.lit(0).cast("long"), F.lit(2 * rows - 1).cast("long"))).alias("y"))
    seen = W.judged(planned, masks, BANDS, MASKS)
    fetched = W.second_wave(planned, seen, 40.0).withColumn("fetched", F.lit(True))
    return seen.join(fetched, ["x", "y"], "left").select("x", "y", "n_valid", "cloud_pct", F.coalesce("fetched", F.lit(False)).alias("fetched"))


# Levels: of the first scene's tiles.
_MEAN = "CASE WHEN count(*) FILTER (v <> -9999) = 0 THEN -9999 ELSE CAST(floor((2 * sum(v) FILTER (v <> -9999) + count(*) FILTER (v <> -9999)) / (2 * count(*) FILTER (v <> -9999))) AS BIGINT) END"


@query(f""", l0 AS (SELECT tile_id % 10 * 8 + pos % 8 AS c, tile_id // 10 * 8 + pos // 8 AS r, dn AS v FROM px WHERE vec_id % 5 = 0),
  l1 AS (SELECT c // 4 AS c, r // 4 AS r, {_MEAN} AS v FROM l0 GROUP BY ALL), l2 AS (SELECT c // 4 AS c, r // 4 AS r, {_MEAN} AS v FROM l1 GROUP BY ALL),
  e AS (SELECT 1 AS level, * FROM l1 UNION ALL SELECT 2, * FROM l2)
  SELECT level, c // 8 AS x, r // 8 AS y, count(*) FILTER (v <> -9999) AS n, CAST(coalesce(sum(v * (r % 8 * 8 + c % 8 + 1)) FILTER (v <> -9999), 0) AS BIGINT) AS digest FROM e GROUP BY ALL""", "px")
def pyramid_levels(px):
    spark, path = px.sparkSession, work_dir(px.sparkSession)
    tiles = px.where("vec_id % 5 = 0").groupBy("tile_id").agg(F.transform(F.array_sort(F.collect_list(F.struct("pos", "dn"))), lambda s: s["dn"]).alias("px"))
    L.publish(tiles.select((F.col("tile_id") % 10).alias("x"), F.floor(F.col("tile_id") / 10).cast("long").alias("y"), "px"), path, EDGE, NODATA, 2)
    both = L.read(spark, path, 10.0, 45.0, 2).unionByName(L.read(spark, path, 10.0, 1000.0, 2))
    ok = F.filter(F.transform("px", lambda v, i: F.when(v != NODATA, v.cast("long") * (i + 1))), lambda v: v.isNotNull())
    return both.select("level", "x", "y", F.size(ok).cast("long").alias("n"), F.aggregate(ok, F.lit(0).cast("long"), lambda a, v: a + v).alias("digest"))
