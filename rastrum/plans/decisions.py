"""Registered queries of mosaic decisions, with SQL on the same pixels and points."""

from __future__ import annotations

from pyspark.sql import functions as F

from rastrum.functions import footprints as P
from rastrum.functions import grid as G
from rastrum.functions.views import view
from rastrum.operators import choice
from rastrum.plans.registry import query_of

# Tiles of 8 pixels of a kilometre about 30 E 38 N, where two zones meet: the scenes are two overpasses, one of them in both zones, and tiles of neither.
GRID = G.Grid(1000.0, 8)
_PLACES = {0: ("a", 36), 1: ("a", 36), 2: ("a", 35), 3: ("b", 36), 4: (None, 35)}
_ROWS = "VALUES " + ", ".join(f"({k}, {repr(a) if a else 'NULL'}, {z})" for k, (a, z) in _PLACES.items())
_EAST = "CASE zone WHEN 36 THEN 29 ELSE 90 END"
_MID = "CASE zone WHEN 36 THEN 237300 ELSE 762700 END"
#: Bounds in degrees, by rule of thumb, never smaller than the tile.
_BOUNDS = f"30 + ((x * 8000 - {_MID}) / 87600.0::DOUBLE) - 0.05::DOUBLE AS west, 30 + ((x * 8000 + 8000 - {_MID}) / 87600.0::DOUBLE) + 0.05::DOUBLE AS east, 38 + ((y * 8000 - 4207000) / 111000.0::DOUBLE) - 0.05::DOUBLE AS south, 38 + ((y * 8000 + 8000 - 4207000) / 111000.0::DOUBLE) + 0.05::DOUBLE AS north"
_SEEN = "CASE WHEN vec_id % 5 = 2 THEN dn <> -9999 ELSE dn <> -9999 AND (tile_id + pos) % 3 <> vec_id % 3 END"


def catalog_of_masks(spark, sf_dir):
    px = view(spark, sf_dir, "px")
    places = spark.createDataFrame([(k, a, z) for k, (a, z) in _PLACES.items()], "k long, acq string, zone int")
    bit = F.when(F.expr(_SEEN), F.lit(1)).otherwise(0)
    byte = px.select("tile_id", "vec_id", F.floor(F.col("pos") / 8).alias("b"), (bit * F.pow(F.lit(2), 7 - F.col("pos") % 8)).alias("v")).groupBy("tile_id", "vec_id", "b").agg(F.sum("v").cast("int").alias("v"))
    packed = byte.groupBy("tile_id", "vec_id").agg(F.unhex(F.array_join(F.transform(F.array_sort(F.collect_list(F.struct("b", "v"))), lambda s: F.lpad(F.hex(s["v"]), 2, "0")), "")).alias("mask"))
    rows = packed.withColumn("k", F.col("vec_id") % 5).join(F.broadcast(places), "k")
    rows = rows.withColumns({"x": F.expr(f"tile_id % 10 + {_EAST}").cast("long"), "y": F.expr("floor(tile_id / 10) + 520").cast("long")})
    spark_bounds = [F.expr(b.replace("::DOUBLE", "D")) for b in _BOUNDS.split(", ")]
    return rows.select(F.lit("B").alias("band"), F.lit("2024-06-01").alias("date"), "x", "y", F.concat(F.lit("EPSG:326"), F.col("zone").cast("string")).alias("crs"), "acq", "mask", *spark_bounds)


def requests_of(spark, sf_dir):
    c = spark.read.parquet(f"{sf_dir.rstrip('/')}/customer.parquet").select(F.col("c_custkey").alias("req"))
    w, s = 29.5 + F.col("req") % 11 * 0.1, 37.65 + F.col("req") % 13 * 0.04
    return c.select("req", F.lit("B").alias("band"), F.lit("2024-06-01").alias("date"), w.alias("w"), s.alias("s"), (w + 0.3).alias("e"), (s + 0.2).alias("n"))


_K = 0.9996 * G._RECT
_FWD = "".join(f" + {a!r}::DOUBLE * cos({2 * j} * xi) * sinh({2 * j} * eta)" for j, a in enumerate(G._ALPHA, 1)), "".join(f" + {a!r}::DOUBLE * sin({2 * j} * xi) * cosh({2 * j} * eta)" for j, a in enumerate(G._ALPHA, 1))
_DECIDED = f"""k(k, acq, zone) AS ({_ROWS}),
  cells AS (SELECT tile_id, vec_id, acq, zone, 'EPSG:326' || zone AS crs, CAST(tile_id % 10 + {_EAST} AS BIGINT) AS x, CAST(tile_id // 10 + 520 AS BIGINT) AS y FROM (SELECT DISTINCT tile_id, vec_id FROM px) JOIN k ON k = vec_id % 5),
  cat AS (SELECT *, {_BOUNDS} FROM cells),
  obs_px AS (SELECT vec_id, x * 8 + pos % 8 AS gx, y * 8 + 7 - pos // 8 AS gy FROM px JOIN cells USING (tile_id, vec_id) WHERE {_SEEN}),
  r AS (SELECT req, w, s, w + 0.3::DOUBLE AS e, s + 0.2::DOUBLE AS n FROM (SELECT c_custkey AS req, 29.5::DOUBLE + c_custkey % 11 * 0.1::DOUBLE AS w, 37.65::DOUBLE + c_custkey % 13 * 0.04::DOUBLE AS s FROM customer)),
  f AS (SELECT req, vec_id, x, y, crs, zone, coalesce(acq, 'none') AS name, acq IS NULL AS last FROM r JOIN cat ON north > s AND south < n AND east > w AND west < e),
  c1 AS (SELECT req, name, last, crs, zone, count(*) AS n FROM f GROUP BY ALL),
  c2 AS (SELECT req, name, last, arg_min(crs, (crs <> CASE WHEN (w + e) / 2 < 30 THEN 'EPSG:32635' ELSE 'EPSG:32636' END, -c1.n, crs)) AS crs FROM c1 JOIN r USING (req) GROUP BY ALL),
  p AS (SELECT req, w + (i + 0.5::DOUBLE) / 8 * (e - w) AS lon, s + (j + 0.5::DOUBLE) / 8 * (n - s) AS lat FROM r, range(0, 8) a(i), range(0, 8) b(j)),
  u0 AS (SELECT req, lon, lat, crs, lat * (pi() / 180) AS phi, (lon - (zone * 6 - 183)) * (pi() / 180) AS dl FROM p JOIN (SELECT DISTINCT req, crs, zone FROM f) USING (req)),
  u1 AS (SELECT *, sinh(ln((1 + sin(phi)) / (1 - sin(phi))) / 2 - {G._E!r}::DOUBLE * (ln((1 + {G._E!r}::DOUBLE * sin(phi)) / (1 - {G._E!r}::DOUBLE * sin(phi))) / 2)) AS t FROM u0),
  u2 AS (SELECT *, atan2(t, cos(dl)) AS xi, ln((1 + sin(dl) / sqrt(1 + t * t)) / (1 - sin(dl) / sqrt(1 + t * t))) / 2 AS eta FROM u1),
  u AS (SELECT req, lon, lat, crs, CAST(floor((500000 + {_K!r}::DOUBLE * (eta{_FWD[0]})) / 1000) AS BIGINT) AS gx, CAST(floor({_K!r}::DOUBLE * (xi{_FWD[1]}) / 1000) AS BIGINT) AS gy FROM u2),
  h AS (SELECT DISTINCT u.req, f.name, u.crs, lon, lat FROM u JOIN f ON f.req = u.req AND f.crs = u.crs AND f.x = u.gx // 8 AND f.y = u.gy // 8 JOIN obs_px o ON o.vec_id = f.vec_id AND o.gx = u.gx AND o.gy = u.gy),
  cov AS (SELECT c2.req, c2.name, c2.last, c2.crs, count(lon) AS cover FROM c2 LEFT JOIN h ON h.req = c2.req AND h.name = c2.name AND h.crs = c2.crs GROUP BY ALL),
  best AS (SELECT *, count(*) FILTER (cover > 0) OVER (PARTITION BY req) AS seen_at, row_number() OVER (PARTITION BY req ORDER BY cover DESC, last, name) AS place FROM cov QUALIFY place = 1),
  el AS (SELECT DISTINCT h.req, h.name, best.crs, h.lon, h.lat FROM h JOIN best ON best.req = h.req AND best.name = h.name AND best.crs <> h.crs),
  near AS (SELECT DISTINCT el.* FROM el JOIN u USING (req, lon, lat, crs) JOIN f ON f.req = el.req AND f.crs = el.crs AND f.name = el.name JOIN obs_px o ON o.vec_id = f.vec_id AND abs(o.gx - u.gx) <= 1 AND abs(o.gy - u.gy) <= 1),
  lack AS (SELECT DISTINCT req FROM (SELECT * FROM el EXCEPT SELECT * FROM near))
  SELECT req, CASE WHEN NOT last THEN name END AS acq, crs, CAST(64 AS BIGINT) AS n_points, cover, CASE WHEN cover > 0 THEN seen_at - 1 ELSE 0 END AS others, req IN (SELECT req FROM lack) AS left_out FROM best"""


@query_of(f", {_DECIDED}", "px")
def mosaic_decisions(spark, sf_dir):
    edges = [F.col(c).alias(name) for c, name in (("w", "west"), ("s", "south"), ("e", "east"), ("n", "north"))]
    lattice = lambda asked: P.request_lattice(asked.select("req", *edges), 1.0, 1.0, least=8, key="req")
    return choice.decided_once(requests_of(spark, sf_dir), catalog_of_masks(spark, sf_dir), lattice, GRID)
