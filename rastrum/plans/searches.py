"""Registered queries of searches: pages of items written as a search would give them, then parsed."""

from __future__ import annotations

from pyspark.sql import functions as F

from rastrum.functions.views import view
from rastrum.plans.registry import query_of
from rastrum.sources import stac
from rastrum.sources.shared import work_dir

_SQL = """SELECT id AS scene, start_date AS date, CASE WHEN o_orderkey % 2 = 0 THEN 'EPSG:' || (32601 + h) ELSE 'EPSG:' || (32701 + v) END AS crs, CASE WHEN o_orderkey % 9 = 0 THEN NULL ELSE cloud_cover END AS cloud_pct,
  CASE o_orderkey % 4 WHEN 0 THEN 'GS2A_' || h || '_' || v WHEN 1 THEN 'sentinel-1a_' || o_orderkey WHEN 2 THEN 'landsat-9_' || lpad(CAST(h AS VARCHAR), 3, '0') END AS acq,
  CASE WHEN o_orderkey % 3 = 0 THEN 'B04' ELSE 'red' END AS asset, 'x/' || o_orderkey AS href,
  CASE WHEN o_orderkey % 6 <> 5 THEN h * 1000.0::DOUBLE END AS west, CASE WHEN o_orderkey % 6 <> 5 THEN v * 1000.0::DOUBLE - 20 * 10 END AS south, CASE WHEN o_orderkey % 6 <> 5 THEN h * 1000.0::DOUBLE + 30 * 10 END AS east, CASE WHEN o_orderkey % 6 <> 5 THEN v * 1000.0::DOUBLE END AS north
  FROM scenes WHERE o_orderkey % 7 <> 6"""


@query_of(f", s AS ({_SQL}) SELECT * FROM s", "scenes")
def stac_scenes(spark, sf_dir):
    """Pages of 200 items, some of which come on two pages; a seventh of the items has no raster asked for, a sixth no place."""
    s, k, folder = view(spark, sf_dir, "scenes"), F.col("o_orderkey"), work_dir(spark)
    here = F.when(k % 6 != 5, F.array(F.lit(10.0), F.lit(0.0), F.col("h") * 1000.0, F.lit(0.0), F.lit(-10.0), F.col("v") * 1000.0))
    shape = F.when(k % 6 != 5, F.array(F.lit(20), F.lit(30)))
    name = F.when(k % 7 == 6, "thumbnail").when(k % 3 == 0, "B04").otherwise("red")
    # Even items have their raster's place on the asset, odd ones on the item.
    asset = F.struct(F.concat(F.lit("x/"), k.cast("string")).alias("href"), F.when(k % 2 == 0, here).alias("proj:transform"), F.when(k % 2 == 0, shape).alias("proj:shape"), F.lit("image/tiff").alias("type"))
    properties = F.struct(
        F.concat("start_date", F.lit("T10:00:00.000Z")).alias("datetime"), F.when(k % 4 == 2, "LANDSAT-9").otherwise("Sentinel-1A").alias("platform"), F.when(k % 9 != 0, F.col("cloud_cover")).alias("eo:cloud_cover"),
        F.when(k % 2 == 0, 32601 + F.col("h")).alias("proj:epsg"), F.when(k % 2 == 1, F.concat(F.lit("EPSG:"), (32701 + F.col("v")).cast("string"))).alias("proj:code"), F.when(k % 2 == 1, here).alias("proj:transform"), F.when(k % 2 == 1, shape).alias("proj:shape"),
        F.when(k % 4 == 0, F.concat(F.lit("GS2A_"), F.col("h").cast("string"), F.lit("_"), F.col("v").cast("string"), F.lit("_N05.09"))).alias("s2:datatake_id"), F.when(k % 4 == 1, k).alias("sat:absolute_orbit"), F.when(k % 4 == 2, F.lpad(F.col("h").cast("string"), 3, "0")).alias("landsat:wrs_path"))
    item = F.struct(F.lit("Feature").alias("type"), F.col("id"), properties.alias("properties"), F.create_map(name, asset).alias("assets"))
    page = F.explode(F.when(k % 10 == 0, F.array(F.floor(k / 800), F.floor(k / 800) + 1)).otherwise(F.array(F.floor(k / 800))))
    pages = s.select(page.alias("page"), item.alias("item")).groupBy("page").agg(F.to_json(F.struct(F.lit("FeatureCollection").alias("type"), F.collect_list("item").alias("features"))).alias("value"))
    pages.select("value").write.option("maxRecordsPerFile", 1).text(folder)
    return stac.scenes(stac.items(stac.read_pages(spark, folder)), "B04", "red")
