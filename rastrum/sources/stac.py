"""STAC item pages, as a search gives them, to scenes: parsed by Spark, each item once."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from rastrum.functions import footprints as P
from rastrum.functions import scalars as S

#: What is read of an item; all else is passed over.
_PROPERTIES = "datetime string, platform string, `eo:cloud_cover` double, `proj:epsg` int, `proj:code` string, `proj:transform` array<double>, `proj:shape` array<int>, `s2:datatake_id` string, `sat:absolute_orbit` long, `landsat:wrs_path` string"
ITEM = f"id string, properties struct<{_PROPERTIES.replace(' string', ':string').replace(' double', ':double').replace(' int', ':int').replace(' array', ':array').replace(' long', ':long')}>, assets map<string, struct<href:string, `proj:transform`:array<double>, `proj:shape`:array<int>>>"
PAGE = f"array<struct<{ITEM.replace('id string', 'id:string').replace('properties struct', 'properties:struct').replace('assets map', 'assets:map')}>>"


def read_pages(spark: SparkSession, folder: str) -> DataFrame:
    """(page, text) of the files in a folder, a page each."""
    return spark.read.text(folder, wholetext=True).select(F.input_file_name().alias("page"), F.col("value").alias("text"))


def items(pages: DataFrame) -> DataFrame:
    """Items (page, id, properties, assets) of pages (page, text: an item collection, or one item), each id once: that of the first page by name, since a search that goes on while items are added repeats some. A text that is no JSON, or an item without an id, is an error that names the page."""
    features = F.from_json(F.get_json_object("text", "$.features"), PAGE)
    alone = F.array(F.from_json("text", ITEM))
    kind = F.get_json_object("text", "$.type")
    found = pages.select("page", F.explode(F.when(kind == "FeatureCollection", F.coalesce(features, F.array().cast(PAGE))).when(kind == "Feature", alone).otherwise(F.raise_error(F.concat(F.lit("no STAC page: "), F.col("page"))).cast(PAGE))).alias("i"))
    named = found.select("page", F.when(F.col("i.id").isNull(), F.raise_error(F.concat(F.lit("an item without an id: "), F.col("page")))).otherwise(F.col("i.id")).alias("id"), "i.properties", "i.assets")
    first = F.row_number().over(Window.partitionBy("id").orderBy("page"))
    return named.withColumn("_r", first).where("_r = 1").drop("_r")


def acquisition(p: Column, scene: Column) -> Column:
    """Name of the overpass that a scene is part of, by what its properties hold: the datatake without its baseline, else platform and orbit, else platform and path; null for other products."""
    radar, optical = p["sat:absolute_orbit"], p["landsat:wrs_path"]
    platform = S.required(p["platform"], scene, "platform")
    return F.when(p["s2:datatake_id"].isNotNull(), S.without_baseline(p["s2:datatake_id"])).when(radar.isNotNull(), S.pass_name(platform, radar)).when(optical.isNotNull(), S.pass_name(platform, optical))


def scenes(found: DataFrame, *assets: str) -> DataFrame:
    """(scene, date, crs, cloud_pct, acq, asset, href, west, south, east, north): items with the first of some assets that each has (left out if none), and the extent of its raster from the asset's projection fields, or else the item's; null where neither tells, or the raster is rotated."""
    p, name = F.col("properties"), S.first_asset(F.col("assets"), *assets)
    one = found.withColumn("asset", name).where("asset is not null").withColumn("_a", F.col("assets")[F.col("asset")])
    transform, shape = F.coalesce("_a.`proj:transform`", p["proj:transform"]), F.coalesce("_a.`proj:shape`", p["proj:shape"])
    sides = P.scene_extent(transform, F.get(shape, 0), F.get(shape, 1))
    return one.select(
        F.col("id").alias("scene"), S.utc_date(S.required(p["datetime"], F.col("id"), "datetime")).alias("date"), S.epsg_name(p["proj:epsg"], p["proj:code"]).alias("crs"),
        p["eo:cloud_cover"].alias("cloud_pct"), acquisition(p, F.col("id")).alias("acq"), "asset", F.col("_a.href").alias("href"), *(v.alias(k) for k, v in zip(("west", "south", "east", "north"), sides)))


def checked_bands(asked: DataFrame, known: DataFrame) -> DataFrame:
    """Bands asked for (dataset, band) with their rows of the band table (dataset, band, asset, ...); one that the table doesn't have is an error that names it."""
    met = asked.join(known.withColumn("_known", F.lit(True)), ["dataset", "band"], "left")
    fault = F.concat(F.col("dataset"), F.lit(" has no band "), F.col("band"))
    return met.where(F.when(F.col("_known").isNull(), F.raise_error(fault).cast("boolean")).otherwise(True)).drop("_known")
