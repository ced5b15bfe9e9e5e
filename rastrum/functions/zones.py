"""Ground that the MGRS grid gives to each UTM zone, as a table, and the tiles that touch that of their own projection."""

from __future__ import annotations

from functools import reduce
from operator import and_

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from rastrum.functions.grid import lon_overlap

# Where the grid departs from zones of 6 degrees. Latitudes, then the longitudes of each zone; those not named don't exist there.
NORWAY = ((56.0, 64.0), {31: (0.0, 3.0), 32: (3.0, 12.0)})
SVALBARD = ((72.0, 84.0), {31: (0.0, 9.0), 33: (9.0, 21.0), 35: (21.0, 33.0), 37: (33.0, 42.0)})
SVALBARD_WITHOUT = (32, 34, 36)


def areas_of(zone: int, south: bool) -> list[tuple[float, float, float, float]]:
    """Rectangles (west, south, east, north in degrees) of a zone and hemisphere."""
    west, east = zone * 6.0 - 186, zone * 6.0 - 180
    if south:
        return [(west, -90.0, east, 0.0)]
    out = [(west, low, east, high) for low, high in ((0.0, 56.0), (64.0, 72.0), (84.0, 90.0))]
    for (low, high), wide in (NORWAY, SVALBARD):
        if not (wide is SVALBARD[1] and zone in SVALBARD_WITHOUT):
            w, e = wide.get(zone, (west, east))
            out.append((w, low, e, high))
    return out


def zone_areas(spark: SparkSession) -> DataFrame:
    """(epsg, area_w, area_s, area_e, area_n) of all zones: some 360 rows, whatever the input."""
    rows = [(32600 + 100 * south + zone, *a) for zone in range(1, 61) for south in (False, True) for a in areas_of(zone, south)]
    return spark.createDataFrame(rows, "epsg int, area_w double, area_s double, area_e double, area_n double")


def utm_epsg(crs: Column) -> Column:
    """Code of a WGS84 UTM zone, null for any other reference system."""
    code = F.regexp_extract(F.upper(crs), r"^(?:EPSG:)?(32[67]\d\d)$", 1)
    return F.when((code != "") & F.substring(code, 4, 2).cast("int").between(1, 60), code.cast("int"))


def canonical(tiles: DataFrame) -> DataFrame:
    """Tiles (crs, and their bounds lon_w, lat_s, lon_e, lat_n, lon_w > lon_e across the antimeridian) that touch the ground of their own zone and hemisphere: of those, every place has one. Tiles of other reference systems have no such rule, and stay; tiles without bounds touch nothing."""
    epsg = utm_epsg(F.col("crs"))
    areas = F.broadcast(zone_areas(tiles.sparkSession))
    overlap = lon_overlap(F.col("lon_w"), F.col("lon_e"), F.col("area_w"), F.col("area_e")) & (F.col("lat_s") < F.col("area_n")) & (F.col("lat_n") > F.col("area_s"))
    touching = tiles.where(epsg.isNotNull()).join(areas, (epsg == F.col("epsg")) & overlap, "left_semi")
    return tiles.where(epsg.isNull()).unionByName(touching)


def zone_plan(points: DataFrame, lon: str, lat: str) -> DataFrame:
    """Points with the code of the zone whose ground holds them (`epsg`); each lies in one."""
    at = F.pmod(F.col(lon) + 180, F.lit(360.0)) - 180
    conditions = [at >= F.col("area_w"), at < F.col("area_e"), F.col(lat) >= F.col("area_s"), (F.col(lat) < F.col("area_n")) | ((F.col("area_n") == 90) & (F.col(lat) == 90))]
    return points.join(F.broadcast(zone_areas(points.sparkSession)), reduce(and_, conditions)).drop("area_w", "area_s", "area_e", "area_n")
