"""Relational operators on tile rows: predicates, dedup, splitting, skip sets, coverage."""

from __future__ import annotations

import math

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

KEY = ["band", "date", "acq", "crs", "x", "y"]


def bbox_intersects(bbox: tuple[float, float, float, float]) -> Column:
    """Rows whose bounds overlap a box; touching is no overlap. west > east: the tile crosses the antimeridian."""
    w, s, e, n = bbox
    if not all(map(math.isfinite, bbox)) or w > e or s > n:
        raise ValueError(f"not a box: {bbox}")
    col = F.col
    return (col("north") > s) & (col("south") < n) & F.when(col("west") <= col("east"), (col("east") > w) & (col("west") < e)).otherwise((col("east") > w) | (col("west") < e))


def date_prefix(prefix: str | None) -> Column:
    """Rows of a date or its beginning; empty: all."""
    return F.col("date").startswith(prefix) if prefix else F.lit(True)


def coverage(tiles: DataFrame) -> DataFrame:
    return tiles.groupBy("date", "band").agg(F.count("*").alias("n"), (F.floor(F.avg("cloud_pct") * 10 + 0.5) / 10).alias("mean_cloud"))


def exact_else_prefix(tiles: DataFrame, date: str) -> DataFrame:
    """Rows of exactly this date if there are any, else those that begin with it."""
    some = tiles.where(date_prefix(date)).withColumn("_exact", F.col("date") == date)
    return some.join(F.broadcast(some.agg(F.coalesce(F.bool_or("_exact"), F.lit(False)).alias("_any"))), F.col("_exact") | ~F.col("_any")).drop("_exact", "_any")


def resolve(tiles: DataFrame, ties: tuple[str, ...] = ()) -> DataFrame:
    """One row of each key (and scene, where there is an acquisition): the newest, then the fullest."""
    scene = F.when(F.col("acq").isNotNull(), F.col("scene_id"))
    order = [F.col("fetched_at").desc(), F.col("valid_px").desc_nulls_last(), F.col("scene_id").asc_nulls_last(), F.col("size_bytes"), *ties]
    return tiles.withColumn("_r", F.row_number().over(Window.partitionBy(*KEY, scene).orderBy(*order))).where("_r = 1").drop("_r")


def split_keys(tiles: DataFrame) -> DataFrame:
    """Keys with an acquisition that several rows hold."""
    return tiles.where("acq is not null").groupBy(*KEY).agg(F.count("*").alias("n")).where("n > 1")


def _shared(tiles: DataFrame) -> DataFrame:
    """Rows with how many hold their key (nulls are equal): one shuffle, the table is read once."""
    return tiles.withColumn("_m", F.count("*").over(Window.partitionBy(*KEY)))


def split_rows(tiles: DataFrame) -> DataFrame:
    """Rows whose key several rows of one acquisition hold."""
    return _shared(tiles).where("acq is not null and _m > 1").drop("_m")


def rest_rows(tiles: DataFrame) -> DataFrame:
    """Rows that no merge touches: without an acquisition, or alone in their key."""
    return _shared(tiles).where("acq is null or _m = 1").drop("_m")


def merge_rows(tiles: DataFrame) -> DataFrame:
    """What merging split rows makes of the columns besides pixels: scenes together, weighted cloud, latest stamp."""
    scenes = F.array_sort(F.array_distinct(F.flatten(F.collect_list(F.split("scene_id", r"[|]")))))
    weight = F.when(F.col("cloud_pct").isNotNull() & (F.coalesce("valid_px", F.lit(0)) > 0), F.col("valid_px"))
    return split_rows(tiles).groupBy(*KEY).agg(
        F.count("*").alias("n"), F.when(F.size(scenes) > 0, F.array_join(scenes, "|")).alias("scene_id"), F.sum("valid_px").cast("long").alias("valid_px"),
        F.sum(F.col("cloud_pct") * weight).alias("cloud_sum"), F.sum(weight).cast("long").alias("cloud_px"), F.max("fetched_at").alias("fetched_at"))


def held_scenes(tiles: DataFrame) -> DataFrame:
    """Per band, date and place: the scenes stored, and whether a stored tile is complete."""
    parts = tiles.withColumn("scene", F.explode_outer(F.split("scene_id", r"[|]")))
    return parts.groupBy("band", "date", "x", "y").agg(F.array_join(F.array_sort(F.collect_set("scene")), "|").alias("scenes"), F.coalesce(F.bool_or(F.col("valid_px") >= F.col("tile_px") * F.col("tile_px")), F.lit(False)).alias("complete"))


def unstored(plan: DataFrame, stored: DataFrame, keys: list[str]) -> DataFrame:
    return plan.join(stored.select(*keys).distinct(), keys, "left_anti")


def to_fetch(plan: DataFrame, held: DataFrame) -> DataFrame:
    """Planned tiles that are neither complete nor have this scene."""
    both = plan.join(held, ["band", "date", "x", "y"], "left")
    return both.where(~F.coalesce("complete", F.lit(False)) & ~F.array_contains(F.split(F.coalesce("scenes", F.lit("")), r"[|]"), F.col("scene"))).select(*plan.columns)


def best_acquisition(tiles: DataFrame) -> DataFrame:
    """Per band and date the acquisition with most observed pixels; ties by name, none last."""
    cover = tiles.groupBy("band", "date", "acq").agg(F.coalesce(F.sum("valid_px"), F.lit(0)).cast("long").alias("cover"))
    return cover.withColumn("_r", F.row_number().over(Window.partitionBy("band", "date").orderBy(F.col("cover").desc(), F.col("acq").asc_nulls_last()))).where("_r = 1").drop("_r")


def majority_crs(tiles: DataFrame, *by: str) -> DataFrame:
    return tiles.groupBy(*by, "crs").count().groupBy(*by).agg(F.min_by("crs", F.struct(-F.col("count"), F.col("crs"))).alias("crs"))


def read_keys(tiles: DataFrame, want: DataFrame, bands: list, xs: list, ys: list, first: str, last: str) -> DataFrame:
    """Tiles with one of some keys (band, date, x, y); lists and the span of dates go to the scan, the exact keys to a semi join."""
    near = tiles.where(F.col("band").isin(*set(bands)) & F.col("x").isin(*set(xs)) & F.col("y").isin(*set(ys)) & F.col("date").between(first, last))
    return near.join(want, ["band", "date", "x", "y"], "left_semi")


def range_join(tiles: DataFrame, boxes: DataFrame, cell: float) -> DataFrame:
    """Tiles (west, south, east, north) with the boxes (w, s, e, n) that they overlap: both sides are dealt into cells, and a pair counts in the cell that holds the south-west corner of what they share."""
    cells = lambda df, w, s, e, n: df.withColumn("_cx", F.explode(F.sequence(F.floor(F.col(w) / cell), F.floor(F.col(e) / cell)))).withColumn("_cy", F.explode(F.sequence(F.floor(F.col(s) / cell), F.floor(F.col(n) / cell))))
    met = cells(tiles, "west", "south", "east", "north").join(cells(boxes, "w", "s", "e", "n"), ["_cx", "_cy"])
    corner = (F.floor(F.greatest("west", "w") / cell) == F.col("_cx")) & (F.floor(F.greatest("south", "s") / cell) == F.col("_cy"))
    return met.where(corner & (F.col("north") > F.col("s")) & (F.col("south") < F.col("n")) & (F.col("east") > F.col("w")) & (F.col("west") < F.col("e"))).drop("_cx", "_cy")


def of_tier(scenes: DataFrame, name: Column, suffix: str, tiers: tuple[str, ...]) -> DataFrame:
    """Scenes of some tiers whose name ends with a region's suffix; scenes without a tier or name are of none."""
    return scenes.where(name.endswith(suffix) & F.col("tier").isin(*tiers))


def plan_tiles(candidates: DataFrame, held: DataFrame, keep=None) -> DataFrame:
    """Candidate tiles (tx, ty) to fetch: those that a rule keeps (zone, extent, area of interest) and that are not held (x, y)."""
    wanted = candidates if keep is None else candidates.where(keep)
    return wanted.join(held.select(F.col("x").alias("tx"), F.col("y").alias("ty")).distinct(), ["tx", "ty"], "left_anti")


def checked_matches(rows: DataFrame, stored: DataFrame, keys: list[str]) -> DataFrame:
    """Catalog rows with their stored tile; an error where a row has none, or several. Keys match null-safely. Tiles that no row asks for are left out first, so what is grouped follows the rows, not the store."""
    on = F.lit(True)
    for k in keys:
        on = on & F.col(f"a.{k}").eqNullSafe(F.col(f"b.{k}"))
    near = stored.alias("b").join(rows.select(*keys).distinct().alias("a"), on, "left_semi")
    counted = near.groupBy(*keys).agg(F.count("*").alias("_n"), *(F.first(c).alias(c) for c in stored.columns if c not in keys))
    met = rows.alias("a").join(counted.alias("b"), on, "left")
    fault = F.when(F.col("b._n").isNull(), "a catalog row has no stored tile").when(F.col("b._n") > 1, "a catalog row has several stored tiles")
    return met.where(F.when(fault.isNull(), True).otherwise(F.raise_error(fault).cast("boolean"))).select("a.*", *(F.col(f"b.{c}") for c in stored.columns if c not in rows.columns))
