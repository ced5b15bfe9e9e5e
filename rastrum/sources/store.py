"""Tile store on Parquet: partitions, sorted appends, compaction, catalog. What is stored is said by a commit log (manifest)."""

from __future__ import annotations

import contextlib
import json
import time
import uuid
from dataclasses import dataclass

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from rastrum.functions.views import view
from rastrum.operators import blobs as B
from rastrum.operators import tiles as T
from rastrum.sources.manifest import Conflict, Log, Version
from rastrum.sources.shared import work_dir

CATALOG = ["file", "band", "date", "x", "y", "crs", "west", "south", "east", "north", "cloud_pct", "scene_id", "size_bytes", "acq", "valid_px"]
SORT = ["band", "date", "x", "y"]
#: Seconds after which a lock counts as left behind by a process that died.
LOCK_S = 600.0


def with_partitions(tiles: DataFrame) -> DataFrame:
    """ym (static or yyyy-mm) and res_group (whole part of the pixel size)."""
    return tiles.withColumns({"ym": F.when(F.col("date") == "", "static").otherwise(F.substring("date", 1, 7)), "res_group": F.floor("res").cast("long")})


def catalog_of(tiles: DataFrame) -> DataFrame:
    """What exists, without pixels, and in which file."""
    named = tiles if "file" in tiles.columns else tiles.withColumn("file", F.lit(None).cast("string"))
    return named.select(*CATALOG)


def sorted_rows(tiles: DataFrame) -> DataFrame:
    """Rows sorted within each month, so row groups prune by band, date and place; a month is dealt over tasks by place. Spark splits tasks beyond its advisory size (the hint), so that a task doesn't grow with what a month gets in one place."""
    dealt = with_partitions(tiles).withColumns({"_x": F.floor(F.col("x") / 64), "_y": F.floor(F.col("y") / 64)}).hint("rebalance", "res_group", "ym", "_x", "_y")
    return dealt.drop("_x", "_y").sortWithinPartitions("res_group", "ym", *SORT)


def append(tiles: DataFrame, path: str, compact_above: int | None = None, ties: tuple[str, ...] = ()) -> list[str]:
    """Rows added, sorted; other writers may append or compact meanwhile. compact_above: months of more appends than this are compacted. Returns the months (folders) written."""
    log = Log(tiles.sparkSession, path)
    written = log.append(sorted_rows(tiles))
    crowded = [f for f, v in written.items() if compact_above is not None and v.batches > compact_above]
    if crowded:
        compact_months(tiles.sparkSession, path, crowded, ties)
    return sorted(written)


def chosen(log: Log, date: str | None = None, group: int | None = None) -> dict[str, Version]:
    """Newest versions of the months that a date or its beginning, and a group of pixel sizes, may have rows in; no other manifest is read."""
    found = []
    for folder in log.folders():
        own = dict(p.split("=", 1) for p in folder.split("/"))
        month_ok = not date or (own["ym"] == date[:7] if len(date) >= 7 else own["ym"].startswith(date))
        if month_ok and (group is None or own["res_group"] == str(group)):
            found.append(folder)
    return log.versions(found)


def scan(spark: SparkSession, path: str, date: str | None = None, group: int | None = None, schema=None) -> DataFrame:
    """Stored tiles, as the newest manifests have them, with the file that holds each. A date or its beginning, and a group of pixel sizes, leave out the other months' files before Spark sees them."""
    log = Log(spark, path)
    tiles = log.read(chosen(log, date, group), schema)
    return tiles.where(T.date_prefix(date)) if date else tiles


class Locked(Exception):
    """Another process compacts this month."""


@contextlib.contextmanager
def month_lock(log: Log, folder: str, wait: float = 0.0, hold: float = LOCK_S):
    """Holds a month for one process, so that no two do the same work; results don't depend on it, the manifest sees to those. A lock names the time it ends, so that of a dead process does. Raises Locked if it stays taken."""
    name, own = f"_locks/{folder.replace('/', '-')}", uuid.uuid4().hex
    p, fs = log._path(name), log._fs
    end = time.monotonic() + wait
    while not log.put_new(name, json.dumps({"owner": own, "until": time.time() + hold})):
        with contextlib.suppress(Exception):  # it may go while it is read
            if json.loads(log._text(name))["until"] < time.time():
                fs.delete(p, False)
                continue
        if time.monotonic() >= end:
            raise Locked(folder)
        time.sleep(0.2)
    try:
        yield
    finally:
        with contextlib.suppress(Exception):
            if json.loads(log._text(name))["owner"] == own:
                fs.delete(p, False)


@dataclass(frozen=True)
class Compacted:
    """What a compaction did: files and bytes before and after, and whether the month is sealed (nothing was appended meanwhile)."""

    folder: str
    files_before: int
    files_after: int
    bytes_before: int
    bytes_after: int
    sealed: bool


def compact_months(spark: SparkSession, path: str, folders: list[str], ties: tuple[str, ...] = (), smaller: bool = False, tries: int = 3) -> tuple[list[Compacted], list[str]]:
    """Months resolved, their split tiles merged where blobs are there (and all written anew where that is smaller), sorted and sealed: one job for all of them, then a commit for each. Only the files it has read are replaced; rows appended meanwhile stay beside the result, and leave that month open. Returns what was done, and the months that other processes held, or kept replacing."""
    log, done, left = Log(spark, path), [], []
    with contextlib.ExitStack() as locks:
        todo = []
        for folder in folders:
            try:
                locks.enter_context(month_lock(log, folder))
                todo.append(folder)
            except Locked:
                left.append(folder)
        for _ in range(tries):
            old = {f: v for f, v in log.versions(todo).items() if v.files and (smaller or not v.sealed)}
            todo = []
            if not old:
                break
            rows = T.resolve(log.read(old).drop("file"), ties)
            if "data" in rows.columns:
                rows = B.merged(rows)
                rows = B.reencoded(rows) if smaller else rows
            by = [*log.by, *SORT]
            made = log.write(rows.repartitionByRange(*by).sortWithinPartitions(*by))

            def put(folder: str) -> Compacted | None:
                try:
                    new = log.replace(folder, old[folder], made.get(folder, []))
                except Conflict:
                    return None
                before, after = old[folder].files, made.get(folder, [])
                return Compacted(folder, len(before), len(after), sum(f.size for f in before), sum(f.size for f in after), new.sealed)

            for folder, one in log.each(put, list(old)).items():
                (done if one else todo).append(one or folder)
    return done, left + todo


def open_months(spark: SparkSession, path: str) -> list[str]:
    """Months with appends since their last compaction."""
    return [f for f, v in Log(spark, path).versions().items() if v.files and not v.sealed]


def compact(spark: SparkSession, path: str, ties: tuple[str, ...] = (), least_batches: int = 1, smaller: bool = False) -> tuple[list[Compacted], list[str]]:
    """The open months of least_batches appends or more compacted (smaller: all months, blobs written anew). Returns what was done, and the months left open because another process holds them."""
    found = {f: v for f, v in Log(spark, path).versions().items() if v.files and (smaller or not v.sealed)}
    return compact_months(spark, path, [f for f, v in found.items() if v.batches >= least_batches], ties, smaller)


def read_rows(spark: SparkSession, path: str, rows: DataFrame, keys: list[str]) -> DataFrame:
    """Catalog rows with the blob of their one stored tile: only the files that the rows name are opened, and of those only the keys' months. An error where a row has no tile, or several (the catalog is older than a compaction then, or a tile is still split)."""
    files = sorted(r[0] for r in rows.select("file").distinct().collect())  # as many as the request touches
    if not files:
        return rows.withColumn("data", F.lit(None).cast("binary"))
    stored = spark.read.option("basePath", path).parquet(*files)
    return B.read_tiles(rows, stored, keys)


def read_catalog(spark: SparkSession, catalog: str, schema=None) -> DataFrame:
    """The newest catalog; where none was published yet an empty frame of the schema."""
    log = Log(spark, catalog, ("part",))
    now = log.latest("part=all")
    if not now.files and schema is not None:
        return spark.createDataFrame([], schema)
    return log.read({"part=all": now}).drop("part", "file").withColumnRenamed("_file", "file")


def rebuild_catalog(spark: SparkSession, path: str, catalog: str) -> DataFrame:
    """The catalog of what is stored, published as one version: readers have the old one until then."""
    rows = catalog_of(scan(spark, path)).withColumnRenamed("file", "_file").withColumn("part", F.lit("all"))
    log = Log(spark, catalog, ("part",))
    made = log.write(rows.repartitionByRange("band", "date").sortWithinPartitions("band", "date", F.col("acq").asc_nulls_last(), "crs", "x", "y"))
    while True:
        with contextlib.suppress(Conflict):  # another one was published: this one is newer
            log.replace("part=all", log.latest("part=all"), made.get("part=all", []))
            return read_catalog(spark, catalog)


TIES = ("l_orderkey", "l_linenumber", "l_partkey", "l_suppkey")


def publish_query(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Two appends, compaction, a third append that stays open, catalog: the coverage of what is published."""
    path = work_dir(spark)
    obs = view(spark, sf_dir, "obs")
    append(obs.where("l_linenumber <= 3"), f"{path}/tiles")
    append(obs.where("l_linenumber between 4 and 5"), f"{path}/tiles")
    compact(spark, f"{path}/tiles", TIES)
    append(obs.where("l_linenumber > 5"), f"{path}/tiles")
    return T.coverage(rebuild_catalog(spark, f"{path}/tiles", f"{path}/catalog"))
