"""Late parts that complete a tile: state by tile, with a timer for those that nobody completes."""

from __future__ import annotations

import numpy as np
from pyspark.sql import DataFrame, Row, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.streaming.stateful_processor import StatefulProcessor

from rastrum.functions.views import view
from rastrum.sources.shared import work_dir
from rastrum.streaming.staging import drained, file_stream, staged

DAY = 86_400_000
OUT = "tile_id long, status string, parts int, missing int, last_scene string, px array<int>"


class Completion(StatefulProcessor):
    """Parts of tiles (px: pixels, null for none) fill what a tile still lacks, in order of time and scene. A tile is told once: complete, at the part that fills its last pixel, or abandoned, when no part came for `patience` days of event time; later parts of a complete tile change nothing until it is forgotten, after as long a time."""

    def __init__(self, nodata: int, patience: int):
        self.nodata, self.patience = nodata, patience

    def init(self, handle) -> None:
        self.handle = handle
        self.state = handle.getValueState("tile", "px array<int>, parts int, scene string, done boolean, until long")

    def _told(self, key, px, parts, scene, status: str) -> Row:
        return Row(tile_id=key[0], status=status, parts=parts, missing=int((px == self.nodata).sum()), last_scene=scene, px=px.tolist())

    def handleInputRows(self, key, rows, timerValues):
        # Each call of the state is a round trip, so there is one to get, one to put, and one timer that moves itself on.
        held = self.state.get()
        px, parts, scene, done, _ = held or (None, 0, None, False, 0)
        px = None if px is None else np.array(px, np.int64)
        newest = -1
        for r in sorted(rows, key=lambda r: (r["at"], r["scene_id"] or "")):
            if r["px"] is None:
                continue
            newest = max(newest, int(r["at"].timestamp() * 1000))
            if done:
                continue
            part = np.array([self.nodata if v is None else v for v in r["px"]], np.int64)
            px = part if px is None else np.where(px == self.nodata, part, px)
            parts, scene = parts + 1, r["scene_id"]
            if (px != self.nodata).all():
                done = True
                yield self._told(key, px, parts, scene, "complete")
        if newest >= 0:
            until = newest + self.patience * DAY
            if not held:
                self.handle.registerTimer(until)
            self.state.update(([] if done else px.tolist(), parts, scene, done, until))

    def handleExpiredTimer(self, key, timerValues, expiredTimerInfo):
        px, parts, scene, done, until = self.state.get()
        if until > timerValues.getCurrentWatermarkInMs():  # parts came since
            self.handle.registerTimer(until)
            return
        if not done:
            yield self._told(key, np.array(px, np.int64), parts, scene, "abandoned")
        self.state.clear()

    def close(self) -> None:
        pass


def completed(parts: DataFrame, nodata: int, patience: int = 10, late: str = "1 day") -> DataFrame:
    """Tiles of a stream of parts (tile_id, scene_id, at timestamp, px array<int>), each told once."""
    marked = parts.withWatermark("at", late)
    return marked.groupBy("tile_id").transformWithState(statefulProcessor=Completion(nodata, patience), outputStructType=OUT, outputMode="Append", timeMode="EventTime")


def parts_of(px: DataFrame) -> DataFrame:
    """A part for each scene of a tile; scenes come a day after each other."""
    arrays = px.groupBy("tile_id", "vec_id", "scene_id").agg(F.transform(F.array_sort(F.collect_list(F.struct("pos", "dn"))), lambda s: s["dn"]).alias("px"))
    at = F.timestamp_seconds(F.lit(1717200000) + F.pmod("vec_id", F.lit(5)) * 86_400)
    return arrays.select("tile_id", "scene_id", at.alias("at"), "px")


def run(spark: SparkSession, source: str, base: str, schema) -> DataFrame:
    """What the parts in a folder make, carried on from the checkpoint of an earlier run."""
    key = "spark.sql.streaming.stateStore.providerClass"
    before = spark.conf.get(key, None)
    spark.conf.set(key, "org.apache.spark.sql.execution.streaming.state.RocksDBStateStoreProvider")  # timers need it
    try:
        drained(completed(file_stream(spark, source, schema), -9999).writeStream.format("parquet").outputMode("append").option("path", f"{base}/out"), f"{base}/checkpoint")
    finally:
        spark.conf.set(key, before) if before else spark.conf.unset(key)
    return spark.read.schema(OUT).parquet(f"{base}/out")


def query(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All parts as a file stream, a scene after the other, then time moved on: every tile, complete or abandoned, with a digest of its pixels."""
    base = work_dir(spark)
    parts = parts_of(view(spark, sf_dir, "px"))
    tick = spark.createDataFrame([(-1, None, None, None)], "tile_id long, scene_id string, at timestamp, px array<int>").withColumn("at", F.timestamp_seconds(F.lit(1717200000 + 100 * 86_400)))
    for _ in staged(parts, f"{base}/in", F.right("scene_id", F.lit(1)).cast("int"), 5, tick):
        told = run(spark, f"{base}/in", base, parts.schema)
    digest = F.aggregate(F.transform("px", lambda v, i: v.cast("long") * (i + 1)), F.lit(0).cast("long"), lambda a, v: a + v)
    return told.select("tile_id", "status", "parts", "missing", "last_scene", digest.alias("digest"))
