"""Ingest as a stream: each micro-batch is a flush into the store, once whatever fails in between; crowded months are compacted on the way, all at the end."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from rastrum.functions.views import view
from rastrum.sources import store
from rastrum.sources.manifest import Log
from rastrum.sources.shared import work_dir
from rastrum.streaming.staging import drained, staged


def append_to(spark: SparkSession, path: str, name: str, compact_above: int = 3, ties: tuple[str, ...] = ()):
    """A foreachBatch sink into a store. A batch's files carry its number, so one that comes again after a failure adds to those months only that have not got it yet."""

    def sink(batch: DataFrame, number: int) -> None:
        log, own = Log(spark, path), f"{name}-{number:09d}"
        there = {folder for folder, v in log.versions().items() if any(f.batch.startswith(own) for f in v.files)}
        written = {f: log.add(f, files) for f, files in log.write(store.sorted_rows(batch), f"{own}-{_turn(log, own)}").items() if f not in there}
        crowded = [f for f, v in written.items() if v.batches > compact_above]
        if crowded:
            store.compact_months(spark, path, crowded, ties)

    return sink


def _turn(log: Log, own: str) -> int:
    """How often a batch was tried before: each try stages its files in a folder of its own."""
    return sum(s.getPath().getName().startswith(own) for s in log._list("_tmp"))


def scenes(spark: SparkSession, folder: str, schema, files: int | None = 10, size: int = 256 << 20) -> DataFrame:
    """A stream of scene files, of which a flush takes so many at most; files=None: so many bytes."""
    name, most = ("maxFilesPerTrigger", files) if files else ("maxBytesPerTrigger", size)
    return spark.readStream.schema(schema).option(name, most).parquet(folder)


def query(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The rows of obs as a stream of files into a store, stopped after each turn and taken up again, then sealed: what each band and month holds, and in how many appends it came."""
    base = work_dir(spark)
    obs = view(spark, sf_dir, "obs")
    run = lambda: drained(scenes(spark, f"{base}/in", obs.schema, None, 1 << 30).writeStream.foreachBatch(append_to(spark, f"{base}/tiles", "obs", 3, store.TIES)), f"{base}/checkpoint")
    for _ in staged(obs, f"{base}/in", F.least(F.col("l_linenumber"), F.lit(6)) - 1, 6):
        run()
    store.compact(spark, f"{base}/tiles", store.TIES)
    tiles = store.scan(spark, f"{base}/tiles")
    return tiles.groupBy("band", F.col("ym").alias("month")).agg(F.count("*").alias("n"), F.sum("size_bytes").alias("bytes"), F.max("fetched_at").alias("newest"))

