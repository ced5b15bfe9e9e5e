"""Incremental ingest as micro-batches: later rows replace earlier ones of their key, in whatever month those are; windowed sums of event streams."""

from __future__ import annotations

from functools import reduce
from operator import and_

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from rastrum.operators.raster import newest
from rastrum.sources.manifest import Conflict, Log
from rastrum.sources.shared import work_dir
from rastrum.streaming.staging import drained, file_stream, staged


def upsert_into(spark: SparkSession, target: str, key: list[str], order: list, month: str = "ym"):
    """A foreachBatch sink into a table of month folders with a commit log. Of each key the first row by `order` stays, over all months: where a later row lies in another month, the earlier one leaves its own. A late row still counts, so no watermark may drop it; a batch that comes twice changes nothing. Only months that gain or lose a row are written anew; those that gain are committed first, so a reader between two commits may see a key twice, never not at all."""
    log = Log(spark, target, (month,))

    def sink(batch: DataFrame, _: int) -> None:
        batch = newest(batch, key, order).persist()
        try:
            gains = {f"{month}={r[0]}" for r in batch.select(month).distinct().collect()}  # months: a few hundred at most
            old = log.versions()
            held = gains
            if any(v.files for v in old.values()):
                same = reduce(and_, (F.col(c).eqNullSafe(F.col(f"_{c}")) for c in key))
                there = log.read(old, batch.schema).join(batch.select(*(F.col(c).alias(f"_{c}") for c in key)), same, "left_semi")
                held = gains | {f"{month}={r[0]}" for r in there.select(month).distinct().collect()}
            touched = {folder: v for folder, v in old.items() if folder in held}
            both = batch
            if any(v.files for v in touched.values()):
                both = log.read(touched, batch.schema).select(*batch.columns).unionByName(batch)
            made = log.write(newest(both, key, order))
            for folder in sorted(held, key=lambda f: (f not in gains, f)):
                log.replace(folder, old.get(folder) or log.latest(folder), made.get(folder, []))
        finally:
            batch.unpersist()

    def safe(batch: DataFrame, number: int) -> None:
        for left in reversed(range(5)):
            try:
                return sink(batch, number)
            except Conflict:  # another stream wrote one of the months
                if not left:
                    raise

    return safe


def current(spark: SparkSession, target: str, schema, month: str = "ym") -> DataFrame:
    """What an upserted table holds now."""
    log = Log(spark, target, (month,))
    return log.read(log.versions(), schema)


def rates(events: DataFrame, late: str = "1 hour") -> DataFrame:
    """15-minute sums of a stream; rows later than `late` are dropped by the watermark."""
    return events.withWatermark("ts", late).groupBy("event_type", F.window("ts", "15 minutes")).agg(F.count("*").alias("n"), F.sum(F.round(F.col("value") * 100).cast("long")).alias("cents"))


def by_months(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The events with every other user's moved on by a month for each type, so that keys come in several months."""
    events = spark.read.parquet(f"{sf_dir.rstrip('/')}/events.parquet")
    moved = F.col("ts") + F.make_interval(months=F.pmod(F.col("event_id"), F.lit(3)).cast("int") * F.pmod(F.col("user_id"), F.lit(2)).cast("int"))
    return events.withColumn("ts", moved).withColumn("ym", F.date_format("ts", "yyyy-MM"))


def query(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The events of some months as a file stream in no order of time, upserted by user and type: the newest of each."""
    base = work_dir(spark)
    rows = by_months(spark, sf_dir)
    target = f"{base}/tiles"
    for _ in staged(rows, f"{base}/in", F.pmod(F.xxhash64("event_id"), F.lit(4)), 4):
        stream = file_stream(spark, f"{base}/in", rows.schema)
        drained(stream.writeStream.foreachBatch(upsert_into(spark, target, ["user_id", "event_type"], [F.col("ts").desc(), F.col("event_id").desc()])), f"{base}/checkpoint")
    return current(spark, target, rows.schema).select("event_id", "user_id", "event_type", "ts", "ym")


def rates_query(spark: SparkSession, sf_dir: str) -> DataFrame:
    """15-minute sums of the events as a stream in order of time."""
    base = work_dir(spark)
    events = spark.read.parquet(f"{sf_dir.rstrip('/')}/events.parquet").select("event_id", "event_type", F.col("ts").cast("timestamp").alias("ts"), "value")
    tick = spark.createDataFrame([(None, "tick", None, None)], events.schema).withColumn("ts", F.expr("timestamp'2100-01-01 00:00:00'"))
    for _ in staged(events, f"{base}/in", F.least(F.floor((F.dayofmonth("ts") - 1) / 8), F.lit(3)), 4, tick):
        drained(rates(file_stream(spark, f"{base}/in", events.schema)).writeStream.format("parquet").outputMode("append").option("path", f"{base}/out"), f"{base}/checkpoint")
    return spark.read.parquet(f"{base}/out").select(F.col("event_type").alias("band"), F.col("window.start").cast("timestamp_ntz").alias("t"), "n", "cents")
