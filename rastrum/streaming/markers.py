"""Steps of a live source that count only once their marker has come: a join of two streams, with a grace."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from rastrum.sources.shared import work_dir
from rastrum.streaming.staging import drained, file_stream, staged

GRACE = "12 hours"


def gated(steps: DataFrame, markers: DataFrame, key: str, grace: str = GRACE, late: str = "1 hour") -> DataFrame:
    """Steps (key, step, ts) of a stream with the markers (key, marker, m_ts) of another that came with them or up to `grace` later: released. A step without one comes out with a null marker once the watermarks have passed its grace, never before. Markers of one step each give a row; first_marker() keeps the first."""
    s, m = steps.withWatermark("ts", late).alias("s"), markers.withWatermark("m_ts", late).alias("m")
    on = (F.col(f"s.{key}") == F.col(f"m.{key}")) & (F.col("m_ts") >= F.col("ts")) & (F.col("m_ts") <= F.col("ts") + F.expr(f"INTERVAL {grace}"))
    return s.join(m, on, "left_outer").select(F.col(f"s.{key}").alias(key), "step", "ts", "marker", "m_ts")


def first_marker(rows: DataFrame, key: str) -> DataFrame:
    """Each step once, with its first marker."""
    return rows.groupBy(key, "step", "ts").agg(F.min(F.struct("m_ts", "marker")).alias("first"), F.count("marker").alias("markers")).select(key, "step", "ts", F.when(F.col("markers") > 0, "released").otherwise("left over").alias("status"), F.col("first.marker").alias("marker"), F.col("first.m_ts").alias("m_ts"))


def query(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Views as steps and sign-ups as markers, by user. A marker's file comes a turn after that of the steps of its time, so steps wait for it."""
    base = work_dir(spark)
    events = spark.read.parquet(f"{sf_dir.rstrip('/')}/events.parquet").select("user_id", F.col("event_id").alias("step"), F.col("ts").cast("timestamp").alias("ts"), "event_type")
    tick = spark.createDataFrame([(-1, None, None, None)], events.schema).withColumn("ts", F.expr("timestamp'2100-01-01 00:00:00'"))
    turn = F.least(F.floor((F.dayofmonth("ts") - 1) / 6), F.lit(4))
    views = staged(events.where("event_type = 'view'"), f"{base}/steps", turn, 6, tick)  # both end in one turn: a watermark of two sources is known for those that a run has seen
    signups = staged(events.where("event_type = 'signup'"), f"{base}/markers", turn + 1, 6, tick)
    for _ in zip(views, signups):
        steps = file_stream(spark, f"{base}/steps", events.schema).select("user_id", "step", "ts")
        markers = file_stream(spark, f"{base}/markers", events.schema).select("user_id", F.col("step").alias("marker"), F.col("ts").alias("m_ts"))
        drained(gated(steps, markers, "user_id").writeStream.format("parquet").outputMode("append").option("path", f"{base}/out"), f"{base}/checkpoint")
    told = first_marker(spark.read.parquet(f"{base}/out").where("user_id >= 0"), "user_id")
    return told.select("user_id", "step", F.col("ts").cast("timestamp_ntz").alias("ts"), "status", "marker", F.col("m_ts").cast("timestamp_ntz").alias("m_ts"))
