"""Tables as file streams: what the streaming queries share."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F


def staged(rows: DataFrame, folder: str, part: Column, parts: int, last: DataFrame | None = None):
    """Rows written to a folder in `parts` turns, those of part 0 first, so that a file stream sees them in this order; then `last`, such as a row that moves the watermark on. A generator: what drains the stream between turns has one micro-batch for each, in however many files it is, so the number of batches doesn't grow with the table and no file of a turn comes late after another."""
    for k in range(parts):
        rows.where(part == k).write.mode("append").parquet(folder)
        yield
    if last is not None:
        last.select(*rows.columns).write.mode("append").parquet(folder)
        yield


def file_stream(spark: SparkSession, folder: str, schema, files: int | None = None) -> DataFrame:
    """The files of a folder; all that are there make one micro-batch, or `files` of them."""
    reader = spark.readStream.schema(schema)
    return (reader.option("maxFilesPerTrigger", files) if files else reader).parquet(folder)


def drained(writer, checkpoint: str) -> None:
    """Runs a stream over all that is there, then stops; a later run goes on from the checkpoint."""
    writer.option("checkpointLocation", checkpoint).trigger(availableNow=True).start().awaitTermination()
