"""The folder that driver and executors share, and tables that are written there because several plans read them."""

from __future__ import annotations

import os
import tempfile
import uuid

from pyspark.sql import DataFrame, SparkSession


def work_dir(spark: SparkSession) -> str:
    """A new path in the folder of spark.checkpoint.dir; where it is unset, as in tests, in a temporary one."""
    found = spark.conf.get("spark.checkpoint.dir", None)
    if not found and not (spark.sparkContext.master or "").startswith("local"):
        raise ValueError("spark.checkpoint.dir must name a folder that driver and executors share")
    return f"{found.rstrip('/')}/{uuid.uuid4().hex}" if found else os.path.join(tempfile.mkdtemp(prefix="rastrum-"), "store")


def written(df: DataFrame) -> DataFrame:
    """Written to the shared folder and read again: made once, whatever reads it, and a lost executor loses nothing."""
    path = work_dir(df.sparkSession)
    df.write.option("compression", "zstd").parquet(path)
    return df.sparkSession.read.schema(df.schema).parquet(path)
