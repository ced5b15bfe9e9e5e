"""What the operators share: tables, the shared folder, cut lineage, sampling, hashing of ids."""

from __future__ import annotations

import contextlib
import functools
import gc
import os
import pickle
import tempfile
import uuid

import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F


#: Rows of an Arrow batch at most: with 10,000 rows of long texts, buffers on both sides take hundreds of MB a task.
BATCH_ROWS = 2000
#: Bytes of an Arrow batch, after which it ends: 2,000 pairs of long texts' sets take hundreds of MB.
BATCH_BYTES = 4 << 20


def small_batches(spark: SparkSession) -> None:
    """Lowers the session's Arrow batch size to BATCH_ROWS, if it is larger, and sets its bytes to BATCH_BYTES."""
    name = "spark.sql.execution.arrow.maxRecordsPerBatch"
    if not 0 < int(spark.conf.get(name)) <= BATCH_ROWS:
        spark.conf.set(name, str(BATCH_ROWS))
    spark.conf.set("spark.sql.execution.arrow.maxBytesPerBatch", str(BATCH_BYTES))


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir.rstrip('/')}/{name}.parquet")


def shared_dir(spark: SparkSession) -> str:
    """The folder in spark.checkpoint.dir, which driver and executors share; where it is unset, as in tests, a temporary one."""
    found = spark.conf.get("spark.checkpoint.dir", None)
    if found:
        return found.rstrip("/")
    if not (spark.sparkContext.master or "").startswith("local"):
        raise ValueError("spark.checkpoint.dir must name a folder that driver and executors share")
    own = os.path.join(tempfile.gettempdir(), f"rastrum-{os.getpid()}")
    os.makedirs(own, exist_ok=True)
    return f"file://{own}"


def cut(df: DataFrame, what: str) -> DataFrame:
    """Written to the shared folder and read again: the lineage ends there, and a lost executor loses nothing."""
    spark = df.sparkSession
    path = f"{shared_dir(spark)}/{what}-{uuid.uuid4().hex}"
    df.write.option("compression", "zstd").parquet(path)
    release(spark)
    out = spark.read.schema(df.schema).parquet(path)
    out._rastrum_path = path
    return out


def release(spark: SparkSession) -> None:
    """Lets Spark delete the shuffle files of plans that nothing refers to any more; else they stay until the driver happens to collect its garbage."""
    gc.collect()
    spark._jvm.System.gc()


def drop(*frames: DataFrame) -> None:
    """Deletes what cut() wrote, once nothing reads it any more."""
    for df in frames:
        path = getattr(df, "_rastrum_path", None)
        if not path:
            continue
        spark = df.sparkSession
        p = spark._jvm.org.apache.hadoop.fs.Path(path)
        p.getFileSystem(spark._jsc.hadoopConfiguration()).delete(p, True)


def id_remainder(column: str, n: int):
    """crc32 of the id as text, modulo n."""
    return F.crc32(F.col(column).cast("string").cast("binary")) % F.lit(n)


def fewest(df: DataFrame, by: str, name: str, most: int) -> DataFrame:
    """Of each value of `by` at most `most` rows, those with the smallest hashes of a column of distinct values. A hash deals the rows into BUCKETS parts, each with its share of the bound, so no task gets all rows of a value, and a task keeps no more of its own than that."""
    mixed = F.xxhash64(name, F.lit(77))
    rank = F.row_number().over(Window.partitionBy(by, "bucket").orderBy("mixed", name))
    dealt = df.withColumns({"mixed": mixed, "bucket": F.pmod(F.xxhash64(name, F.lit(78)), F.lit(BUCKETS))})
    return dealt.withColumn("rank", rank).where(F.col("rank") <= -(-most // BUCKETS)).select(by, name)


#: Parts of the rows of a label or language, from each of which a share of the teaching rows comes.
BUCKETS = 16


def teaching_rows(rows: DataFrame, most: int, max_chars: int) -> DataFrame:
    """(text, y) rows for a fit: of each y at most `most` distinct texts of max_chars characters at most, by fewest(); so the same rows each time, however often a row is repeated. Nothing reaches the driver."""
    narrow = rows.where(F.col("text").isNotNull() & (F.length("text") <= max_chars)).select("y", F.xxhash64("text").alias("h")).distinct()
    chosen = fewest(narrow, "y", "h", most)
    return rows.where(F.length("text") <= max_chars).withColumn("h", F.xxhash64("text")).join(F.broadcast(chosen), ["y", "h"]).select("text", "y").dropDuplicates(["y", "text"])


def labelled(docs: DataFrame, labels: DataFrame, most: int) -> DataFrame:
    """(text, y) of labelled documents. labels: doc_id, y; an id with both labels teaches nothing. Of each label at most 4 * `most` ids by fewest(), so this side is small."""
    one = labels.where(F.col("doc_id").isNotNull()).groupBy("doc_id").agg(F.min("y").alias("y"), F.max("y").alias("z")).where("y = z").select("doc_id", "y")
    chosen = fewest(one, "y", "doc_id", 4 * most)
    return docs.select("doc_id", F.col("text").cast("string").alias("text")).join(F.broadcast(chosen), "doc_id").select("text", "y")


def fitted(rows: DataFrame, fit, what: str):
    """fit(texts, labels) of all rows in one task, as of built()."""

    def make(batches):
        found = sorted(((r["y"], r["text"]) for b in batches for r in b.to_pylist()), key=lambda r: (str(r[0]), r[1]))
        return fit([t for _, t in found], [y for y, _ in found])

    return built(rows.select("text", "y"), make, what)


def built(rows: DataFrame, make, what: str):
    """make(batches) of all rows in one task, which a lost executor only delays; the rows are bounded by their makers. The model's bytes go through the shared folder and are broadcast."""
    spark = rows.sparkSession

    def run(batches):
        model = pickle.dumps(make(batches))
        trim()
        for lo in range(0, len(model), 1 << 20):
            yield pa.RecordBatch.from_arrays([pa.array([lo]), pa.array([model[lo : lo + (1 << 20)]], pa.binary())], names=["at", "data"])

    made = cut(rows.coalesce(1).mapInArrow(run, "at long, data binary"), what)
    data = b"".join(r["data"] for r in sorted(made.collect(), key=lambda r: r["at"]))
    drop(made)
    return spark.sparkContext.broadcast(data or pickle.dumps(make([])))


def trim() -> None:
    """Gives the memory that a worker no longer uses back to the system; workers live on for later tasks."""
    import ctypes

    pa.default_memory_pool().release_unused()
    with contextlib.suppress(OSError, AttributeError):  # where the C library has no such call
        ctypes.CDLL(None).malloc_trim(0)


def trimmed(run):
    """A function of batches, after which the worker's free memory goes back."""

    def whole(batches):
        yield from run(batches)
        trim()

    return whole


@functools.lru_cache(maxsize=1)
def _loaded(data: bytes):
    return pickle.loads(data)


def loaded(model):
    """The model in a broadcast of fitted(), unpacked once in a worker."""
    return _loaded(model.value)


#: Bits of a bitmap, as a power of two: at least, at most.
FEWEST_BITS, MOST_BITS = 20, 26


def bloom_of(ids: DataFrame, column: str, rows: int):
    """A bitmap over the hashes in a column (64-bit) of so many rows at most, with 8 bits for each as far as MOST_BITS (8 MB) allow, so it may be sent to all executors. It lets through all that is in the column, and some that isn't; callers tell those apart by a join."""
    import numpy as np

    bits = min(MOST_BITS, max(FEWEST_BITS, (8 * rows).bit_length()))
    at = F.col(column).bitwiseAND(F.lit((1 << bits) - 1))
    found = ids.groupBy(F.shiftright(at, 6).alias("w")).agg(F.bit_or(F.expr(f"shiftleft(1L, cast({column} & 63 as int))")).alias("b")).toArrow()
    out = np.zeros(1 << (bits - 6), np.int64)
    out[found.column("w").to_numpy()] = found.column("b").to_numpy()
    return out.view(np.uint64)


def in_bloom(bitmap, hashes):
    import numpy as np

    bits = int(len(bitmap)).bit_length() - 1 + 6
    at = hashes & np.uint64((1 << bits) - 1)
    return (bitmap[at >> np.uint64(6)] >> (at & np.uint64(63))) & np.uint64(1) == 1
