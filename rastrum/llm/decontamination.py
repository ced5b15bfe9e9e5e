"""Operator 8, benchmark decontamination; DataFrame functions only.

Words are runs of letters and digits, lower-cased; a text is the sequence of
its WORDS-word shingles. A shingle's weight is one over the number of benchmark
items that have it (1 where none has). A window is as long as an item; windows
lie wherever a document has an item's shingle at the place that aligns the two
(a window that shares no shingle with any item is similar to none, so none is
lost). Each window and item gets a 64-bit SimHash of its weighted shingles.
Fingerprints of one length within RADIUS bits are found by RADIUS + 1 blocks:
two such fingerprints agree in a block at least (pigeonhole). Candidates are
verified by the exact weighted Jaccard similarity of their distinct shingles.

At similarity 0.8 the fingerprints differ in about 10 of 64 bits (deviation 3),
so RADIUS 18 passes over 99.7 % there, and nearly all above it; equal passages
always.

Result: (doc_id, item_id, first_word, n_words, similarity), the best window of
each document (all rows of one id; rows with a null id are one document) and
item; of windows equally similar the first. Null and empty texts, items with
fewer than WORDS words and documents that have no item give no row. Repeated
rows count once; other columns are ignored.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from .shared import cut, table

WORDS, RADIUS, SIMILARITY = 5, 18, 0.8
BITS = 64
#: A side of at most so many rows (of a few numbers each) is broadcast; a larger one is shuffled.
BROADCAST_ROWS = 500_000


def shingled(df: DataFrame, *keys: str) -> DataFrame:
    """keys and the array `sh` of shingle hashes, in order. To be exploded by the outer forms only: for the inner ones the optimizer adds a filter on the array's size below, in which the words would be split anew for every shingle."""
    words = F.array_remove(F.split(F.lower("text"), r"[^\p{L}\p{N}]+"), "").alias("words")
    rest = ", ".join(f"get(words, i + {j})" for j in range(1, WORDS))
    return (
        df.where("text is not null").select(*keys, words)
        .select(*keys, F.size("words").alias("n_words"), F.expr(f"transform(words, (w, i) -> xxhash64(w, {rest}))").alias("sh"))
        .select(*keys, "n_words", F.slice("sh", 1, F.greatest(F.col("n_words") - (WORDS - 1), F.lit(0))).alias("sh"))
    )


def sized(df: DataFrame, rows: int) -> DataFrame:
    """A side with that many rows, with a broadcast hint where the bound allows it."""
    return F.broadcast(df) if rows <= BROADCAST_ROWS else df


def fingerprint(rows: DataFrame, *keys: str) -> DataFrame:
    """SimHash and total weight of the (distinct) shingles s with weights w of each key."""
    bit = lambda i: F.sum(F.when(F.expr(f"shiftright(s, {i}) & 1L") == 1, F.col("w")).otherwise(-F.col("w")))
    sums = rows.groupBy(*keys).agg(F.sum("w").alias("weight"), *(bit(i).alias(f"b{i}") for i in range(BITS)))
    fp = F.expr(" | ".join(f"if(b{i} > 0, shiftleft(1L, {i}), 0L)" for i in range(BITS)))
    return sums.select(*keys, "weight", fp.alias("fp"))


def blocked(prints: DataFrame) -> DataFrame:
    """A row for each block of a fingerprint; the blocks share the 64 bits out as evenly as can be."""
    n = RADIUS + 1
    edges = [BITS * k // n for k in range(n + 1)]
    parts = [F.expr(f"shiftrightunsigned(fp, {a}) & {(1 << (b - a)) - 1}L") for a, b in zip(edges, edges[1:])]
    return prints.select("*", F.posexplode(F.array(*parts)).alias("block", "part"))


def contaminated(docs: DataFrame, benchmark: DataFrame, similarity: float = SIMILARITY) -> DataFrame:
    exact = _found(docs, benchmark, similarity)
    best = exact.groupBy("doc_id", "item_id").agg(F.max_by(F.struct("first", "n_words", "similarity"), F.struct(F.round("similarity", 9), -F.col("first"))).alias("b"))
    return best.select("doc_id", "item_id", F.col("b.first").alias("first_word"), F.col("b.n_words").alias("n_words"), F.round("b.similarity", 9).alias("similarity"))


def _found(docs: DataFrame, benchmark: DataFrame, similarity: float) -> DataFrame:
    """Windows (doc_id, rid, first, n_words, item_id, similarity) similar enough to an item; rid: hash of id and text."""
    items = cut(shingled(benchmark.select(F.col("item_id").cast("long").alias("item_id"), F.col("text").cast("string").alias("text")), "item_id").where(F.col("n_words") >= WORDS), "items")
    placed = items.select("item_id", "n_words", F.posexplode_outer("sh").alias("at", "s"))
    weights = placed.groupBy("s").agg((F.lit(1.0) / F.count_distinct("item_id")).alias("w"))
    n_placed = placed.count()
    rows = docs.select(F.col("doc_id").cast("long").alias("doc_id"), F.col("text").cast("string").alias("text"), F.xxhash64(F.col("doc_id").cast("long"), F.col("text").cast("string")).alias("rid"))
    # Windows: the document's shingle at `pos` is the item's at `at`.
    hits = shingled(rows, "doc_id", "rid").select("doc_id", "rid", F.posexplode_outer("sh").alias("pos", "s")).join(sized(placed, n_placed), "s")
    windows = cut(hits.select("doc_id", "rid", F.greatest(F.col("pos") - F.col("at"), F.lit(0)).alias("first"), "n_words").distinct(), "windows")
    of_doc = windows.groupBy("rid").agg(F.collect_set(F.struct("first", "n_words")).alias("wins"))
    texts = rows.join(sized(windows.select("rid").distinct(), windows.count()), "rid", "left_semi").dropDuplicates(["rid"])
    inside = (
        shingled(texts, "rid").select("rid", "sh").join(of_doc, "rid").select("rid", "sh", F.explode_outer("wins").alias("win"))
        .select("rid", F.col("win.first").alias("first"), F.col("win.n_words").alias("n_words"), F.explode_outer(F.array_distinct(F.slice("sh", F.col("win.first") + 1, F.col("win.n_words") - (WORDS - 1)))).alias("s"))
        .join(sized(weights, n_placed), "s", "left").select("rid", "first", "n_words", "s", F.coalesce("w", F.lit(1.0)).alias("w"))
    )
    inside = cut(inside, "inside")
    key = ("rid", "first", "n_words")  # ids may be null, which joins would lose
    prints = fingerprint(inside, *key)
    item_shingles = placed.select("item_id", "n_words", "s").distinct().join(sized(weights, n_placed), "s")
    item_prints = fingerprint(item_shingles, "item_id", "n_words").withColumnsRenamed({"fp": "item_fp", "weight": "item_weight"})
    item_blocks = blocked(item_prints.withColumn("fp", F.col("item_fp"))).select("item_id", "n_words", "item_fp", "item_weight", "block", "part")
    near = (
        blocked(prints).join(sized(item_blocks, n_placed * (RADIUS + 1)), ["n_words", "block", "part"])
        .where(F.bit_count(F.col("fp").bitwiseXOR(F.col("item_fp"))) <= RADIUS)
        .select(*key, "item_id", "weight", "item_weight").distinct()
    )
    common = inside.join(sized(item_shingles.select("item_id", "n_words", "s"), n_placed), ["n_words", "s"]).groupBy(*key, "item_id").agg(F.sum("w").alias("common"))
    exact = near.join(common, [*key, "item_id"]).withColumn("similarity", F.col("common") / (F.col("weight") + F.col("item_weight") - F.col("common")))
    named = windows.select("rid", "doc_id").distinct()
    return exact.where(F.col("similarity") >= similarity).join(named, "rid").select("doc_id", "rid", "first", "n_words", "item_id", "similarity")


def decontaminated(docs: DataFrame, benchmark: DataFrame) -> DataFrame:
    """The documents (all columns) in which no item was found; a row is judged by its own id (null or not) and text."""
    rid = F.xxhash64(F.col("doc_id").cast("long"), F.col("text").cast("string"))
    keyed = docs.select(F.struct(*(F.col(f"`{c}`") for c in docs.columns)).alias("row"), rid.alias("rid"))
    return keyed.join(_found(docs, benchmark, SIMILARITY).select("rid").distinct(), "rid", "left_anti").select("row.*")


def query(spark: SparkSession, sf_dir: str) -> DataFrame:
    return contaminated(table(spark, sf_dir, "documents"), table(spark, sf_dir, "benchmark"))
