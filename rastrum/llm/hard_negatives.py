"""Operator 11, hard-negative mining.

Anchors (ids divisible by ANCHORS) against all rows, in blocks: a task has a block
of anchors and a block of rows. Rows are product-quantised: every SUB components
become one of CENTROIDS centroids (fitted on at most SAMPLE distinct rows,
rounded to whole numbers), and the norm of what that leaves is stored. The
score of a row is then that of its centroids, from a table per anchor, plus or minus
the anchor's norm times the stored one (Cauchy and Schwarz), so no row that may
count is passed over; those left get their exact whole-number score. A window's
threshold comes from the exact scores of its likeliest rows. First the
positives are found, then, for each, the negatives between its two bounds.

Rows with a null label or vector, or with a null or non-finite component, take no part;
shorter vectors count as followed by zeros. A null vec_id is no anchor, keeps its label and
comes last among equal scores. Equal rows each count, an anchor's own row alone
is left out; they tie by vec_id, then in no stated order (their output is alike).
An empty table gives no rows. Scores of 2^62 and more raise an ArithmeticError.
"""

from __future__ import annotations

import math

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from .shared import cut, small_batches, table

ANCHORS, POSITIVES, NEGATIVES, LABELS, SHIFTED = 50, 5, 3, 10, 7
#: Share of the positive's score that a negative's has at least and at most, in percent.
LOW, HIGH = 50, 95
SUB, CENTROIDS = 2, 256
#: Rows that the centroids are fitted on, at most, and components of them.
SAMPLE, SAMPLE_VALUES = 4096, 1 << 20
#: Anchors and rows of a task, about.
ANCHOR_BLOCK, ROW_BLOCK = 2048, 4096
#: Likeliest rows of a window, whose exact scores give its threshold.
SEEDS = 16
LAST_ID = (1 << 63) - 1  # stands for a null id
SCHEMA = "anchor_id long, positive_id long, rank int, negative_id long, positive_score long, negative_score long"
_FOUND = "a_rid long, anchor_id long, p_rid long, positive_id long, positive_score long"


def vectors(rows: DataFrame) -> DataFrame:
    """(vec_id, label, x array<long>) of the rows that take part."""
    whole = F.forall("embedding", lambda v: v.isNotNull() & ~F.isnan(v.cast("double")) & (F.abs(v.cast("double")) < F.lit(float("inf"))))
    label = F.when(F.col("vec_id") % SHIFTED == 0, (F.col("label") + 1) % LABELS).otherwise(F.col("label"))
    usable = rows.select("vec_id", "label", "embedding").where(F.col("label").isNotNull() & F.col("embedding").isNotNull() & whole)
    return usable.select(F.col("vec_id").cast("long").alias("vec_id"), label.cast("long").alias("label"), F.transform("embedding", lambda v: F.floor(v.cast("double") * 256)).alias("x"))


def _matrix(column: pa.Array, dim: int) -> np.ndarray:
    """Lists as rows, with zeros behind the shorter ones."""
    size = np.diff(np.asarray(column.offsets))
    flat = column.flatten().to_numpy(zero_copy_only=False).astype(np.int64)
    out = np.zeros((len(size), dim), np.int64)
    out[np.repeat(np.arange(len(size)), size), np.arange(len(flat)) - np.repeat(np.cumsum(size) - size, size)] = flat
    return out


def codebooks(x: np.ndarray, rounds: int = 6) -> np.ndarray:
    """Centroids of each SUB components (parts x CENTROIDS x SUB), by Lloyd's method from the first rows; whole numbers."""
    parts = x.shape[1] // SUB
    out = np.zeros((parts, CENTROIDS, SUB))
    for j in range(parts):
        v = x[:, j * SUB : (j + 1) * SUB].astype(np.float64)
        c = v[np.arange(CENTROIDS) % len(v)].copy()
        for _ in range(rounds):
            near = ((c * c).sum(1) - 2 * v @ c.T).argmin(1)
            n = np.bincount(near, minlength=CENTROIDS)
            for s in range(SUB):
                c[n > 0, s] = np.bincount(near, v[:, s], CENTROIDS)[n > 0] / n[n > 0]
        out[j] = np.rint(c)
    return out


def quantised(x: np.ndarray, books: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Codes of each row (bytes), and the norm of what they leave, rounded up."""
    codes = np.zeros((len(x), len(books)), np.uint8)
    left = np.zeros(len(x))
    for j, c in enumerate(books):
        v = x[:, j * SUB : (j + 1) * SUB].astype(np.float64)
        codes[:, j] = ((c * c).sum(1) - 2 * v @ c.T).argmin(1)
        left += ((v - c[codes[:, j]]) ** 2).sum(1)
    return codes, np.sqrt(left) * (1 + 1e-9)


class Block:
    """Rows of a task, sorted by label, ready to be scored."""

    def __init__(self, t: pa.Table, books: np.ndarray, wide: bool, exact: bool):
        order = np.argsort(t.column("label").to_numpy(), kind="stable")
        self.label, self.rid, self.id, self.norm = (t.column(c).to_numpy()[order] for c in ("label", "rid", "vec_id", "norm"))
        raw = lambda name, kind, n: np.frombuffer(b"".join(t.column(name).to_pylist()), kind).reshape(len(t), n)[order]
        self.x = raw("x", "<i8" if wide else "<i2", books.shape[0] * SUB).astype(np.float64 if exact else np.int64)
        self.codes = np.ascontiguousarray(raw("codes", np.uint8, books.shape[0]).T)
        top = float(np.abs(self.x).max(initial=0))
        self.most = books.shape[0] * SUB * max(top, float(np.abs(books).max(initial=0))) ** 2

    def slice_of(self, label: int) -> tuple[int, int]:
        return int(np.searchsorted(self.label, label)), int(np.searchsorted(self.label, label, "right"))

    def estimates(self, a: np.ndarray, books: np.ndarray):
        """Table scores of all rows for some anchors (anchors x rows), and what rounding may have moved them by."""
        most = self.most + books.shape[0] * SUB * float(np.abs(a).max(initial=0)) ** 2
        kind = np.float32 if most < 1 << 23 else np.float64
        out = np.zeros((len(self.rid), len(a)), kind)
        for j, c in enumerate(books):
            out += (c @ a[:, j * SUB : (j + 1) * SUB].T.astype(np.float64)).astype(kind)[self.codes[j]]
        return np.ascontiguousarray(out.T), 0.0 if most < 1 << 52 else most * len(books) * 2.0**-48

    def scores(self, at: np.ndarray, anchor: np.ndarray) -> np.ndarray:
        return (self.x[at] @ anchor).astype(np.int64)

    def best(self, at: np.ndarray, score: np.ndarray, k: int) -> np.ndarray:
        """Of some rows those k with the highest scores (ties: smaller id), as positions in `at`."""
        return np.lexsort((self.rid[at], self.id[at], -score))[:k]


def _top(v: np.ndarray, k: int) -> np.ndarray:
    return np.argpartition(-v, k - 1)[:k] if len(v) > k else np.arange(len(v))


def _chunks(anchors: Block, rows: Block, books: np.ndarray):
    """(anchor's position, its table scores, half widths of their bounds) for all anchors."""
    step = max(4, min(128, (1 << 25) // max(1, len(books) * CENTROIDS * 8)))
    for lo in range(0, len(anchors.rid), step):
        a = anchors.x[lo : lo + step]
        est, slack = rows.estimates(a, books)
        norms = np.sqrt((a.astype(np.float64) ** 2).sum(1)) * (1 + 1e-9)
        for i in range(len(a)):
            yield lo + i, est[i], norms[i] * rows.norm + slack


def block_positives(anchors: Block, rows: Block, books: np.ndarray) -> list[tuple]:
    """(anchor, row, score) of each anchor's best rows of its label within the block."""
    out = []
    for i, est, width in _chunks(anchors, rows, books):
        lo, hi = rows.slice_of(anchors.label[i])
        at = lo + np.flatnonzero(rows.rid[lo:hi] != anchors.rid[i])
        if len(at) > POSITIVES:
            sure = np.sort(rows.scores(at[_top(est[at], POSITIVES)], anchors.x[i]))[0]
            at = at[est[at] + width[at] >= sure]
        score = rows.scores(at, anchors.x[i])
        out += [(i, int(at[b]), int(score[b])) for b in rows.best(at, score, POSITIVES)]
    return out


def block_negatives(anchors: Block, rows: Block, books: np.ndarray, wanted: dict[int, set[int]]) -> list[tuple]:
    """(anchor, positive's score, row, score) of the best rows of another label between the bounds of each wanted score. wanted: by the anchor's rid."""
    out = []
    for i, est, width in _chunks(anchors, rows, books):
        lo, hi = rows.slice_of(anchors.label[i])
        other = np.ones(len(est), bool)
        other[lo:hi] = False
        windows = [(p, -(-LOW * p // 100), HIGH * p // 100) for p in wanted.get(int(anchors.rid[i]), ())]
        windows = [w for w in windows if w[1] <= w[2]]
        if not windows or not other.any():
            continue
        high, low = est + width, est - width
        exact, known = np.zeros(len(est), np.int64), np.zeros(len(est), bool)
        for p, least, most in windows:
            near = np.flatnonzero(other & (est <= most))
            seed = near[_top(est[near], SEEDS)]
            exact[seed], known[seed] = rows.scores(seed, anchors.x[i]), True
            inside = np.sort(exact[seed][(exact[seed] >= least) & (exact[seed] <= most)])
            sure = inside[-NEGATIVES] if len(inside) >= NEGATIVES else least
            at = np.flatnonzero(other & (high >= sure) & (low <= most))
            new = at[~known[at]]
            exact[new], known[new] = rows.scores(new, anchors.x[i]), True
            at = at[(exact[at] >= sure) & (exact[at] <= most)]
            out += [(i, p, int(at[b]), int(exact[at[b]])) for b in rows.best(at, exact[at], NEGATIVES)]
    return out


def index(rows: DataFrame):
    """(index, codebooks, wide, exact): every row that takes part, quantised, in the shared folder; None if there is none."""
    spark = rows.sparkSession
    base = vectors(rows)
    n, dim, top = base.agg(F.count("*"), F.max(F.size("x")), F.max(F.greatest(F.array_max("x"), -F.array_min("x")))).first()
    if not n:
        return None
    dim, top = max(SUB, -(-dim // SUB) * SUB), max(int(top or 0), 1)
    if dim * top * top >= 1 << 62:
        raise ArithmeticError("components too large for scores of 64 bits")
    most = max(1, min(SAMPLE, SAMPLE_VALUES // dim))
    share = F.lit(min(1.0, 2 * most / n))
    drawn = base.select("x", F.xxhash64("x").alias("h")).where(F.pmod("h", F.lit(1 << 30)) < share * (1 << 30)).dropDuplicates(["h"]).orderBy("h").limit(most)
    found = drawn.select("x").toArrow().column("x").combine_chunks()
    books = codebooks(_matrix(found, dim) if len(found) else np.zeros((1, dim), np.int64))
    sent, wide = spark.sparkContext.broadcast(books), top >= 1 << 15

    def run(batches):
        for b in batches:
            x = _matrix(b.column(2), dim)
            codes, norm = quantised(x, sent.value)
            raw = np.ascontiguousarray(x.astype("<i8" if wide else "<i2"))
            ids = b.column(0).fill_null(LAST_ID)
            yield pa.RecordBatch.from_arrays([ids, b.column(1), pa.array([v.tobytes() for v in raw], pa.binary()), pa.array([v.tobytes() for v in codes], pa.binary()), pa.array(norm)], names=["vec_id", "label", "x", "codes", "norm"])

    made = base.mapInArrow(run, "vec_id long, label long, x binary, codes binary, norm double").withColumn("rid", F.monotonically_increasing_id())
    return cut(made, "vectors"), n, sent, wide, dim * top * top < 1 << 52


def hard_negatives(rows: DataFrame) -> DataFrame:
    """For each anchor and each of its first POSITIVES positives the first NEGATIVES rows of other labels whose score is LOW to HIGH percent of the positive's."""
    spark = rows.sparkSession
    small_batches(spark)
    made = index(rows)
    if made is None:
        return spark.createDataFrame([], SCHEMA)
    indexed, n, sent, wide, exact = made
    anchors = spark.read.schema(indexed.schema).parquet(indexed._rastrum_path).where((F.col("vec_id") % ANCHORS == 0) & (F.col("vec_id") != LAST_ID))
    row_blocks, anchor_blocks = -(-n // ROW_BLOCK), -(-anchors.count() // ANCHOR_BLOCK)
    dealt = lambda k: F.pmod(F.xxhash64("rid"), F.lit(max(1, k)).cast("long"))
    every = lambda k: F.explode(F.sequence(F.lit(0).cast("long"), F.lit(max(1, k) - 1).cast("long")))
    rows_of = indexed.withColumn("rb", dealt(row_blocks)).withColumn("ab", every(anchor_blocks)).groupBy("ab", "rb")
    anchors_of = lambda df: df.withColumn("ab", dealt(anchor_blocks)).withColumn("rb", every(row_blocks)).groupBy("ab", "rb")

    def first(left: pa.Table, right: pa.Table) -> pa.Table:
        a, r = (Block(t, sent.value, wide, exact) for t in (left, right))
        got = block_positives(a, r, sent.value) if len(left) and len(right) else []
        i, j = (np.array([g[k] for g in got], np.int64) for k in (0, 1))
        return pa.table({"a_rid": a.rid[i], "anchor_id": a.id[i], "p_rid": r.rid[j], "positive_id": r.id[j], "positive_score": pa.array([g[2] for g in got], pa.int64())})

    best = Window.partitionBy("a_rid").orderBy(F.desc("positive_score"), "positive_id", "p_rid")
    found = anchors_of(anchors).cogroup(rows_of).applyInArrow(first, _FOUND)
    positives = cut(found.withColumn("k", F.row_number().over(best)).where(F.col("k") <= POSITIVES).drop("k"), "positives")
    windows = positives.groupBy(F.col("a_rid").alias("rid")).agg(F.collect_set("positive_score").alias("wanted"))  # POSITIVES at most

    def second(left: pa.Table, right: pa.Table) -> pa.Table:
        a, r = (Block(t, sent.value, wide, exact) for t in (left, right))
        wanted = dict(zip(left.column("rid").to_pylist(), map(set, left.column("wanted").to_pylist())))
        got = block_negatives(a, r, sent.value, wanted) if len(left) and len(right) else []
        i, j = (np.array([g[k] for g in got], np.int64) for k in (0, 2))
        return pa.table({"a_rid": a.rid[i], "positive_score": pa.array([g[1] for g in got], pa.int64()), "n_rid": r.rid[j], "negative_id": r.id[j], "negative_score": pa.array([g[3] for g in got], pa.int64())})

    near = anchors_of(anchors.join(windows, "rid")).cogroup(rows_of).applyInArrow(second, "a_rid long, positive_score long, n_rid long, negative_id long, negative_score long")
    order = Window.partitionBy("a_rid", "positive_score").orderBy(F.desc("negative_score"), "negative_id", "n_rid")
    ranked = near.withColumn("rank", F.row_number().over(order)).where(F.col("rank") <= NEGATIVES)
    named = lambda c: F.when(F.col(c) != LAST_ID, F.col(c)).alias(c)
    return positives.join(ranked, ["a_rid", "positive_score"]).select("anchor_id", named("positive_id"), "rank", named("negative_id"), "positive_score", "negative_score")


def query(spark: SparkSession, sf_dir: str) -> DataFrame:
    return hard_negatives(table(spark, sf_dir, "embeddings"))


ORACLE_SQL = """
WITH v AS (
  SELECT row_number() OVER () AS rid, vec_id, CASE WHEN vec_id % 7 = 0 THEN (label + 1) % 10 ELSE label END AS label, [floor(256 * c::DOUBLE) for c in embedding] AS x
  FROM embeddings WHERE label IS NOT NULL AND embedding IS NOT NULL AND len([c for c in embedding if c IS NULL OR NOT isfinite(c)]) = 0
), s AS (
  SELECT a.rid AS ar, a.vec_id AS anchor_id, v.rid, v.vec_id, a.label = v.label AS same, list_inner_product(a.x, v.x)::BIGINT AS score
  FROM v AS a JOIN v ON a.vec_id % 50 = 0 AND a.rid <> v.rid
), p AS (
  SELECT *, row_number() OVER (PARTITION BY ar ORDER BY score DESC, vec_id, rid) AS k FROM s WHERE same QUALIFY k <= 5
), n AS (
  SELECT p.anchor_id, p.vec_id AS positive_id, p.score AS positive_score, s.vec_id AS negative_id, s.score AS negative_score,
    row_number() OVER (PARTITION BY p.ar, p.rid ORDER BY s.score DESC, s.vec_id, s.rid) AS rank
  FROM p JOIN s ON s.ar = p.ar AND NOT s.same AND 50 * p.score <= 100 * s.score AND 100 * s.score <= 95 * p.score
)
SELECT anchor_id, positive_id, rank::INTEGER AS rank, negative_id, positive_score, negative_score FROM n WHERE rank <= 3
"""
