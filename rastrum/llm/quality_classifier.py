"""Operator 13, quality classifier.

Random indexing: every token slot (a hash of the token) has a sparse index vector of
+1 and -1 drawn from a rule, and its word vector is the sum of the index vectors of the
tokens up to SPAN places away, over all documents. The sums are whole numbers, made in
each task and added by Spark, so they are the same in any order; the table of word
vectors has 2^BITS rows whatever the input, and is broadcast. A document is the mean and
the spread of its tokens' word vectors and index vectors, and the mean product of
neighbours' ones. A network of two layers, in numpy, learns from at most TRAIN_ROWS
distinct labelled texts of each label, none longer than TRAIN_CHARS (the documented
bound), in one task, each label weighted by its share of all labelled rows; a temperature
fitted on a third of them, left out of the learning, calibrates its probabilities.

A token is a run of letters (all bytes beyond ASCII count), of digits, or of one kind of other
characters. Null and empty texts have no token: their vector is zero, and their score the
network's for that. Without rows of both labels every score is the share of good
ones (0.5 without any). Repeated rows are scored alike, rows with a null id teach
nothing and are not held out; other columns are never read.
"""

from __future__ import annotations

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from . import kernels as K
from .shared import cut, drop, fitted, id_remainder, labelled, loaded, small_batches, table, teaching_rows

#: Slots of tokens as a power of two, components of a vector, those that an index vector has, places around a token.
BITS, DIM, FILLED, SPAN = 14, 32, 4, 2
HIDDEN = 24
#: Numbers that a document becomes.
WIDTH = 4 * DIM + 3
#: Teaching texts of each label at most, and characters of the longest one.
TRAIN_ROWS, TRAIN_CHARS = 2000, 200_000
U = np.uint64
_KIND = np.zeros(256, np.uint8)  # 0 between tokens, then letters, digits, and each ASCII sign for itself
_KIND[0x80:] = 1
_KIND[33:127] = np.arange(33, 127)
_KIND[65:91] = _KIND[97:123] = 1
_KIND[48:58] = 2


def tokens(buf: np.ndarray, offs: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """(slot, row) of every token, in order."""
    if not len(buf):
        return np.zeros(0, np.int64), np.zeros(0, np.int64)
    kind = _KIND[buf]
    edge = np.ones(len(buf) + 1, bool)
    edge[1:-1] = kind[1:] != kind[:-1]
    edge[offs] = True
    starts = np.flatnonzero(edge[:-1] & (kind > 0))
    ends = np.flatnonzero(edge[1:] & (kind > 0)) + 1
    h = K.span_hashes(buf, starts, ends)
    return (h >> U(64 - BITS)).astype(np.int64), np.searchsorted(offs, starts, "right") - 1


def index_vectors() -> np.ndarray:
    """FILLED components of +1 or -1 for each slot, by a rule."""
    draw = K.mix(np.arange(1, FILLED * (1 << BITS) + 1, dtype=U) * U(0x9E3779B97F4A7C15)).reshape(-1, FILLED)
    out = np.zeros((1 << BITS, DIM), np.int8)
    for k in range(FILLED):
        np.add.at(out, (np.arange(1 << BITS), (draw[:, k] % U(DIM)).astype(np.int64)), np.where(draw[:, k] >> U(63), 1, -1).astype(np.int8))
    return out


_INDEX = index_vectors()


def contexts(slot: np.ndarray, row: np.ndarray) -> np.ndarray:
    """For each token the sum of the index vectors of those up to SPAN places away in its text."""
    own = _INDEX[slot]
    out = np.zeros((len(slot), DIM), np.int8)
    for d in range(1, min(SPAN, len(slot) - 1) + 1):
        near = (row[d:] == row[:-d])[:, None]
        out[d:] += own[:-d] * near
        out[:-d] += own[d:] * near
    return out


def word_vectors(docs: DataFrame):
    """Broadcast table of unit word vectors, from all documents."""
    spark = docs.sparkSession
    names = [f"c{i}" for i in range(DIM)]

    def run(batches):
        total = np.zeros((1 << BITS, DIM), np.int64)
        for batch in batches:
            buf, offs = K.utf8(K.text_column(batch))
            for lo, hi in K.slices(offs):
                slot, row = tokens(buf[offs[lo] : offs[hi]], offs[lo : hi + 1] - offs[lo])
                if len(slot):
                    order = np.argsort(slot, kind="stable")
                    ranked = slot[order]
                    first = np.flatnonzero(np.r_[True, ranked[1:] != ranked[:-1]])
                    total[ranked[first]] += np.add.reduceat(contexts(slot, row)[order], first, axis=0, dtype=np.int64)
        at = np.flatnonzero(total.any(1))
        for i in range(0, len(at), 2000):
            part = at[i : i + 2000]
            yield pa.RecordBatch.from_arrays([pa.array(part), *(pa.array(np.ascontiguousarray(total[part, k])) for k in range(DIM))], names=["slot", *names])

    sums = docs.select(F.col("text").cast("string").alias("text")).mapInArrow(run, "slot long, " + ", ".join(f"{c} long" for c in names))
    made = cut(sums.groupBy("slot").agg(*(F.sum(c).alias(c) for c in names)), "word-vectors")
    got = made.toArrow()  # 2^BITS rows at most
    drop(made)
    out = np.zeros((1 << BITS, DIM), np.float32)
    out[got.column("slot").to_numpy()] = np.stack([got.column(c).to_numpy() for c in names], 1)
    return spark.sparkContext.broadcast(out / np.maximum(np.sqrt((out * out).sum(1, keepdims=True)), 1e-6))


def pooled(vectors: np.ndarray, buf: np.ndarray, offs: np.ndarray) -> np.ndarray:
    """Of each row the mean and spread of its tokens' word and index vectors, the mean product of neighbours' vectors, and the logarithm of the tokens' number."""
    n = len(offs) - 1
    out = np.zeros((n, WIDTH), np.float32)
    slot, row = tokens(buf, offs)
    if not len(slot):
        return out
    beside = np.flatnonzero(row[1:] == row[:-1])
    pairs = np.maximum(np.bincount(row[beside], minlength=n), 1)
    for k, v in enumerate((vectors, _INDEX)):
        out[:, 4 * DIM + k] = np.bincount(row[beside], np.einsum("nd,nd->n", v[slot[beside]], v[slot[beside + 1]], dtype=np.float32), n) / pairs
    seen, count = np.unique(row * (1 << BITS) + slot, return_counts=True)
    row, slot = seen >> BITS, seen & ((1 << BITS) - 1)
    first = np.flatnonzero(np.r_[True, row[1:] != row[:-1]])
    share = (count / np.add.reduceat(count, first)[np.cumsum(np.r_[0, row[1:] != row[:-1]])])[:, None].astype(np.float32)
    for k, v in enumerate((vectors[slot], _INDEX[slot].astype(np.float32) / np.float32(FILLED**0.5))):
        mean = np.add.reduceat(v * share, first, axis=0)
        square = np.add.reduceat(v * v * share, first, axis=0)
        out[row[first], 2 * k * DIM : (2 * k + 1) * DIM] = mean
        out[row[first], (2 * k + 1) * DIM : (2 * k + 2) * DIM] = np.sqrt(np.maximum(square - mean * mean, 0))
    out[row[first], -1] = np.log1p(np.add.reduceat(count, first))
    return out


def logits(m: dict, x: np.ndarray) -> np.ndarray:
    return np.tanh(((x - m["mean"]) / m["scale"]) @ m["w1"] + m["b1"]) @ m["w2"] + m["b2"]


def scores(m: dict, x: np.ndarray) -> np.ndarray:
    """Calibrated probabilities of good quality."""
    return 1 / (1 + np.exp(-np.clip(logits(m, x).astype(np.float64) / m["temperature"], -30, 30)))


def gradients(m: dict, x: np.ndarray, y: np.ndarray, weight: np.ndarray) -> dict:
    """Of the mean cross-entropy, by the network's weights; x already centred and scaled, each row with its own weight."""
    h = np.tanh(x @ m["w1"] + m["b1"])
    g = weight * (1 / (1 + np.exp(-np.clip(h @ m["w2"] + m["b2"], -30, 30))) - y) / len(y)
    back = g[:, None] * m["w2"] * (1 - h * h)
    return {"w1": x.T @ back, "b1": back.sum(0), "w2": h.T @ g, "b2": g.sum()}


def temperature(z: np.ndarray, y: np.ndarray, weight: np.ndarray) -> float:
    """The divisor of the logits with the least cross-entropy on rows left out of the fit, by golden section of its logarithm."""
    loss = lambda t: float(np.mean(weight * (np.logaddexp(0, z / np.exp(t)) - y * z / np.exp(t))))
    lo, hi, cut_ = np.log(0.05), np.log(20.0), (5**0.5 - 1) / 2
    while hi - lo > 1e-4:
        a, b = hi - cut_ * (hi - lo), lo + cut_ * (hi - lo)
        lo, hi = (lo, b) if loss(a) < loss(b) else (a, hi)
    return float(np.exp((lo + hi) / 2))


def fit_vectors(x: np.ndarray, labels: list[int], share: float | None = None, epochs: int = 60, batch: int = 64, seed: int = 2) -> dict:
    """The network by Adam on two thirds of the rows, its temperature on the others. share: of good ones among all labelled rows, for which the rows are weighted."""
    y = np.array(labels, np.float64)
    width = x.shape[1]
    rng = np.random.default_rng(seed)
    own = float(y.mean()) if len(y) else 0.5
    share = own if share is None else share
    m = {"mean": np.zeros(width, np.float32), "scale": np.ones(width, np.float32), "w1": np.zeros((width, HIDDEN)), "b1": np.zeros(HIDDEN), "w2": np.zeros(HIDDEN), "b2": float(np.log(max(share, 1e-6) / max(1 - share, 1e-6))), "temperature": 1.0}
    if len(set(labels)) < 2:
        return m
    weight = np.where(y == 1, share / own, (1 - share) / (1 - own))
    order = rng.permutation(len(y))
    held, train = order[: len(y) // 3], order[len(y) // 3 :]
    m["mean"], m["scale"] = x[train].mean(0), x[train].std(0) + np.float32(1e-2)
    m["w1"], m["w2"] = rng.standard_normal((width, HIDDEN)) / width**0.5, rng.standard_normal(HIDDEN) / HIDDEN**0.5
    v = (x - m["mean"]) / m["scale"]
    first, second, step = {}, {}, 0
    for _ in range(epochs):
        for part in np.array_split(rng.permutation(train), max(1, len(train) // batch)):
            step += 1
            for k, g in gradients(m, v[part], y[part], weight[part]).items():
                g = g + (1e-4 * m[k] if k[0] == "w" else 0)
                first[k] = 0.9 * first.get(k, 0) + 0.1 * g
                second[k] = 0.999 * second.get(k, 0) + 0.001 * g * g
                m[k] = m[k] - 0.003 * (first[k] / (1 - 0.9**step)) / (np.sqrt(second[k] / (1 - 0.999**step)) + 1e-8)
    if len(held):
        m["temperature"] = temperature(logits(m, x[held]), y[held], weight[held])
    return m


def trained(docs: DataFrame, labels: DataFrame, vectors, most: int = TRAIN_ROWS):
    """The broadcast network of the labelled documents that may teach."""

    def fit(texts: list[str], y: list[int]) -> dict:
        parts = [pooled(vectors.value, *K.utf8(pa.array(texts[i : i + 200], pa.large_string()))) for i in range(0, len(texts), 200)]
        return fit_vectors(np.concatenate([np.zeros((0, WIDTH), np.float32), *parts]), y, share)

    y = labels.where((id_remainder("doc_id", 3) != 1) & F.col("quality").isin(0, 1)).select("doc_id", F.col("quality").cast("int").alias("y"))
    share = y.agg(F.avg("y")).first()[0]
    return fitted(teaching_rows(labelled(docs, y, most), most, TRAIN_CHARS), fit, "classifier-model")


def quality_scores(docs: DataFrame, labels: DataFrame) -> DataFrame:
    """One row per document: calibrated probability of good quality, and the prediction."""
    small_batches(docs.sparkSession)
    vectors = word_vectors(docs)
    model = trained(docs, labels, vectors)

    def run(batches):
        for batch in batches:
            buf, offs = K.utf8(K.text_column(batch))
            for lo, hi in K.slices(offs):
                n = hi - lo
                p = scores(loaded(model), pooled(vectors.value, buf[offs[lo] : offs[hi]], offs[lo : hi + 1] - offs[lo]))
                yield pa.RecordBatch.from_arrays([batch.column(0).slice(lo, n), batch.column(2).slice(lo, n), pa.array(p), pa.array((p >= 0.5).astype(np.int32))], names=["doc_id", "held_out", "score", "predicted"])

    held = F.coalesce(id_remainder("doc_id", 3) == 1, F.lit(False)).alias("held_out")
    return docs.select(F.col("doc_id").cast("long").alias("doc_id"), F.col("text").cast("string").alias("text"), held).mapInArrow(run, "doc_id long, held_out boolean, score double, predicted int")


def query(spark: SparkSession, sf_dir: str) -> DataFrame:
    return quality_scores(table(spark, sf_dir, "documents"), table(spark, sf_dir, "labels"))
