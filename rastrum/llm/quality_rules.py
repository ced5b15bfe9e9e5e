"""Operator 6, quality rules.

Fixed counting rules and a logistic regression over hashed word and character
n-grams. It is trained in one task on labelled rows (at most TRAIN_ROWS distinct
texts of each label, none longer than TRAIN_CHARS: the documented bound),
calibrated by Platt's method on rows left out of the fit, and scored in Arrow
batches against fixed thresholds. Ids may be null, which teach nothing.

Null and empty texts have no word: they fail the base rule, their n-gram score
is that of the bias alone, and they are not kept. A table without usable labels
gives a model that keeps everything the base rules keep. Other columns of the
input are ignored. Repeated rows are each judged alone.
"""

from __future__ import annotations

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from . import kernels as K
from .shared import fitted, labelled, loaded, small_batches, table, teaching_rows, trimmed

BITS = 18
#: Teaching texts of each label at most, and characters of the longest one.
TRAIN_ROWS, TRAIN_CHARS = 2000, 200_000
#: A document is kept where its calibrated probability of good quality reaches this.
KEEP_AT = 0.5
MIN_WORDS, REPEAT_SHARE = 10, 20
#: Bytes of text handled at a time: their n-grams take some 100 times as much.
SLICE = 512 << 10
U = np.uint64
_SYMBOL = np.zeros(256, bool)
_SYMBOL[[ord(c) for c in "#*$%&|<>"]] = True
_NEWLINE = np.zeros(256, bool)
_NEWLINE[10] = True
_LEAD = np.ones(256, bool)
_LEAD[0x80:0xC0] = False
_MASK = U((1 << BITS) - 1)
SCHEMA = "doc_id long, n_words long, word_chars long, n_symbols long, n_dup_lines long, n_repeat_words long, base_failed boolean, quality double, kept boolean"


def _sums(row: np.ndarray, n: int, weights=None) -> np.ndarray:
    return np.bincount(row, weights, minlength=n)


def _again(h: np.ndarray, row: np.ndarray):
    """For hashes with their rows: which occur more than once in their row, and which have an equal one before them."""
    if not len(h):
        z = np.zeros(0, bool)
        return z, z
    own = K.mix(h + row.astype(U) * U(0x9E3779B97F4A7C15))
    order = np.argsort(own, kind="stable")
    s = own[order]
    same = s[1:] == s[:-1]
    many, later = np.zeros(len(h), bool), np.zeros(len(h), bool)
    later[order[1:]] = same
    many[order[1:]] |= same
    many[order[:-1]] |= same
    return many, later


def base_counts(buf: np.ndarray, offs: np.ndarray) -> dict[str, np.ndarray]:
    """The five counts of each row of a slice, and its word hashes."""
    n = len(offs) - 1
    starts, ends, row = K.spans(buf, offs)
    out = {"n_words": _sums(row, n).astype(np.int64)}
    lead = np.r_[0, np.cumsum(_LEAD[buf] & ~K._SPACE[buf])]
    out["word_chars"] = lead[offs[1:]] - lead[offs[:-1]]
    sym = np.r_[0, np.cumsum(_SYMBOL[buf])]
    out["n_symbols"] = sym[offs[1:]] - sym[offs[:-1]]
    word = K.span_hashes(buf, starts, ends)
    ls, le, lrow = K.spans(buf, offs, _NEWLINE)
    ink = np.r_[0, np.cumsum(~K._SPACE[buf])]
    has = ink[le] > ink[ls]
    ls, le, lrow = ls[has], le[has], lrow[has]
    _, later = _again(K.span_hashes(buf, ls, le), lrow)
    out["n_dup_lines"] = _sums(lrow[later], n).astype(np.int64)
    g, grow, at = K.shingles(word, row, 5)
    many, _ = _again(g, grow)
    edge = np.zeros(len(word) + 6, np.int64)
    np.add.at(edge, at[many], 1)
    np.add.at(edge, at[many] + 5, -1)
    covered = np.cumsum(edge)[: len(word)] > 0
    out["n_repeat_words"] = _sums(row[covered], n).astype(np.int64)
    return out | {"word": word, "row": row}


def ngram_slots(buf: np.ndarray, offs: np.ndarray, word: np.ndarray, row: np.ndarray):
    """Hashed slots of 3 and 5 characters and of 1 and 2 words, with their rows."""
    owner = np.repeat(np.arange(len(offs) - 1, dtype=np.int32), np.diff(offs))[_LEAD[buf]]
    b = np.frombuffer(buf.tobytes().decode("utf-8", "surrogatepass").encode("utf-32-le", "surrogatepass"), np.uint32).astype(U)
    for k, salt in ((3, 3), (5, 5)):
        v = np.zeros(max(0, len(b) - k + 1), U)
        for j in range(k if len(v) else 0):
            v = v * U(0x100000001B3) + b[j : len(b) - k + 1 + j]
        ok = owner[: len(v)] == owner[k - 1 :]
        yield (((v[ok] * U(0x9E3779B97F4A7C15 + 2 * salt)) >> U(64 - BITS)).astype(np.int64)), owner[: len(v)][ok]
    yield (word & _MASK).astype(np.int64), row
    two, trow, _ = K.shingles(word, row, 2)
    yield (two & _MASK).astype(np.int64), trow


def features(texts: list[str | None]):
    """Per text sorted slots and their shares (each kind of n-gram sums to 1)."""
    buf, offs = K.utf8(pa.array([t or "" for t in texts], pa.large_string()))
    out = [[] for _ in texts]
    for lo, hi in K.slices(offs, SLICE):
        part, po = buf[offs[lo] : offs[hi]], offs[lo : hi + 1] - offs[lo]
        starts, ends, row = K.spans(part, po)
        word = K.span_hashes(part, starts, ends)
        for kind, (slot, owner) in enumerate(ngram_slots(part, po, word, row)):
            bounds = np.searchsorted(owner, np.arange(hi - lo + 1))
            for i in range(hi - lo):
                s, c = np.unique(slot[bounds[i] : bounds[i + 1]], return_counts=True)
                if len(s):
                    out[lo + i].append(((s + (kind << BITS)).astype(np.int32), (c / c.sum()).astype(np.float32)))
        for i in range(lo, hi):  # some 8 bytes an n-gram of all teaching rows, and no more
            x = out[i]
            out[i] = (np.concatenate([s for s, _ in x]), np.concatenate([c for _, c in x])) if x else (np.zeros(0, np.int32), np.zeros(0, np.float32))
    return out


def fit(texts: list[str | None], labels: list[int], epochs: int = 6, seed: int = 1) -> dict:
    """Weights by AdaGrad on two thirds of the rows, Platt's scale and shift on the others."""
    w, b = np.zeros(4 << BITS, np.float32), 0.0
    y = np.array(labels, np.float64)
    if len(set(labels)) < 2:
        return {"w": w, "b": 0.0, "a": 0.0, "c": 9.0}
    x = features(texts)
    rng = np.random.default_rng(seed)
    order = rng.permutation(len(y))
    held, train = order[: len(y) // 3], order[len(y) // 3 :]
    g2 = np.full(len(w), 1e-6, np.float32)
    weight = np.where(y == 1, 0.5 / max(y[train].mean(), 1e-3), 0.5 / max(1 - y[train].mean(), 1e-3))
    for _ in range(epochs):
        for i in rng.permutation(train):
            s, c = x[i]
            p = 1 / (1 + np.exp(-np.clip(w[s] @ c + b, -30, 30)))
            e = weight[i] * (p - y[i])
            g = np.float32(e) * c
            g2[s] += g * g
            w[s] -= 0.5 * g / np.sqrt(g2[s])
            b -= 0.01 * e
    z = np.array([w[x[i][0]] @ x[i][1] + b for i in held])
    t = y[held]
    a, c = 1.0, 0.0
    for _ in range(200):  # Platt: Newton steps with his smoothed targets
        pos, neg = t.sum(), len(t) - t.sum()
        target = np.where(t == 1, (pos + 1) / (pos + 2), 1 / (neg + 2))
        p = 1 / (1 + np.exp(-np.clip(a * z + c, -30, 30)))
        d, r = p - target, np.maximum(p * (1 - p), 1e-6)
        h = np.array([[r @ (z * z) + 1e-3, r @ z], [r @ z, r.sum() + 1e-3]])
        step = np.linalg.solve(h, [d @ z + 1e-3 * (a - 1), d.sum()])
        a, c = a - np.clip(step[0], -1, 1), c - np.clip(step[1], -1, 1)
        if abs(step).max() < 1e-6:
            break
    return {"w": w, "b": float(b), "a": float(max(a, 1e-3)), "c": float(c)}


def scores(model: dict, buf: np.ndarray, offs: np.ndarray, word: np.ndarray, row: np.ndarray) -> np.ndarray:
    n = len(offs) - 1
    z = np.full(n, model["b"])
    for kind, (slot, owner) in enumerate(ngram_slots(buf, offs, word, row)):
        w = model["w"][kind << BITS : (kind + 1) << BITS]
        z += _sums(owner, n, w[slot]) / np.maximum(_sums(owner, n), 1)
    return 1 / (1 + np.exp(-np.clip(model["a"] * z + model["c"], -30, 30)))


def learned(docs: DataFrame, labels: DataFrame, most: int = TRAIN_ROWS):
    """The broadcast model of the labelled documents."""
    y = labels.where(F.col("quality").isin(0, 1)).select("doc_id", F.col("quality").cast("int").alias("y"))
    return fitted(teaching_rows(labelled(docs, y, most), most, TRAIN_CHARS), fit, "quality-model")


def judged(model: dict, buf: np.ndarray, offs: np.ndarray, keep_at: float):
    """Counts, base verdict, probability and verdict of each row of a slice."""
    c = base_counts(buf, offs)
    failed = (c["n_words"] < MIN_WORDS) | (100 * c["n_repeat_words"] > REPEAT_SHARE * c["n_words"])
    q = scores(model, buf, offs, c["word"], c["row"])
    return c, failed, q, ~failed & (q >= keep_at)


def quality_rules(docs: DataFrame, labels: DataFrame, keep_at: float = KEEP_AT) -> DataFrame:
    """One row per document with the base counts, the calibrated probability and the verdict."""
    small_batches(docs.sparkSession)
    model = learned(docs, labels)

    def judge(batches):
        for batch in batches:
            buf, offs = K.utf8(K.text_column(batch))
            ids = batch.column(0)
            for lo, hi in K.slices(offs, SLICE):
                c, failed, q, kept = judged(loaded(model), buf[offs[lo] : offs[hi]], offs[lo : hi + 1] - offs[lo], keep_at)
                names = ("n_words", "word_chars", "n_symbols", "n_dup_lines", "n_repeat_words")
                yield pa.RecordBatch.from_arrays([ids.slice(lo, hi - lo), *(pa.array(c[k], pa.int64()) for k in names), pa.array(failed), pa.array(q), pa.array(kept)], names=["doc_id", *names, "base_failed", "quality", "kept"])

    return docs.select(F.col("doc_id").cast("long").alias("doc_id"), F.col("text").cast("string").alias("text")).mapInArrow(trimmed(judge), SCHEMA)


def keep_good(docs: DataFrame, labels: DataFrame, keep_at: float = KEEP_AT) -> DataFrame:
    """The documents (all their columns) that the rules keep."""
    small_batches(docs.sparkSession)
    model = learned(docs, labels)

    def judge(batches):
        for batch in batches:
            buf, offs = K.utf8(K.text_column(batch))
            for lo, hi in K.slices(offs, SLICE):
                yield batch.slice(lo, hi - lo).filter(pa.array(judged(loaded(model), buf[offs[lo] : offs[hi]], offs[lo : hi + 1] - offs[lo], keep_at)[3]))

    return docs.mapInArrow(trimmed(judge), docs.schema)


def query(spark: SparkSession, sf_dir: str) -> DataFrame:
    return quality_rules(table(spark, sf_dir, "documents"), table(spark, sf_dir, "labels"))
