"""Operator 9, language identification.

One interpolated Kneser-Ney character model for each language (order ORDER).
The n-grams of all languages share sorted arrays of 64-bit hashes with one
column of log-probabilities for each language; a small directory over the top
bits finds a hash in a few steps. The language with the lowest cross-entropy
per character wins. A sharpness for the scores and a rejection threshold for
each language are calibrated on training documents left out of the models.

The models learn from every teaching document and from whole texts: tasks count
the n-grams of their rows, and Spark adds the counts of each language. A fifth of
the teaching documents, by a hash of the text, counts for nothing and calibrates,
all of it, by sums over tasks; a language that has texts in that fifth only
learns from them and is not calibrated. Repeated rows count as often as they
occur. N-grams of ORDER characters are counted in 2^SLOTS slots by hash, so a
model's size does not grow with the table beyond them; two in one slot count as
one, whose shorter n-grams are those of the smaller one. Null texts and texts without a
letter are `und` with score 0; combining marks alone are no letters. Long texts
are read whole. Of languages with one cross-entropy the first in their order by
name wins. Documents without lang teach nothing but are predicted; if none
teaches, all are `und`. Rows with a null id teach nothing, are predicted and not
held out; repeated rows are predicted alike; other columns are never read.
"""

from __future__ import annotations

import functools
import sys
import unicodedata

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from . import kernels as K
from .shared import built, cut, drop, id_remainder, loaded, small_batches, table, trimmed

ORDER = 4
#: Slots of the n-grams of ORDER characters, as a power of two.
SLOTS = 22
#: Sharpnesses that are tried.
TAUS = (2.0, 4.0, 8.0, 16.0, 32.0, 64.0)
#: N-grams that a counting task holds before it adds them up.
HELD = 1 << 20
U = np.uint64
_MULT = (np.arange(1, ORDER + 1, dtype=U) * U(0x9E3779B97F4A7C15)) | U(1)
SCHEMA = "doc_id long, held_out boolean, lang_pred string, score double, cross_entropy double, rejected boolean"


@functools.cache
def folded() -> np.ndarray:
    """Letters stand for themselves, all else for a blank."""
    out = np.full(sys.maxunicode + 1, 32, np.uint32)
    for c in range(sys.maxunicode + 1):
        if unicodedata.category(chr(c))[0] in "LM":
            out[c] = c
    return out


@functools.cache
def is_letter() -> np.ndarray:
    """Letters proper; combining marks belong to a word but make none."""
    out = np.zeros(sys.maxunicode + 1, bool)
    for c in range(sys.maxunicode + 1):
        out[c] = unicodedata.category(chr(c))[0] == "L"
    return out


def letters(texts: list[str | None]) -> tuple[np.ndarray, np.ndarray]:
    """Characters of all texts, each with ORDER - 1 blanks before it, runs of blanks as one; and where each text's own begin and end."""
    pad = " " * (ORDER - 1)
    raw = [(t or "").lower() for t in texts]
    code = folded()[np.frombuffer((pad + pad.join(raw)).encode("utf-32-le", "surrogatepass"), np.uint32)]
    lens = np.array([len(t) for t in raw], np.int64)
    begin = np.cumsum(lens + ORDER - 1) - lens
    blank = code == 32
    keep = np.ones(len(code), bool)
    keep[1:] = ~(blank[1:] & blank[:-1])
    for j in range(1, ORDER):
        keep[begin - j] = True
    place = np.r_[0, np.cumsum(keep)]
    return code[keep], np.c_[place[begin], place[begin + lens]]


def grams(code: np.ndarray, k: int) -> np.ndarray:
    """Hash of the k characters that end at each place (from k - 1 on; before, zero)."""
    out = np.zeros(len(code), U)
    if len(code) >= k:
        total = np.zeros(len(code) - k + 1, U)
        for j in range(k):
            total += (code[j : len(code) - k + 1 + j].astype(U) + U(1)) * _MULT[j] * U(2 * j + 3)
        out[k - 1 :] = K.mix(total + U(k))
    return out


class Sorted:
    """Sorted hashes with a directory over their top bits."""

    def __init__(self, keys: np.ndarray):
        self.keys = np.r_[keys, np.full(1, 2**64 - 1, U)]
        self.bits = max(8, int(len(keys)).bit_length())
        self.start = np.searchsorted(keys, np.arange(1 << self.bits, dtype=U) << U(64 - self.bits)).astype(np.int32)

    def find(self, h: np.ndarray) -> np.ndarray:
        """Place of each hash, or -1."""
        at = self.start[(h >> U(64 - self.bits)).astype(np.int64)]
        got = self.keys[at]
        behind = np.flatnonzero(got < h)
        while len(behind):
            at[behind] += 1
            got[behind] = self.keys[at[behind]]
            behind = behind[got[behind] < h[behind]]
        at[got != h] = -1
        return at


def _slot(h: np.ndarray) -> np.ndarray:
    """Slots of hashes of ORDER characters: their top bits, in place."""
    return h >> U(64 - SLOTS) << U(64 - SLOTS)


def _hash(chars: np.ndarray) -> np.ndarray:
    """Hash of each row of characters, as of grams()."""
    total = np.zeros(len(chars), U)
    for j in range(chars.shape[1]):
        total += (chars[:, j].astype(U) + U(1)) * _MULT[j] * U(2 * j + 3)
    return K.mix(total + U(chars.shape[1]))


def counted(texts: list[str | None], group: np.ndarray) -> tuple[np.ndarray, ...]:
    """(group, a, b, n): how often texts of each group have each n-gram of ORDER characters; a, b: two characters each."""
    code, span = letters(texts)
    size = span[:, 1] - span[:, 0]
    own = np.repeat(group.astype(np.int64), size)
    ends = np.arange(len(own)) + np.repeat(span[:, 0] - (np.cumsum(size) - size), size)
    wide = code.astype(np.int64)
    two = wide[:-1] << 32 | wide[1:]
    return added(own, two[ends - 3], two[ends - 1], np.ones(len(ends), np.int64), grams(code, ORDER)[ends])


def added(group: np.ndarray, a: np.ndarray, b: np.ndarray, n: np.ndarray, h: np.ndarray | None = None) -> tuple[np.ndarray, ...]:
    """Counts of one n-gram of one group added up."""
    if h is None:
        h = _hash(_chars(a, b))
    _, first, inv = np.unique(h ^ K.mix(group.astype(U)), return_index=True, return_inverse=True)
    return group[first], a[first], b[first], np.bincount(inv, n, len(first)).astype(np.int64)


def _chars(a: np.ndarray, b: np.ndarray) -> np.ndarray:
    low = np.int64(0xFFFFFFFF)
    return np.stack([a >> 32, a & low, b >> 32, b & low], 1).astype(np.uint32)


def _kneser_ney(chars: np.ndarray, count: np.ndarray):
    """For one language, per order: (hash or slot, suffix's hash, context's hash, discounted share), and (context's hash, log of what is left for lower orders). chars, count: its n-grams of ORDER characters, a slot each."""
    out = []
    for k in range(ORDER, 0, -1):
        full = _hash(chars)
        suffix, context = _hash(chars[:, 1:]), _hash(chars[:, :-1])
        ones, twos = (count == 1).sum(), (count == 2).sum()
        discount = min(0.95, max(0.1, ones / max(1, ones + 2 * twos)))
        ctx, inv = np.unique(context, return_inverse=True)
        total, kinds = np.bincount(inv, count), np.bincount(inv)
        out.append((_slot(full) if k == ORDER else full, suffix, context, (count - discount) / total[inv], ctx, discount * kinds / total))
        # Of the next lower order: in how many different n-grams of this one it is the end.
        _, first, count = np.unique(suffix, return_index=True, return_counts=True)
        chars = chars[first, 1:]
    return out[::-1]


def assembled(names: list[str], which: np.ndarray, a: np.ndarray, b: np.ndarray, n: np.ndarray) -> dict:
    """Models of all languages, evaluated over the union of their n-grams, from counts. which: number of a count's language."""
    if not len(n):
        return {"names": []}
    slot = _slot(_hash(_chars(a, b)))
    order = np.lexsort((b, a, slot))
    which, a, b, n, slot = (x[order] for x in (which, a, b, n, slot))
    _, first, inv = np.unique(slot, return_index=True, return_inverse=True)
    chars = _chars(a[first], b[first])
    parts = []
    for j in range(len(names)):
        own = which == j
        total = np.bincount(inv[own], n[own], len(first))
        parts.append(_kneser_ney(chars[total > 0], total[total > 0].astype(np.int64)))
    kinds = len(np.unique(np.concatenate([p[0][0] for p in parts]))) + 1
    levels = []
    for k in range(ORDER):
        keys, first = np.unique(np.concatenate([p[k][0] for p in parts]), return_index=True)
        suffix, context = np.concatenate([p[k][1] for p in parts])[first], np.concatenate([p[k][2] for p in parts])[first]
        ctx = np.unique(np.concatenate([p[k][4] for p in parts]))
        left = np.ones((len(ctx), len(names)))
        share = np.zeros((len(keys), len(names)))
        for j, p in enumerate(parts):
            left[np.searchsorted(ctx, p[k][4]), j] = p[k][5]
            share[np.searchsorted(keys, p[k][0]), j] = p[k][3]
        lower = np.full((len(keys), len(names)), 1 / kinds) if k == 0 else np.exp(levels[k - 1]["log"][np.searchsorted(levels[k - 1]["keys"], suffix)])
        value = share + left[np.searchsorted(ctx, context)] * lower
        levels.append({"keys": keys, "log": np.log(np.maximum(value, 1e-12)).astype(np.float32), "ctx": ctx, "left": np.log(np.maximum(left, 1e-12)).astype(np.float32)})
    return {"names": names, "kinds": kinds, "levels": levels}


def train(texts: list[str], langs: list[str]) -> dict:
    """Models of texts at hand."""
    names = sorted(set(langs))
    return assembled(names, *counted(texts, np.array([names.index(x) for x in langs], np.int64)))


def prepared(model: dict) -> dict:
    """The model with its directories, built once in each worker."""
    if "find" not in model and model["names"]:
        model["find"] = [(Sorted(x["keys"]), Sorted(x["ctx"])) for x in model["levels"]]
    return model


def _log_probs(model: dict, code: np.ndarray, ends: np.ndarray, k: int) -> np.ndarray:
    """Log-probability of the character at each end after its context, for each language; n-grams that no language has back off."""
    if k < 0:
        return np.full((len(ends), len(model["names"])), np.float32(-np.log(model["kinds"])))
    level, (find, find_ctx) = model["levels"][k], model["find"][k]
    h = _gram_at(code, ends, k + 1)
    at = find.find(_slot(h) if k + 1 == ORDER else h)
    out = level["log"][at]
    miss = np.flatnonzero(at < 0)
    if len(miss):
        ctx = find_ctx.find(_gram_at(code, ends[miss] - 1, k) if k else np.zeros(len(miss), U))
        out[miss] = _log_probs(model, code, ends[miss], k - 1) + np.where(ctx[:, None] >= 0, level["left"][ctx], np.float32(0))
    return out


def _gram_at(code: np.ndarray, ends: np.ndarray, k: int) -> np.ndarray:
    if len(ends) * 2 > len(code):
        return grams(code, k)[ends]
    total = np.zeros(len(ends), U)
    for j in range(k):
        total += (code[ends - k + 1 + j].astype(U) + U(1)) * _MULT[j] * U(2 * j + 3)
    return K.mix(total + U(k))


def cross_entropies(model: dict, texts: list[str | None]) -> tuple[np.ndarray, np.ndarray]:
    """Per text and language the cross-entropy per character; and the number of letters."""
    code, span = letters(texts)
    own = np.zeros(len(code) + 1, np.int64)
    np.add.at(own, span[:, 0], 1)
    np.add.at(own, span[:, 1], -1)
    ends = np.flatnonzero(np.cumsum(own)[:-1] > 0)
    logs = _log_probs(model, code, ends, ORDER - 1) if len(ends) else np.zeros((0, len(model["names"])), np.float32)
    sums = np.vstack([np.zeros((1, logs.shape[1])), np.cumsum(logs, axis=0, dtype=np.float64)])
    place = np.searchsorted(ends, span)
    n = place[:, 1] - place[:, 0]
    letter = np.r_[0, np.cumsum(is_letter()[code])]
    return -(sums[place[:, 1]] - sums[place[:, 0]]) / np.maximum(n, 1)[:, None], letter[span[:, 1]] - letter[span[:, 0]]


def _counts(batches):
    """Rows (y, apart, slot, a, b, n) of a task's texts; the counts of one n-gram may come in parts."""
    names, kept, size = {}, [], 0

    def row(group, a, b, n):
        known = np.array([*names, ""], object)
        return pa.RecordBatch.from_arrays([pa.array(known[group >> 1], pa.string()), pa.array(group & 1 == 1), pa.array(_slot(_hash(_chars(a, b))).view(np.int64)), pa.array(a), pa.array(b), pa.array(n)], names=["y", "apart", "slot", "a", "b", "n"])

    for batch in batches:
        column = K.text_column(batch)
        group = np.array([2 * names.setdefault(y, len(names)) for y in batch.column(1).to_pylist()], np.int64) + batch.column(2).to_numpy(zero_copy_only=False)
        _, offs = K.utf8(column)
        for lo, hi in K.slices(offs, 1 << 20):
            kept.append(counted(column.slice(lo, hi - lo).to_pylist(), group[lo:hi]))
            size += len(kept[-1][0])
            if size >= HELD:
                kept = [added(*(np.concatenate(x) for x in zip(*kept)))]
                size = len(kept[0][0])
                if size >= HELD // 2:
                    yield row(*kept[0])
                    kept, size = [], 0
    if kept:
        yield row(*added(*(np.concatenate(x) for x in zip(*kept))))


def learned(teach: DataFrame):
    """The broadcast model of teaching rows (text, y, apart)."""

    def make(batches):
        t = pa.Table.from_batches(batches) if (batches := list(batches)) else None
        if t is None or not len(t):
            return {"names": []}
        y, apart = t.column("y").to_pandas(), t.column("apart").to_numpy()
        # Languages all of whose texts are set apart.
        alone = set(y.unique()) - set(y[~apart].unique())
        names = sorted(y.unique())
        use = ~apart | y.isin(alone).to_numpy()
        which = np.searchsorted(names, y[use].to_numpy().astype(str)) if len(names) else np.zeros(0, np.int64)
        return assembled(names, which, *(t.column(c).to_numpy()[use] for c in "abn")) | {"alone": sorted(alone)}

    low = F.min(F.struct("a", "b"))
    rows = teach.mapInArrow(trimmed(_counts), "y string, apart boolean, slot long, a long, b long, n long").groupBy("y", "apart", "slot").agg(low.alias("g"), F.sum("n").alias("n")).select("y", "apart", "g.a", "g.b", "n")
    counts = cut(rows, "language-counts")
    model = built(counts, make, "language-model")
    drop(counts)
    return model


def calibrated(teach: DataFrame, model) -> tuple[float, dict[str, float]]:
    """The sharpness with the least loss on the rows set apart, and each language's highest cross-entropy that is not rejected."""

    def run(batches):
        m = prepared(loaded(model))
        names, sums = m["names"], {}
        for batch in batches:
            column, y = K.text_column(batch), batch.column(1).to_pylist()
            _, offs = K.utf8(column)
            for lo, hi in K.slices(offs, 1 << 20):
                if not names:
                    continue
                h, n = cross_entropies(m, column.slice(lo, hi - lo).to_pylist())
                for name in set(y[lo:hi]) - set(m["alone"]):
                    own = np.array([x == name for x in y[lo:hi]]) & (n > 0)
                    if own.any() and name in names:
                        j, g = names.index(name), h[own]
                        lose = [float(np.sum(np.log(np.exp(-tau * (g - g.min(1, keepdims=True))).sum(1)) + tau * (g[:, j] - g.min(1)))) for tau in TAUS]
                        sums.setdefault(name, []).append([len(g), g[:, j].sum(), (g[:, j] ** 2).sum(), g[:, j].max(), *lose])
        rows = [[name, *np.sum(v, 0).tolist()[:3], max(x[3] for x in v), *np.sum(v, 0).tolist()[4:]] for name, v in sums.items()]
        fields = [("y", pa.string()), *((c, pa.float64()) for c in ("n", "s", "q", "top", *(f"l{i}" for i in range(len(TAUS)))))]
        yield pa.RecordBatch.from_arrays([pa.array([r[i] for r in rows], k) for i, (_, k) in enumerate(fields)], names=[c for c, _ in fields])

    lose = [f"l{i}" for i in range(len(TAUS))]
    sums = teach.where("apart").mapInArrow(trimmed(run), "y string, n double, s double, q double, top double, " + ", ".join(f"{c} double" for c in lose))
    found = sums.groupBy("y").agg(F.max("top").alias("top"), *(F.sum(c).alias(c) for c in ("n", "s", "q", *lose))).collect()
    if not found:
        return 30.0, {}
    best = min(range(len(TAUS)), key=lambda i: sum(r[lose[i]] for r in found))
    return TAUS[best], {r["y"]: r["top"] + 3 * max(0.0, r["q"] / r["n"] - (r["s"] / r["n"]) ** 2) ** 0.5 + 0.1 for r in found}


def identify(docs: DataFrame) -> DataFrame:
    small_batches(docs.sparkSession)
    text = F.col("text").cast("string")
    teach = docs.where((id_remainder("doc_id", 3) != 1) & F.col("lang").isNotNull() & (F.length("text") > 0)).select(text.alias("text"), F.col("lang").cast("string").alias("y"), (F.pmod(F.xxhash64(text, F.lit(79)), F.lit(5)) == 0).alias("apart"))
    model = learned(teach)
    tau, limits = calibrated(teach, model)

    def predict(batches):
        m = prepared(loaded(model))
        names = np.array([*m["names"], "und"], object)
        limit = np.array([limits.get(x, 1e9) for x in m["names"]] + [0.0])
        for batch in batches:
            column = K.text_column(batch)
            _, offs = K.utf8(column)
            for lo, hi in K.slices(offs, 1 << 20):
                texts = column.slice(lo, hi - lo).to_pylist()
                best, score, cross, rejected = np.full(len(texts), len(names) - 1), np.zeros(len(texts)), np.zeros(len(texts)), np.ones(len(texts), bool)
                if m["names"]:
                    h, n = cross_entropies(m, texts)
                    some = n > 0
                    best[some] = h[some].argmin(1)
                    z = np.exp(-tau * (h - h.min(1, keepdims=True)))
                    score[some] = (1 / z.sum(1))[some]
                    cross[some] = h[some].min(1)
                    rejected[some] = (cross > limit[best])[some] | (score[some] < 0.5)
                yield pa.RecordBatch.from_arrays([batch.column(0).slice(lo, hi - lo), batch.column(2).slice(lo, hi - lo), pa.array(names[best], pa.string()), pa.array(score), pa.array(cross), pa.array(rejected)], names=["doc_id", "held_out", "lang_pred", "score", "cross_entropy", "rejected"])

    return docs.select(F.col("doc_id").cast("long").alias("doc_id"), "text", F.coalesce(id_remainder("doc_id", 3) == 1, F.lit(False)).alias("held_out")).mapInArrow(predict, SCHEMA)


def query(spark: SparkSession, sf_dir: str) -> DataFrame:
    return identify(table(spark, sf_dir, "documents"))
