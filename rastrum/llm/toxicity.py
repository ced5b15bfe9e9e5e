"""Operator 2, toxicity.

A bidirectional gated recurrent network over words, with attention pooling.
A word enters as the embedding of its hash beside the mean embedding of its
character n-grams, so words never seen still have their parts. All windows of
WINDOW words, STRIDE apart (they overlap), of every whole text are scored; the
highest window counts. Trained in numpy, in one task, on at most TRAIN_ROWS
distinct texts of each label, none longer than TRAIN_CHARS (the documented
bound): windows that look most suspicious by the
log-odds of their n-grams, then those the network itself finds worst.

Null texts and texts without a word have score 0. Rows without a label teach
nothing; if a label is missing altogether every score is 0. Repeated rows are
scored alike; other columns are never read. Rows whose id is null are scored,
teach nothing and are not held out.
"""

from __future__ import annotations

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from . import kernels as K
from .shared import fitted, id_remainder, labelled, loaded, small_batches, table, teaching_rows

WINDOW, STRIDE = 32, 24
HIDDEN, D_WORD, D_CHAR = 8, 4, 8
WORD_BITS, CHAR_BITS = 16, 19
#: Teaching texts of each label at most, and characters of the longest one.
TRAIN_ROWS, TRAIN_CHARS = 1000, 200_000
#: Documents' worth of the base rate that every n-gram counts as besides what was seen.
PRIOR = 10.0
#: Cost of a clean document flagged, in toxic ones missed (clean ones are far more).
CLEAN = 3
U = np.uint64
# Words are runs of ASCII letters, digits and all bytes beyond ASCII.
_APART = np.ones(256, bool)
_APART[0x80:] = False
_APART[48:58] = _APART[65:91] = _APART[97:123] = False


def vocabulary_of(buf: np.ndarray, offs: np.ndarray):
    """Distinct words: their hashes, slots of their n-grams with bounds; then the word of each place, and each row's bounds."""
    starts, ends, row = K.spans(buf, offs, _APART)
    h = K.span_hashes(buf, starts, ends, K._LOWER)
    keys, first, inv = np.unique(h, return_index=True, return_inverse=True)
    s, e = starts[first], ends[first]
    lens = e - s + 2
    edge = np.cumsum(lens) - lens
    flat = np.full(int(lens.sum()), 1, np.uint8)  # 1 marks a word's start and end
    inner = np.repeat(s - edge - 1, lens) + np.arange(len(flat))
    inside = np.ones(len(flat), bool)
    inside[edge] = inside[edge + lens - 1] = False
    flat[inside] = K._LOWER[buf[inner[inside]]]
    owner = np.repeat(np.arange(len(keys), dtype=np.int32), lens)
    slots, owners = [], []
    for k in (3, 4, 5):
        n = len(flat) - k + 1
        if n > 0:
            v = np.zeros(n, U)
            for j in range(k):
                v = v * U(257) + flat[j : n + j].astype(U)
            ok = owner[:n] == owner[k - 1 :]
            slots.append((K.mix(v[ok] + U(k << 50)) >> U(64 - CHAR_BITS)).astype(np.int32))
            owners.append(owner[:n][ok])
    for k in (6, 7, 8, 9):  # of longer n-grams, those at a word's start and end
        for at in (edge[lens > k], (edge + lens - k)[lens > k]):
            v = np.zeros(len(at), U)
            for j in range(k):
                v = v * U(257) + flat[at + j].astype(U)
            slots.append((K.mix(v + U(k << 50)) >> U(64 - CHAR_BITS)).astype(np.int32))
            owners.append(owner[at])  # the owner of a place in the flat bytes
    slot, own = (np.concatenate(slots), np.concatenate(owners)) if slots else (np.zeros(0, np.int32), np.zeros(0, np.int32))
    slots = owners = None
    slot = slot[np.argsort(own, kind="stable")]
    bounds = np.r_[0, np.cumsum(np.bincount(own, minlength=len(keys)))]
    return keys, slot, bounds, inv, np.searchsorted(row, np.arange(len(offs)))


def means(table_: np.ndarray, slot: np.ndarray, bounds: np.ndarray) -> np.ndarray:
    """Mean of the table's rows at each word's slots (every word has at least one)."""
    if len(bounds) < 2:
        return np.zeros((0, table_.shape[1]), table_.dtype)
    return np.add.reduceat(table_[slot], bounds[:-1], axis=0) / np.maximum(np.diff(bounds), 1)[:, None].astype(np.float32)


def peaks(odds: np.ndarray, slot: np.ndarray, bounds: np.ndarray) -> np.ndarray:
    """Highest log-odds among each word's n-grams."""
    return np.maximum.reduceat(odds[slot], bounds[:-1]) if len(bounds) > 1 else np.zeros(0, np.float32)


def windows_of(bounds: np.ndarray):
    """(row, first place, words) of all windows: STRIDE apart, the last one up to the row's end."""
    n = np.diff(bounds)
    count = np.where(n > 0, 1 + np.maximum(0, -(-(n - WINDOW) // STRIDE)), 0)
    row = np.repeat(np.arange(len(n)), count)
    k = np.arange(len(row)) - np.repeat(np.cumsum(count) - count, count)
    at = np.maximum(0, np.minimum(k * STRIDE, n[row] - WINDOW))
    return row, bounds[row] + at, np.minimum(n[row] - at, WINDOW)


def _sigmoid(x):
    return 1 / (1 + np.exp(-x))


def forward(m: dict, px: np.ndarray, size: np.ndarray, keep: bool = False):
    """px: input sums of the gates, windows x WINDOW x 6 HIDDEN (both directions); size: words in each window."""
    n, h = len(px), HIDDEN
    states = np.zeros((n, WINDOW, 2 * h), np.float32)
    tape = {}
    for d, steps in ((0, range(WINDOW)), (1, range(WINDOW - 1, -1, -1))):
        u, state = m["u"][d], np.zeros((n, h), np.float32)
        for t in steps:
            x = px[:, t, 3 * h * d : 3 * h * (d + 1)]
            s = state @ u
            zr = _sigmoid(x[:, : 2 * h] + s[:, : 2 * h])
            z, r = zr[:, :h], zr[:, h:]
            c = np.tanh(x[:, 2 * h :] + r * s[:, 2 * h :])
            on = (t < size)[:, None]
            new = np.where(on, (1 - z) * c + z * state, state)
            if keep:
                tape[d, t] = (state, z, r, c, s[:, 2 * h :], on)
            state = new
            states[:, t, h * d : h * (d + 1)] = state
    a = np.tanh(states @ m["wa"])
    e = np.where(np.arange(WINDOW) < size[:, None], a @ m["va"], -1e9)
    e = np.exp(e - e.max(1, keepdims=True))
    e /= e.sum(1, keepdims=True)
    pooled = np.einsum("nt,nth->nh", e, states)
    logit = pooled @ m["wo"] + m["bo"]
    return (logit, states, a, e, pooled, tape) if keep else logit


def backward(m: dict, g: np.ndarray, size: np.ndarray, states, a, e, pooled, tape):
    """Gradients of the network's own weights, and of px."""
    h, n = HIDDEN, len(g)
    out = {"wo": pooled.T @ g, "bo": np.float32(g.sum())}
    gp = g[:, None] * m["wo"]
    gs = e[:, :, None] * gp[:, None]
    ge = np.einsum("nth,nh->nt", states, gp)
    ge = e * (ge - (e * ge).sum(1, keepdims=True))
    out["va"] = np.einsum("nt,ntk->k", ge, a)
    ga = ge[:, :, None] * m["va"] * (1 - a * a)
    out["wa"] = np.einsum("nth,ntk->hk", states, ga)
    gs = gs + ga @ m["wa"].T
    gx = np.zeros((n, WINDOW, 6 * h), np.float32)
    out["u"] = np.zeros_like(m["u"])
    for d, steps in ((0, range(WINDOW - 1, -1, -1)), (1, range(WINDOW))):
        back = np.zeros((n, h), np.float32)
        for t in steps:
            state, z, r, c, s, on = tape[d, t]
            total = back + gs[:, t, h * d : h * (d + 1)]
            gc = np.where(on, total * (1 - z), 0) * (1 - c * c)
            gz = np.where(on, total * (state - c), 0) * z * (1 - z)
            gr = gc * s * r * (1 - r)
            gu = np.concatenate([gz, gr, gc * r], 1)
            gx[:, t, 3 * h * d : 3 * h * (d + 1)] = np.concatenate([gz, gr, gc], 1)
            out["u"][d] += state.T @ gu
            back = np.where(on, total * z, total) + gu @ m["u"][d].T
    return out, gx


def start(seed: int = 5) -> dict:
    rng = np.random.default_rng(seed)
    n = lambda *s: (rng.standard_normal(s) / np.sqrt(s[-2])).astype(np.float32)
    d, h = D_WORD + D_CHAR + 1, HIDDEN
    return {
        "ew": (0.05 * rng.standard_normal((1 << WORD_BITS, D_WORD))).astype(np.float32), "ec": (0.05 * rng.standard_normal((1 << CHAR_BITS, D_CHAR))).astype(np.float32),
        "wx": n(d, 6 * h), "b": np.zeros(6 * h, np.float32), "u": n(2, h, 3 * h), "wa": n(2 * h, h), "va": n(1, h)[0], "wo": n(1, 2 * h)[0], "bo": np.float32(0),
    }


def inputs(m: dict, keys, slot, bounds) -> np.ndarray:
    return np.concatenate([m["ew"][(keys >> U(64 - WORD_BITS)).astype(np.int64)], means(m["ec"], slot, bounds), peaks(m["odds"], slot, bounds)[:, None]], 1)


def _gather(px: np.ndarray, inv: np.ndarray, at: np.ndarray, size: np.ndarray) -> np.ndarray:
    place = np.minimum(at[:, None] + np.arange(WINDOW), max(len(inv) - 1, 0))
    return px[inv[place]]


def row_scores(m: dict, buf: np.ndarray, offs: np.ndarray):
    """Score of each row, and its worst window's first word within the row."""
    n = len(offs) - 1
    best, where = np.zeros(n), np.zeros(n, np.int64)
    keys, slot, bounds, inv, rows = vocabulary_of(buf, offs)
    if not len(inv):
        return best, where
    px = inputs(m, keys, slot, bounds) @ m["wx"] + m["b"]
    row, at, size = windows_of(rows)
    p = np.concatenate([_sigmoid(np.clip(forward(m, _gather(px, inv, at[i : i + 4096], size[i : i + 4096]), size[i : i + 4096]), -30, 30)) for i in range(0, len(at), 4096)])
    firsts = np.flatnonzero(np.r_[True, row[1:] != row[:-1]])
    top = np.maximum.reduceat(p, firsts)
    best[row[firsts]] = top
    order = np.lexsort((at, -p, row))
    lead = order[np.flatnonzero(np.r_[True, row[order][1:] != row[order][:-1]])]
    where[row[lead]] = at[lead] - rows[row[lead]]
    return best, where


def fit(texts: list[str], labels: list[int]) -> dict | None:
    """The network, and a threshold moved to 0.5: of the logits of a fifth of the rows, left out of the learning, that with the least cost, one clean row flagged counting like CLEAN toxic rows missed."""
    held = np.arange(len(labels)) % 5 == 4
    pick = lambda keep: ([t for t, k in zip(texts, keep) if k], [v for v, k in zip(labels, keep) if k])
    m = learned(*pick(~held))
    if m is None:
        return None
    left, y = pick(held)
    p = np.concatenate([row_scores(m, *K.utf8(pa.array(left[i : i + 50], pa.large_string())))[0] for i in range(0, len(left), 50)] or [np.zeros(0)])
    y = np.array(y)
    z = np.log(np.clip(p, 1e-9, 1 - 1e-9) / (1 - np.clip(p, 1e-9, 1 - 1e-9)))
    steps = np.arange(-2.0, 6.01, 0.25)
    cost = np.array([CLEAN * ((z >= s) & (y == 0)).sum() + ((z < s) & (y == 1)).sum() for s in steps])
    best = steps[cost == cost.min()]
    m["bo"] = np.float32(m["bo"] - (0.75 * best.min() + 0.25 * best.max()))
    return m


def learned(texts: list[str], labels: list[int], rounds: int = 2, epochs: int = 3, batch: int = 128) -> dict | None:
    y = np.array(labels, np.float32)
    if len(set(labels)) < 2:
        return None
    buf, offs = K.utf8(pa.array(texts, pa.large_string()))
    keys, slot, bounds, inv, rows = vocabulary_of(buf, offs)
    n = len(y)
    # Log-odds of n-grams: in how many documents of either label each occurs.
    df = np.zeros((2, 1 << CHAR_BITS))
    for i in range(n):
        w = np.unique(inv[rows[i] : rows[i + 1]])
        if len(w):
            s = np.unique(np.concatenate([slot[bounds[x] : bounds[x + 1]] for x in w]))
            df[int(y[i]), s] += 1
    base = float(y.mean())
    share = (df[1] + PRIOR * base) / (df.sum(0) + PRIOR)
    odds = (np.log(share / (1 - share)) - np.log(base / (1 - base))).astype(np.float32)
    m = start()
    suspicion = peaks(odds, slot, bounds)
    rng = np.random.default_rng(3)
    row, at, size = windows_of(rows)
    word = suspicion[inv]
    peak = np.array([word[a : a + s].max() for a, s in zip(at, size)])
    g2 = {k: np.full(np.shape(v), 1e-4, np.float32) for k, v in m.items()}
    m["odds"] = odds
    own = np.r_[np.searchsorted(row, np.arange(n)), len(row)]
    clean = [np.arange(own[i], own[i + 1]) for i in range(n)]
    pick = np.array([c[peak[c].argmax()] if len(c) else -1 for c in clean])
    extra = np.zeros(0, np.int64)
    for r in range(rounds):
        rand = np.array([rng.choice(c) for i, c in enumerate(clean) if len(c) and y[i] == 0], np.int64)
        chosen = np.concatenate([pick[pick >= 0], rand, extra])
        for _ in range(epochs):
            for part in np.array_split(rng.permutation(chosen), max(1, len(chosen) // batch)):
                _learn(m, g2, keys, slot, bounds, inv, at[part], size[part], y[row[part]])
        px = inputs(m, keys, slot, bounds) @ m["wx"] + m["b"]
        logit = np.concatenate([forward(m, _gather(px, inv, at[i : i + 4096], size[i : i + 4096]), size[i : i + 4096]) for i in range(0, len(at), 4096)])
        worst = np.array([c[logit[c].argmax()] if len(c) else -1 for c in clean])
        extra = worst[(worst >= 0) & (y == 0)]
        hard = np.flatnonzero((y[row] == 0) & (logit > -1))
        extra = np.concatenate([extra, hard[np.argsort(-logit[hard], kind="stable")]])
        pick = np.where((y == 1) & (worst >= 0) & (rng.random(n) < 0.5), worst, pick)
    return m


def _learn(m, g2, keys, slot, bounds, inv, at, size, y, rate: float = 0.08):
    """One step of AdaGrad on some windows."""
    place = np.minimum(at[:, None] + np.arange(WINDOW), len(inv) - 1)
    used, back = np.unique(inv[place], return_inverse=True)
    back = back.reshape(place.shape)
    lens = np.diff(bounds)[used]
    edge = np.r_[0, np.cumsum(lens)]
    s = slot[np.repeat(bounds[used] - edge[:-1], lens) + np.arange(edge[-1])]
    x = np.concatenate([m["ew"][(keys[used] >> U(64 - WORD_BITS)).astype(np.int64)], means(m["ec"], s, edge), peaks(m["odds"], s, edge)[:, None]], 1)
    px = (x @ m["wx"] + m["b"])[back]
    logit, *kept = forward(m, px, size, keep=True)
    g = ((_sigmoid(np.clip(logit, -30, 30)) - y) / len(y)).astype(np.float32)
    grad, gx = backward(m, g, size, *kept)
    flat, at_word = gx.reshape(-1, gx.shape[-1]), back.ravel()
    order = np.argsort(at_word, kind="stable")
    gw = np.add.reduceat(flat[order], np.searchsorted(at_word[order], np.arange(len(used))), axis=0)
    grad["wx"], grad["b"] = x.T @ gw, gw.sum(0)
    gin = gw @ m["wx"].T
    for k, v in grad.items():
        g2[k] += v * v
        m[k] = m[k] - rate * v / np.sqrt(g2[k])
    for k, index, v in (("ew", (keys[used] >> U(64 - WORD_BITS)).astype(np.int64), gin[:, :D_WORD]), ("ec", s, np.repeat(gin[:, D_WORD:-1] / lens[:, None], lens, axis=0))):
        order = np.argsort(index, kind="stable")
        ranked = index[order]
        edges = np.flatnonzero(np.r_[True, ranked[1:] != ranked[:-1]])
        i, total = ranked[edges], np.add.reduceat(v[order], edges, axis=0)
        g2[k][i] += total * total
        m[k][i] -= rate * total / np.sqrt(g2[k][i])


def trained(docs: DataFrame, labels: DataFrame, most: int = TRAIN_ROWS):
    """The broadcast model of the labelled documents that may teach."""
    y = labels.where((id_remainder("doc_id", 5) != 0) & F.col("toxic").isin(0, 1)).select("doc_id", F.col("toxic").cast("int").alias("y"))
    return fitted(teaching_rows(labelled(docs, y, most), most, TRAIN_CHARS), fit, "toxicity-model")


def toxicity(docs: DataFrame, labels: DataFrame) -> DataFrame:
    """One row per document: score, prediction, and where its worst window begins (in words)."""
    small_batches(docs.sparkSession)
    model = trained(docs, labels)

    def score(batches):
        m = loaded(model)
        for batch in batches:
            buf, offs = K.utf8(K.text_column(batch))
            for lo, hi in K.slices(offs, 1 << 20):
                n = hi - lo
                p, at = row_scores(m, buf[offs[lo] : offs[hi]], offs[lo : hi + 1] - offs[lo]) if m else (np.zeros(n), np.zeros(n, np.int64))
                yield pa.RecordBatch.from_arrays([batch.column(0).slice(lo, n), batch.column(2).slice(lo, n), pa.array(p.astype(np.float64)), pa.array((p >= 0.5).astype(np.int32)), pa.array(at)], names=["doc_id", "held_out", "score", "predicted", "worst_at"])

    return docs.select(F.col("doc_id").cast("long").alias("doc_id"), "text", F.coalesce(id_remainder("doc_id", 5) == 0, F.lit(False)).alias("held_out")).mapInArrow(score, "doc_id long, held_out boolean, score double, predicted int, worst_at long")


def query(spark: SparkSession, sf_dir: str) -> DataFrame:
    return toxicity(table(spark, sf_dir, "documents"), table(spark, sf_dir, "labels"))
