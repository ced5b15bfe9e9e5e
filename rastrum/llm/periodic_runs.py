"""Operator 12, periodic runs.

Words `[^\\x20\\x09-\\x0D]+` of every whole text, numbered from 0. A run is a stretch
with smallest period q and max(LEAST, TIMES * q) words at least that neither
neighbour extends. Every stretch of 2^k words of a text gets a name (Karp, Miller
and Rosenberg: the pair of names of its halves), so two blocks of q words are
equal when the names at both their ends are. A run holds at least three whole blocks of
the grid 0, q, 2q, ..., so for each q only neighbouring blocks are compared; where
two in succession agree, the stretch is extended to both sides, less than q
words, by going down the levels of names. Names are kept only where a text still
repeats something at a level, so the levels end soon for most texts.

One text is handled by one task, whole: names take 8 bytes a word and level, up to
log2(n / TIMES) levels for a text of n words that repeats its longest stretches.

Null and empty texts have no word: no run, four nulls, and the hashes of nothing.
A null id leaves its text as it is (nothing is repeated on purpose in it).
Repeated rows are each judged alone; other columns are never read.
"""

from __future__ import annotations

import hashlib
import zlib
from fractions import Fraction

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from . import kernels as K
from .shared import small_batches, table

#: A run's words: so many at least, and so many times its period.
LEAST, TIMES = 6, 4
#: Pairs of blocks compared at a time.
TESTS = 1 << 20
SCHEMA = "doc_id long, n_runs long, start long, length long, period long, exponent_milli long, runs_sha256 string, collapsed_sha256 string, n_words long, n_dropped long"
_NOTHING = hashlib.sha256(b"").hexdigest()


def words_of(buf: np.ndarray, offs: np.ndarray) -> tuple[pa.Array, np.ndarray]:
    """All words of some texts as one array, and where each text's begin (and the last one's end)."""
    starts, ends, row = K.spans(buf, offs)
    edges = np.r_[0, np.cumsum(ends - starts)]
    ink = np.ascontiguousarray(buf[~K._SPACE[buf]])
    words = pa.Array.from_buffers(pa.binary(), len(starts), [None, pa.py_buffer(edges.astype(np.int32)), pa.py_buffer(ink)])
    return words, np.searchsorted(row, np.arange(len(offs)))


def repeated_on_purpose(doc_id: int | None, n: int) -> np.ndarray:
    """The place that each of a text's n words comes from: for one text in ten the words from some place on repeat with a period."""
    at = np.arange(n)
    h = zlib.crc32(str(doc_id).encode()) if doc_id is not None else 1
    if h % 10 == 0 and n:
        g = h // 10
        a = g % n
        at[a:] = a + np.arange(n - a) % (1 + (n - a) // (3 + g % 8))
    return at


def first_names(ids: np.ndarray, row: np.ndarray):
    """Names of single words, apart for each text, and whether a name comes twice."""
    _, name, count = np.unique(row.astype(np.int64) * (int(ids.max()) + 1) + ids, return_inverse=True, return_counts=True)
    return name, count[name] > 1


def longer_names(name: np.ndarray, many: np.ndarray, width: int, end: np.ndarray):
    """Names of stretches of 2 * width words from those of width words. A stretch that can't come twice, or goes beyond its text, has a name of its own."""
    n = len(name)
    at = np.flatnonzero(many & (np.arange(n) + 2 * width <= end))
    at = at[many[at + width]]
    out, twice = np.arange(n, 2 * n), np.zeros(n, bool)
    if len(at):
        _, inv, count = np.unique(name[at] * (2 * n) + name[at + width], return_inverse=True, return_counts=True)
        out[at], twice[at] = inv, count[inv] > 1
    return out, twice


def equal_ahead(names: list[np.ndarray], i: np.ndarray, j: np.ndarray, end: np.ndarray) -> np.ndarray:
    """Words from i on that equal those from j on (i < j), fewer than 2^levels, j's inside its text."""
    got = np.zeros(len(i), np.int64)
    for k in range(len(names) - 1, -1, -1):
        ok = j + got + (1 << k) <= end
        at = np.where(ok, got, 0)
        same = ok & (names[k][np.minimum(i + at, len(names[k]) - 1)] == names[k][np.minimum(j + at, len(names[k]) - 1)])
        got += same << k
    return got


def equal_behind(names: list[np.ndarray], i: np.ndarray, j: np.ndarray, begin: np.ndarray) -> np.ndarray:
    """Words before i that equal those before j (i < j), fewer than 2^levels, i's inside its text."""
    got = np.zeros(len(i), np.int64)
    for k in range(len(names) - 1, -1, -1):
        ok = i - got - (1 << k) >= begin
        back = np.where(ok, got + (1 << k), 0)
        got += (ok & (names[k][np.minimum(i - back, len(names[k]) - 1)] == names[k][np.minimum(j - back, len(names[k]) - 1)])) << k
    return got


def runs_of(ids: np.ndarray, bounds: np.ndarray) -> np.ndarray:
    """(text, start, length, period) of every run, by text, start and period; ids: numbers of words, bounds: where texts begin."""
    lens = np.diff(bounds)
    row = np.repeat(np.arange(len(lens)), lens)
    if not len(ids):
        return np.zeros((0, 4), np.int64)
    end = bounds[1:][row]
    name, many = first_names(ids, row)
    names, found = [], []
    k = 0
    while many.any():
        names.append(name)
        width = 1 << k
        live = np.flatnonzero(np.bincount(row[many], minlength=len(lens)) > 0)
        live = live[lens[live] // TIMES >= width]
        if not len(live):
            break
        periods = np.minimum(2 * width - 1, lens[live] // TIMES) - width + 1
        doc = np.repeat(live, periods)
        q = width + np.arange(len(doc)) - np.repeat(np.cumsum(periods) - periods, periods)
        found += _at_level(names, doc, q, bounds, lens)
        name, many = longer_names(name, many, width, end)
        k += 1
    out = np.concatenate([np.zeros((0, 4), np.int64), *found])
    out = out[np.lexsort((out[:, 3], out[:, 2], out[:, 1], out[:, 0]))]
    old = np.r_[False, (out[1:, :3] == out[:-1, :3]).all(1)][: len(out)]  # a stretch's smallest period comes first
    out = out[~old]
    return out[np.lexsort((out[:, 3], out[:, 1], out[:, 0]))]


def _at_level(names, doc, q, bounds, lens) -> list[np.ndarray]:
    """Runs with periods from 2^k to 2^(k + 1) - 1, k being the highest level of names."""
    top, width = names[-1], 1 << (len(names) - 1)
    tests = lens[doc] // q - 1
    total = np.cumsum(tests)
    found, lo = [], 0
    while lo < len(doc):
        done = total[lo - 1] if lo else 0
        hi = max(lo + 1, int(np.searchsorted(total, done + TESTS, "right")))
        d, p, t = doc[lo:hi], q[lo:hi], tests[lo:hi]
        lo = hi
        pair = np.repeat(np.arange(len(d)), t)
        step = p[pair]
        g = bounds[d][pair] + (np.arange(len(pair)) - np.repeat(np.cumsum(t) - t, t)) * step
        at = np.flatnonzero(top[g] == top[g + step])
        at = at[top[g[at] + step[at] - width] == top[g[at] + 2 * step[at] - width]]
        if not len(at):
            continue
        first = np.flatnonzero(np.r_[True, (at[1:] != at[:-1] + 1) | (pair[at[1:]] != pair[at[:-1]])])
        blocks = np.diff(np.r_[first, len(at)]) + 1
        first, blocks = first[blocks > 2], blocks[blocks > 2]
        if not len(first):
            continue
        one = at[first]
        start, period, text = g[one], step[one], d[pair[one]]
        stop = start + blocks * period
        left = equal_behind(names, start, start + period, bounds[text])
        right = equal_ahead(names, stop - period, stop, bounds[text + 1])
        start, length = start - left - bounds[text], blocks * period + left + right
        keep = length >= np.maximum(LEAST, TIMES * period)
        found.append(np.stack([text, start, length, period], 1)[keep])
    return found


def digests(doc_ids: list, buf: np.ndarray, offs: np.ndarray) -> dict[str, list]:
    """The columns of SCHEMA for some texts."""
    words, bounds = words_of(buf, offs)
    n = np.diff(bounds)
    source = np.concatenate([b + repeated_on_purpose(i, m) for i, b, m in zip(doc_ids, bounds, n)] or [np.zeros(0, np.int64)])
    ids = words.dictionary_encode().indices.to_numpy(zero_copy_only=False).astype(np.int64)[source]
    runs = runs_of(ids, bounds)
    edge = np.zeros(len(ids) + 1, np.int64)
    if len(runs):
        np.add.at(edge, bounds[runs[:, 0]] + runs[:, 1] + runs[:, 3], 1)
        np.add.at(edge, bounds[runs[:, 0]] + runs[:, 1] + runs[:, 2], -1)
    keep = np.cumsum(edge)[:-1] == 0
    left = np.r_[0, np.cumsum(keep)]
    joined = pc.binary_join(pa.ListArray.from_arrays(pa.array(left[bounds], pa.int32()), words.take(pa.array(source[keep]))), b" ")
    out = {c: [] for c in ("n_runs", "start", "length", "period", "exponent_milli", "runs_sha256", "collapsed_sha256", "n_words", "n_dropped")}
    own = np.searchsorted(runs[:, 0], np.arange(len(n) + 1))
    for i in range(len(n)):
        mine = runs[own[i] : own[i + 1], 1:].tolist()
        best = _best(mine)
        for c, v in zip(("start", "length", "period"), best or [None] * 3):
            out[c].append(v)
        out["n_runs"].append(len(mine))
        out["exponent_milli"].append(1000 * best[1] // best[2] if best else None)
        out["runs_sha256"].append(hashlib.sha256("".join(f"{s},{m},{p}\n" for s, m, p in mine).encode()).hexdigest() if mine else _NOTHING)
        out["collapsed_sha256"].append(hashlib.sha256(joined[i].as_buffer()).hexdigest() if n[i] else _NOTHING)
        out["n_words"].append(int(n[i]))
        out["n_dropped"].append(int(n[i] - (left[bounds[i + 1]] - left[bounds[i]])))
    return out


def _best(runs: list) -> list | None:
    """The run with the greatest length / period; of equal ones the first to start, then that with the smallest period."""
    if not runs:
        return None
    high = max(m / p for _, m, p in runs) * (1 - 1e-12)  # quotients that floats can't tell apart are compared exactly
    return max((r for r in runs if r[1] / r[2] >= high), key=lambda r: (Fraction(r[1], r[2]), -r[0], -r[2]))


def periodic_runs(docs: DataFrame) -> DataFrame:
    """One row per document: its runs' number and digest, the strongest one, and the digest of its words without repeats."""
    small_batches(docs.sparkSession)
    kinds = {"runs_sha256": pa.string(), "collapsed_sha256": pa.string()}

    def run(batches):
        for batch in batches:
            buf, offs = K.utf8(K.text_column(batch))
            for lo, hi in K.slices(offs):
                ids = batch.column(0).slice(lo, hi - lo)
                got = digests(ids.to_pylist(), buf[offs[lo] : offs[hi]], offs[lo : hi + 1] - offs[lo])
                yield pa.RecordBatch.from_arrays([ids, *(pa.array(v, kinds.get(c, pa.int64())) for c, v in got.items())], names=["doc_id", *got])

    return docs.select(F.col("doc_id").cast("long").alias("doc_id"), F.col("text").cast("string").alias("text")).mapInArrow(run, SCHEMA)


def query(spark: SparkSession, sf_dir: str) -> DataFrame:
    return periodic_runs(table(spark, sf_dir, "documents"))
