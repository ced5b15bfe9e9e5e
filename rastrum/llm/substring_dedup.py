"""Operator 4, substring dedup by compact windows.

A text is the sequence of its K-word shingles. Under one hash function, the
nodes of the Cartesian tree over the shingles' hashes are compact windows
(l, c, r): every subsequence from l..c to c..r has its min-hash at c. Those at
least LEAST shingles long are found by sliding minima; there are about
2 n / LEAST. Windows of two documents with one minimum under one function hold
subsequences that share it; with FUNCTIONS functions, passages of similarity
0.8 meet with probability 1 - 0.2^FUNCTIONS, equal passages always.

Windows with one key meet in four steps, linear in the windows but for the last
part of step 3, which is quadratic in the windows that stay open and share much,
in time, not in rows: they meet in tiles of a bounded size:
1. Every window meets the key's earliest one, so a passage that a third of all
   documents share gives linearly many candidates.
2. Windows whose place no passage of step 1 holds (open ones) meet all earlier
   ones of their key, if the key has SMALL windows at most.
3. In keys with more windows, a passage at an open window's place has LEAST
   places in a row, the window's place among them, of which the other document
   has FEWEST at least; so of any LEAST - FEWEST + HITS of them it has HITS. Open
   windows first meet the earliest window that holds one of these shingles; those
   that are open still look for the shingles that the fewest windows of the key
   hold, and meet all earlier ones that hold HITS, those with most hits first,
   until a passage holds the window's place. A window with too few shingles
   that any other of its key holds meets none, so a line that millions share makes
   no pairs by itself. Of a shingle that repeats, places in a passage found don't
   count.
4. Of every window, all runs of LEAST shingles at its place that are no part of
   an equal run found before are named by their hash, and each meets the
   earliest document with that run. A document that has an equal run at all has
   it in the earliest one that does, where no earlier equal run hides it; so
   equal passages of LEAST shingles are found whatever the size of their keys.
Passages that are similar without an equal run of LEAST shingles may be missed
where no function gives them one key.

Candidates on one diagonal of two documents become one region; the passages in
it are the runs of the best score (a shared shingle gains, another loses),
which must be LEAST shingles long with similarity SIMILARITY or more.

Result: one row for each passage of a document that an earlier one has:
(doc_id, first_word, n_words, rep_doc_id, rep_first_word, rep_n_words,
similarity). Earlier is the smaller id; of several texts under one id, which
count as a document each, the smaller hash of the text; null ids come last.
Rows whose whole text equals an earlier one's are one row, matched with it,
however short the parts; rows that repeat id and text are one document.
Passages repeated inside one document only are not looked for. Null, empty and
short texts have no window. Other columns are ignored.
"""

from __future__ import annotations

import hashlib

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from . import kernels as K
from . import meeting
from .shared import MOST_BITS, bloom_of, cut, drop, in_bloom, small_batches, table, trimmed

U = np.uint64
WORDS = 5
#: Shingles of the shortest passage: 50 words.
LEAST = 46
FUNCTIONS = 3
SIMILARITY = 0.8
#: Windows of a key that all meet in step 2; those of larger keys meet by what they share.
SMALL = 24
#: Shingles of a run that a partner must have among the rarest ones, of which so many more are taken.
HITS = 12


def sliding_min(v: np.ndarray, w: int) -> np.ndarray:
    """Minimum of every w values in a row: running minima from both ends of blocks of w."""
    n = len(v) - w + 1
    size = -(-len(v) // w) * w
    x = np.full(size, np.iinfo(np.uint64).max, U)
    x[: len(v)] = v
    x = x.reshape(-1, w)
    left = np.minimum.accumulate(x, 1).ravel()
    right = np.minimum.accumulate(x[:, ::-1], 1)[:, ::-1].ravel()
    return np.minimum(right[:n], left[w - 1 : w - 1 + n])


def _smaller(value: np.ndarray, text: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """For each value the nearest one before it in its text that is not greater (-1: none), and the nearest after it that is smaller (their number: none). All at once: who stands before a greater one takes over where that one points, so a few rounds do."""
    n = len(value)
    new = np.ones(n, bool)
    new[1:] = text[1:] != text[:-1]
    before, after = np.arange(-1, n - 1), np.arange(1, n + 1)
    before[new] = -1
    after[:-1][new[1:]] = n
    for at, none, over in ((before, -1, np.greater), (after, n, np.greater_equal)):
        open_ = np.arange(n)
        while True:
            open_ = open_[at[open_] != none]
            open_ = open_[over(value[at[open_]], value[open_])]
            if not len(open_):
                break
            at[open_] = at[at[open_]]
    return before, after


def compact_windows(v: np.ndarray, row: np.ndarray, bounds: np.ndarray, least: int):
    """(c, l, r) of the windows at least `least` long; v: hashes, row: their text, bounds: of the texts. Of equal hashes the first counts as smaller."""
    z = np.zeros(0, np.int64)
    if len(v) < least:
        return z, z, z
    low = sliding_min(v, least)
    whole = row[: len(low)] == row[least - 1 :]
    # A value is the least of some window: compare it with the greatest of the minima of the windows around it.
    top = np.zeros(len(v) + least - 1, U)
    top[least - 1 : least - 1 + len(low)] = np.where(whole, low, U(0))
    reach = ~sliding_min(~top, least)[: len(v)]
    c = np.flatnonzero((v <= reach) & (reach > 0))
    if not len(c):
        return z, z, z
    value, text = v[c], row[c]
    before, after = _smaller(value, text)
    l = np.where(before >= 0, c[before] + 1, bounds[text])
    r = np.where(after < len(c), c[np.minimum(after, len(c) - 1)] - 1, bounds[text + 1] - 1)
    ok = r - l + 1 >= least
    return c[ok], l[ok], r[ok]


def shingled(column: pa.Array, k: int):
    """Slices of a column: (first row, last row, shingle hashes, their row, bounds of rows)."""
    buf, offs = K.utf8(column)
    for lo, hi in K.slices(offs, 1 << 20):
        h, row = K.words(buf[offs[lo] : offs[hi]], offs[lo : hi + 1] - offs[lo], lower=True)
        sh, srow, _ = K.shingles(h, row, k)
        yield lo, hi, sh, srow, np.searchsorted(srow, np.arange(hi - lo + 1))


def _function(sh: np.ndarray, k: int) -> np.ndarray:
    return K.mix(sh ^ K.mix(np.full(1, 1000 + k, U)))


#: Mark beside a window's place: it stands for several places of a shingle.
MANY = 1 << 30
_NAMES = ["part", "chunk", "data", "h", "ord", "words", "id"]
_ROWS = "part int, chunk long, data binary, h long, ord long, words long, id long"


def _closed(chunk: meeting.Chunk) -> pa.RecordBatch:
    rows = chunk.close()
    return pa.RecordBatch.from_arrays([pa.array([r[0] for r in rows], pa.int32()), pa.array([r[1] for r in rows], pa.int64()), pa.array([r[2] for r in rows], pa.binary()), *(pa.nulls(len(rows), pa.int64()) for _ in range(4))], names=_NAMES)


def _noted(h, ord_, words, at) -> pa.RecordBatch:
    """Rows beside the keys: a document's number in its chunk, its words."""
    m = len(h)
    return pa.RecordBatch.from_arrays([pa.array(np.full(m, meeting.OTHER, np.int32)), pa.nulls(m, pa.int64()), pa.nulls(m, pa.binary()), pa.array(h), pa.array(ord_), pa.array(words), pa.array(at)], names=_NAMES)


def _windows(rows: DataFrame, k: int, least: int, functions: int, parts: int) -> DataFrame:
    """Packed keys of the windows with their (l, c, r), and a row for each document. A document that a task has met before is passed over."""

    def run(batches):
        met, chunk = set(), meeting.Chunk(parts, 3)
        for batch in batches:
            ord_, text, h = batch.column(0).to_numpy(), K.text_column(batch), batch.column(2).to_numpy()
            buf, offs = K.utf8(text)
            n = np.zeros(len(h), np.int64)
            at = np.zeros(len(h), np.int64)
            new = np.zeros(len(h), bool)
            for i, name in enumerate(zip(ord_.tolist(), h.tolist())):
                if name not in met:
                    if len(met) >= 1 << 20:
                        met.clear()
                    met.add(name)
                    new[i] = True
                    number = chunk.owner()
                    at[i] = chunk.id | number
            for lo, hi in K.slices(offs, 1 << 20):
                hashes, row = K.words(buf[offs[lo] : offs[hi]], offs[lo : hi + 1] - offs[lo], lower=True)
                n[lo:hi] = np.bincount(row, minlength=hi - lo)
                sh, row, _ = K.shingles(hashes, row, k)
                bounds = np.searchsorted(row, np.arange(hi - lo + 1))
                for f in range(functions):
                    v = _function(sh, f)
                    c, l, r = compact_windows(v, row, bounds, least)
                    own = new[lo + row[c]]
                    c, l, r = c[own], l[own], r[own]
                    if not len(c):
                        continue
                    # A shingle that repeats in a text gives it one window for all: from the first one's left to the last one's right.
                    name = K.mix(v[c] + row[c].astype(U) * U(0x9E3779B97F4A7C15))
                    order = np.argsort(name, kind="stable")
                    first = np.flatnonzero(np.r_[True, name[order][1:] != name[order][:-1]])
                    l, r, many = np.minimum.reduceat(l[order], first), np.maximum.reduceat(r[order], first), np.diff(np.r_[first, len(order)]) > 1
                    c = np.minimum.reduceat(c[order], first)
                    base, owner = bounds[row[c]], at[lo + row[c]] & ((1 << meeting.OWNER_BITS) - 1)
                    chunk.add(K.mix(v[c] + U(f)), owner, l - base, (c - base) | many * MANY, r - base)
            yield _noted(h[new], ord_[new], n[new], at[new])
            if chunk.full():
                yield _closed(chunk)
        yield _closed(chunk)

    return rows.mapInArrow(trimmed(run), _ROWS)


def _sequences(rows: DataFrame, k: int, bitmap) -> DataFrame:
    """32-bit names of the shingles of texts that may be wanted."""

    def run(batches):
        met = set()
        for batch in batches:
            batch = batch.filter(pa.array(in_bloom(bitmap.value, batch.column(2).to_numpy().view(U))))
            h = batch.column(2).to_numpy()
            for lo, hi, sh, _, bounds in shingled(K.text_column(batch), k):
                take = np.flatnonzero(np.diff(bounds))
                take = [i for i in take.tolist() if int(h[lo + i]) not in met and not met.add(int(h[lo + i]))]
                if len(met) >= 1 << 20:
                    met.clear()
                short = (sh >> U(32)).astype(np.uint32)
                yield pa.RecordBatch.from_arrays([pa.array(h[lo:hi][take]), pa.array([short[bounds[i] : bounds[i + 1]].tobytes() for i in take], pa.binary())], names=["doc", "seq"])

    return rows.mapInArrow(trimmed(run), "doc long, seq binary").dropDuplicates(["doc"])


#: A shared shingle gains one, another loses so much; stricter scores find the better parts of a run, down to equal runs.
LOSSES = (1.5, 4.0, 1e6)
#: Diagonals of two texts are counted in slots; two slots beside each other are a band.
SLOT = 32
#: A longer run that isn't similar enough is looked at in overlapping pieces of half that length, a shorter one in ever smaller ones; one with repeated shingles in pieces of two passages' length.
LONG = 512


def _totals(v: np.ndarray, kind=np.int64) -> np.ndarray:
    """Running sums, the first 0."""
    out = np.zeros(len(v) + 1, kind)
    np.cumsum(v, out=out[1:])
    return out


def _best_run(hit: np.ndarray, loss: float) -> tuple[int, int]:
    """The run with the best score: (first, end)."""
    total = _totals(hit * (1.0 + loss) - loss, np.float64)
    end = int((total - np.minimum.accumulate(total)).argmax())
    return int(total[: end + 1].argmin()), end


def _fewest(least: int, similarity: float) -> int:
    """Shared places that `least` places in a row have somewhere in a passage: if a share 1 - similarity is not shared, the fullest `least` places lack 5/3 of that share at most."""
    return int((1 - (1 - similarity) * 5 / 3) * least)


def promising(xs: list[np.ndarray], ys: list[np.ndarray], low: np.ndarray, high: np.ndarray, least: int, similarity: float) -> np.ndarray:
    """Of pairs of regions, those where a passage may hold one of the places low..high of the first: some `least` places in a row that reach into them have enough shared ones. All pairs at once."""
    xl, yl = np.array([len(x) for x in xs], np.int64), np.array([len(y) for y in ys], np.int64)
    if not len(xl):
        return np.zeros(0, bool)
    name = lambda v, n: (np.repeat(np.arange(len(n), dtype=U), n) << U(32)) | np.concatenate(v).astype(U)
    known, mine = np.sort(name(ys, yl)), name(xs, xl)
    if not len(known):
        return np.zeros(len(xl), bool)
    total = _totals(known[np.minimum(np.searchsorted(known, mine), len(known) - 1)] == mine)
    at = _totals(xl)
    # Windows of a pair: they begin at low - least + 1 at the earliest and at high at the latest, inside its own places.
    begin, end = np.maximum(low - least + 1, 0), np.minimum(high, xl - least) + 1
    n = np.maximum(end - begin, 0)
    some = np.flatnonzero(n)
    ok = np.zeros(len(xl), bool)
    if len(some):
        m = n[some]
        first = np.repeat(at[some] + begin[some] - _totals(m)[:-1], m) + np.arange(int(m.sum()))
        ok[some] = np.logical_or.reduceat(total[first + least] - total[first] >= _fewest(least, similarity), _totals(m)[:-1])
    return ok & (yl >= similarity * least)


def in_bands(xs: list[np.ndarray], ys: list[np.ndarray], d: np.ndarray, e: np.ndarray, least: int, similarity: float) -> np.ndarray:
    """Of pairs of regions, those where band_runs may find a passage along the diagonals d to e: some `least` places in a row have enough shared ones there. All pairs at once."""
    xl, yl = np.array([len(x) for x in xs], np.int64), np.array([len(y) for y in ys], np.int64)
    ok = (xl >= least) & (yl >= similarity * least)
    # A number is of pair, name and place: 11, 32 and 21 bits. Longer texts are let through.
    pairs = np.flatnonzero(ok & (yl < 1 << 21))
    for lo in range(0, len(pairs), 1 << 11):
        p = pairs[lo : lo + (1 << 11)]
        number = lambda v, place: np.repeat(np.arange(len(p), dtype=U) << U(53), [len(v[i]) for i in p]) | np.concatenate([v[i] for i in p]).astype(U) << U(21) | place.astype(U)
        at, there = _totals(xl[p]), _totals(yl[p])
        low = np.arange(at[-1]) + np.repeat(d[p] - at[:-1], xl[p])
        high = low + np.repeat(e[p] - d[p], xl[p])
        known = np.sort(number(ys, np.arange(there[-1]) - np.repeat(there[:-1], yl[p])))
        mine = number(xs, np.clip(low, 0, (1 << 21) - 1))
        found = known[np.minimum(np.searchsorted(known, mine), len(known) - 1)]
        hit = (found >> U(21) == mine >> U(21)) & ((found & U((1 << 21) - 1)).astype(np.int64) <= high)
        total, n = _totals(hit), xl[p] - least + 1
        first = np.repeat(at[:-1] - _totals(n)[:-1], n) + np.arange(int(n.sum()))
        ok[p] = np.logical_or.reduceat(total[first + least] - total[first] >= _fewest(least, similarity), _totals(n)[:-1])
    return ok


def _dense(hit: np.ndarray, least: int, similarity: float) -> bool:
    """Whether some `least` places in a row have as many shared ones as a passage must have somewhere."""
    if len(hit) < least:
        return False
    total = _totals(hit)
    return bool((total[least:] - total[:-least] >= _fewest(least, similarity)).any())


def _alike(a: np.ndarray, b: np.ndarray) -> float:
    a, b = np.unique(a), np.unique(b)
    common = len(np.intersect1d(a, b, assume_unique=True))
    return common / (len(a) + len(b) - common)


def _alike_single(a: np.ndarray, b: np.ndarray) -> float:
    """_alike of sorted distinct names and others."""
    b = np.unique(b)
    common = int(np.count_nonzero(a[np.minimum(np.searchsorted(a, b), len(a) - 1)] == b))
    return common / (len(a) + len(b) - common)


def _closest(part: np.ndarray, y: np.ndarray) -> tuple[int, int, float]:
    """The stretch of y most similar to part, (first, end, similarity): the best of all stretches of its length, then with the best end for its first place and the best first place for that end."""
    if not len(y):
        return 0, 0, 0.0
    n, at = min(len(part), len(y)), np.arange(len(y))
    known = np.unique(part)
    inside = known[np.minimum(np.searchsorted(known, y), len(known) - 1)] == y
    order = np.argsort(y, kind="stable")
    same = np.flatnonzero(y[order[1:]] == y[order[:-1]])
    before, after = np.full(len(y), -1), np.full(len(y), len(y))
    before[order[1:][same]], after[order[:-1][same]] = order[:-1][same], order[1:][same]
    # A place counts in the stretches that hold it and none of its shingle before it.
    low = np.maximum(np.maximum(before + 1, at - n + 1), 0)
    count = lambda w: np.cumsum(np.bincount(low, w, len(y) + 1) - np.bincount(at + 1, w, len(y) + 1))[: len(y) - n + 1]
    every, common = count(np.ones(len(y))), count(inside.astype(float))
    start = int((common / (len(known) + every - common)).argmax())
    new = before[start:] < start
    every, common = np.cumsum(new), np.cumsum(new & inside[start:])
    end = start + int((common / (len(known) + every - common)).argmax()) + 1
    new = (after[:end] >= end)[::-1]
    every, common = np.cumsum(new), np.cumsum(new & inside[:end][::-1])
    score = common / (len(known) + every - common)
    return end - 1 - int(score.argmax()), end, float(score.max())


def _places(y: np.ndarray) -> np.ndarray:
    """Names with their places, sorted."""
    return np.sort((y.astype(U) << U(32)) | np.arange(len(y), dtype=U))


def _in_band(x: np.ndarray, y: np.ndarray, lo: int, hi: int, keyed: np.ndarray, d: int, e: int, least: int, similarity: float, covered: np.ndarray, single: bool, seen: set) -> list[tuple]:
    """Passages of x[lo:hi] whose shared shingles are in y d to e places on (counted from lo). covered: places of x with a passage; seen: what was looked at, as bands beside each other often share the same places."""
    part, out = x[lo:hi].astype(U), []
    low = np.arange(d, d + len(part))
    found = keyed[np.minimum(np.searchsorted(keyed, (part << U(32)) | np.maximum(low, 0).astype(U)), len(keyed) - 1)]
    place = (found & U(0xFFFFFFFF)).astype(np.int64)
    hit = (found >> U(32) == part) & (place <= low + (e - d)) & (low + (e - d) >= 0)
    if (name := hit.tobytes()) in seen:
        return out
    seen.add(name)
    todo, tried = [(0, len(part))], set()
    while todo:
        p, q = todo.pop()
        if (p, q) in tried or tried.add((p, q)) or q - p < least or not _dense(hit[p:q], least, similarity) or single and not _shares(hit[p:q], least, similarity) or covered[lo + p : lo + q][hit[p:q]].all():
            continue
        for loss in LOSSES:
            f, g = _best_run(hit[p:q], loss)
            f, g = p + f, p + g
            if loss == LOSSES[0]:
                wide = f, g
            # No stretch has more of a run's shingles than the band has.
            own = part[f:g]
            if g - f < least or (np.count_nonzero(hit[f:g]) / (g - f) if single else len(np.unique(own[hit[f:g]])) / len(np.unique(own))) < similarity:
                continue
            # The stretch of y between the first and the last shared place; if it isn't similar enough, the most similar one.
            base, there = 0, place[f:g][hit[f:g]]
            start, stop = int(there.min()), int(there.max()) + 1
            s = _alike(own, y[start:stop]) if not single else _alike_single(np.sort(own), y[start:stop])
            if s < similarity:
                base = max(0, f + d)
                start, stop, s = _closest(x[lo + f : lo + g], y[base : max(0, g + e + 1)])
            if s >= similarity:
                out.append((lo + f, g - f, base + start, stop - start, s))
                covered[lo + f : lo + g] = True
                todo += [(p, f), (g, q)]
                break
        else:
            f, g = wide
            todo += [(p, f), (g, q)]
            piece = LONG // 2 if single else 2 * least
            if g - f > (LONG if single else piece):
                todo += [(i, min(i + piece, g)) for i in range(f, g - least + 1, piece // 2)]
            elif g - f > least and single:
                third = max(1, (g - f) // 3)
                todo += [(f, g - third), (f + third, g)]
    return out


def _shares(hit: np.ndarray, least: int, similarity: float) -> bool:
    """Whether some run of `least` places or more shares as many as a passage of distinct shingles must."""
    total = _totals(hit - similarity, np.float64)
    return bool((total[least:] - np.minimum.accumulate(total[:-least])).max() > -1e-6)


def band_runs(x: np.ndarray, y: np.ndarray, d: int, e: int, least: int, similarity: float) -> list[tuple]:
    """Passages of x in y, as of all_runs, along the diagonals d to e."""
    if len(x) < least or len(y) < similarity * least:
        return []
    return _in_band(x, y, 0, len(x), _places(y), d, e, least, similarity, np.zeros(len(x), bool), len(set(x.tolist())) == len(x), set())


def _banded(x: np.ndarray, y: np.ndarray, lo: int, hi: int, least: int, similarity: float, covered: np.ndarray) -> list[tuple]:
    """Passages of x[lo:hi], each looked for in one band of diagonals, so that a shingle that y has elsewhere too does not count there. covered: places of x with a passage."""
    part, out = x[lo:hi].astype(U), []
    keyed = _places(y)
    names, where = keyed >> U(32), (keyed & U(0xFFFFFFFF)).astype(np.int64)
    a, b = np.searchsorted(names, part), np.searchsorted(names, part, "right")
    counts, total = np.zeros((len(part) + len(y)) // SLOT + 2, np.int64), np.cumsum(b - a)
    i = 0
    while i < len(part):
        j = max(i + 1, int(np.searchsorted(total, (total[i - 1] if i else 0) + (1 << 20), "right")))
        many = (b - a)[i:j]
        own = np.repeat(np.arange(i, j), many)
        place = where[np.repeat(a[i:j] - _totals(many)[:-1], many) + np.arange(len(own))]
        counts += np.bincount((place - own + len(part)) // SLOT, minlength=len(counts))
        i = j
    band, seen = counts[:-1] + counts[1:], set()
    single = len(np.unique(part)) == len(part)
    for k in np.argsort(-band, kind="stable"):
        if band[k] < _fewest(least, similarity):
            break
        d = int(k) * SLOT - len(part)
        out += _in_band(x, y, lo, hi, keyed, d, d + 2 * SLOT - 1, least, similarity, covered, single, seen)
    return out


def _equal(x: np.ndarray, y: np.ndarray, least: int, covered: np.ndarray) -> list[tuple]:
    """Equal passages that reach a place not covered yet."""
    base = U(0x9E3779B97F4A7C15)
    powers = np.full(max(len(x), len(y)) + 1, base)
    powers[0] = 1
    powers = np.cumprod(powers, dtype=U)

    def names(v):
        total = _totals(K.mix(v.astype(U) + U(1)) * powers[: len(v)], U)
        return (total[least:] - total[:-least]) * powers[len(powers) - 1 - np.arange(len(v) - least + 1)]

    if min(len(x), len(y)) < least:
        return []
    hx, hy = names(x), names(y)
    order = np.argsort(hy, kind="stable")
    at = np.minimum(np.searchsorted(hy[order], hx), len(hy) - 1)
    same = hy[order][at] == hx
    open_ = _totals(~covered)
    out, end = [], 0
    for i in np.flatnonzero(same & (open_[least:] > open_[:-least])):
        if i + least <= end:
            continue
        p, n = int(order[at[i]]), 0
        m = min(len(x) - i, len(y) - p)
        differ = np.flatnonzero(x[i : i + m] != y[p : p + m])
        n = int(differ[0]) if len(differ) else m
        if n >= least:
            out.append((int(i), n, p, n, 1.0))
            covered[i : i + n] = True
            end = i + n
    return out


def all_runs(x: np.ndarray, y: np.ndarray, least: int, similarity: float) -> list[tuple]:
    """Passages of x in y as (first, length, first in y, length in y, similarity): that with the best score first, then what is left on either side. Where the best one isn't similar enough to what follows the first place of its first shingle in y, stricter scores find its better parts, and every band of diagonals and every equal run is looked at, so that no other place and no other passage of the region is passed over."""
    if len(x) < least or len(y) < similarity * least:
        return []
    known = np.sort(y)
    at = np.minimum(np.searchsorted(known, x), len(known) - 1)
    hit = known[at] == x
    out, todo, open_ = [], [(0, len(x), False)], []
    while todo:
        lo, hi, inside = todo.pop()
        if hi - lo < least or np.count_nonzero(hit[lo:hi]) < similarity * least:
            continue
        for loss in LOSSES:
            first, end = _best_run(hit[lo:hi], loss)
            if end - first >= least:
                part = x[lo + first : lo + end]
                # The stretch of y that answers: from the first to the last shared shingle within reach of the passage's length.
                back = np.flatnonzero(np.isin(y, part))
                lead = np.flatnonzero(y == part[0])
                start = int(lead[0]) if len(lead) else int(back[0])
                stop = int(back[back < start + len(part) + least].max()) + 1
                s = _alike(part, y[start:stop])
                if s >= similarity:
                    out.append((lo + first, end - first, start, stop - start, s))
                    todo += [(lo, lo + first, inside), (lo + end, hi, inside)]
                    break
            if not inside:
                open_.append((lo, hi))
                inside = True
    covered = np.zeros(len(x), bool)
    for f in out:
        covered[f[0] : f[0] + f[1]] = True
    for lo, hi in open_:
        if _dense(hit[lo:hi], least, similarity):
            out += _banded(x, y, lo, hi, least, similarity, covered)
    if open_ and not covered[hit].all():
        out += _equal(x, y, least, covered)
    return out


_FOUND = "doc long, rep long, first int, n int, rep_first int, rep_n int, similarity double, kind int"
_KINDS = [pa.int64(), pa.int64(), *[pa.int32()] * 4, pa.float64(), pa.int32()]
#: Kinds of what verification finds: a similar passage, an equal one, an equal run inside a similar one.
SIMILAR, EQUAL, INSIDE = 0, 1, 2


def may_hold(same: np.ndarray, n: int, least: int, similarity: float) -> bool:
    """Whether any stretches of two texts may be similar enough; same: for each place of the n of x, then of y, the first place with its shingle. Where all shared shingles come once and in one order, two stretches share some in a row, and between the first and the last of these both have what only one text has: too much of it, and no choice of stretches helps. Other texts may hold a passage."""
    mine, other = same[:n], same[n:]
    shared = other < n
    place = other[shared]
    if (mine != np.arange(n)).any() or (place[1:] <= place[:-1]).any():
        return True
    # Of a shingle that only y has, and repeats, the first place counts.
    alone = np.cumsum(~shared & (other == np.arange(n, len(same))))[shared]
    gain = np.arange(len(place)) - similarity * (place + alone)
    few = int(np.ceil(similarity * least - 1e-6)) - 1
    if len(gain) <= few:
        return False
    return bool((gain[few:] - np.minimum.accumulate(gain[: len(gain) - few])).max() > similarity - 1 - 1e-6)


#: What _found_in has found, by the pattern of its texts; so many at most.
_PATTERNS, MOST_PATTERNS = {}, 1 << 14


def _found_in(x: np.ndarray, y: np.ndarray, d0: int | None, d1: int | None, least: int, similarity: float) -> list[tuple]:
    """(first, n, first in y, n in y, similarity, kind) of the passages of x in y. A key's passage lies along its diagonal; that of a shingle that repeats (no diagonal) may lie anywhere. All depends on which places have equal shingles, not on the shingles, so a pattern that many pairs have, as those of copies, is looked at once."""
    _, first, at = np.unique(np.concatenate([x, y]), return_index=True, return_inverse=True)
    same = first[at]
    if not may_hold(same, len(x), least, similarity):
        return []
    pattern = hashlib.blake2b(same.tobytes(), digest_size=16).digest(), len(x), d0, d1, least, similarity
    if pattern not in _PATTERNS:
        if len(_PATTERNS) >= MOST_PATTERNS:
            _PATTERNS.clear()
        _PATTERNS[pattern] = list(_passages_of(x, y, d0, d1, least, similarity))
    return _PATTERNS[pattern]


def _passages_of(x: np.ndarray, y: np.ndarray, d0: int | None, d1: int | None, least: int, similarity: float):
    for first, n, there, m, s in all_runs(x, y, least, similarity) if d0 is None else band_runs(x, y, d0 - NEAR_DIAGONALS, d1 + NEAR_DIAGONALS, least, similarity):
        whole = n == m and bool((x[first : first + n] == y[there : there + m]).all())
        yield first, n, there, m, s, EQUAL if whole else SIMILAR
        if not whole:
            yield from ((first + e[0], e[1], there + e[2], e[3], 1.0, INSIDE) for e in _equal(x[first : first + n], y[there : there + m], least, np.zeros(n, bool)))


def _worth(xs: list[np.ndarray], ys: list[np.ndarray], low: np.ndarray, high: np.ndarray, d0: list, d1: list, least: int, similarity: float) -> list[int]:
    """The pairs of regions that _found_in need look at: those that are promising, also along their diagonals where they have some."""
    some = np.flatnonzero(promising(xs, ys, low, high, least, similarity))
    banded = np.array([i for i in some.tolist() if d0[i] is not None], np.int64)
    near = lambda d, by: np.array([d[i] + by for i in banded], np.int64)
    lost = banded[~in_bands([xs[i] for i in banded], [ys[i] for i in banded], near(d0, -NEAR_DIAGONALS), near(d1, NEAR_DIAGONALS), least, similarity)]
    return np.setdiff1d(some, lost, assume_unique=True).tolist()


def _found_batch(rows: list[tuple]) -> pa.RecordBatch:
    return pa.RecordBatch.from_arrays([pa.array([r[i] for r in rows], k) for i, k in enumerate(_KINDS)], names=[f.split()[0] for f in _FOUND.split(", ")])


def _of(seqs: DataFrame, docs: DataFrame, most: int) -> DataFrame:
    """The sequences of some documents (column doc; `most` at most): a bitmap keeps the others out of the shuffle that follows; a few may come along."""
    bitmap = seqs.sparkSession.sparkContext.broadcast(bloom_of(docs, "doc", most))

    def run(batches):
        for batch in batches:
            yield batch.filter(pa.array(in_bloom(bitmap.value, batch.column(0).to_numpy().view(U))))

    return seqs.mapInArrow(run, "doc long, seq binary")


def _verified(regions: DataFrame, seqs: DataFrame, least: int, similarity: float) -> DataFrame:
    """Regions (doc, l, r, rep, rl, rr, with the places c0..c1 that the documents' keys share, and their diagonals) with the passages found in them."""
    cutout = lambda s, l, r: F.expr(f"substring({s}, 4 * {l} + 1, 4 * ({r} - {l} + 1))")
    # Both joins have the same right side, so its shuffle is made once.
    sides = regions.join(seqs, "doc").select(F.col("doc").alias("later"), "l", F.col("rep").alias("doc"), "rl", "rr", (F.col("c0") - F.col("l")).alias("c0"), (F.col("c1") - F.col("l")).alias("c1"), *(F.when(~F.col("free"), F.col(d) + F.col("l") - F.col("rl")).alias(d) for d in ("d0", "d1")), cutout("seq", "l", "r").alias("x"))
    sides = sides.join(seqs, "doc").select(F.col("later").alias("doc"), "l", F.col("doc").alias("rep"), "rl", "c0", "c1", "d0", "d1", "x", cutout("seq", "rl", "rr").alias("y"))

    def run(batches):
        for batch in batches:
            out = []
            doc, l, rep, rl = (batch.column(i).to_pylist() for i in range(4))
            d0, d1 = batch.column(6).to_pylist(), batch.column(7).to_pylist()
            xs, ys = ([np.frombuffer(v.as_buffer(), np.uint32) for v in batch.column(c)] for c in (8, 9))
            for i in _worth(xs, ys, *(batch.column(c).to_numpy().astype(np.int64) for c in (4, 5)), d0, d1, least, similarity):
                out += [(doc[i], rep[i], l[i] + a, n, rl[i] + b, m, s, kind) for a, n, b, m, s, kind in _found_in(xs[i], ys[i], d0[i], d1[i], least, similarity)]
            yield _found_batch(out)

    return sides.mapInArrow(trimmed(run), _FOUND)


#: Diagonals of two documents that make one region.
NEAR_DIAGONALS = 32


def _regions(pairs: DataFrame, similarity: float) -> DataFrame:
    """Candidate pairs of windows, one region for each two documents and band of diagonals."""
    slot = F.floor((F.col("c") - F.col("rc")) / F.lit(NEAR_DIAGONALS))
    # A passage holds the shared shingle on both sides; on either side of it, it is longer than the other by the shingles that only it has: (1 - s) / s of the other's length at most.
    more = (1 - similarity) / similarity
    reach = lambda edge, o_edge, o_c, o_other: F.abs(F.col(o_c) - F.col(o_edge)) + F.ceil((F.abs(F.col(o_edge) - F.col(o_other)) + 1) * F.lit(more)).cast("int")
    free = F.col("many") | F.col("rmany")
    low = lambda l, c, ol, oc, other: F.when(free, F.col(l)).otherwise(F.greatest(F.col(l), F.col(c) - reach(l, ol, oc, other)))
    high = lambda r, c, o_r, oc, other: F.when(free, F.col(r)).otherwise(F.least(F.col(r), F.col(c) + reach(r, o_r, oc, other)))
    first, last = (F.when(F.col("many"), F.col(edge)).otherwise(F.col("c")) for edge in ("l", "r"))
    sides = pairs.select("doc", "rep", slot.alias("slot"), (F.col("rc") - F.col("c")).alias("d"), free.alias("free"), first.alias("c0"), last.alias("c1"), low("l", "c", "rl", "rc", "rr").alias("l"), high("r", "c", "rr", "rc", "rl").alias("r"), low("rl", "rc", "l", "c", "r").alias("rl"), high("rr", "rc", "r", "c", "l").alias("rr"))
    return sides.groupBy("doc", "rep", "slot").agg(F.min("l").alias("l"), F.max("r").alias("r"), F.min("rl").alias("rl"), F.max("rr").alias("rr"), F.min("c0").alias("c0"), F.max("c1").alias("c1"), F.min("d").alias("d0"), F.max("d").alias("d1"), F.bool_or("free").alias("free")).drop("slot")


def _open(met: DataFrame, found: DataFrame) -> DataFrame:
    """Windows whose place no passage found holds; of a shingle that repeats, all its places."""
    spots = found.where(F.col("kind") != INSIDE).groupBy("doc").agg(F.collect_set(F.struct("first", "n")).alias("spots"))
    first, last = (F.when(F.col("many"), F.col(edge)).otherwise(F.col("c")) for edge in ("l", "r"))
    held = F.exists("spots", lambda s: (s["first"] <= first) & (last < s["first"] + s["n"]))
    return met.join(spots, "doc", "left").where(~F.coalesce(held, F.lit(False))).select(met.columns)


def _beside(doc: pa.Array, column: str) -> np.ndarray:
    return doc.values.field(column).to_numpy(zero_copy_only=False)


_HELD = "part int, chunk long, data binary, id long, doc long, ord long, key long, l int, c int, r int, many boolean, open boolean"


def _item(key: int, names: np.ndarray, parts: int) -> np.ndarray:
    """A window's key with each of some shingles: part of the key space and 32 bits, as meeting.shared_keys has them."""
    v = _named(key, names)
    return ((v >> U(32)) * U(parts) >> U(32) << U(32) | v & U(0xFFFFFFFF)).view(np.int64)


def _named(key: int, names: np.ndarray) -> np.ndarray:
    return K.mix(K.mix(names.astype(U)) ^ U(key & (1 << 64) - 1))


def _around(x: np.ndarray, place: int, many: bool, least: int) -> tuple[np.ndarray, np.ndarray]:
    """Places of a window's key in its shingles x, and all places less than `least` from one."""
    places = np.flatnonzero(x == x[place]) if many else np.array([place])
    edge = np.zeros(len(x) + 1, np.int64)
    np.add.at(edge, np.maximum(places - least + 1, 0), 1)
    np.add.at(edge, np.minimum(places + least, len(x)), -1)
    return places, np.flatnonzero(np.cumsum(edge)[:-1] > 0)


def _sought_bitmap(open_: DataFrame, seqs: DataFrame, least: int, most: int):
    """A bitmap of the shingles, each with its key, around the places of open windows (key, doc, l, c, r, many)."""

    def run(batches):
        for batch in batches:
            out = [np.zeros(0, U)]
            for seq, own in zip(batch.column(0), batch.column(1)):
                x = np.frombuffer(seq.as_buffer(), np.uint32)
                for key, l, c, r, many in zip(*(_beside(own, f).tolist() for f in ("key", *_WINDOW))):
                    x_ = x[l : r + 1]
                    out.append(np.unique(_named(key, x_[_around(x_, c - l, many, least)[1]])))
            yield pa.RecordBatch.from_arrays([pa.array(np.concatenate(out).view(np.int64))], names=["x"])

    own = open_.groupBy("doc").agg(F.collect_list(F.struct("key", *_WINDOW)).alias("places"))
    named = own.join(_of(seqs, open_, most), "doc").select("seq", "places").mapInArrow(trimmed(run), "x long")
    return open_.sparkSession.sparkContext.broadcast(bloom_of(named, "x", 1 << MOST_BITS))


def _held(large: DataFrame, seqs: DataFrame, parts: int, least: int = LEAST, most: int = 1 << 23) -> tuple[DataFrame, DataFrame]:
    """Windows of large keys, by a number (id) of each, open ones with their shingles (seq); and (item, id, often) of the shingles in them that two windows of a key hold at least, often: how many do. Shingles that no open window of the key has around its place are left out (but for some that pass the bitmap): nobody looks for them."""
    bitmap = _sought_bitmap(large.where("open"), seqs, least, most)
    places = large.groupBy("doc").agg(F.min("ord").alias("ord"), F.collect_list(F.struct("key", "l", "c", "r", "many", "open")).alias("places"))
    fields = [f.split() for f in _HELD.split(", ")]
    kinds = [{"int": pa.int32(), "long": pa.int64(), "binary": pa.binary(), "boolean": pa.bool_()}[k] for _, k in fields]

    def table(**columns):
        n = len(columns["part"])
        return pa.RecordBatch.from_arrays([pa.array(columns[f], k) if f in columns else pa.nulls(n, k) for (f, _), k in zip(fields, kinds)], names=[f for f, _ in fields])

    def closed(chunk):
        rows = chunk.close()
        return table(part=[r[0] for r in rows], chunk=[r[1] for r in rows], data=[r[2] for r in rows])

    def run(batches):
        chunk = meeting.Chunk(parts)
        for batch in batches:
            for doc, ord_, seq, own in zip(batch.column(0).to_pylist(), batch.column(1).to_pylist(), batch.column(2), batch.column(3)):
                x = np.frombuffer(seq.as_buffer(), np.uint32)
                key, l, r = (_beside(own, f) for f in ("key", "l", "r"))
                ids = np.zeros(len(key), np.int64)
                for i in range(len(key)):
                    number = chunk.owner()
                    ids[i] = chunk.id | number
                    v = _named(int(key[i]), x[l[i] : r[i] + 1])
                    chunk.add(np.unique(v[in_bloom(bitmap.value, v)]), number)
                    if chunk.full():
                        yield closed(chunk)
                n = len(key)
                yield table(part=np.full(n, meeting.OTHER), id=ids, doc=np.full(n, doc), ord=np.full(n, ord_), key=key, l=l, c=_beside(own, "c"), r=r, many=_beside(own, "many"), open=_beside(own, "open"), data=[x[a : b + 1].tobytes() if o else None for a, b, o in zip(l.tolist(), r.tolist(), _beside(own, "open").tolist())])
        yield closed(chunk)

    packed = cut(places.join(_of(seqs, large, most), "doc").select("doc", "ord", "seq", "places").mapInArrow(trimmed(run), _HELD), "held")
    shared = cut(meeting.shared_keys(packed).withColumnRenamed("key", "item"), "shared-items")
    windows = cut(packed.where(F.col("part") == meeting.OTHER).select("id", "doc", "ord", "key", *_WINDOW, "open", F.col("data").alias("seq")), "held-by")
    drop(packed)
    items = cut(shared.join(shared.groupBy("item").agg(F.count("*").alias("often")), "item"), "items")
    drop(shared)
    return windows, items


def sought(often: np.ndarray, begins: np.ndarray, least: int, fewest: int) -> tuple[np.ndarray, np.ndarray]:
    """Places of which a partner has HITS at least, if it has `fewest` of `least` places in a row that begin at one of some places; and all places of such runs. often: how many windows hold each place's shingle (below 2: no other one). The rarest of each run are taken; runs with too few held by others are passed over."""
    out, every = np.zeros(len(often), bool), np.zeros(len(often), bool)
    shared, take = _totals(often > 1), least - fewest + HITS
    begins = begins[shared[begins + least] - shared[begins] >= fewest]
    # Places in the order of rarity: equal ones in that of place, so that neighbouring runs take the same.
    rank = np.empty(len(often), np.int64)
    rank[np.argsort(often, kind="stable")] = np.arange(len(often))
    for lo in range(0, len(begins), 4096):
        at = begins[lo : lo + 4096, None] + np.arange(least)
        some = np.argpartition(rank[at], take - 1, axis=1)[:, :take]
        out[np.take_along_axis(at, some, 1).ravel()] = True
        every[at.ravel()] = True
    return out & (often > 1), every & (often > 1)


def _seekers(windows: DataFrame, items: DataFrame, ids: DataFrame, found: DataFrame, least: int, similarity: float, parts: int) -> DataFrame:
    """(item, id, rare): the shingles that open windows (ids) with a possible partner share with others; rare: at how many of the places by which they look for all partners. Windows have their shingles beside them, so that the texts' are not shuffled anew."""
    fewest = _fewest(least, similarity)
    own = items.join(ids, "id", "left_semi").groupBy("id").agg(F.collect_list(F.struct("item", "often")).alias("items"))

    def run(batches):
        for batch in batches:
            ids, key, l, c, r, many = (batch.column(i).to_pylist() for i in range(6))
            out_item, out_id, out_rare = [], [], []
            for i in range(len(ids)):
                x = np.frombuffer(batch.column(6)[i].as_buffer(), np.uint32)
                item, count = _beside(batch.column(7)[i], "item"), _beside(batch.column(7)[i], "often")
                order = np.argsort(item)
                item, count = item[order], count[order]
                mine = _item(key[i], x, parts)
                at = np.minimum(np.searchsorted(item, mine), len(item) - 1)
                held = np.where(item[at] == mine, count[at], 1)
                # Runs around the places of the key's shingle that no passage holds.
                places = _around(x, c[i] - l[i], many[i], least)[0]
                if batch.column(8)[i].is_valid:
                    first, n = (_beside(batch.column(8)[i], f) for f in ("first", "n"))
                    kept = _totals(np.bincount(np.clip(first - l[i], 0, len(x)), minlength=len(x) + 1) - np.bincount(np.clip(first + n - l[i], 0, len(x)), minlength=len(x) + 1))[1:] > 0
                    places = places[~kept[places]]
                near = np.zeros(len(x) + least, np.int64)
                np.add.at(near, np.maximum(places - least + 1, 0), 1)
                np.add.at(near, places + 1, -1)
                begins = np.flatnonzero(np.cumsum(near)[: max(0, len(x) - least + 1)] > 0)
                rare, every = sought(held, begins, least, fewest)
                got = np.unique(mine[every])
                known, times = np.unique(mine[rare], return_counts=True)
                count = np.zeros(len(got), np.int64)
                count[np.searchsorted(got, known)] = times
                out_item.append(got)
                out_id.append(np.full(len(got), ids[i]))
                out_rare.append(count)
            yield pa.RecordBatch.from_arrays([pa.array(np.concatenate([np.zeros(0, k), *v])) for v, k in ((out_item, np.int64), (out_id, np.int64), (out_rare, np.int64))], names=["item", "id", "rare"])

    spots = found.where(F.col("kind") != INSIDE).groupBy("doc").agg(F.collect_set(F.struct("first", "n")).alias("spots"))
    spotted = windows.where("open").select("id", "doc").join(spots, "doc").select("id", "spots")
    rows = windows.where("open").select("id", "key", *_WINDOW, "seq").join(own, "id").join(spotted, "id", "left").select("id", "key", *_WINDOW, "seq", "items", "spots")
    return cut(rows.mapInArrow(trimmed(run), "item long, id long, rare long"), "seekers")


#: Windows of a key that meet at a time, or so many shingles (4 bytes each) where windows are long.
TILE, TILE_SHINGLES = 512, 1 << 20
_WINDOW = ("l", "c", "r", "many")


def _crowd(seekers: DataFrame, items: DataFrame, windows: DataFrame, seqs: DataFrame, most: int) -> DataFrame:
    """Windows that may meet by what they share: (key, id, doc, ord, window, items, seq), items: (item, rare) of the shingles looked for that each holds, rare above 0 where it looks for it itself. Windows whose shingles together can't be hit often enough are left out."""
    wanted = seekers.groupBy("item").agg(F.max("rare").alias("most"))
    held = items.select("item", "id").join(wanted, "item").join(seekers, ["item", "id"], "left").select("id", "most", F.struct("item", F.coalesce("rare", F.lit(0)).alias("rare")).alias("own"))
    own = held.groupBy("id").agg(F.sum("most").alias("most"), F.collect_list("own").alias("items")).where(F.col("most") >= HITS).drop("most")
    own = cut(own.join(windows.drop("seq", "open"), "id"), "crowd")
    cutout = F.expr("substring(seq, 4 * l + 1, 4 * (r - l + 1))")
    out = cut(own.join(_of(seqs, own, most), "doc").withColumn("seq", cutout), "crowd")
    drop(own)
    return out


def _met_in_tiles(crowd: DataFrame, least: int, similarity: float) -> DataFrame:
    """Passages of windows that look for partners in earlier windows of their key that hold HITS of what they look for. A key's windows are dealt into tiles, of which every two meet in one task; there hits are counted by matrix products and partners are tried in the order of hits, until a passage holds the window's place. Only passages leave the task."""
    more = (1 - similarity) / similarity
    sizes = crowd.groupBy("key").agg(F.count("*").alias("n"), F.sum(F.length("seq") / 4).alias("shingles"), F.max(F.exists("items", lambda x: x["rare"] > 0)).alias("looks")).where("n > 1 and looks")
    tiles = F.greatest(F.ceil(F.col("n") / F.lit(TILE)), F.ceil(F.col("shingles") / F.lit(TILE_SHINGLES))).cast("int")
    dealt = crowd.join(sizes.select("key", tiles.alias("tiles")), "key").withColumn("tile", F.pmod(F.xxhash64("id", F.lit(12)), F.col("tiles")).cast("int")).withColumn("other", F.explode(F.sequence(F.lit(0), F.col("tiles") - 1)))
    full = dealt.select("key", F.least("tile", "other").alias("i"), F.greatest("tile", "other").alias("j"), "tile", "doc", "ord", *_WINDOW, "items", "seq")

    def run(key, t):
        i, j = key[1].as_py(), key[2].as_py()
        tile, doc, ord_, l, c, r, many = (t.column(f).to_numpy() for f in ("tile", "doc", "ord", *_WINDOW))
        l, c, r, many = l.astype(np.int64), c.astype(np.int64), r.astype(np.int64), many.astype(bool)
        seq = [np.frombuffer(x.as_buffer(), np.uint32) for x in t.column("seq").combine_chunks()]
        lists = t.column("items").combine_chunks()
        rows = np.repeat(np.arange(len(tile)), lists.value_lengths().to_numpy())
        item, rare = (lists.flatten().field(f).to_numpy() for f in ("item", "rare"))
        _, token = np.unique(item, return_inverse=True)
        order = np.argsort(token, kind="stable")
        token, rows, rare = token[order], rows[order], rare[order]
        seeks = np.unique(rows[rare > 0])
        at = np.searchsorted(seeks, rows)
        hits = np.zeros((len(seeks), len(tile)), np.float32)
        for lo in range(0, int(token[-1]) + 1, 4096):
            a, b = np.searchsorted(token, (lo, lo + 4096))
            held, looks = np.zeros((len(tile), 4096), np.float32), np.zeros((len(seeks), 4096), np.float32)
            held[rows[a:b], token[a:b] - lo] = 1
            own = np.flatnonzero(rare[a:b] > 0) + a
            looks[at[own], token[own] - lo] = rare[own]
            hits += looks @ held.T
        out = []
        for k, w in enumerate(seeks.tolist()):
            earlier = (ord_ < ord_[w]) | (ord_ == ord_[w]) & (doc < doc[w])
            some = np.flatnonzero((hits[k] >= HITS) & earlier & (tile == (j if tile[w] == i else i)))
            some = some[np.lexsort((doc[some], ord_[some], -hits[k][some]))]
            x, open_ = seq[w], np.zeros(len(seq[w]), bool)
            open_[_around(x, int(c[w] - l[w]), bool(many[w]), least)[0]] = True
            for lo in range(0, len(some), 64):
                if not open_.any():
                    break
                p = some[lo : lo + 64]
                free = many[w] | many[p]
                # As in _regions(), for each two windows by themselves.
                span, far = np.ceil((r[w] - l[w] + 1) * more).astype(np.int64), np.ceil((r[p] - l[p] + 1) * more).astype(np.int64)
                xl, xr = (np.where(free, edge, v) for edge, v in ((l[w], np.maximum(l[w], c[w] - (c[p] - l[p]) - far)), (r[w], np.minimum(r[w], c[w] + (r[p] - c[p]) + far))))
                yl, yr = (np.where(free, edge, v) for edge, v in ((l[p], np.maximum(l[p], c[p] - (c[w] - l[w]) - span)), (r[p], np.minimum(r[p], c[p] + (r[w] - c[w]) + span))))
                xs = [x[a - l[w] : b - l[w] + 1] for a, b in zip(xl, xr)]
                ys = [seq[q][a - l[q] : b - l[q] + 1] for q, a, b in zip(p, yl, yr)]
                d = [None if f else v for f, v in zip(free.tolist(), (c[p] - c[w] + xl - yl).tolist())]
                for n in _worth(xs, ys, (l[w] if many[w] else c[w]) - xl, (r[w] if many[w] else c[w]) - xl, d, d, least, similarity):
                    if not open_.any():
                        break
                    for a, m, b, q, s, kind in _found_in(xs[n], ys[n], d[n], d[n], least, similarity):
                        out.append((int(doc[w]), int(doc[p[n]]), int(xl[n]) + a, m, int(yl[n]) + b, q, s, kind))
                        open_[xl[n] - l[w] + a : xl[n] - l[w] + a + m] = False
        return pa.Table.from_batches([_found_batch(out)])

    # As many tasks as there are shuffle partitions, though they read little: they take long.
    tasks = int(crowd.sparkSession.conf.get("spark.sql.shuffle.partitions"))
    return full.repartition(tasks, "key", "i", "j").groupBy("key", "i", "j").applyInArrow(run, _FOUND)


def _sized(rows: DataFrame) -> DataFrame:
    """For each key its earliest window (rep, rl, rc, rr, rmany) and how many it has."""
    size = rows.groupBy("key").agg(F.min(F.struct("ord", "doc", *_WINDOW)).alias("p"), F.count("*").alias("size"))
    return size.select("key", "size", F.col("p.doc").alias("rep"), *(F.col(f"p.{x}").alias(f"r{x}") for x in _WINDOW))


def _earlier(later: DataFrame, rows: DataFrame) -> DataFrame:
    """Pairs of windows with one key: later ones with all that come before them."""
    sides = rows.select("key", F.col("doc").alias("rep"), F.col("ord").alias("rord"), *(F.col(x).alias(f"r{x}") for x in _WINDOW))
    return later.join(sides, "key").where("ord > rord or ord = rord and doc > rep").select("doc", "rep", *_WINDOW, *(f"r{x}" for x in _WINDOW))


def _equal_runs(met: DataFrame, found: DataFrame, seqs: DataFrame, least: int, parts: int) -> DataFrame:
    """Step 4: passages of equal runs. met: windows, found: what is known."""
    places = met.groupBy("doc").agg(F.min("ord").alias("ord"), F.collect_set(F.struct(*_WINDOW)).alias("places"))
    known = found.where(F.col("kind") != SIMILAR).groupBy("doc").agg(F.collect_set(F.struct("first", "n")).alias("runs"))
    base = U(0x9E3779B97F4A7C15)

    def run(batches):
        chunk = meeting.Chunk(parts, 2)
        powers = back = np.zeros(0, U)
        for batch in batches:
            doc, ord_ = batch.column(0).to_numpy(), batch.column(1).to_numpy()
            at = np.zeros(len(doc), np.int64)
            for i, (seq, places_, runs) in enumerate(zip(batch.column(2), batch.column(3), batch.column(4))):
                number = chunk.owner()
                at[i] = chunk.id | number
                x = np.frombuffer(seq.as_buffer(), np.uint32)
                m = len(x) - least + 1
                if m < 1:
                    continue
                l, c, r, many = (_beside(places_, f) for f in _WINDOW)
                low = np.where(many, l, np.maximum(l, c - least + 1))
                high = np.minimum(np.where(many, r, np.minimum(c + least - 1, r)) - least + 1, m - 1)
                ok = high >= low
                edge = np.zeros(m + 1, np.int64)
                np.add.at(edge, low[ok], 1)
                np.add.at(edge, high[ok] + 1, -1)
                wanted = np.cumsum(edge)[:m] > 0
                if runs.is_valid:
                    for a, n in zip(_beside(runs, "first"), _beside(runs, "n")):
                        wanted[a : a + n - least + 1] = False
                where = np.flatnonzero(wanted)
                if len(where):
                    if len(powers) <= len(x):
                        powers = np.cumprod(np.full(2 * len(x), base), dtype=U)
                        back = np.cumprod(np.full(2 * len(x), U(pow(int(base), -1, 1 << 64))), dtype=U)
                    total = _totals(K.mix(x.astype(U) + U(1)) * powers[: len(x)], U)
                    key = K.mix((total[where + least] - total[where]) * back[where])
                    chunk.add(key, number, where, (key >> U(32)).astype(np.uint32).view(np.int32))
            yield _noted(doc, ord_, np.zeros(len(doc), np.int64), at)
            if chunk.full():
                yield _closed(chunk)
        yield _closed(chunk)

    packed = cut(places.join(known, "doc", "left").join(seqs, "doc").select("doc", "ord", "seq", "places", "runs").mapInArrow(trimmed(run), _ROWS), "runs")
    named = packed.where(F.col("part") == meeting.OTHER).select("id", F.col("h").alias("doc"), "ord")
    rows = meeting.shared_keys(packed, 2).join(named, "id").select("key", F.col("e1").alias("high"), "ord", "doc", F.col("e0").alias("at"))
    rows = cut(rows, "shared-runs")
    drop(packed)
    low = rows.groupBy("key", "high").agg(F.min(F.struct("ord", "doc", "at")).alias("low")).select("key", "high", F.col("low.doc").alias("rep"), F.col("low.at").alias("rep_at"))
    met_at = rows.join(low, ["key", "high"]).where("doc <> rep").select("doc", "rep", "at", (F.col("at") - F.col("rep_at")).alias("diagonal"))
    order = F.row_number().over(Window.partitionBy("doc", "rep", "diagonal").orderBy("at"))
    runs = met_at.withColumn("island", F.col("at") - order).groupBy("doc", "rep", "diagonal", "island").agg(F.min("at").alias("first"), (F.max("at") - F.min("at") + F.lit(least)).alias("n"))
    out = runs.select("doc", "rep", "first", "n", (F.col("first") - F.col("diagonal")).alias("rep_first"), F.col("n").alias("rep_n"), F.lit(1.0).alias("similarity"), F.lit(EQUAL).alias("kind"))
    out = cut(out, "equal")
    drop(rows)
    return out


def _first_copies(rows: DataFrame) -> tuple[DataFrame, DataFrame]:
    """Rows without later copies of a text, and those copies as (ord, h, rep): hash of the text, order of its first row."""
    named = rows.select("ord", "h", F.crc32("text").alias("g"), F.length("text").alias("n"))
    first = named.groupBy("h", "g", "n").agg(F.min("ord").alias("rep"), F.max("ord").alias("last")).where("rep < last")
    copies = cut(named.join(first.drop("last"), ["h", "g", "n"]).where("ord > rep").select("ord", "h", "rep").distinct(), "copies")
    gone = rows.sparkSession.sparkContext.broadcast(bloom_of(copies.select(F.xxhash64("ord", "h").alias("x")), "x", copies.count()))
    # Later copies stay out: the few that pass the bitmap without being copies are told apart by a join.
    tested = rows.select("ord", "text", "h", F.xxhash64("ord", "h").alias("x"))
    kinds = "ord long, text string, h long, x long"
    maybe = tested.mapInArrow(lambda b: _split_by(b, gone, True), kinds).join(copies.select("ord", "h"), ["ord", "h"], "left_anti").select("ord", "text", "h", "x")
    return tested.mapInArrow(lambda b: _split_by(b, gone, False), kinds).unionByName(maybe), copies


def _split_by(batches, bitmap, inside: bool):
    for batch in batches:
        yield batch.filter(pa.array(in_bloom(bitmap.value, batch.column(3).to_numpy().view(U)) == inside))


def _ordered(docs: DataFrame) -> DataFrame:
    return docs.select(F.coalesce(F.col("doc_id").cast("long"), F.lit((1 << 63) - 1)).alias("ord"), F.col("text").cast("string").alias("text"), F.xxhash64(F.col("text").cast("string")).alias("h"))


def found_passages(docs: DataFrame, k: int = WORDS, least: int = LEAST, similarity: float = SIMILARITY, functions: int = FUNCTIONS) -> DataFrame:
    """(ord, h, first_word, n_words, rep_ord, rep_first_word, rep_n_words, similarity): passages() by order and hash of the text."""
    small_batches(docs.sparkSession)
    rows = _ordered(docs).where("text is not null")
    parts = meeting.parts_for(docs)
    rest, copies = _first_copies(rows)
    mapped = cut(_windows(rest, k, least, functions, parts), "windows")
    texts = mapped.where(F.col("part") == meeting.OTHER).select("id", "h", "ord", "words")
    c, many = F.col("e1").bitwiseAND(F.lit(MANY - 1)), F.col("e1") >= MANY
    met = meeting.shared_keys(mapped, 3).join(texts.select("id", F.col("h").alias("doc"), "ord"), "id").select("key", "doc", "ord", F.col("e0").alias("l"), c.alias("c"), F.col("e2").alias("r"), many.alias("many"))
    met = cut(met, "met")
    names = cut(texts.select("h", "ord", "words").dropDuplicates(["h"]), "names")
    drop(mapped)
    wanted = met.select("doc").distinct()
    bitmap = docs.sparkSession.sparkContext.broadcast(bloom_of(wanted, "doc", names.count()))
    seqs = cut(_sequences(rest, k, bitmap), "sequences")
    most = names.count()

    def verified(pairs):
        regions = cut(_regions(pairs, similarity), "regions")
        out = cut(_verified(regions, _of(seqs, regions.select(F.explode(F.array("doc", "rep")).alias("doc")), most), least, similarity), "passages")
        drop(regions)
        return out

    # 1: with the key's earliest window.
    size = cut(_sized(met), "sizes")
    found = verified(met.join(size, "key").where("doc <> rep"))
    # 2: small keys, all earlier windows but the earliest.
    small = met.join(size.where(F.col("size").between(3, SMALL)).select("key", F.col("rep").alias("first")), "key").where("doc <> first")
    found = found.unionByName(verified(_earlier(_open(small, found), small)))
    # 3: large keys, by the shingles that the fewest of their windows hold.
    rows = met.join(size.where(F.col("size") > SMALL).select("key"), "key")
    spots = _open(rows, found).select("key", "doc", "c", F.lit(True).alias("open")).distinct()
    rows = cut(rows.join(spots.select("key").distinct(), "key", "left_semi").join(spots, ["key", "doc", "c"], "left").withColumn("open", F.coalesce("open", F.lit(False))), "large")
    windows, items = _held(rows, seqs, parts, least, most)
    drop(size, rows)
    side = windows.select(F.col("id").alias("rid"), F.col("doc").alias("rep"), F.col("ord").alias("rord"), *(F.col(x).alias(f"r{x}") for x in _WINDOW))
    # Of shingles that nobody looks for, no holder is needed.
    holders = lambda own: items.select("item", F.col("id").alias("rid")).join(own.select("item").distinct(), "item", "left_semi").join(side.select("rid", "rord", "rep"), "rid")
    earlier = lambda own, sides: own.join(windows.select("id", "ord", "doc"), "id").join(sides, "item").where("ord > rord or ord = rord and doc > rep")
    of = lambda pairs: pairs.join(windows.select("id", "doc", *_WINDOW), "id").join(side, "rid").select("doc", "rep", *_WINDOW, *(f"r{x}" for x in _WINDOW))
    seekers = _seekers(windows, items, windows.where("open").select("id"), found, least, similarity, parts)
    first = holders(seekers).groupBy("item").agg(F.min(F.struct("rord", "rep", "rid")).alias("p")).select("item", "p.*")
    tried = cut(earlier(seekers, first).select("id", "rid").distinct(), "pairs")
    found = found.unionByName(verified(of(tried)))
    open_ = _open(windows.where("open").drop("seq"), found).select("id").join(seekers.select("id").distinct(), "id", "left_semi")
    still = _seekers(windows, items, open_, found, least, similarity, parts)
    crowd = _crowd(still.where("rare > 0"), items, windows, seqs, most)
    drop(windows, items, seekers, still, tried)
    found = found.unionByName(cut(_met_in_tiles(crowd, least, similarity), "passages"))
    drop(crowd)
    # 4: equal runs.
    found = found.unionByName(_equal_runs(met, found, seqs, least, parts))
    drop(met, seqs)
    add = k - 1
    parts_ = found.where(F.col("kind") != INSIDE).groupBy("doc", "rep", "first").agg(F.max(F.struct("n", "rep_first", "rep_n", "similarity")).alias("b"))
    own, other = names.select(F.col("h").alias("doc"), "ord"), names.select(F.col("h").alias("rep"), F.col("ord").alias("rep_ord"))
    parts_ = parts_.join(own, "doc").join(other, "rep").select(
        "ord", F.col("doc").alias("h"), F.col("first").alias("first_word"), (F.col("b.n") + add).cast("int").alias("n_words"), "rep_ord", F.col("b.rep_first").alias("rep_first_word"), (F.col("b.rep_n") + add).cast("int").alias("rep_n_words"), F.col("b.similarity").alias("similarity"))
    n = F.col("words").cast("int")
    whole = copies.join(names.select("h", "words"), "h").where(F.col("words") >= least + add).select(
        "ord", "h", F.lit(0).alias("first_word"), n.alias("n_words"), F.col("rep").alias("rep_ord"), F.lit(0).alias("rep_first_word"), n.alias("rep_n_words"), F.lit(1.0).alias("similarity"))
    return parts_.unionByName(whole)


def passages(docs: DataFrame, k: int = WORDS, least: int = LEAST, similarity: float = SIMILARITY, functions: int = FUNCTIONS) -> DataFrame:
    back = lambda c: F.when(F.col(c) < (1 << 63) - 1, F.col(c))
    found = found_passages(docs, k, least, similarity, functions)
    return found.select(back("ord").alias("doc_id"), "first_word", "n_words", back("rep_ord").alias("rep_doc_id"), "rep_first_word", "rep_n_words", "similarity")


def remove_passages(docs: DataFrame, k: int = WORDS, least: int = LEAST, similarity: float = SIMILARITY) -> DataFrame:
    """The documents (all columns) without the passages that an earlier document has; n_chars, if there, is counted anew. A row is cut by the passages of its own id and text. A document that loses every word stays with an empty text."""
    spans = found_passages(docs, k, least, similarity).groupBy("ord", "h").agg(F.sort_array(F.collect_set(F.struct("first_word", "n_words"))).alias("spans"))
    kinds, columns = docs.schema, docs.columns
    text_at = columns.index("text")

    def run(batches):
        for batch in batches:
            row, spans_of = batch.column(0), batch.column(1)
            out = [row.field(i) for i in range(len(columns))]
            if spans_of.null_count < len(spans_of):
                text = out[text_at].to_pylist()
                for i, s in enumerate(spans_of.to_pylist()):
                    if s and text[i]:
                        text[i] = without(text[i], [(x["first_word"], x["n_words"]) for x in s])
                out[text_at] = pa.array(text, out[text_at].type)
                if "n_chars" in columns:
                    at = columns.index("n_chars")
                    out[at] = pa.array([old if s is None else len(t) for old, s, t in zip(out[at].to_pylist(), spans_of.to_pylist(), text)], out[at].type)
            yield pa.RecordBatch.from_arrays(out, names=columns)

    keyed = docs.select(F.struct(*(F.col(f"`{c}`") for c in columns)).alias("row"), F.coalesce(F.col("doc_id").cast("long"), F.lit((1 << 63) - 1)).alias("ord"), F.xxhash64(F.col("text").cast("string")).alias("h"))
    return keyed.join(spans, ["ord", "h"], "left").select("row", "spans").mapInArrow(trimmed(run), kinds)


def without(text: str, spans: list[tuple[int, int]]) -> str:
    """A text without some runs of words; what is left of a cut is one line break."""
    raw = text.encode("utf-8", "surrogatepass")
    buf = np.frombuffer(raw, np.uint8)
    starts, ends, _ = K.spans(buf, np.array([0, len(buf)]))
    out, at = [], 0
    for first, n in sorted(spans):
        if first >= len(starts):
            continue
        a, b = int(starts[first]), int(ends[min(first + n, len(ends)) - 1])
        if b <= at:
            continue
        out.append(raw[at : max(a, at)].strip())
        at = b
    out.append(raw[at:].strip())
    return b"\n".join(x for x in out if x).decode("utf-8", "surrogatepass")


def query(spark: SparkSession, sf_dir: str) -> DataFrame:
    return passages(table(spark, sf_dir, "documents"))
