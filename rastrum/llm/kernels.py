"""Vectorised text kernels over Arrow string buffers.

Every kernel works on the bytes of a whole Arrow column: no text is cut, and no
Python object is made for a word. A hash of a word is a sum of its bytes, each
multiplied by a pseudo-random number of its place, and then mixed; so it is the
same on every executor.
"""

from __future__ import annotations

import numpy as np
import pyarrow as pa

U = np.uint64
#: Text bytes handled at a time inside an Arrow batch; a longer text is a slice of its own.
SLICE_BYTES = 2 << 20

_SPACE = np.zeros(256, bool)
_SPACE[[0x20, 0x09, 0x0A, 0x0B, 0x0C, 0x0D]] = True
_LOWER = np.arange(256, dtype=np.uint8)
_LOWER[65:91] += 32
_SAME = np.arange(256, dtype=np.uint8)


def mix(x: np.ndarray) -> np.ndarray:
    """A bijection of 64-bit numbers that spreads every bit (the finaliser of MurmurHash3)."""
    x = x ^ (x >> U(33))
    x = x * U(0xFF51AFD7ED558CCD)
    x = x ^ (x >> U(33))
    x = x * U(0xC4CEB9FE1A85EC53)
    return x ^ (x >> U(33))


_places = mix(np.arange(1, 4097, dtype=U) * U(0x9E3779B97F4A7C15)) | U(1)


def places(n: int) -> np.ndarray:
    """Multipliers of the first n places in a word or line; odd, from a rule."""
    global _places
    if n > len(_places):
        _places = mix(np.arange(1, 2 * n + 1, dtype=U) * U(0x9E3779B97F4A7C15)) | U(1)
    return _places


def utf8(column: pa.Array) -> tuple[np.ndarray, np.ndarray]:
    """Bytes and offsets of a string column; null counts as empty."""
    column = column.fill_null("") if column.null_count else column
    wide = pa.types.is_large_string(column.type)
    _, offsets, data = column.buffers()
    offs = np.frombuffer(offsets, np.int64 if wide else np.int32)[column.offset : column.offset + len(column) + 1].astype(np.int64) if len(column) else np.zeros(1, np.int64)
    raw = np.frombuffer(data, np.uint8) if data is not None and data.size else np.zeros(0, np.uint8)
    return raw[offs[0] : offs[-1]], offs - offs[0]


def slices(offs: np.ndarray, size: int = SLICE_BYTES):
    """Ranges of rows that hold about `size` bytes, one row at least."""
    lo, n = 0, len(offs) - 1
    while lo < n:
        hi = max(lo + 1, int(np.searchsorted(offs, offs[lo] + size, "right")) - 1)
        yield lo, min(hi, n)
        lo = min(hi, n)


def spans(buf: np.ndarray, offs: np.ndarray, apart: np.ndarray = _SPACE):
    """Starts, ends and row of every maximal run of bytes outside `apart`; runs end where a row ends."""
    if not len(buf):
        z = np.zeros(0, np.int64)
        return z, z, z
    inside = ~apart[buf]
    cut = np.zeros(len(buf) + 1, bool)
    cut[offs] = True
    before = np.empty(len(buf), bool)
    before[0] = False
    before[1:] = inside[:-1]
    after = np.empty(len(buf), bool)
    after[-1] = False
    after[:-1] = inside[1:]
    starts = np.flatnonzero(inside & (~before | cut[:-1]))
    ends = np.flatnonzero(inside & (~after | cut[1:])) + 1
    return starts, ends, np.searchsorted(offs, starts, "right") - 1


def span_hashes(buf: np.ndarray, starts: np.ndarray, ends: np.ndarray, table: np.ndarray = _SAME) -> np.ndarray:
    """64-bit hash of each span (not empty); bytes pass through `table` first."""
    if not len(starts):
        return np.zeros(0, U)
    lens = ends - starts
    first = np.zeros(len(lens), np.int64)
    np.cumsum(lens[:-1], out=first[1:])
    place = np.arange(int(lens.sum()), dtype=np.int64)
    shift = np.repeat((starts - first).astype(np.int32 if len(buf) < 2**31 else np.int64), lens)
    within = place - np.repeat(first, lens)
    at = place + shift
    value = (table[buf[at]].astype(U) + U(1)) * places(int(lens.max()))[within]
    return mix(np.add.reduceat(value, first))


def words(column_buf: np.ndarray, offs: np.ndarray, lower: bool = False):
    """(hash, row) of every word `[^\\x20\\x09-\\x0D]+`, in order; `lower` folds A-Z only."""
    starts, ends, row = spans(column_buf, offs)
    return span_hashes(column_buf, starts, ends, _LOWER if lower else _SAME), row


_STEP = mix(np.arange(101, 133, dtype=U)) | U(1)


def shingles(h: np.ndarray, row: np.ndarray, k: int, short: bool = False):
    """(hash, row, first word's index) of every k words in a row. short: a row with fewer words, but one at least, has its whole sequence as one."""
    n = len(h) - k + 1
    if n > 0:
        total = np.zeros(n, U)
        for j in range(k):
            total += h[j : j + n] * _STEP[j]
        ok = np.flatnonzero(row[:n] == row[k - 1 :])
        out, rows, at = mix(total[ok]), row[ok], ok
    else:
        out, rows, at = np.zeros(0, U), np.zeros(0, np.int64), np.zeros(0, np.int64)
    if short and len(h):
        firsts = np.flatnonzero(np.r_[True, row[1:] != row[:-1]])
        lens = np.diff(np.r_[firsts, len(h)])
        few = lens < k
        if few.any():
            place = np.arange(len(h)) - np.repeat(firsts, lens)
            keep = np.repeat(few, lens)
            part = (h[keep] * _STEP[place[keep] % 32])
            bounds = np.r_[0, np.cumsum(lens[few])[:-1]]
            extra = mix(np.add.reduceat(part, bounds) + lens[few].astype(U))
            out, rows, at = np.r_[out, extra], np.r_[rows, row[firsts[few]]], np.r_[at, firsts[few]]
            order = np.argsort(at, kind="stable")
            out, rows, at = out[order], rows[order], at[order]
    return out, rows, at


def text_column(batch: pa.RecordBatch, name: str = "text") -> pa.Array:
    column = batch.column(batch.schema.get_field_index(name))
    return column if pa.types.is_string(column.type) or pa.types.is_large_string(column.type) else column.cast(pa.string())
