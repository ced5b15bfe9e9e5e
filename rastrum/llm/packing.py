"""Operator 10, packing along a space-filling curve.

Each document is encoded once; a vector of its hashed tokens is projected to
DIMS numbers, and its place on a Hilbert curve through that space is its sort
key (a hash of the document, and of how often its task has met it, breaks ties, so that a large group of copies is
dealt over many tasks). Key ranges of about equal size come from a sample of at
most SAMPLE documents; it only sets the balance, never what is packed. Within a
range documents follow each other along the curve without gaps and are cut
where a sequence is full, so only the last sequence of a range is not.

Null texts are empty; an empty document is its closing id 0 alone. Repeated
rows are packed as often as they occur. Other columns are ignored.
"""

from __future__ import annotations

import functools
import re
import zlib
from collections import Counter

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from . import kernels as K
from .shared import small_batches, table, trimmed

LENGTH = 1024
DIMS, DEPTH = 4, 10
#: Bytes of text for a range (some 400 sequences at least), ranges at most, and sampled documents for each.
RANGE_BYTES, RANGES, KEYS_A_RANGE = 2 << 20, 20_000, 60
BUCKETS = 1 << 12
U = np.uint64


@functools.cache
def encoder(vocabulary: str):
    """A fast encoder for a byte-level BPE file whose ids are its merge ranks, which is checked; one for each worker."""
    import tiktoken

    from .bpe import Vocabulary

    v = Vocabulary(vocabulary)
    if any(made != 256 + r for r, made in v.rank.values()):
        raise ValueError("ids of this vocabulary don't follow its merges")
    # Fixed value: the pre-tokenizer's pattern.
    pattern = r"""'(?:[sdmt]|ll|ve|re)| ?\p{L}+| ?\p{N}+| ?[^\s\p{L}\p{N}]+|\s+(?!\S)|\s+"""
    return tiktoken.Encoding("own", pat_str=pattern, mergeable_ranks=v.id_of, special_tokens=v.special)


#: Fixed value: the characters that the pattern's \\s stands for, in a run so long that the pattern would not end well.
_LONG_SPACE = re.compile("[\t-\r \x85\xa0\u1680\u2000-\u200a\u2028\u2029\u202f\u205f\u3000]{4096,}")


def ids_of(enc, text: str) -> np.ndarray:
    """Ids of a whole text. In a run of white space all but the last character is one piece of the pattern (all, at the end); so around long runs the text is encoded in parts, which takes time in proportion to it."""
    out, at = [], 0
    for m in _LONG_SPACE.finditer(text):
        out.append(enc.encode_to_numpy(text[at : m.start()], allowed_special="all"))
        at = m.end() - (m.end() < len(text))
        out.append(np.array(enc._encode_single_piece(text[m.start() : at]), np.uint32))
    out.append(enc.encode_to_numpy(text[at:], allowed_special="all"))
    return np.concatenate(out).astype(np.uint32)


@functools.cache
def projection() -> np.ndarray:
    """Random directions, one row for each bucket of hashed ids."""
    return np.random.default_rng(7).standard_normal((BUCKETS, DIMS)).astype(np.float32)


def hilbert(cells: np.ndarray, depth: int = DEPTH) -> np.ndarray:
    """Places on the Hilbert curve of points with whole coordinates below 2^depth: Gray-code walk over the bit planes, from the axes to the transposed index."""
    x = cells.astype(np.int64).T.copy()
    n = len(x)
    for plane in range(depth - 1, 0, -1):
        q, p = 1 << plane, (1 << plane) - 1
        for i in range(n):
            high = (x[i] & q) > 0
            t = np.where(high, 0, (x[0] ^ x[i]) & p)
            x[0] ^= np.where(high, p, t)
            x[i] ^= t if i else 0
    for i in range(1, n):
        x[i] ^= x[i - 1]
    t = np.zeros_like(x[0])
    for plane in range(depth - 1, 0, -1):
        t ^= np.where(x[n - 1] & (1 << plane), (1 << plane) - 1, 0)
    x ^= t
    key = np.zeros(x.shape[1], np.int64)
    for plane in range(depth - 1, -1, -1):
        for i in range(n):
            key = key << 1 | (x[i] >> plane & 1)
    return key


def curve_keys(ids: list[np.ndarray], salt: np.ndarray) -> np.ndarray:
    """Sort keys below 2^60: the place on the curve, then 20 bits of the salt."""
    flat = np.concatenate([*ids, np.zeros(0, np.uint32)])
    lens = np.array([len(x) for x in ids])
    bucket = ((flat.astype(U) * U(0x9E3779B97F4A7C15)) >> U(52)).astype(np.int64)
    sums = np.zeros((len(ids), DIMS), np.float32)
    if len(flat):
        full = np.flatnonzero(lens)
        sums[full] = np.add.reduceat(projection()[bucket], (np.cumsum(lens) - lens)[full], axis=0)
    unit = sums / np.sqrt(np.maximum(lens, 1))[:, None].astype(np.float32)
    cells = np.clip((np.tanh(unit / 4) + 1) / 2 * (1 << DEPTH), 0, (1 << DEPTH) - 1).astype(np.int64)
    return hilbert(cells) << 20 | (salt >> U(44)).astype(np.int64)


def _encode(vocabulary: str, batches):
    """Slices of batches (doc_id, text, hash): (batch, first row, end, encoded ids of each row, keys)."""
    enc, met = encoder(vocabulary), Counter()
    for batch in batches:
        column = K.text_column(batch).fill_null("")
        _, offs = K.utf8(column)
        own = batch.column(2).to_numpy().view(U)
        salt = np.zeros(len(own), U)
        for i, h in enumerate(own.tolist()):
            salt[i] = met[h]
            met[h] += 1
        for lo, hi in K.slices(offs):
            ids = [ids_of(enc, t) for t in column.slice(lo, hi - lo).to_pylist()]
            yield batch, lo, hi, ids, curve_keys(ids, K.mix(own[lo:hi] * U(0xD1B54A32D192ED03) + salt[lo:hi]))


def _bounds(rows: DataFrame, vocabulary: str) -> np.ndarray:
    """Where the ranges of keys begin, but the first; from a sample of the rows, of bounded size."""
    count, size = rows.agg(F.count("*"), F.coalesce(F.sum(F.octet_length("text")), F.lit(0))).first()
    n = int(min(max(1, size // RANGE_BYTES), RANGES))
    if n == 1:
        return np.zeros(0, np.int64)

    def keys(batches):
        for _, _, _, _, key in _encode(vocabulary, batches):
            yield pa.RecordBatch.from_arrays([pa.array(key)], names=["key"])

    share = min(1.0, KEYS_A_RANGE * n / count)
    found = np.sort(rows.sample(share, 7).mapInArrow(trimmed(keys), "key long").toArrow().column("key").to_numpy())
    return found[(np.arange(1, n) * len(found)) // n] if len(found) else np.zeros(0, np.int64)


def pack(docs: DataFrame, vocabulary: str, length: int = LENGTH) -> DataFrame:
    """One row per piece: its place in its document and in its sequence."""
    small_batches(docs.sparkSession)
    rows = docs.select(F.col("doc_id").cast("long").alias("doc_id"), F.col("text").cast("string").alias("text")).withColumn("h", F.xxhash64("doc_id", "text"))
    bounds = _bounds(rows, vocabulary)
    n = len(bounds) + 1

    def encode(batches):
        for batch, lo, hi, ids, key in _encode(vocabulary, batches):
            raw = [x.astype(np.uint16 if not len(x) or x.max() < 1 << 16 else np.uint32) for x in ids]
            yield pa.RecordBatch.from_arrays(
                [pa.array(np.searchsorted(bounds, key, "right"), pa.int32()), pa.array(key), batch.column(0).slice(lo, hi - lo), pa.array([len(x) + 1 for x in ids], pa.int64()), pa.array([x.tobytes() for x in raw], pa.binary())],
                names=["part", "key", "doc_id", "n", "ids"],
            )

    def cut(batches):
        part, done = -1, 0
        for batch in batches:
            part_of, _, doc, n_of, raw = (c.to_pylist() if k else c.to_numpy() for k, c in enumerate(batch.columns))
            out = [[] for _ in range(7)]
            for p, d, n, b in zip(part_of.tolist(), doc, n_of, raw):
                if p != part:
                    part, done = p, 0
                x = np.zeros(n, "<u4")
                x[: n - 1] = np.frombuffer(b, np.uint16 if len(b) == 2 * (n - 1) else np.uint32)
                at = 0
                while at < n:
                    size = min(length - done % length, n - at)
                    for column, v in zip(out, (d, at, size, zlib.crc32(x[at : at + size].tobytes()), n, (p << 40) + done // length, done % length)):
                        column.append(v)
                    at, done = at + size, done + size
            yield pa.RecordBatch.from_arrays([pa.array(c, pa.int64()) for c in out], names=["doc_id", "start", "length", "ids_crc32", "doc_tokens", "sequence_id", "offset"])

    encoded = rows.mapInArrow(trimmed(encode), "part int, key long, doc_id long, n long, ids binary")
    return (
        encoded.repartitionById(n, F.col("part")).sortWithinPartitions("part", "key", "doc_id", "n", "ids")
        .mapInArrow(trimmed(cut), "doc_id long, start long, length long, ids_crc32 long, doc_tokens long, sequence_id long, offset long")
    )


def query(spark: SparkSession, sf_dir: str) -> DataFrame:
    import public_tokenizers

    return pack(table(spark, sf_dir, "documents"), public_tokenizers.path("byte_bpe_50k.json"))
