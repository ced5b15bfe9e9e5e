"""Which keys several documents share, found with 8 bytes a key in the shuffle.

A task gathers the keys of many documents into a chunk. A key that two documents
of a chunk have is known to be shared at once: its rows stay in the chunk, and
one of them goes on as a mark. All other keys go, packed as 32 bits beside their
part of the key space, to the task of that part, which tells those that another
chunk has too. A key therefore reaches a task once for each chunk at most,
however many documents have it; a key that only one document has ends there.

Two keys of one part with the same 32 bits are taken as one: callers verify.
"""

from __future__ import annotations

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

U = np.uint64
#: Documents of a chunk at most (bits), and keys after which it is closed.
OWNER_BITS, CHUNK_KEYS = 20, 1 << 18
#: Bytes of input for a part of the key space: some 10 MB of packed keys.
PART_BYTES = 16 << 20
LOCAL, OTHER = -1, -2


def parts_for(df: DataFrame) -> int:
    """Parts of the key space: they follow the size of the input, and are as many as the shuffle partitions at least."""
    size = int(str(df._jdf.queryExecution().optimizedPlan().stats().sizeInBytes()))
    known = size // PART_BYTES if size < 1 << 60 else 0  # beyond that Spark does not know it
    return max(int(df.sparkSession.conf.get("spark.sql.shuffle.partitions")), min(known, 1 << 20))


def pack(x: np.ndarray) -> bytes:
    """Rows of numbers (uint32) as bytes: differences in the first row, which is in order, then all first bytes, all second ones and so on, compressed."""
    x = x.copy()
    x[0, 1:] -= x[0, :-1].copy()
    planes = np.ascontiguousarray(x.view(np.uint8).reshape(len(x), -1, 4).transpose(0, 2, 1))
    return x.shape[1].to_bytes(4, "little") + pa.compress(planes.tobytes(), "zstd", asbytes=True)


def unpack(data, rows: int) -> np.ndarray:
    n = int.from_bytes(data[:4], "little")
    planes = np.frombuffer(pa.decompress(data[4:], 4 * n * rows, "zstd"), np.uint8).reshape(rows, 4, n)
    x = np.ascontiguousarray(planes.transpose(0, 2, 1)).view(np.uint32).reshape(rows, n)
    x[0] = np.cumsum(x[0], dtype=np.uint32)
    return x


class Chunk:
    """Keys of documents, with numbers (int32) beside each."""

    def __init__(self, parts: int, extras: int = 0):
        from pyspark import TaskContext

        self.parts, self.extras = parts, extras
        self.base = TaskContext.get().partitionId() << (2 * OWNER_BITS)
        self.seq = 0
        self._clear()

    def _clear(self) -> None:
        self.rows, self.size, self.owners = [], 0, 0

    @property
    def id(self) -> int:
        return self.base | self.seq << OWNER_BITS

    def owner(self) -> int:
        """A number for the next document."""
        self.owners += 1
        return self.owners - 1

    def add(self, keys: np.ndarray, owner, *extras: np.ndarray) -> None:
        """Keys (uint64) of an owner, or of one each; a key at most once for an owner."""
        self.size += len(keys)
        own = np.broadcast_to(np.asarray(owner, np.uint32), len(keys))
        self.rows.append((keys, own, *(np.asarray(x, np.int32).view(np.uint32) for x in extras)))

    def full(self) -> bool:
        return self.size >= CHUNK_KEYS or self.owners >= (1 << OWNER_BITS) - (1 << 12)

    def close(self) -> list[tuple[int, int, bytes]]:
        """(part, chunk, data) rows; the chunk begins anew."""
        rows, chunk = self.rows, self.id
        self.seq += 1
        self._clear()
        if not rows:
            return []
        keys = np.concatenate([r[0] for r in rows])
        beside = np.stack([np.concatenate([r[i] for r in rows]) for i in range(1, 2 + self.extras)])
        part = ((keys >> U(32)) * U(self.parts)) >> U(32)
        low = keys & U(0xFFFFFFFF)
        order = np.argsort((part << U(32)) | low, kind="stable")
        part, low, beside = part[order], low[order].astype(np.uint32), beside[:, order]
        new = np.r_[True, (part[1:] != part[:-1]) | (low[1:] != low[:-1])] if len(part) else np.zeros(0, bool)
        first = np.flatnonzero(new)
        many = np.diff(np.r_[first, len(part)]) > 1
        data = np.concatenate([low[first][None], beside[:, first]])
        data[1] |= many.astype(np.uint32) << np.uint32(31)
        part_of = part[first]
        edge = np.flatnonzero(np.r_[True, part_of[1:] != part_of[:-1]]) if len(part_of) else np.zeros(0, np.int64)
        out = [(int(part_of[a]), chunk, pack(data[:, a:b])) for a, b in zip(edge, np.r_[edge[1:], len(part_of)])]
        both = np.repeat(many, np.diff(np.r_[first, len(part)]))
        if both.any():
            out.append((LOCAL, chunk, pack(np.concatenate([part[both].astype(np.uint32)[None], low[both][None], beside[:, both]]))))
        return out


def _table(key, owner, extras) -> dict:
    return {"key": pa.array(key.astype(np.int64)), "id": pa.array(owner.astype(np.int64)), **{f"e{i}": pa.array(x.view(np.int32)) for i, x in enumerate(extras)}}


def shared_keys(packed: DataFrame, extras: int = 0) -> DataFrame:
    """(key, id, e0, e1, ...) of the keys that two documents have at least; id: chunk and owner."""
    schema = "key long, id long" + "".join(f", e{i} int" for i in range(extras))

    def inside(batches):
        for batch in batches:
            for chunk, data in zip(batch.column(0).to_pylist(), batch.column(1)):
                x = unpack(data.as_py(), 3 + extras)
                yield pa.RecordBatch.from_pydict(_table((x[0].astype(U) << U(32)) | x[1], x[2].astype(np.int64) | chunk, [np.ascontiguousarray(v) for v in x[3:]]))

    def across(key, t):
        x = [unpack(v.as_py(), 2 + extras) for v in t.column("data")]
        chunk = np.repeat(t.column("chunk").to_numpy(), [v.shape[1] for v in x])
        x = np.concatenate(x, axis=1)
        order = np.argsort(x[0], kind="stable")
        low = x[0][order]
        same = low[1:] == low[:-1]
        often = (np.r_[same, False] | np.r_[False, same]) & (x[1][order] >> np.uint32(31) == 0)
        at = order[often]
        out = _table((U(key[0].as_py()) << U(32)) | x[0][at], x[1][at].astype(np.int64) | chunk[at], [np.ascontiguousarray(v[at]) for v in x[2:]])
        return pa.table(out)

    here = packed.where(F.col("part") == LOCAL).select("chunk", "data").mapInArrow(inside, schema)
    return here.unionByName(packed.where("part >= 0").select("part", "chunk", "data").groupBy("part").applyInArrow(across, schema))
