"""Operator 1, n-gram Jaccard join by parity sketches.

A document's set holds the hashes of its distinct shingles. Sizes fall into
bands; all pairs that can link meet in a band (documents just below a band are
its guests). In a band whose largest set has T shingles, linked sets differ in
D = floor(2 T (1 - j) / (1 + j)) shingles at most. Each set is dealt by hash
into B = D + 1 + S blocks; a block's sketch has one parity bit for each of 64
hash values, and a shingle flips one bit of one block. So the Hamming distance
of two sketches is at most the number of shingles in which the sets differ, and
at least S + 1 blocks of linked sets are equal (pigeonhole): they share S + 1
keys. Each set leaves out the S of its keys that most sets have (blocks of
shingles found everywhere). Two linked sets still share a key: the rarest that
both have is left out by neither.

Sets that share a key are compared in rounds. In the first STARS rounds a set
is compared with one other at most, the smallest of most of its keys, so that a
group of near copies becomes few components by linearly many pairs. Then come
the pairs that share a key and are not in one component yet: small keys by a
join; large keys in tiles, with exact intersections in the tile. Candidates
pass the Hamming bound of their sketches, then an exact check of their sets.
Components of all links are the result. Nothing is capped or dropped.

Copies of one set are one class from the start. Null, empty and blank texts
have no shingle and link with nothing. Repeated rows get a row each. Ids may be
null or repeat; other columns are ignored.
"""

from __future__ import annotations

import functools
import math

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from . import kernels as K
from . import meeting
from .components import connected_components
from .shared import bloom_of, cut, drop, in_bloom, small_batches, table, trimmed

U = np.uint64
#: Keys with more sets than this are compared in tiles of TILE sets, or of TILE_SHINGLES (8 bytes each) where the sets are large.
LARGE, TILE, TILE_SHINGLES = 64, 512, 1 << 20
#: Text bytes whose sets are made at a time.
SLICE = 1 << 20
GROWTH = 1.5
#: Slack of a band, as a share of the shingles that may differ; bits of a key that name its band.
SLACK, BAND_BITS = 0.1, 6
#: Rounds in which a set is compared with one other only.
STARS = 2


class Bands:
    """Size bands for linking at part / whole (a ratio of whole numbers) or more."""

    def __init__(self, part: int, whole: int):
        self.part, self.whole = part, whole
        self.edges = [1]

    def _grow(self, n: int) -> None:
        while self.edges[-1] <= n:
            self.edges.append(max(self.edges[-1] + 1, math.ceil(self.edges[-1] * GROWTH)))

    def of(self, n: int) -> list[int]:
        """Bands of a set of n: its own, and the next one if a partner may be there."""
        self._grow(2 * n + 2)
        k = int(np.searchsorted(self.edges, n, "right")) - 1
        return [k] + [k + 1] * (self.whole * n >= self.part * self.edges[k + 1])

    @functools.cache
    def shape(self, k: int) -> tuple[int, int]:
        """Most differing shingles, and slack."""
        self._grow(1)
        while len(self.edges) < k + 2:
            self._grow(self.edges[-1])
        top = self.edges[k + 1] - 1
        d = 2 * top * (self.whole - self.part) // (self.whole + self.part)
        return d, 1 + math.ceil(SLACK * d)


def blocks(s: np.ndarray, n: int) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Of n blocks: parity words, shingles in each, XOR of whole hashes in each."""
    b = ((s >> U(32)) * U(n) >> U(32)).astype(np.int64)
    bits = np.bincount(b * 64 + (s & U(63)).astype(np.int64), minlength=64 * n) & 1
    order = np.argsort(b, kind="stable")
    count = np.bincount(b, minlength=n)
    full = np.flatnonzero(count)
    xor = np.zeros(n, U)
    xor[full] = np.bitwise_xor.reduceat(s[order], (np.cumsum(count) - count)[full])
    return np.packbits(bits.astype(np.uint8), bitorder="little").view(U), count, xor


def keys_of(s: np.ndarray, bands: Bands) -> np.ndarray:
    """Keys of a set: one for each block in each of its bands; the last BAND_BITS bits name the band."""
    out = []
    for k in bands.of(len(s)):
        d, slack = bands.shape(k)
        if d == 0:
            continue  # only equal sets link
        word, count, xor = blocks(s, d + 1 + slack)
        at = np.arange(len(word), dtype=U)
        key = K.mix(word ^ K.mix(xor + (at << U(20)) + (U(k) << U(52)) + count.astype(U)))
        out.append(key >> U(BAND_BITS) << U(BAND_BITS) | U(k))
    return np.concatenate(out) if out else np.zeros(0, U)


def _thinned(keyed: DataFrame, bands: Bands) -> DataFrame:
    """(key, fp) without the slack keys of each set and band that most sets have (ties: by key). The rarest key that two linked sets share stays in both: they share slack + 1 at least, so slack of them come before it in either."""
    slack = F.array(*(F.lit(bands.shape(k)[1]) for k in range(1 << BAND_BITS)))
    sized = keyed.join(keyed.groupBy("key").agg(F.count("*").alias("m")), "key").withColumn("band", F.col("key").bitwiseAND(F.lit((1 << BAND_BITS) - 1)).cast("int"))
    rank = F.row_number().over(Window.partitionBy("fp", "band").orderBy(F.desc("m"), "key"))
    kept = sized.withColumn("rank", rank).where(F.col("rank") > F.get(slack, "band")).select("key", "fp")
    return kept


def sketch(s: np.ndarray) -> np.ndarray:
    """Parity words of a set for the Hamming bound: 2 to 4 bits a shingle, of a power of two of words, so that two sketches fold to one size."""
    n = 1 << max(0, (len(s) * 2 // 64 - 1)).bit_length()
    b = (s >> U(6)) & U(64 * n - 1)
    return np.packbits((np.bincount(b.astype(np.int64), minlength=64 * n) & 1).astype(np.uint8), bitorder="little").view(U)


def hamming(a: np.ndarray, b: np.ndarray) -> int:
    if len(a) > len(b):
        a, b = b, a
    if len(b) > len(a):
        b = np.bitwise_xor.reduce(b.reshape(-1, len(a)), axis=0)
    return int(np.bitwise_count(a ^ b).sum())


def sets_of(column: pa.Array, k: int):
    """(row, set) of each row with a shingle, in order."""
    buf, offs = K.utf8(column)
    for lo, hi in K.slices(offs, SLICE):
        h, row = K.words(buf[offs[lo] : offs[hi]], offs[lo : hi + 1] - offs[lo], lower=True)
        sh, srow, _ = K.shingles(h, row, k, short=True)
        bounds = np.searchsorted(srow, np.arange(hi - lo + 1))
        for i in np.flatnonzero(np.diff(bounds)):
            yield lo + int(i), np.unique(sh[bounds[i] : bounds[i + 1]])


def print_of(s: np.ndarray) -> int:
    """64-bit name of a set."""
    return int(K.mix(K.mix(np.bitwise_xor.reduce(s, keepdims=True)) + np.add.reduce(K.mix(s), keepdims=True) + U(len(s))).view(np.int64)[0])


def _mapped(docs: DataFrame, k: int, bands: tuple[int, int], parts: int) -> DataFrame:
    """For each document a row (part OTHER) with its id in a chunk and the size, name and sketch of its set; beside them the chunks' packed keys. A set that a task has met before gives no keys again."""

    def run(batches):
        own, met, chunk = Bands(*bands), set(), meeting.Chunk(parts)

        def closed():
            rows = chunk.close()
            none = lambda kind: pa.nulls(len(rows), kind)
            return pa.RecordBatch.from_arrays([pa.array([r[0] for r in rows], pa.int32()), pa.array([r[1] for r in rows], pa.int64()), pa.array([r[2] for r in rows], pa.binary()), *(none(pa.int64()) for _ in range(5)), none(pa.binary())], names=names)

        names = ["part", "chunk", "data", "doc_id", "h", "n", "fp", "id", "sketch"]
        for batch in batches:
            m = batch.num_rows
            n, name, at, sketches = np.zeros(m, np.int64), np.zeros(m, np.int64), np.zeros(m, np.int64), [None] * m
            for i, s in sets_of(K.text_column(batch), k):
                n[i], name[i] = len(s), print_of(s)
                number = chunk.owner()
                at[i] = chunk.id | number
                if int(name[i]) in met:
                    continue
                if len(met) >= 1 << 20:
                    met.clear()
                met.add(int(name[i]))
                sketches[i] = sketch(s).tobytes()
                chunk.add(np.unique(keys_of(s, own)), number)
            none = n == 0
            yield pa.RecordBatch.from_arrays([pa.array(np.full(m, meeting.OTHER, np.int32)), pa.nulls(m, pa.int64()), pa.nulls(m, pa.binary()), batch.column(0), batch.column(2), pa.array(n), pa.array(name, mask=none), pa.array(at, mask=none), pa.array(sketches, pa.binary())], names=names)
            if chunk.full():
                yield closed()
        yield closed()

    return docs.mapInArrow(trimmed(run), "part int, chunk long, data binary, doc_id long, h long, n long, fp long, id long, sketch binary")


def _sets(docs: DataFrame, k: int, wanted: DataFrame, reps: DataFrame, rows: int) -> DataFrame:
    """(fp, set) of the wanted sets (column fp), read anew from the first document of each (x: hash of its id and text): cheaper than carrying all sets through a shuffle. A bitmap picks the documents; a few others may come along. Repeated rows of that document give their set once."""
    picked = reps.join(wanted.select("fp").distinct(), "fp", "left_semi")
    bitmap = docs.sparkSession.sparkContext.broadcast(bloom_of(picked, "x", rows))

    def run(batches):
        met = set()
        for batch in batches:
            batch = batch.filter(pa.array(in_bloom(bitmap.value, batch.column(1).to_numpy().view(U))))
            names, data = [], []
            for _, s in sets_of(K.text_column(batch), k):
                name = print_of(s)
                if name not in met:
                    if len(met) >= 1 << 20:
                        met.clear()
                    met.add(name)
                    names.append(name)
                    data.append(s.tobytes())
            yield pa.RecordBatch.from_pydict({"fp": pa.array(names, pa.int64()), "set": pa.array(data, pa.binary())})

    return docs.select("text", F.xxhash64("doc_id", "h").alias("x")).mapInArrow(trimmed(run), "fp long, set binary").dropDuplicates(["fp"])


def _linked(pairs: DataFrame, sketches: DataFrame, sets_for, part: int, whole: int) -> DataFrame:
    """Of pairs (a, b), those that link: by sizes and the Hamming bound, then by the sets (sets_for gives those of some names)."""

    def close(batches):
        for batch in batches:
            na, nb = batch.column(2).to_numpy(), batch.column(3).to_numpy()
            most = (na + nb) * (whole - part) // (whole + part)
            ok = (whole * np.minimum(na, nb) >= part * np.maximum(na, nb)).tolist()
            for i in np.flatnonzero(ok):
                ok[i] = hamming(np.frombuffer(batch.column(4)[i].as_buffer(), U), np.frombuffer(batch.column(5)[i].as_buffer(), U)) <= most[i]
            yield batch.select([0, 1]).filter(pa.array(ok, pa.bool_()))

    def exact(batches):
        for batch in batches:
            ok = []
            for x, y in zip(batch.column(2), batch.column(3)):
                x, y = np.frombuffer(x.as_buffer(), U), np.frombuffer(y.as_buffer(), U)
                common = len(np.intersect1d(x, y, assume_unique=True))
                ok.append(whole * common >= part * (len(x) + len(y) - common))
            yield batch.select([0, 1]).filter(pa.array(ok, pa.bool_()))

    def beside(found: DataFrame, table: DataFrame, *columns: str) -> DataFrame:
        for side in "ba":
            found = found.join(table.select(F.col("fp").alias(side), *(F.col(c).alias(c + side) for c in columns)), side)
        return found.select("a", "b", *(c + side for c in columns for side in "ab"))

    near = cut(beside(pairs, sketches, "n", "sketch").mapInArrow(trimmed(close), "a long, b long"), "near")
    sets = cut(sets_for(near.select(F.col("a").alias("fp")).unionByName(near.select(F.col("b").alias("fp")))), "sets")
    links = cut(beside(near, sets, "set").mapInArrow(trimmed(exact), "a long, b long"), "links")
    drop(sets, near)
    return links


def _meetings(rows: DataFrame, sizes: DataFrame) -> DataFrame:
    """(key, i, j, tile, fp, comp): the sets of two tiles i and j of a key, whose number follows its sets and their shingles (sizes: fp, n), so that no meeting grows with the length of texts."""
    total = rows.join(sizes, "fp").groupBy("key").agg(F.sum("n").alias("shingles"))
    tiles = F.greatest(F.ceil(F.col("size") / F.lit(TILE)), F.ceil(F.col("shingles") / F.lit(TILE_SHINGLES))).cast("int")
    dealt = rows.join(total, "key").withColumn("tiles", tiles).withColumn("tile", F.pmod(F.xxhash64("fp", F.lit(11)), F.col("tiles")).cast("int"))
    return dealt.withColumn("other", F.explode(F.sequence(F.lit(0), F.col("tiles") - 1))).select("key", F.least("tile", "other").alias("i"), F.greatest("tile", "other").alias("j"), "tile", "fp", "comp")


def _tiles(rows: DataFrame, sizes: DataFrame, sets: DataFrame, part: int, whole: int) -> DataFrame:
    """Links within large keys, exactly: the sets of a key are dealt into tiles, and every two tiles of a key meet in one task; pairs already in one component are passed over. Of each meeting only the links of a spanning forest are given."""
    full = _meetings(rows, sizes).join(sets.select("fp", "set"), "fp").select("key", "i", "j", "tile", "fp", "comp", "set")

    def links(key, t):
        i, j = key[1].as_py(), key[2].as_py()
        tile, fp, comp = (t.column(c).to_numpy() for c in ("tile", "fp", "comp"))
        s = [np.frombuffer(x.as_buffer(), U) for x in t.column("set").combine_chunks()]
        left, right = np.flatnonzero(tile == i), np.flatnonzero(tile == j)
        size = np.array([len(x) for x in s])
        flat, own = np.concatenate(s), np.repeat(np.arange(len(s)), size)
        token, at, many = np.unique(flat, return_inverse=True, return_counts=True)
        common = np.zeros((len(s), len(s)), np.float32)
        shared = many[at] > 1
        at, own = at[shared], own[shared]
        order = np.argsort(at, kind="stable")
        at, own = at[order], own[order]
        step = np.r_[0, np.flatnonzero(at[1:] != at[:-1]) + 1, len(at)] if len(at) else np.zeros(1, np.int64)
        for lo in range(0, len(step) - 1, 4096):
            hi = min(lo + 4096, len(step) - 1)
            m = np.zeros((len(s), hi - lo), np.float32)
            part_ = slice(step[lo], step[hi])
            m[own[part_], np.repeat(np.arange(hi - lo), np.diff(step[lo : hi + 1]))] = 1
            common += m @ m.T
        c = common[np.ix_(left, right)].astype(np.int64)
        ok = (whole * c >= part * (size[left][:, None] + size[right] - c)) & (comp[left][:, None] != comp[right])
        root: dict[int, int] = {}

        def find(x):
            while root.get(x, x) != x:
                x = root[x]
            return x

        a, b = [], []
        for x, y in zip(*np.nonzero(ok)):
            p, q = find(int(comp[left[x]])), find(int(comp[right[y]]))
            if p != q:
                root[max(p, q)] = min(p, q)
                a.append(fp[left[x]])
                b.append(fp[right[y]])
        return pa.table({"a": pa.array(a, pa.int64()), "b": pa.array(b, pa.int64())})

    return full.groupBy("key", "i", "j").applyInArrow(links, "a long, b long")


def _star_pairs(keyed: DataFrame, comp: DataFrame | None, tried: DataFrame | None) -> DataFrame:
    """One pair (a, b) for each set b that has a key in which another component is the smallest: with the first set a of that component in most of its keys. comp: (id, component) of linked sets."""
    own = _components_of(keyed, comp)
    low = own.groupBy("key").agg(F.min(F.struct("comp", "fp")).alias("low"), F.max("comp").alias("high")).where("low.comp < high").select("key", F.col("low.fp").alias("a"), F.col("low.comp").alias("c"))
    met = own.join(low, "key").where("comp <> c").select("a", F.col("fp").alias("b"))
    if tried is not None:
        met = met.join(tried, ["a", "b"], "left_anti")
    counts = met.groupBy("b", "a").agg(F.count("*").alias("m"))
    return counts.groupBy("b").agg(F.max(F.struct("m", "a")).alias("best")).select(F.col("best.a").alias("a"), "b")


def _components_of(keyed: DataFrame, comp: DataFrame | None) -> DataFrame:
    if comp is None:
        return keyed.withColumn("comp", F.col("fp"))
    return keyed.join(comp.select(F.col("id").alias("fp"), "component"), "fp", "left").select("key", "fp", F.coalesce("component", "fp").alias("comp"))


def components_of_rows(docs: DataFrame, k: int = 4, part: int = 85, whole: int = 100) -> DataFrame:
    """(doc_id, h, n, fp, component) of each row; h: hash of its text, fp: name of its set, component: the smallest name that its set is linked with, null without words."""
    small_batches(docs.sparkSession)
    docs = docs.select(F.col("doc_id").cast("long").alias("doc_id"), "text", F.xxhash64("text").alias("h"))
    mapped = cut(_mapped(docs, k, (part, whole), meeting.parts_for(docs)), "mapped")
    light = cut(mapped.where(F.col("part") == meeting.OTHER).drop("part", "chunk", "data"), "light")
    named = light.where("fp is not null")
    total = light.count()
    shared = meeting.shared_keys(mapped).join(named.select("id", "fp"), "id").select("key", "fp").distinct()
    every = cut(shared, "shared-keys")
    drop(mapped)
    thin = cut(_thinned(every, Bands(part, whole)), "thin-keys")
    several = thin.groupBy("key").agg(F.count("*").alias("m")).where("m > 1").select("key")
    keyed = cut(thin.join(several, "key"), "keys")
    drop(every, thin)
    reps = cut(named.groupBy("fp").agg(F.min(F.struct("doc_id", "h")).alias("rep")).select("fp", F.xxhash64("rep.doc_id", "rep.h").alias("x")), "names")
    sketches = cut(named.where("sketch is not null").join(keyed.select("fp").distinct(), "fp", "left_semi").select("fp", "n", "sketch").dropDuplicates(["fp"]), "sketches")
    sets_for = lambda wanted: _sets(docs, k, wanted, reps, total)
    links, tried, comp, used = None, None, None, []
    for _ in range(STARS):
        pairs = cut(_star_pairs(keyed, comp, tried), "pairs")
        new = _linked(pairs, sketches, sets_for, part, whole)
        used += [pairs, new]
        tried = pairs if tried is None else tried.unionByName(pairs)
        links = new if links is None else links.unionByName(new)
        comp = connected_components(links)
    # Keys whose sets are in several components still.
    own = _components_of(keyed, comp)
    sizes = own.groupBy("key").agg(F.count("*").alias("size"), F.min("comp").alias("c0"), F.max("comp").alias("c1")).where("c0 < c1").select("key", "size")
    rest = cut(own.join(sizes, "key").select("key", "fp", "comp", "size"), "rest")
    small, large = rest.where(F.col("size") <= LARGE), rest.where(F.col("size") > LARGE)
    pairs = (
        small.select("key", F.col("fp").alias("a"), F.col("comp").alias("ca"))
        .join(small.select("key", F.col("fp").alias("b"), F.col("comp").alias("cb")), "key")
        .where("a < b and ca <> cb").select("a", "b").distinct().join(tried, ["a", "b"], "left_anti")
    )
    links = links.unionByName(_linked(pairs, sketches, sets_for, part, whole))
    if not large.isEmpty():
        sets = cut(sets_for(large), "sets")
        used.append(sets)
        links = links.unionByName(_tiles(large, sketches.select("fp", "n"), sets, part, whole))
    links = cut(links, "links")
    drop(keyed, rest, sketches, reps, *used)
    groups = connected_components(links)
    drop(links)
    return light.select("doc_id", "h", "n", "fp").join(groups.select(F.col("id").alias("fp"), "component"), "fp", "left").select("doc_id", "h", "n", "fp", F.coalesce("component", "fp").alias("component"))


def jaccard_components(docs: DataFrame, k: int = 4, part: int = 85, whole: int = 100) -> DataFrame:
    """(doc_id, n_shingles, component_id) of each document."""
    rows = cut(components_of_rows(docs, k, part, whole), "components")
    smallest = rows.where("component is not null").groupBy("component").agg(F.min("doc_id").alias("component_id"))
    return rows.join(smallest, "component", "left").select("doc_id", F.col("n").alias("n_shingles"), F.coalesce("component_id", "doc_id").alias("component_id"))


def keep_one(docs: DataFrame, k: int = 5, part: int = 80, whole: int = 100) -> DataFrame:
    """The documents (all columns), one of each component: that with the smallest id, of several texts with that id the one whose hash is smallest; null ids come last. A row repeated with id and text is one document, all of whose rows stay or go."""
    rows = cut(components_of_rows(docs, k, part, whole).select(F.coalesce(F.col("doc_id"), F.lit((1 << 63) - 1)).alias("id"), "h", "component").where("component is not null"), "components")
    first = rows.groupBy("component").agg(F.min(F.struct("id", "h")).alias("first"))
    gone = rows.join(first, "component").where("id <> first.id or h <> first.h").select("id", "h").distinct()
    own = docs.select(F.struct(*(F.col(f"`{c}`") for c in docs.columns)).alias("row"), F.coalesce(F.col("doc_id").cast("long"), F.lit((1 << 63) - 1)).alias("id"), F.xxhash64("text").alias("h"))
    return own.join(gone, ["id", "h"], "left_anti").select("row.*")


def query(spark: SparkSession, sf_dir: str) -> DataFrame:
    return jaccard_components(table(spark, sf_dir, "documents"))
