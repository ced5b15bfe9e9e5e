"""Hard negatives, periodic runs and the quality classifier: brute force, SQL, odd rows, held-out rows."""

import hashlib
import math
import random
import re
import zlib
from fractions import Fraction

import duckdb
import numpy as np
import pytest
from pyspark.sql import functions as F

from rastrum.llm import hard_negatives, periodic_runs, quality_classifier, registry

SF = "/root/testdata/sf0.001"
WORD = re.compile(r"[^\x20\x09-\x0D]+")
KIND = "vec_id long, embedding array<float>, label int"


def brute_negatives(rows):
    live = []
    for i, e, y in rows:
        if y is None or e is None or any(v is None or not math.isfinite(v) for v in e):
            continue
        live.append((i, [math.floor(256 * float(np.float32(v))) for v in e], (y + 1) % 10 if i is not None and i % 7 == 0 else y))
    dim = max((len(x) for _, x, _ in live), default=0)
    live = [(i, x + [0] * (dim - len(x)), y) for i, x, y in live]
    key = lambda r: (-r[1], math.inf if r[0] is None else r[0])
    out = []
    for a, (i, x, y) in enumerate(live):
        if i is None or i % 50:
            continue
        all_ = [(j, sum(p * q for p, q in zip(x, z)), k == y) for b, (j, z, k) in enumerate(live) if b != a]
        for j, p, _ in sorted((r for r in all_ if r[2]), key=key)[:5]:
            inside = sorted((r for r in all_ if not r[2] and 50 * p <= 100 * r[1] <= 95 * p), key=key)[:3]
            out += [(i, j, k + 1, n, p, s) for k, (n, s, _) in enumerate(inside)]
    return sorted(out, key=repr)


def mined(df):
    return sorted(((r["anchor_id"], r["positive_id"], r["rank"], r["negative_id"], r["positive_score"], r["negative_score"]) for r in hard_negatives.hard_negatives(df).collect()), key=repr)


def odd_vectors(n=260, dim=6, seed=3):
    rnd = random.Random(seed)
    base = [[rnd.uniform(-1, 1) for _ in range(dim)] for _ in range(20)]
    rows = [(i, [v + rnd.gauss(0, 0.2) for v in base[i % 20]] if i % 3 else base[7], i % 4) for i in range(n)]  # a third are copies of one vector
    rows += [(300, None, 1), (350, [float("nan")] * dim, 1), (351, [float("inf")] + [0.0] * (dim - 1), 2), (352, [None] + [0.1] * (dim - 1), 2), (353, base[1], None)]
    rows += [(None, base[2], 1), (None, base[2], 2), (400, [], 1), (450, base[3][:2], 3), (100, base[5], 0), (100, base[5], 0), (500, [0.0] * dim, 2), (550, [300.0] * dim, 1)]
    return rows


def test_negatives_on_odd_rows(spark):
    rows = odd_vectors()
    df = spark.createDataFrame(rows, KIND).withColumn("rid", F.lit("x")).withColumn("x", F.lit(1)).withColumn("score", F.lit(None).cast("int"))
    assert mined(df) == brute_negatives(rows)


def test_negatives_in_many_blocks(spark, monkeypatch):
    monkeypatch.setattr(hard_negatives, "ROW_BLOCK", 40)
    monkeypatch.setattr(hard_negatives, "ANCHOR_BLOCK", 3)
    monkeypatch.setattr(hard_negatives, "SAMPLE", 30)
    rows = odd_vectors(seed=5)
    assert mined(spark.createDataFrame(rows, KIND)) == brute_negatives(rows)


def test_negatives_of_nothing(spark):
    assert mined(spark.createDataFrame([], KIND)) == []
    assert mined(spark.createDataFrame([(50, [0.5, 0.5], 1)], KIND)) == []
    assert mined(spark.createDataFrame([(50, None, 1), (100, [0.1], None)], KIND)) == []


def test_negatives_against_sql(spark):
    con = duckdb.connect()
    con.execute(f"CREATE VIEW embeddings AS SELECT * FROM '{SF}/embeddings.parquet'")
    want = sorted(con.sql(f"SELECT anchor_id, positive_id, rank, negative_id, positive_score, negative_score FROM ({hard_negatives.ORACLE_SQL})").fetchall(), key=repr)
    assert want and mined(spark.read.parquet(f"{SF}/embeddings.parquet")) == want


def test_bounds_hold_every_score():
    rnd = np.random.default_rng(2)
    x = rnd.integers(-150, 150, (400, 8))
    books = hard_negatives.codebooks(x[:60])
    codes, norm = hard_negatives.quantised(x, books)
    a = rnd.integers(-150, 150, (30, 8))
    decoded = np.concatenate([books[j][codes[:, j]] for j in range(4)], 1)
    width = np.sqrt((a**2).sum(1))[:, None] * (1 + 1e-9) * norm
    assert (np.abs(a @ x.T - a @ decoded.T) <= width + 1e-6).all()


def test_too_large_components_are_named(spark):
    with pytest.raises(ArithmeticError):
        hard_negatives.hard_negatives(spark.createDataFrame([(50, [1e15], 1), (51, [1.0], 1)], KIND))


def brute_runs(w):
    """All runs from the definition: for each period the maximal stretches that have it, less those with a smaller one."""
    found, n = {}, len(w)
    for q in range(1, n // 4 + 1):
        i = 0
        while i + q < n:
            j = i
            while j + q < n and w[j] == w[j + q]:
                j += 1
            if j > i and j + q - i >= max(6, 4 * q):
                x = w[i : j + q]
                if not any(x[r:] == x[:-r] for r in range(1, q)):
                    found[i, j + q - i, q] = 1
            i = max(j, i + 1)
    return sorted(found, key=lambda r: (r[0], r[2]))


def brute_digest(doc_id, text):
    w = WORD.findall(text or "")
    n = len(w)
    h = zlib.crc32(str(doc_id).encode()) if doc_id is not None else 1
    if h % 10 == 0 and n:
        g = h // 10
        a = g % n
        p = 1 + (n - a) // (3 + g % 8)
        w = [w[i] if i < a else w[a + (i - a) % p] for i in range(n)]
    runs = brute_runs(w)
    gone = {i for s, m, p in runs for i in range(s + p, s + m)}
    best = max(runs, key=lambda r: (Fraction(r[1], r[2]), -r[0], -r[2]), default=None)
    return (
        doc_id, len(runs), *(best or (None,) * 3), best and 1000 * best[1] // best[2],
        hashlib.sha256("".join(f"{s},{m},{p}\n" for s, m, p in runs).encode()).hexdigest(), hashlib.sha256(" ".join(x for i, x in enumerate(w) if i not in gone).encode()).hexdigest(),
    )


COLUMNS = ["doc_id", "n_runs", "start", "length", "period", "exponent_milli", "runs_sha256", "collapsed_sha256"]


def test_runs_of_short_words():
    rnd = random.Random(1)
    for _ in range(600):
        docs = []
        for _ in range(rnd.randrange(1, 5)):
            w = [rnd.choice(rnd.choice(["ab", "abc", "a", "abcdef"])) for _ in range(rnd.randrange(70))]
            if rnd.random() < 0.6 and len(w) > 8:
                p, s = rnd.randrange(1, 9), rnd.randrange(len(w))
                for t in range(s + p, rnd.randrange(s, len(w) + 1)):
                    w[t] = w[t - p]
            docs.append(w)
        got = periodic_runs.runs_of(np.array([ord(c) for w in docs for c in w], np.int64), np.cumsum([0, *map(len, docs)]))
        for i, w in enumerate(docs):
            assert [tuple(r) for r in got[got[:, 0] == i, 1:].tolist()] == brute_runs(w)


def test_runs_in_small_portions(monkeypatch):
    w = [c for c in "abab" * 40 + "xyz" * 30 + "q" * 50]
    ids, bounds = np.array([ord(c) for c in w]), np.array([0, len(w)])
    whole = periodic_runs.runs_of(ids, bounds)
    monkeypatch.setattr(periodic_runs, "TESTS", 3)
    assert (periodic_runs.runs_of(ids, bounds) == whole).all() and len(whole) == 3


def test_runs_on_the_table_and_odd_rows(spark):
    real = [(r["doc_id"], r["text"]) for r in spark.read.parquet(f"{SF}/documents.parquet").select("doc_id", "text").collect()]
    odd = [None, "", " \n\t", "one", "a " * 6, "a b " * 4, "ä\x00ö " * 9, "x" * 5000, "z\n" * 3000, "p q r s t " * 700, "a a a a a a b a a a a a a"]
    rows = [r for r in real if len(r[1] or "") < 20_000] + [(10_000 + i, t) for i, t in enumerate(odd)] + [(10_005, "a b a b")] * 2 + [(None, "c d " * 30), (None, None)]
    df = spark.createDataFrame([(i, t, "en", 3, "s") for i, t in rows], "doc_id long, text string, period string, n_runs int, start string")
    got = [tuple(r[c] for c in COLUMNS) for r in periodic_runs.periodic_runs(df).collect()]
    assert sorted(got, key=repr) == sorted((brute_digest(*r) for r in rows), key=repr)
    assert sum(r[1] for r in got) > 20


def test_runs_of_nothing(spark):
    assert periodic_runs.periodic_runs(spark.createDataFrame([], "doc_id long, text string")).collect() == []


def test_word_vectors_against_a_plain_sum(spark):
    texts = [None, "", "Red red red!! 12 and äö", "a b c d e f a b", "one"]
    rows = spark.createDataFrame([(t,) for t in texts], "text string").repartition(3)
    got = quality_classifier.word_vectors(rows).value
    index = quality_classifier._INDEX.astype(int)
    want = np.zeros(got.shape)
    for t in texts:
        pieces = re.findall(r"[^\W\d_]+|\d+|!+", t or "")
        slot = [int(quality_classifier.tokens(np.frombuffer(p.encode(), np.uint8), np.array([0, len(p.encode())]))[0][0]) for p in pieces]
        for i, s in enumerate(slot):
            for j in range(max(0, i - 2), min(len(slot), i + 3)):
                want[s] += index[slot[j]] if j != i else 0
    norm = np.sqrt((want**2).sum(1, keepdims=True))
    assert np.allclose(got, want / np.maximum(norm, 1e-6), atol=1e-6)


def test_gradients_by_differences():
    rnd = np.random.default_rng(1)
    x, y, weight = rnd.standard_normal((7, 5)), np.array([0, 1, 1, 0, 1, 0, 0.0]), rnd.random(7) + 0.5
    m = {"mean": np.zeros(5), "scale": np.ones(5), "w1": rnd.standard_normal((5, 4)), "b1": rnd.standard_normal(4), "w2": rnd.standard_normal(4), "b2": 0.3, "temperature": 1.0}

    def loss(m):
        z = quality_classifier.logits(m, x)
        return float(np.mean(weight * (np.logaddexp(0, z) - y * z)))

    for k, g in quality_classifier.gradients(m, x, y, weight).items():
        for at in np.ndindex(np.shape(m[k])):
            hi, lo = ({**m, k: np.array(m[k], float)} for _ in range(2))
            hi[k][at] += 1e-6
            lo[k][at] -= 1e-6
            assert abs((loss(hi) - loss(lo)) / 2e-6 - np.asarray(g)[at]) < 1e-6


def test_temperature_is_the_best_divisor():
    rnd = np.random.default_rng(4)
    z = rnd.standard_normal(3000) * 2
    y = (rnd.random(3000) < 1 / (1 + np.exp(-z))).astype(float)
    assert abs(np.log(quality_classifier.temperature(5 * z, y, np.ones(3000)) / 5)) < 0.15


def test_classifier_on_held_out_and_odd_rows(spark):
    docs, labels = (spark.read.parquet(f"/root/testdata/sf0.01/{t}.parquet") for t in ("documents", "labels"))
    odd = spark.createDataFrame([(-1, None), (-2, ""), (None, "Good words are here."), (-3, "\x00 \x7f"), (-4, "a" * 300_000), (-4, "a" * 300_000)], "doc_id long, text string")
    both = docs.select("doc_id", "text").unionByName(odd).withColumns({"score": F.lit("x"), "slot": F.lit(1), "y": F.lit(2)})
    got = quality_classifier.quality_scores(both, labels).toPandas()
    assert len(got) == docs.count() + 6 and got["score"].between(0, 1).all() and (got["predicted"] == (got["score"] >= 0.5)).all()
    held = labels.toPandas().merge(got[got["held_out"] & (got["doc_id"] >= 0)], on="doc_id")
    assert len(held) > 80 and (held["predicted"] == held["quality"]).mean() > 0.95
    assert not got[got["doc_id"].isna()]["held_out"].any()
    copies = got[got["doc_id"] == -4]["score"].tolist()
    assert copies[0] == copies[1]


def test_classifier_without_rows_or_labels(spark):
    docs = spark.createDataFrame([(1, "some text")], "doc_id long, text string")
    none, one = spark.createDataFrame([], "doc_id long, quality int"), spark.createDataFrame([(0, 1)], "doc_id long, quality int")
    assert [r["score"] for r in quality_classifier.quality_scores(docs, none).collect()] == [0.5]
    assert quality_classifier.quality_scores(docs.limit(0), none).collect() == []
    assert quality_classifier.quality_scores(docs, one).collect()[0]["score"] >= 0.5


def test_new_queries_are_registered(spark):
    found = registry.queries()
    for name in ("op11_hard_negatives", "op12_periodic_runs", "op13_quality_classifier"):
        assert found[name](spark, SF).count() > 0
    assert "op11_hard_negatives" in registry.oracle_sql()
