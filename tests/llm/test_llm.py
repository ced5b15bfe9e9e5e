"""Operators for training text against brute force, on small fixtures with nulls, empty and odd texts."""

import re
import zlib
from collections import Counter

import numpy as np
import pytest
from pyspark.sql import functions as F

from rastrum.llm import bpe, components, decontamination, html_text, language_id, ngram_jaccard, packing, quality_rules, registry, substring_dedup, token_counts, toxicity, url_filters

SF = "/root/testdata/sf0.001"
WORD = re.compile(r"[^\x20\x09-\x0D]+")
LOW = str.maketrans({i: i + 32 for i in range(65, 91)})
ODD = [None, "", "  \n\t ", "one", "One two", "a b c d e f", "Ärger über Öl " * 30, "x" * 5000, "z\n" * 400]


@pytest.fixture(scope="module")
def docs(spark):
    """The smallest table, odd texts, repeated rows, and a column whose name clashes."""
    real = [(r["doc_id"], r["text"]) for r in spark.read.parquet(f"{SF}/documents.parquet").collect()]
    rows = real + [(10_000 + i, t) for i, t in enumerate(ODD)] + [(10_005, "a b c d e f")] * 2 + [(20_000, real[3][1]), (20_001, real[3][1] + " more")]
    return spark.createDataFrame([(i, t, "en", None, 7) for i, t in rows], "doc_id long, text string, lang string, source string, n long"), rows


@pytest.fixture(scope="module")
def labels(spark):
    return spark.read.parquet(f"{SF}/labels.parquet")


def empty(spark):
    return spark.createDataFrame([], "doc_id long, text string, lang string, source string, n_chars long")


def brute_components(rows, k, part, whole):
    sets = []
    for _, t in rows:
        w = WORD.findall((t or "").translate(LOW))
        sets.append({tuple(w[i : i + k]) for i in range(max(1, len(w) - k + 1))} if w else set())
    up = list(range(len(rows)))

    def find(x):
        while up[x] != x:
            x = up[x]
        return x

    for i, a in enumerate(sets):
        for j in range(i):
            common = len(a & sets[j])
            if common and whole * common >= part * (len(a) + len(sets[j]) - common):
                up[find(i)] = find(j)
    low = {}
    for i, (d, _) in enumerate(rows):
        low[find(i)] = min(low.get(find(i), d), d)
    return sorted((d, len(s), low[find(i)]) for i, ((d, _), s) in enumerate(zip(rows, sets)))


def test_ngram_jaccard(docs):
    df, rows = docs
    got = sorted((r["doc_id"], r["n_shingles"], r["component_id"]) for r in ngram_jaccard.jaccard_components(df).collect())
    assert got == brute_components(rows, 4, 85, 100)


def test_near_copies_in_tiles(spark, monkeypatch):
    import random

    monkeypatch.setattr(ngram_jaccard, "LARGE", 8)
    rnd = random.Random(4)
    base = [f"w{rnd.randrange(10**6)}" for _ in range(120)]
    rows = []
    for i in range(150):
        w = list(base)
        for _ in range(rnd.randrange(6)):
            w[rnd.randrange(len(w))] = f"x{rnd.randrange(10**6)}"
        rows.append((i, " ".join(w)))
    got = sorted((r["doc_id"], r["n_shingles"], r["component_id"]) for r in ngram_jaccard.jaccard_components(spark.createDataFrame(rows, "doc_id long, text string")).collect())
    assert got == brute_components(rows, 4, 85, 100)


def test_components(spark):
    edges = spark.createDataFrame([(i, i + 1) for i in range(30)] + [(50, 60), (60, 55), (70, 70), (None, 3)], "a long, b long")
    got = {r["id"]: r["component"] for r in components.connected_components(edges).collect()}
    assert got == {i: 0 for i in range(31)} | {50: 50, 55: 50, 60: 50}


def test_quality_counts(docs, labels):
    df, rows = docs
    got = {(r["doc_id"], r["n_words"], r["word_chars"], r["n_symbols"], r["n_dup_lines"], r["n_repeat_words"]) for r in quality_rules.quality_rules(df, labels).collect()}
    for d, t in rows:
        t = t or ""
        w = WORD.findall(t)
        five = Counter(tuple(w[i : i + 5]) for i in range(len(w) - 4))
        covered = {j for i in range(len(w) - 4) if five[tuple(w[i : i + 5])] > 1 for j in range(i, i + 5)}
        lines = [x for x in t.split("\n") if WORD.search(x)]
        assert (d, len(w), sum(map(len, w)), len(re.findall(r"[#*$%&|<>]", t)), len(lines) - len(set(lines)), len(covered)) in got


def test_tokens_and_packing(docs):
    import numpy as np
    import public_tokenizers as P
    from tokenizers import Tokenizer

    df, rows = docs
    rows = [(d, t or "") for d, t in rows]
    library = Tokenizer.from_file(P.path("byte_bpe_50k.json"))
    ids = {(d, t): e.ids for (d, t), e in zip(rows, library.encode_batch([t for _, t in rows], add_special_tokens=False))}
    got = sorted((r["doc_id"], r["n_bytes"], r["n_tokens"], r["over_limit"]) for r in token_counts.count_tokens(df, P.path("byte_bpe_50k.json")).collect())
    assert got == sorted((d, len(t.encode()), len(ids[d, t]), len(ids[d, t]) > 1024) for d, t in rows)
    pieces = packing.pack(df, P.path("byte_bpe_50k.json")).collect()
    want = Counter((d, len(ids[d, t]) + 1) for d, t in rows)
    assert Counter((p["doc_id"], p["doc_tokens"]) for p in pieces if p["start"] == 0) == want
    text = {d: np.array(ids[d, t] + [0], "<u4") for d, t in rows}
    ends: dict = {}
    for p in sorted(pieces, key=lambda p: (p["sequence_id"], p["offset"])):
        assert p["offset"] == ends.get(p["sequence_id"], 0) and p["offset"] + p["length"] <= 1024
        ends[p["sequence_id"]] = p["offset"] + p["length"]
        assert zlib.crc32(text[p["doc_id"]][p["start"] : p["start"] + p["length"]].tobytes()) == p["ids_crc32"]
    assert sum(p["length"] for p in pieces) == sum(n * c for (_, n), c in want.items())


def test_splitter_matches_library():
    import random

    import public_tokenizers as P
    from tokenizers import Tokenizer

    machine = bpe.transducer(P.path("byte_bpe_50k.json"))
    rnd = random.Random(3)
    alphabet = "ab 's'tre'lldm\n\t  　é漢字1٣²!?.'''  "
    texts = ["", " ", "a<|endoftext|><|endoftext|> b", "a" * 3000, *("".join(rnd.choice(alphabet) for _ in range(rnd.randint(1, 60))) for _ in range(800))]
    want = [e.ids for e in Tokenizer.from_file(P.path("byte_bpe_50k.json")).encode_batch(texts, add_special_tokens=False)]
    got = [[i for x in p for i in ((machine.v.special[x],) if isinstance(x, str) else machine.encode(x))] for p in bpe.pieces(texts, machine.v.special)]
    assert got == want


def test_packing_blanks_repeats_and_many_ranges(spark, monkeypatch):
    import numpy as np
    import public_tokenizers as P
    from tokenizers import Tokenizer

    path = P.path("byte_bpe_50k.json")
    rows = [(1, " " * 1_000_000 + "a"), (2, "x" + "\n" * 5000 + "y"), (3, "\t" * 9000), (None, "no id"), (4, "")] + [(5, "one row " * 40)] * 300 + [(6 + i, f"word{i} " * 50) for i in range(300)]
    df = spark.createDataFrame([(i, t, 1) for i, t in rows], "doc_id long, text string, part int").repartition(3)
    library = Tokenizer.from_file(path)
    for size in (packing.RANGE_BYTES, 100_000):
        monkeypatch.setattr(packing, "RANGE_BYTES", size)
        pieces = packing.pack(df, path).collect()
        whole = {}
        for p in pieces:
            if p["start"] == 0:
                whole[p["doc_id"], p["doc_tokens"]] = whole.get((p["doc_id"], p["doc_tokens"]), 0) + 1
        assert whole == Counter((i, len(library.encode(t, add_special_tokens=False).ids) + 1) for i, t in rows)
        tokens, sequences = sum(p["length"] for p in pieces), len({p["sequence_id"] for p in pieces})
        assert sequences <= -(-tokens // 1024) + 1_200_000 // size + 2
    one = next(p for p in pieces if p["doc_id"] == 2)
    ids = np.array([*library.encode(rows[1][1], add_special_tokens=False).ids, 0], "<u4")
    assert one["ids_crc32"] == zlib.crc32(ids[one["start"] : one["start"] + one["length"]].tobytes())


def test_hilbert_is_a_walk():
    import itertools

    import numpy as np

    cells = np.array(list(itertools.product(range(8), repeat=3)))
    key = packing.hilbert(cells, 3)
    assert sorted(key) == list(range(512))
    assert (np.abs(np.diff(cells[np.argsort(key)], axis=0)).sum(1) == 1).all()


def test_language(spark):
    d = spark.read.parquet(f"{SF}/documents.parquet")
    extra = spark.createDataFrame([(900_001, None, "en"), (900_002, "", None), (900_003, "12 34 !!", "de"), (900_004, "\u0301\u0300 \u0301", None)], "doc_id long, text string, lang string")
    got = language_id.identify(d.select("doc_id", "text", "lang").unionByName(extra)).join(d.select("doc_id", F.col("lang").alias("truth")), "doc_id", "left").collect()
    assert all(r["lang_pred"] == "und" and r["score"] == 0 for r in got if r["doc_id"] > 900_000)
    held = [r for r in got if r["held_out"] and r["truth"]]
    assert sum(r["lang_pred"] == r["truth"] for r in held) >= 0.95 * len(held)


def test_toxicity_gradients():
    import numpy as np

    rng = np.random.default_rng(0)
    m = toxicity.start()
    px, size = rng.standard_normal((4, toxicity.WINDOW, 6 * toxicity.HIDDEN)).astype(np.float32) * 0.5, np.array([32, 5, 1, 17])
    logit, *kept = toxicity.forward(m, px, size, keep=True)
    grad, gx = toxicity.backward(m, np.ones(4, np.float32), size, *kept)
    for name, at in (("u", (0, 3, 5)), ("u", (1, 2, 20)), ("wa", (3, 1)), ("va", (2,)), ("wo", (6,))):
        old, e = m[name][at], 1e-2
        m[name][at] = old + e
        up = toxicity.forward(m, px, size).sum()
        m[name][at] = old - e
        down = toxicity.forward(m, px, size).sum()
        m[name][at] = old
        assert abs((up - down) / (2 * e) - grad[name][at]) < 0.02 * max(1, abs(grad[name][at]))
    assert gx[2, 5:].any() == False  # noqa: E712  beyond a window's words nothing flows


def test_toxicity(spark):
    text = "the of and in to " * 12
    rows = [(i, (text + ("you idiot scum " if i % 2 else "you kind soul ") + text + f"w{i}")) for i in range(300)]
    lab = spark.createDataFrame([(i, 1, i % 2) for i, _ in rows], "doc_id long, quality int, toxic int")
    got = toxicity.toxicity(spark.createDataFrame(rows + [(900, None), (901, "")], "doc_id long, text string"), lab).collect()
    held = [r for r in got if r["held_out"] and r["doc_id"] < 900]
    assert held and all(r["predicted"] == r["doc_id"] % 2 for r in held)
    assert all(r["score"] == 0 for r in got if r["doc_id"] >= 900)


def test_html():
    page = """<html><body><header><h1>Site</h1></header><div class="nav"><a href=x>Home</a></div><div class=cookie-notice>We use cookies, ok.</div>
    <div id="content"><h2>Title here</h2><p>First, some text, long enough to score well, yes.<p>Second &amp; more,   with commas.<div class="ad">Buy now, cheap</div>
    <ul><li>point one, with text</li></ul></div><div id=comments><p>I like this, really, a long comment, with many words, and commas, everywhere.</p></div><aside>Side, text</aside><script>var a="<p>x</p>";</script></body></html>"""
    listed = "<article><p>Some prose, long enough, with commas, and more of it, here.</p><ul><li><a href=x>A source of the article</a></li></ul></article>"
    assert html_text.main_text(listed).endswith("\n\nA source of the article")
    assert html_text.main_text(f"<body><form action=x>{listed}</form></body>") == html_text.main_text(listed)
    assert html_text.main_text("<p>Prose, with commas, and so on, and more.</p><form><p>Name</p></form>") == "Prose, with commas, and so on, and more."
    assert html_text.main_text(page) == "Title here\n\nFirst, some text, long enough to score well, yes.\n\nSecond & more, with commas.\n\npoint one, with text"
    assert [html_text.main_text(x) for x in (None, "", "plain", "<p>", "&lt;b&gt;", "<div>" * 3000 + "deep" + "</div>" * 3000)] == ["", "", "plain", "", "<b>", "deep"]


def test_url_aliases(spark):
    pages = spark.createDataFrame(
        [(1, "http://a.org/x?1#f", '<link rel=canonical href="//b.net/fr/z">'), (2, "http://b.net/fr/z", None), (3, "https://c.org/", '<meta http-equiv="refresh" content="0; url=http://a.org/x?1">'), (4, None, "x"), (5, "nope", None), (6, "http://D.org/q", '<LINK href="/w" rel="canonical">'), (7, "http://d.org/w", '<link rel=canonical href="https://www.e.com/">')],
        "page_id long, url string, html string",
    )
    got = {r["page_id"]: (r["host"], r["rule"], r["verdict"]) for r in url_filters.url_filters(pages).collect()}
    assert got == {1: ("a.org", None, "block"), 2: ("b.net", "net/fr/", "block"), 3: ("c.org", None, "block"), 4: ("", None, "allow"), 5: ("", None, "allow"), 6: ("d.org", None, "allow"), 7: ("d.org", None, "allow")}


def test_url_alias_in_mixed_case(spark):
    pages = spark.createDataFrame([(1, "http://a.org/x", '<link rel=CaNoNiCaL href="http://b.net/fr/z">')], "page_id long, url string, html string")
    assert [r["verdict"] for r in url_filters.url_filters(pages).collect()] == ["block"]


def test_url_targets_of_every_kind(spark):
    import duckdb

    tag = '<LINK REL="canonical" HREF="{}">'.format
    rows = [
        (1, "http://a.org/x/p.html", tag("z.html")), (2, "http://a.org/x/z.html", tag("//b.net/es/q")), (3, "http://c.org/a/b/c", tag("../../d/./e")), (4, "http://c.org/d/e", tag("http://b.net/fr/")),
        (5, "http://d.org/s?k=1", tag("?k=2")), (6, "http://d.org/s?k=2", tag("https://net/es/1")), (7, "http://e.org", tag("up")), (8, "http://e.org/up", '<meta http-equiv=refresh content="0;URL=//x.net/fr/a">'),
        (9, "http://f.org/1", "<!-- " + tag("http://b.net/es/") + " -->"), (10, "http://g.org/1", "<script>var a='" + tag("http://b.net/es/") + "';</script>"), (11, "http://h.org/", tag("mailto:a@b.c")),
        (12, "http://i.org/a/", tag("../../../b/..")), (13, "http://i.org/", tag("//net/es/")), (14, None, tag("x")), (None, "http://a.org/x/p.html", None), (15, "nope", tag("http://net/es/")),
        (16, "http://j.org/a?b#c", tag("#d")), (17, "http://j.org/a?b", tag("http://net/fr/")), (18, "http://net/es/", None), (18, "http://net/es/", None), (19, "", ""),
    ]
    pages = spark.createDataFrame([(*r, "x") for r in rows], "page_id long, url string, html string, address string")
    got = sorted(repr(tuple(r)) for r in url_filters.url_filters(pages).collect())
    con = duckdb.connect()
    con.execute("CREATE TABLE pages (page_id BIGINT, url VARCHAR, html VARCHAR)")
    con.executemany("INSERT INTO pages VALUES (?, ?, ?)", rows)
    assert got == sorted(repr(tuple(r)) for r in con.sql(f"SELECT page_id, host, path, rule, verdict FROM ({url_filters.ORACLE_SQL})").fetchall())
    assert {r[0] for r in map(eval, got) if r[4] == "block"} == {*range(1, 9), 12, 13, 16, 17, 18, None}


def passage(n, seed):
    import random

    rnd = random.Random(seed)
    return " ".join(f"t{rnd.randrange(10**7)}" for _ in range(n))


@pytest.mark.parametrize("small", [24, 3])
def test_passages(spark, monkeypatch, small):
    monkeypatch.setattr(substring_dedup, "SMALL", small)
    shared, edited = passage(60, 1), passage(80, 2)
    changed = edited.split()
    changed[40] = "other"
    rows = [(i, f"{passage(30, 100 + i)} {shared} {passage(30, 200 + i)}") for i in range(8)]
    rows += [(20, edited), (21, f"{passage(10, 300)} {' '.join(changed)}"), (30, passage(200, 5)), (31, None), (32, ""), (33, "a b"), (40, passage(70, 9)), (41, passage(70, 9)), (42, passage(70, 9))]
    got = {}
    for r in substring_dedup.passages(spark.createDataFrame(rows, "doc_id long, text string")).collect():
        got.setdefault(r["doc_id"], set()).update(range(r["first_word"], r["first_word"] + r["n_words"]))
    assert set(got) == {*range(1, 8), 21, 41, 42}
    assert all(set(range(30, 90)) <= got[i] and len(got[i]) <= 64 for i in range(1, 8))
    assert len(got[21]) >= 78 and len(got[41]) == 70
    left = {r["doc_id"]: r["text"] for r in substring_dedup.remove_passages(spark.createDataFrame(rows, "doc_id long, text string")).collect()}
    assert left[0] == rows[0][1] and shared not in left[3] and left[3].startswith(passage(30, 103)) and left[42] == ""


def test_runs_at_every_place():
    import numpy as np

    at = iter(range(10**6))
    some = lambda n: [next(at) for _ in range(n)]
    runs = lambda x, y: substring_dedup.all_runs(np.array(x, np.uint32), np.array(y, np.uint32), 46, 0.8)
    line, one, two = some(30), some(96), some(70)
    assert runs(some(100) + line + one, line + some(300) + line + one) == [(100, 126, 330, 126, 1.0)]
    got = runs(some(100) + line + one + some(50) + two, line + some(300) + one + some(20) + two)
    assert sorted(got) == [(130, 96, 330, 96, 1.0), (276, 70, 446, 70, 1.0)]
    rng = np.random.default_rng(1)
    fresh = lambda n: rng.integers(0, 2**32, n).astype(np.uint32)
    for _ in range(60):
        blocks = [fresh(rng.integers(5, 90)) for _ in range(6)]
        x, y = (np.concatenate([blocks[rng.integers(6)] if rng.random() < 0.5 else fresh(rng.integers(5, 60)) for _ in range(rng.integers(3, 14))]) for _ in range(2))
        found = substring_dedup.all_runs(x, y, 46, 0.8)
        for first, n, there, m, s in found:
            a, b = set(x[first : first + n].tolist()), set(y[there : there + m].tolist())
            assert n >= 46 and s >= 0.8 and abs(len(a & b) / len(a | b) - s) < 1e-9
        covered = {i for f in found for i in range(f[0], f[0] + f[1])}
        have = {y[j : j + 46].tobytes() for j in range(len(y) - 45)}
        assert all(set(range(i, i + 46)) <= covered for i in range(len(x) - 45) if x[i : i + 46].tobytes() in have)


def covered_words(spark, rows):
    """Covered places of each document under one hash function, so that each passage of 50 words has one key."""
    got = {}
    for r in substring_dedup.passages(spark.createDataFrame(rows, "doc_id long, text string"), functions=1).collect():
        got.setdefault(r["doc_id"], set()).update(range(r["first_word"], r["first_word"] + r["n_words"]))
    return got


def key_place(text):
    import pyarrow as pa

    ((_, _, sh, *_),) = substring_dedup.shingled(pa.array([text]), 5)
    return int(substring_dedup._function(sh, 0).argmin())


def test_large_keys_lose_no_partner(spark, monkeypatch):
    monkeypatch.setattr(substring_dedup, "SMALL", 2)
    hot, shared = passage(60, 31), passage(50, 33)
    c = key_place(shared)
    line = " ".join(shared.split()[c : c + 5])
    # Document 0 has the line at which 3 and 4 share a passage, and another passage of both.
    around = next(t for t in (f"{passage(30, 1000 + i)} {line} {passage(30, 2000 + i)}" for i in range(2000)) if key_place(t) == 30)
    rows = [(0, f"{hot} {around}"), *((i, f"{hot} {passage(60, 50 + i)} {shared} {passage(50, 60 + i)}") for i in (3, 4))]
    got = covered_words(spark, rows)
    assert set(range(60)) <= got[3] and not got[3] & set(range(121, 169))
    assert set(range(60)) | set(range(120, 170)) <= got[4]


def test_chains_of_near_copies(spark, monkeypatch):
    monkeypatch.setattr(substring_dedup, "SMALL", 2)
    # One word differs from one to the next: 0.86 similar, and 0.74 over one between.
    for i in range(2000):
        base = passage(70, 3000 + i).split()
        second = [*base[:25], "y", *base[26:]]
        third = [*second[:45], "z", *second[46:]]
        texts = [" ".join(t) for t in (base, second, third)]
        if {key_place(t) for t in texts} <= set(range(26, 41)) and len({key_place(t) for t in texts}) == 1:
            break
    got = covered_words(spark, list(enumerate(texts)))
    assert set(range(70)) <= got[1] and set(range(70)) <= got[2]


def test_a_passage_around_a_common_line(spark):
    line, other = passage(10, 71), passage(60, 72)
    around = f"{passage(30, 73)} {line} {passage(30, 74)}"
    rows = [(i, f"{passage(40, 500 + i)} {line} {passage(40, 600 + i)}{' ' + other if i == 0 else ''}") for i in range(42)]
    rows += [(50, f"{passage(20, 700)} {around}"), (60, f"{around} {passage(15, 701)} {other}")]
    got = covered_words(spark, rows)
    assert set(got) == {60} and set(range(70)) | set(range(85, 145)) <= got[60]


def test_similar_passages_made_of_common_lines(spark):
    import random

    rnd = random.Random(12)
    lines = [passage(10, 4000 + i) for i in range(60)]
    rows = [(i, " ".join(rnd.sample(lines, 24))) for i in range(300)]
    for i in range(40):
        w = " ".join(rnd.sample(lines, 24)).split()
        near = list(w)
        for at in (47, 90, 130, 170, 205):
            near[at] = f"e{i}_{at}"
        rows += [(1000 + i, f"{passage(20, 5000 + i)} {' '.join(w)}"), (2000 + i, f"{' '.join(near)} {passage(20, 6000 + i)}")]
    got = {}
    for r in substring_dedup.passages(spark.createDataFrame(rows, "doc_id long, text string")).collect():
        got.setdefault(r["doc_id"], set()).update(range(r["first_word"], r["first_word"] + r["n_words"]))
    # Each passage is like its pair's alone: 0.81 similar, and no 50 words of it are equal.
    share = [len(got.get(2000 + i, set()) & set(range(240))) / 240 for i in range(40)]
    assert sum(share) / 40 >= 0.99 and min(share) > 0.9 and not any(i in got for i in range(300))


def test_partners_in_a_crowd_around_one_stretch(spark):
    import pyarrow as pa

    # All documents have one stretch of 40 words, too short for a passage; two each go on alike, but for one word. The key's place is the stretch's first.
    first = lambda t: substring_dedup._function(next(substring_dedup.shingled(pa.array([t]), 5))[2], 0)
    core = min((passage(40, 20_000 + i) for i in range(3000)), key=lambda t: int(first(t)[0]))
    assert first(core).argmin() == 0
    rows = [(0, f"{passage(30, 30_000)} {core} {passage(31, 30_001)}")]
    for i in range(1, 31):
        after = passage(30, 31_000 + i)
        rows += [(100 * k + i, f"{passage(30, 32_000 + 100 * k + i)} {core} edit{k}_{i} {after}") for k in (1, 2)]
    assert sum(key_place(t) == 30 for _, t in rows) >= 58
    got = covered_words(spark, rows)
    share = [len(got.get(200 + i, set()) & set(range(30, 101))) / 71 for i in range(1, 31)]
    assert sum(share) / 30 >= 0.9 and not any(i in got for i in range(100))


def test_two_texts_under_one_id_and_repeated_rows(spark):
    shared, own = passage(70, 81), passage(120, 82)
    rows = [(1, shared), (2, f"{shared} {passage(9, 83)}"), (2, own), (3, own + " more"), (None, shared + " tail"), (4, "  " + shared + "\n"), (None, None), (5, "")] + [(6, passage(80, 84))] * 50
    df = spark.createDataFrame([(i, t, 7, 3) for i, t in rows], "doc_id long, text string, spans int, n_chars int")
    left = sorted((str(r["doc_id"]), r["text"] or "", r["n_chars"]) for r in substring_dedup.remove_passages(df).collect())
    want = [(1, shared, 3), (2, passage(9, 83), None), (2, own, 3), (3, "more", 4), (None, "tail", 4), (4, "", 0), (None, "", 3), (5, "", 3)] + [(6, passage(80, 84), 3)] * 50
    assert left == sorted((str(i), t, len(t) if n is None else n) for i, t, n in want)


def test_equal_passages_against_all_pairs(spark):
    import random

    rnd = random.Random(9)
    blocks = [passage(n, 900 + n) for n in (8, 12, 30, 44, 50, 55, 70, 90)]
    rows = [(i, " ".join(rnd.choice(blocks) if rnd.random() < 0.6 else passage(rnd.randint(3, 60), 5000 + 50 * i + j) for j in range(rnd.randint(1, 8)))) for i in range(90)]
    got = covered_words(spark, rows)
    seen = {}
    for i, t in rows:
        w = t.split()
        for j in range(len(w) - 49):
            first = seen.setdefault(tuple(w[j : j + 50]), i)
            assert first == i or set(range(j, j + 50)) <= got.get(i, set()), (i, j)
    names = {i: t.split() for i, t in rows}
    five = lambda w: {tuple(w[j : j + 5]) for j in range(len(w) - 4)}
    for r in substring_dedup.passages(spark.createDataFrame(rows, "doc_id long, text string"), functions=1).collect():
        a, b = (five(names[r[f"{p}doc_id"]][r[f"{p}first_word"] : r[f"{p}first_word"] + r[f"{p}n_words"]]) for p in ("", "rep_"))
        assert r["rep_doc_id"] < r["doc_id"] and r["n_words"] >= 50 and len(a & b) >= 0.8 * len(a | b) - 1e-9


def test_decontamination(spark):
    item = passage(20, 1)
    near = item.split()
    near[19] = "other"
    rows = [(1, f"{passage(10, 2)} {item.upper()}! {passage(5, 3)}"), (2, " ".join(near)), (3, passage(100, 4)), (4, None), (5, ""), (6, " ".join(item.split()[:12]))]
    got = {(r["doc_id"], r["item_id"]): r["similarity"] for r in decontamination.contaminated(spark.createDataFrame(rows, "doc_id long, text string"), spark.createDataFrame([(7, item), (8, "too short"), (9, None)], "item_id long, text string")).collect()}
    assert set(got) == {(1, 7), (2, 7)} and got[1, 7] == 1 and abs(got[2, 7] - 15 / 17) < 1e-6


def test_empty_tables(spark, labels):
    import public_tokenizers as P

    e, b = empty(spark), spark.createDataFrame([], "item_id long, text string")
    path = P.path("byte_bpe_50k.json")
    for df in (ngram_jaccard.jaccard_components(e), quality_rules.quality_rules(e, labels), toxicity.toxicity(e, labels), language_id.identify(e), token_counts.count_tokens(e, path), packing.pack(e, path), substring_dedup.passages(e), decontamination.contaminated(e, b)):
        assert df.collect() == []
    pages = spark.createDataFrame([], "page_id long, url string, html string")
    assert html_text.extract(pages).collect() == [] and url_filters.url_filters(pages).collect() == []


def test_url_sql(spark):
    import duckdb

    con = duckdb.connect()
    con.execute(f"CREATE VIEW pages AS SELECT * FROM '{SF}/pages.parquet'")
    want = sorted(map(repr, con.sql(f"SELECT page_id, host, path, rule, verdict FROM ({registry.oracle_sql()['op5_url_filters']})").fetchall()))
    assert sorted(repr(tuple(r)) for r in registry.queries()["op5_url_filters"](spark, SF).select("page_id", "host", "path", "rule", "verdict").collect()) == want


def test_pipeline(spark):
    import corpus_pipeline

    docs = spark.read.parquet(f"{SF}/documents.parquet")
    columns = docs.columns
    for name, stage in corpus_pipeline.STAGES:
        out = corpus_pipeline.cut(stage(spark, docs, SF), "test")
        if name != corpus_pipeline.STAGES[-1][0]:
            assert out.columns == columns and 0 < out.count() <= docs.count()
            docs = out
    assert sum(r["length"] for r in out.collect()) == sum(r["doc_tokens"] for r in out.where("start = 0").collect())


def test_many_repeated_rows_of_one_id(spark):
    a, b = passage(70, 91).split(), passage(70, 91).split()
    b[69] = "other"
    rows = [(1, " ".join(a))] * 1000 + [(2, " ".join(b))] * 300 + [(2, passage(30, 92)), (None, " ".join(a)), (None, None)]
    df = spark.createDataFrame([(i, t, 1, 2, 3) for i, t in rows], "doc_id long, text string, key int, fp int, component int")
    got = Counter((r["doc_id"], r["n_shingles"], r["component_id"]) for r in ngram_jaccard.jaccard_components(df).collect())
    assert got == Counter({(1, 67, 1): 1000, (2, 67, 1): 300, (2, 27, 2): 1, (None, 67, 1): 1, (None, 0, None): 1})
    left = Counter((r["doc_id"], r["text"]) for r in ngram_jaccard.keep_one(df).collect())
    assert left == Counter({(1, " ".join(a)): 1000, (2, passage(30, 92)): 1, (None, None): 1})


def test_teaching_rows_are_bounded(spark):
    from rastrum.llm import shared

    df = spark.createDataFrame([(f"text {i}", i % 2) for i in range(4000)] + [("again", 1)] * 3000 + [(None, 1), ("x" * 50, 0)], "text string, y int")
    rows = shared.teaching_rows(df, 160, 20)
    got = Counter(r["y"] for r in rows.collect())
    assert 140 <= got[0] <= 160 and 140 <= got[1] <= 160 and rows.where("length(text) > 20").isEmpty()
    assert sorted(map(tuple, rows.collect())) == sorted(map(tuple, shared.teaching_rows(df.repartition(3), 160, 20).collect()))


def test_kept_follows_the_rules(docs, labels):
    df, rows = docs
    for r in quality_rules.quality_rules(df, labels).collect():
        assert r["base_failed"] == (r["n_words"] < 10 or 100 * r["n_repeat_words"] > 20 * r["n_words"])
        assert r["kept"] == (not r["base_failed"] and r["quality"] >= quality_rules.KEEP_AT)
    held = Counter((r["doc_id"], r["text"]) for r in quality_rules.keep_good(df, labels).collect())
    verdicts = Counter((r["doc_id"], r["kept"]) for r in quality_rules.quality_rules(df, labels).collect())
    assert sum(held.values()) == sum(n for (_, kept), n in verdicts.items() if kept)


def test_quality_score_against_a_plain_sum():
    import numpy as np
    import pyarrow as pa

    from rastrum.llm import kernels as K

    texts = ["Ärger über Öl and some more words", "a", "", "zwei Wörter"]
    rng = np.random.default_rng(1)
    model = {"w": rng.standard_normal(4 << quality_rules.BITS).astype(np.float32), "b": 0.3, "a": 1.2, "c": -0.1}
    buf, offs = K.utf8(pa.array(texts, pa.large_string()))
    word, row = K.words(buf, offs)
    got = quality_rules.scores(model, buf, offs, word, row)
    for i, (t, (slot, share)) in enumerate(zip(texts, quality_rules.features(texts))):
        assert share.sum() == pytest.approx(sum((len(t) >= 3, len(t) >= 5, len(t.split()) >= 1, len(t.split()) >= 2)), abs=1e-5)
        assert got[i] == pytest.approx(1 / (1 + np.exp(-(1.2 * (float(model["w"][slot] @ share) + 0.3) - 0.1))), abs=1e-4)


def test_network_against_a_plain_loop():
    import numpy as np

    rng = np.random.default_rng(4)
    m, h = toxicity.start(), toxicity.HIDDEN
    for k in ("u", "wa", "va", "wo"):
        m[k] = rng.standard_normal(np.shape(m[k])).astype(np.float32) * 0.5
    size = np.array([toxicity.WINDOW, 7])
    px = rng.standard_normal((2, toxicity.WINDOW, 6 * h)).astype(np.float32) * 0.5
    both, one = toxicity.forward(m, px, size), [toxicity.forward(m, px[i : i + 1], size[i : i + 1])[0] for i in range(2)]
    changed = px.copy()
    changed[1, 7:] = 9.0
    assert np.allclose(both, one, atol=1e-5) and np.allclose(both, toxicity.forward(m, changed, size), atol=1e-5)


def test_decontamination_against_all_windows(spark):
    import random

    rnd = random.Random(5)
    items = [(i, passage(rnd.randint(8, 30), 700 + i)) for i in range(6)] + [(6, passage(12, 700)), (7, " ".join(passage(30, 701).split()[:12]))]
    rows = []
    for i in range(40):
        w = rnd.choice(items)[1].split()
        for _ in range(rnd.randrange(3)):
            w[rnd.randrange(len(w))] = f"e{rnd.randrange(99)}"
        rows.append((i, f"{passage(rnd.randint(0, 15), 800 + i)} {' '.join(w)} {passage(rnd.randint(0, 15), 900 + i)}".strip()))
    rows += [(None, items[2][1]), (90, None), (91, "")]
    of = lambda w: {tuple(w[j : j + 5]) for j in range(len(w) - 4)}
    own = {i: of(t.split()) for i, t in items if len(t.split()) >= 5}
    count = Counter(s for v in own.values() for s in v)
    weight = lambda v: sum(1 / max(count[s], 1) for s in v)
    want = {}
    for d, t in rows:
        w = (t or "").split()
        for i, v in own.items():
            n = len(dict(items)[i].split())
            for j in range(max(1, len(w) - n + 1)):
                x = of(w[j : j + n])
                if x and weight(x & v) >= 0.8 * weight(x | v) - 1e-9:
                    want[d, i] = max(want.get((d, i), 0), weight(x & v) / weight(x | v))
    got = {(r["doc_id"], r["item_id"]): r["similarity"] for r in decontamination.contaminated(spark.createDataFrame(rows, "doc_id long, text string"), spark.createDataFrame(items, "item_id long, text string")).collect()}
    assert set(got) == set(want) and all(abs(got[k] - want[k]) < 1e-6 for k in want)
    clean = decontamination.decontaminated(spark.createDataFrame([(i, t, 1) for i, t in rows], "doc_id long, text string, rid int"), spark.createDataFrame(items, "item_id long, text string"))
    assert clean.columns == ["doc_id", "text", "rid"] and Counter(r["doc_id"] for r in clean.collect()) == Counter(d for d, _ in rows if not any(k[0] == d for k in want))


def test_odd_rows_everywhere(spark, labels):
    import public_tokenizers as P

    texts = [*ODD, "w " * 500_000, "Some plain words, and more of them.", None]
    rows = [(None if i % 4 == 0 else i // 2, t) for i, t in enumerate(texts)] * 2
    wide = ", ".join(f"{c} int" for c in ("key", "id", "h", "ord", "part", "chunk", "data", "rank", "y", "held_out", "bucket", "x"))
    df = spark.createDataFrame([(i, t, "en", None, 3, *[1] * 12) for i, t in rows], f"doc_id long, text string, lang string, source string, n_chars int, {wide}")
    bench = spark.createDataFrame([(1, "Some plain words, and more of them."), (None, "x"), (2, None)], "item_id long, text string")
    n = len(rows)
    assert toxicity.toxicity(df, labels).count() == language_id.identify(df).count() == quality_rules.quality_rules(df, labels).count() == n
    assert ngram_jaccard.jaccard_components(df).count() == token_counts.count_tokens(df, P.path("byte_bpe_50k.json")).count() == n
    assert packing.pack(df, P.path("byte_bpe_50k.json")).where("start = 0").count() == n
    assert {r["item_id"] for r in decontamination.contaminated(df, bench).collect()} == {1}
    for stage in (lambda d: ngram_jaccard.keep_one(d), lambda d: substring_dedup.remove_passages(d), lambda d: decontamination.decontaminated(d, bench), lambda d: quality_rules.keep_good(d, labels)):
        for frame in (df, df.limit(0)):
            out = stage(frame)
            assert out.columns == df.columns and out.count() <= n


def test_tiles_are_bounded_by_shingles(spark, monkeypatch):
    """Sets of long texts meet in more tiles: before, 512 sets made a tile however large they were."""
    monkeypatch.setattr(ngram_jaccard, "TILE_SHINGLES", 20_000)
    rows = spark.createDataFrame([(7, i, i, 100) for i in range(100)], "key long, fp long, comp long, size long")
    sizes = spark.createDataFrame([(i, 2_000) for i in range(100)], "fp long, n long")
    met = ngram_jaccard._meetings(rows, sizes).collect()
    groups = Counter((r["i"], r["j"]) for r in met)
    assert max(groups.values()) * 2_000 <= 3 * 2 * 20_000
    pairs = {(min(a["fp"], b["fp"]), max(a["fp"], b["fp"])) for a in met for b in met if (a["i"], a["j"]) == (b["i"], b["j"]) and a["fp"] != b["fp"]}
    assert len(pairs) == 100 * 99 // 2


def test_open_windows_have_their_shingles(spark):
    """The windows that look for partners have their shingles beside them, and items how many windows hold them, so neither is shuffled anew for each round."""
    seqs = [np.arange(i, i + 60, dtype=np.uint32) for i in range(3)]
    docs = spark.createDataFrame([(i, bytearray(s.tobytes())) for i, s in enumerate(seqs)], "doc long, seq binary")
    large = spark.createDataFrame([(5, i, i, 2, 20, 50, False, i > 0) for i in range(3)], "key long, doc long, ord long, l int, c int, r int, many boolean, open boolean")
    windows, items = substring_dedup._held(large, docs, 4)
    assert {r["doc"]: r["seq"] for r in windows.collect()} == {i: bytearray(seqs[i][2:51].tobytes()) if i else None for i in range(3)}
    often = Counter(r["item"] for r in items.collect())
    assert len(often) == 49 and all(r["often"] == often[r["item"]] for r in items.collect())


def test_crowds_make_no_pairs(spark, monkeypatch):
    """Windows that share much meet in tiles: before, every two of them were a row."""
    monkeypatch.setattr(substring_dedup, "SMALL", 2)
    monkeypatch.setattr(substring_dedup, "TILE", 16)
    base, rows, seen = passage(140, 40_000).split(), [], {}
    for i in range(60):
        # Five own words each: any two share more than HITS shingles, few are similar enough.
        w = list(base)
        for at in (10 + i % 7, 30 + i % 11, 52 + i % 5, 90 + i % 6, 112 + i % 13):
            w[at] = f"o{i}_{at}"
        rows.append((i, f"{passage(20, 41_000 + i)} {' '.join(w)} {passage(20, 42_000 + i)}"))
    true_cut = substring_dedup.cut

    def counted(df, what):
        out = true_cut(df, what)
        seen.setdefault(what, []).append(out.count())
        return out

    monkeypatch.setattr(substring_dedup, "cut", counted)
    covered_words(spark, rows)
    # Pairs are those with the earliest holders only; of the rest, tasks give passages.
    assert len(seen["pairs"]) == 1 and seen["pairs"][0] <= 4 * seen["met"][0] and len(seen["crowd"]) == 2


def test_packed_keys():
    from rastrum.llm import meeting

    rng = np.random.default_rng(3)
    x = np.stack([np.sort(rng.integers(0, 1 << 32, 8192, np.uint32)), rng.integers(0, 2000, 8192, np.uint32)])
    data = meeting.pack(x)
    assert (meeting.unpack(data, 2) == x).all() and len(data) < 0.6 * x.nbytes
    assert meeting.unpack(meeting.pack(x[:, :0]), 2).shape == (2, 0)
