"""The learned models against plain loops: Kneser-Ney from its definition, the recurrent network step by step."""

import math
from collections import Counter, defaultdict

import numpy as np

from rastrum.llm import language_id, toxicity


class Textbook:
    """Interpolated Kneser-Ney over characters, from counts in dictionaries."""

    def __init__(self, texts, order):
        self.order = order
        grams = [Counter() for _ in range(order + 1)]
        for t in texts:
            padded = " " * (order - 1) + t
            for i in range(order - 1, len(padded)):
                for k in range(1, order + 1):
                    grams[k][padded[i - k + 1 : i + 1]] += 1
        self.count, self.discount, self.total, self.kinds = {}, {}, {}, {}
        for k in range(order, 0, -1):
            if k < order:  # how many different characters stand before it
                before = Counter(g[1:] for g in grams[k + 1])
                grams[k] = Counter({g: before[g] for g in grams[k]})
            ones, twos = (sum(c == n for c in grams[k].values()) for n in (1, 2))
            self.discount[k] = min(0.95, max(0.1, ones / max(1, ones + 2 * twos)))
            total, kinds = defaultdict(int), defaultdict(int)
            for g, c in grams[k].items():
                total[g[:-1]] += c
                kinds[g[:-1]] += 1
            self.count[k], self.total[k], self.kinds[k] = grams[k], total, kinds

    def p(self, gram, alphabet):
        k = len(gram)
        if k == 0:
            return 1 / alphabet
        ctx, d = gram[:-1], self.discount[k]
        if ctx not in self.total[k]:
            return self.p(gram[1:], alphabet)
        share = max(self.count[k].get(gram, 0) - d, 0) / self.total[k][ctx]
        return share + d * self.kinds[k][ctx] / self.total[k][ctx] * self.p(gram[1:], alphabet)

    def cross_entropy(self, text, alphabet):
        padded = " " * (self.order - 1) + text
        logs = [math.log(self.p(padded[i - self.order + 1 : i + 1], alphabet)) for i in range(self.order - 1, len(padded))]
        return -sum(logs) / len(logs)


def test_kneser_ney_against_the_textbook():
    own = {"aa": ["the cat sat on the mat", "a cat and a hat", "that is the hat"], "bb": ["der hund und die katze", "ein hut und der hund", "die katze und der hut", "ähre über öl"]}
    model = language_id.prepared(language_id.train([t for v in own.values() for t in v], [n for n, v in own.items() for _ in v]))
    alphabet = len({c for v in own.values() for t in v for c in t}) + 1
    books = {n: Textbook(v, language_id.ORDER) for n, v in own.items()}
    tests = ["the hat", "der hut", "xyz quu", "katze cat", "ö", "a", "the katze sat über und under it all"]
    got, n = language_id.cross_entropies(model, tests)
    assert n.tolist() == [sum(c.isalpha() for c in t) for t in tests]
    for i, t in enumerate(tests):
        for j, name in enumerate(model["names"]):
            assert abs(got[i, j] - books[name].cross_entropy(t, alphabet)) < 1e-4, (t, name)
    # Shares of all characters of the alphabet after a context, and of the one unknown, sum to one.
    for ctx in ("the", "  d", "zzz"):
        total = sum(books["bb"].p(ctx + c, alphabet) for c in sorted({c for v in own.values() for t in v for c in t})) + books["bb"].p(ctx + "☃", alphabet)
        assert abs(total - 1) < 1e-9


def test_languages_learn_from_every_teaching_text(spark):
    """More texts than the 400 of a language that were read before, and longer ones than 200,000 characters: every n-gram counts."""
    texts = [(f"aa bb {chr(97 + i % 26)}{chr(97 + i // 26 % 26)}", "en") for i in range(600)] + [("xyz " * 60_000, "en"), ("und der hund " * 3, "de"), ("und die katze", "de")]
    rows = [(*r, False) for r in texts]
    df = spark.createDataFrame(rows, "text string, y string, apart boolean")
    got = {}
    for r in df.repartition(5).mapInArrow(language_id._counts, "y string, apart boolean, slot long, a long, b long, n long").collect():
        gram = "".join(map(chr, (r["a"] >> 32, r["a"] & 0xFFFFFFFF, r["b"] >> 32, r["b"] & 0xFFFFFFFF)))
        got[r["y"], gram] = got.get((r["y"], gram), 0) + r["n"]
    want = Counter((y, ("   " + t)[i : i + 4]) for t, y in texts for i in range(len(t)))
    assert {k: v for k, v in got.items() if k[1][-1] != " "} == {k: v for k, v in want.items() if k[1][-1] != " "}
    model = language_id.loaded(language_id.learned(df))
    plain = language_id.train([t for t, _ in texts], [y for _, y in texts])
    assert model["names"] == plain["names"] == ["de", "en"] and model["alone"] == []
    for a, b in zip(model["levels"], plain["levels"]):
        assert (a["keys"] == b["keys"]).all() and np.allclose(a["log"], b["log"]) and np.allclose(a["left"], b["left"])


def sigmoid(x):
    return 1 / (1 + math.exp(-x))


def plain_network(m, px, size):
    """One window through both directions of the network and the attention, number by number."""
    h = toxicity.HIDDEN
    states = [[0.0] * (2 * h) for _ in range(size)]
    for d in (0, 1):
        state = [0.0] * h
        for t in range(size) if d == 0 else range(size - 1, -1, -1):
            x = px[t][3 * h * d : 3 * h * (d + 1)]
            s = [sum(state[i] * m["u"][d][i][j] for i in range(h)) for j in range(3 * h)]
            z = [sigmoid(x[j] + s[j]) for j in range(h)]
            r = [sigmoid(x[h + j] + s[h + j]) for j in range(h)]
            c = [math.tanh(x[2 * h + j] + r[j] * s[2 * h + j]) for j in range(h)]
            state = [(1 - z[j]) * c[j] + z[j] * state[j] for j in range(h)]
            states[t][h * d : h * (d + 1)] = state
    energy = []
    for t in range(size):
        a = [math.tanh(sum(states[t][i] * m["wa"][i][k] for i in range(2 * h))) for k in range(h)]
        energy.append(sum(a[k] * m["va"][k] for k in range(h)))
    share = [math.exp(e - max(energy)) for e in energy]
    pooled = [sum(share[t] * states[t][i] for t in range(size)) / sum(share) for i in range(2 * h)]
    return sum(pooled[i] * m["wo"][i] for i in range(2 * h)) + m["bo"]


def test_network_against_plain_steps():
    rng = np.random.default_rng(4)
    m = toxicity.start()
    for k in ("u", "wa", "va", "wo"):
        m[k] = rng.standard_normal(np.shape(m[k])).astype(np.float32) * 0.5
    m["bo"] = np.float32(0.3)
    size = np.array([toxicity.WINDOW, 7, 1])
    px = rng.standard_normal((3, toxicity.WINDOW, 6 * toxicity.HIDDEN)).astype(np.float32)
    got = toxicity.forward(m, px, size)
    for i in range(3):
        assert abs(float(got[i]) - plain_network({k: np.asarray(v, float).tolist() for k, v in m.items() if k in ("u", "wa", "va", "wo", "bo")}, px[i].astype(float).tolist(), int(size[i]))) < 1e-4


def test_inputs_and_windows_against_plain_loops():
    rng = np.random.default_rng(5)
    m = toxicity.start()
    m["odds"] = rng.standard_normal(1 << toxicity.CHAR_BITS).astype(np.float32)
    for k in ("u", "wa", "va", "wo"):
        m[k] = rng.standard_normal(np.shape(m[k])).astype(np.float32) * 0.5
    texts = ["One two Three", "", "word " * 100 + "last one", "äö x1"]
    raw = [t.encode() for t in texts]
    buf, offs = np.frombuffer(b"".join(raw), np.uint8), np.cumsum([0, *map(len, raw)])
    score, at = toxicity.row_scores(m, buf, offs)
    for i, r in enumerate(raw):
        keys, slot, bounds, inv, _ = toxicity.vocabulary_of(np.frombuffer(r, np.uint8), np.array([0, len(r)]))
        if not len(inv):
            assert score[i] == 0
            continue
        x = []
        for w in inv:
            own = slot[bounds[w] : bounds[w + 1]]
            mean = [float(np.mean([m["ec"][s][j] for s in own])) for j in range(toxicity.D_CHAR)]
            x.append([*m["ew"][int(keys[w]) >> (64 - toxicity.WORD_BITS)].tolist(), *mean, max(float(m["odds"][s]) for s in own)])
        px = (np.array(x) @ m["wx"] + m["b"]).tolist()
        n = len(inv)
        begins = [0] if n <= toxicity.WINDOW else sorted({min(k * toxicity.STRIDE, n - toxicity.WINDOW) for k in range(-(-(n - toxicity.WINDOW) // toxicity.STRIDE) + 1)})
        plain = {k: np.asarray(v, float).tolist() for k, v in m.items() if k in ("u", "wa", "va", "wo", "bo")}
        best = [sigmoid(plain_network(plain, px[b : b + toxicity.WINDOW], min(n - b, toxicity.WINDOW))) for b in begins]
        assert abs(score[i] - max(best)) < 1e-4 and abs(best[begins.index(int(at[i]))] - max(best)) < 1e-6
