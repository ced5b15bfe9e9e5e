"""Byte-pair encoding as finite-state machines.

Splitter: a deterministic machine over character classes finds where the pieces
of a text begin (the rule of the byte-level pre-tokenizer). Its texts are cut
into chunks of equal length; for every chunk the map "state before -> state
after" is made for all states at once, the maps compose through a prefix scan
(log2 of the chunks steps), and a second pass marks the piece starts.

Counter: a deterministic transducer reads a piece byte by byte; each transition
is annotated with the number of tokens it adds. Its state holds, for every
place from which some token of the vocabulary could still reach further, the
place in the trie, the last token there and the count relative to now; a token
may follow another only where the pair is encoded as itself. States are
compiled when first reached; the table is emptied when it is full, so memory
stays bounded.
"""

from __future__ import annotations

import functools
import json
import sys
import unicodedata

import numpy as np

# Classes of characters.
LETTER, NUMBER, OTHER, BLANK, WHITE, OPEN2, OPEN3 = range(7)
# Contractions that the pre-tokenizer splits off, and white space outside ASCII.
CONTRACTIONS = ("'s", "'t", "'re", "'ve", "'m", "'ll", "'d")
WHITE_SPACE = (0x85, 0xA0, 0x1680, *range(0x2000, 0x200B), 0x2028, 0x2029, 0x202F, 0x205F, 0x3000)
CHUNK = 512
CACHE_PIECES = 400_000


@functools.cache
def char_classes() -> np.ndarray:
    out = np.full(sys.maxunicode + 1, OTHER, np.uint8)
    for c in range(sys.maxunicode + 1):
        kind = unicodedata.category(chr(c))[0]
        if kind in "LN":
            out[c] = LETTER if kind == "L" else NUMBER
    out[list(range(9, 14))] = WHITE
    out[list(WHITE_SPACE)] = WHITE
    out[32] = BLANK
    return out


# States of the splitter: nothing read, inside a run of letters / numbers / others, after a blank that the next run
# takes in, inside white space, and inside a contraction with one or two more characters to come or just ended.
NONE, IN_L, IN_N, IN_O, AFTER_BLANK, IN_W, ONE_MORE, TWO_MORE, ENDED = range(9)
STATES = 9
#: Symbols: class, plus 7 where the next character of the text is not white space; 14 begins a text.
SYMBOLS, BEGIN = 15, 14


@functools.cache
def splitter() -> tuple[np.ndarray, np.ndarray]:
    """Next state, and whether a piece begins at the character read."""
    to, starts = np.zeros((STATES, SYMBOLS), np.uint8), np.zeros((STATES, SYMBOLS), bool)
    runs = {LETTER: IN_L, NUMBER: IN_N, OTHER: IN_O}
    for state in range(STATES):
        for symbol in range(14):
            kind, solid = symbol % 7, symbol >= 7
            if state == TWO_MORE:
                to[state, symbol] = ONE_MORE
            elif state == ONE_MORE:
                to[state, symbol] = ENDED
            elif kind in (BLANK, WHITE):
                # The last character of white space before something solid stands alone, or joins it if it is a blank.
                to[state, symbol] = AFTER_BLANK if kind == BLANK and solid else IN_W
                starts[state, symbol] = solid or state not in (IN_W, AFTER_BLANK)
            elif kind in (OPEN2, OPEN3) and state not in (IN_O, AFTER_BLANK):
                to[state, symbol], starts[state, symbol] = (ONE_MORE if kind == OPEN2 else TWO_MORE), True
            else:
                run = runs[OTHER if kind in (OPEN2, OPEN3) else kind]
                to[state, symbol], starts[state, symbol] = run, state not in (run, AFTER_BLANK)
        to[state, BEGIN] = NONE
    return to, starts


def symbols(code: np.ndarray, begins: np.ndarray) -> np.ndarray:
    """Symbols of the characters of several texts laid end to end; begins: where each (not empty) text starts."""
    n = len(code)
    kind = char_classes()[code]
    new = np.zeros(n + 4, bool)
    new[begins] = True
    new[n:] = True
    ahead = np.r_[code, np.zeros(3, code.dtype)]
    at = np.flatnonzero((code == 39) & ~new[1 : n + 1])
    one, two = ahead[at + 1], ahead[at + 2]
    kind[at[np.isin(one, (115, 116, 109, 100))]] = OPEN2
    kind[at[(((one == 114) | (one == 118)) & (two == 101) | (one == 108) & (two == 108)) & ~new[at + 2]]] = OPEN3
    solid = np.zeros(n, bool)
    solid[:-1] = ((kind[1:] != BLANK) & (kind[1:] != WHITE)) & ~new[1:n]
    return kind + np.where(solid, 7, 0).astype(np.uint8)


def piece_starts(code: np.ndarray, begins: np.ndarray, chunk: int = CHUNK) -> np.ndarray:
    """Places at which a piece begins. A text begins with its own BEGIN symbol, so that no state passes from one to the next."""
    if not len(code):
        return np.zeros(0, np.int64)
    to, starts = splitter()
    sym = symbols(code, begins)
    stream = np.insert(sym, begins, BEGIN)
    n = -(-len(stream) // chunk)
    grid = np.full(n * chunk, BEGIN, np.uint8)
    grid[: len(stream)] = stream
    grid = np.ascontiguousarray(grid.reshape(n, chunk).T)
    flat, width = to.ravel(), np.uint8(SYMBOLS)  # the largest index is below 256
    # Map of each chunk, for all states. Once every state has led to the same one, the map is constant: one state is enough.
    maps = np.tile(np.arange(STATES, dtype=np.uint8), (n, 1))
    one, open_ = np.zeros(n, np.uint8), np.arange(n)
    for j in range(chunk):
        if len(open_) < n:
            one = flat[one * width + grid[j]]
        if len(open_):
            part = flat[maps[open_] * width + grid[j][open_, None]]
            maps[open_] = part
            if j % 8 == 7:
                closed = (part == part[:, :1]).all(1)
                one[open_[closed]] = part[closed, 0]
                open_ = open_[~closed]
    closed = np.setdiff1d(np.arange(n), open_)
    maps[closed] = one[closed, None]
    # Prefix scan: after the step of distance d, maps[i] covers up to 2d chunks that end with i.
    d = 1
    while d < n:
        later = np.take_along_axis(maps[d:], maps[:-d].astype(np.intp), 1)
        maps = np.concatenate([maps[:d], later])
        d *= 2
    state = np.zeros(n, np.uint8)
    state[1:] = maps[:-1, NONE]
    marks, flags = np.zeros((chunk, n), bool), starts.ravel()
    for j in range(chunk):
        at = state * width + grid[j]
        marks[j], state = flags[at], flat[at]
    keep = np.ones(len(stream), bool)
    keep[begins + np.arange(len(begins))] = False
    return np.flatnonzero(marks.T.ravel()[: len(stream)][keep])


class Vocabulary:
    """Tokens, merges and special strings of a byte-level BPE file for the tokenizers library."""

    def __init__(self, path: str):
        with open(path, encoding="utf-8") as f:
            model = json.load(f)
        # The byte alphabet of byte-level BPE: printable bytes stand for themselves, the others follow from 256 on.
        plain = [*range(33, 127), *range(161, 173), *range(174, 256)]
        rest = [b for b in range(256) if b not in plain]
        byte = {chr(b): b for b in plain} | {chr(256 + i): b for i, b in enumerate(rest)}
        raw = lambda s: bytes(byte[c] for c in s)
        self.special = {x["content"]: x["id"] for x in model["added_tokens"]}
        self.id_of = {raw(s): i for s, i in model["model"]["vocab"].items() if s not in self.special}
        self.bytes_of = {i: s for s, i in self.id_of.items()}
        self.rank = {}
        for r, m in enumerate(model["model"]["merges"]):
            a, b = m.split(" ") if isinstance(m, str) else m
            self.rank[self.id_of[raw(a)], self.id_of[raw(b)]] = (r, self.id_of[raw(a) + raw(b)])

    def merge(self, piece: bytes) -> list[int]:
        """Merges by rank; for short strings (a pair of tokens)."""
        ids = [self.id_of[piece[i : i + 1]] for i in range(len(piece))]
        while len(ids) > 1:
            best = min(((self.rank[p][0], i) for i, p in enumerate(zip(ids, ids[1:])) if p in self.rank), default=None)
            if best is None:
                break
            pair = ids[best[1]], ids[best[1] + 1]
            new, out, i = self.rank[pair][1], [], 0
            while i < len(ids):
                if i + 1 < len(ids) and (ids[i], ids[i + 1]) == pair:
                    out.append(new)
                    i += 2
                else:
                    out.append(ids[i])
                    i += 1
            ids = out
        return ids


class Transducer:
    """Counts the tokens of pieces; `encode` also gives them."""

    MOST_STATES = 200_000

    def __init__(self, vocabulary: Vocabulary):
        self.v = vocabulary
        self.child: list[dict[int, int]] = [{}]
        self.token = [-1]
        for s, i in vocabulary.id_of.items():
            node = 0
            for b in s:
                if b not in self.child[node]:
                    self.child[node][b] = len(self.child)
                    self.child.append({})
                    self.token.append(-1)
                node = self.child[node][b]
            self.token[node] = i
        self.pairs: dict[tuple[int, int], bool] = {}
        self.counts: dict[bytes, int] = {}
        self.older: dict[bytes, int] = {}
        self.ids: dict[bytes, tuple[int, ...]] = {}
        self.clear()

    def clear(self) -> None:
        start = ((0, -1, 0),)
        self.state_of, self.states, self.edges = {start: 0}, [start], [{}]

    def follows(self, a: int, b: int) -> bool:
        if a < 0:
            return True
        found = self.pairs.get((a, b))
        if found is None:
            if len(self.pairs) > 2_000_000:
                self.pairs.clear()
            found = self.pairs[a, b] = self.v.merge(self.v.bytes_of[a] + self.v.bytes_of[b]) == [a, b]
        return found

    def compile(self, state: int, byte: int) -> tuple[int, int, int]:
        """The transition: next state, tokens added, last token."""
        alive, best = [], None
        for node, last, count in self.states[state]:  # from the farthest place on: the longest token first
            to = self.child[node].get(byte)
            if to is None:
                continue
            if best is None and self.token[to] >= 0 and self.follows(last, self.token[to]):
                best = self.token[to], count + 1
            if self.child[to]:
                alive.append((to, last, count))
        token, gain = best
        new = (*((n, t, c - gain) for n, t, c in alive), (0, token, 0))
        k = self.state_of.get(new)
        if k is None:
            k = self.state_of[new] = len(self.states)
            self.states.append(new)
            self.edges.append({})
        edge = self.edges[state][byte] = (k, gain, token)
        return edge

    def run(self, piece: bytes) -> tuple[int, list[int]]:
        """Number of tokens, and the last token of each prefix."""
        if len(self.states) > self.MOST_STATES:
            self.clear()
        state = total = 0
        lasts = []
        for byte in piece:
            edge = self.edges[state].get(byte) or self.compile(state, byte)
            state, gain, token = edge
            total += gain
            lasts.append(token)
        return total, lasts

    def total(self, pieces: list[bytes]) -> int:
        """Tokens of several pieces. Counts of short pieces are kept in two generations, so memory stays bounded."""
        found = list(map(self.counts.get, pieces))
        if None not in found:
            return sum(found)
        for k, n in enumerate(found):
            if n is None:
                piece = pieces[k]
                n = self.counts.get(piece)
                if n is None:
                    n = self.older.pop(piece, None)
                    if n is None:
                        n = self.run(piece)[0]
                    if len(piece) < 256:
                        if len(self.counts) >= CACHE_PIECES:
                            self.counts, self.older = {}, self.counts
                        self.counts[piece] = n
                found[k] = n
        return sum(found)

    def encode(self, piece: bytes) -> tuple[int, ...]:
        found = self.ids.get(piece)
        if found is None:
            if len(self.ids) > CACHE_PIECES:
                self.ids.clear()
            _, lasts = self.run(piece)
            out, at = [], len(piece)
            while at:
                out.append(lasts[at - 1])
                at -= len(self.v.bytes_of[out[-1]])
            found = tuple(out[::-1])
            if len(piece) < 256:
                self.ids[piece] = found
        return found


@functools.cache
def transducer(path: str) -> Transducer:
    """One for each Python worker."""
    return Transducer(Vocabulary(path))


def pieces(texts: list[str], special: dict[str, int]):
    """Per text its pieces as bytes; a special string is itself a str."""
    parts, owner = [], []
    for i, t in enumerate(texts):
        left = [t]
        for s in special:
            if s in t:
                left = [x for y in left for x in (_around(y, s) if y not in special else [y])]
        parts += [x for x in left if x]
        owner += [i] * sum(1 for x in left if x)
    out: list[list] = [[] for _ in texts]
    plain = [k for k, x in enumerate(parts) if x not in special]
    raw = [parts[k].encode("utf-8", "surrogatepass") for k in plain]
    code = np.frombuffer("".join(parts[k] for k in plain).encode("utf-32-le", "surrogatepass"), np.uint32)
    lens = np.array([len(parts[k]) for k in plain], np.int64)
    begins = np.cumsum(lens) - lens
    at = piece_starts(code, begins)
    # Characters to bytes.
    width = 1 + (code > 0x7F).astype(np.int8) + (code > 0x7FF) + (code > 0xFFFF)
    place = np.r_[0, np.cumsum(width, dtype=np.int64)]
    cuts = place[at]
    edges = np.searchsorted(at, np.r_[begins, len(code)])
    cut = cuts.tolist()
    found = {}
    for j, k in enumerate(plain):
        base = int(place[begins[j]])
        c = [x - base for x in cut[edges[j] : edges[j + 1]]]
        c.append(len(raw[j]))
        b = raw[j]
        found[k] = [b[x:y] for x, y in zip(c, c[1:])]
    for k, i in enumerate(owner):
        out[i] += found[k] if k in found else [parts[k]]
    return out


def _around(text: str, s: str) -> list[str]:
    out = []
    for k, x in enumerate(text.split(s)):
        out += [s, x] if k else [x]
    return out
