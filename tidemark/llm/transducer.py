"""A byte-level BPE tokenizer compiled to two deterministic transducers that count tokens.

The first reads classes of characters and marks where the pre-tokenizer's pattern cuts. Its maps from state to state
form a small finite monoid, so a chunk of text is one element of it: chunks are reduced side by side, their elements
are combined by a parallel prefix scan, and every chunk then knows the state it starts in.

The second reads the bytes of the words so found. A state holds, for every suffix of the word that may still grow into
a token, the token that ends before that suffix and how many tokens the count there lies behind; this is all that the
choice of later tokens depends on. A transition is annotated with the tokens it adds to the count. States are made when
first met and kept in arrays, so all words step at once; past a bound the arrays are dropped between batches and grow
anew, which changes no count.
"""

from __future__ import annotations

import json

import numpy as np
from tokenizers import Regex, pre_tokenizers

from tidemark.llm import streams

# Classes of characters for the pattern 's|'t|'re|'ve|'m|'ll|'d| ?\p{L}+| ?\p{N}+| ?[^\s\p{L}\p{N}]+|\s+(?!\S)|\s+
END, SPACE, WHITE, NUMBER, OTHER, QUOTE, LETTER, SINGLE, BEFORE_E, ELL, E, SPECIAL = range(12)
# States: what the text so far leaves open.
START, LETTERS, NUMBERS, OTHERS, QUOTED, WANT_E, WANT_L, DONE, ONE_SPACE, ONE_WHITE, RUN_SPACE, RUN_WHITE, MARK = range(13)
IS_LETTER = (LETTER, SINGLE, BEFORE_E, ELL, E)


def _step(state: int, kind: int) -> tuple[int, bool, bool]:
    """Next state; whether a cut lies before this character; whether one lies before the character before it."""
    if kind == END:
        return START, True, state in (WANT_E, WANT_L)
    if kind == SPECIAL:
        return MARK, state != MARK, state in (WANT_E, WANT_L)
    if state in (WANT_E, WANT_L):
        if (state, kind) in ((WANT_E, E), (WANT_L, ELL)):
            return DONE, False, False
        after, cut, _ = _step(LETTERS, kind)
        return after, cut, True
    if state == QUOTED and kind in (SINGLE, BEFORE_E, ELL):
        return {SINGLE: DONE, BEFORE_E: WANT_E, ELL: WANT_L}[kind], False, False
    in_space = state in (ONE_SPACE, ONE_WHITE, RUN_SPACE, RUN_WHITE)
    if kind in (SPACE, WHITE):
        if in_space:
            return (RUN_SPACE if kind == SPACE else RUN_WHITE), False, False
        return (ONE_SPACE if kind == SPACE else ONE_WHITE), True, False
    retro, led = state in (RUN_SPACE, RUN_WHITE), state in (ONE_SPACE, RUN_SPACE)
    if kind in IS_LETTER:
        return LETTERS, not (led or state == LETTERS), retro
    if kind == NUMBER:
        return NUMBERS, not (led or state == NUMBERS), retro
    joined = led or state in (OTHERS, QUOTED)
    return (QUOTED if kind == QUOTE and not joined else OTHERS), not joined, retro


class Cutter:
    """Where the pattern cuts a run of characters, by composition of chunk maps."""

    def __init__(self, chunk: int = 512) -> None:
        self.chunk = chunk
        steps = [[_step(s, k) for k in range(12)] for s in range(13)]
        self.next = np.array([[x[0] for x in row] for row in steps], np.uint8)
        self.cut = np.array([[x[1] for x in row] for row in steps], bool)
        self.retro = np.array([[x[2] for x in row] for row in steps], bool)
        maps = [tuple(self.next[:, k].tolist()) for k in range(12)]
        elements = {tuple(range(13)): 0}
        todo = [tuple(range(13))]
        while todo:  # all maps that texts can have
            m = todo.pop()
            for g in maps:
                new = tuple(g[s] for s in m)
                if new not in elements:
                    elements[new] = len(elements)
                    todo.append(new)
        self.maps = np.array(list(elements), np.uint8)
        n = len(elements)
        self.then = np.array([[elements[tuple(g[s] for s in m)] for g in maps] for m in elements], np.uint16)
        self.product = np.array(
            [[elements[tuple(np.array(b)[list(a)].tolist())] for b in elements] for a in elements], np.uint16
        ).reshape(n, n)
        self.kinds = self._kinds()

    @staticmethod
    def _kinds() -> np.ndarray:
        """The class of every character, asked of the library whose pattern this is, so that both know the same Unicode."""
        kinds = np.full(0x110000, OTHER, np.uint8)
        points = np.array([*range(0xD800), *range(0xE000, 0x33000)])  # beyond these no letter, number or space is assigned
        every = "".join(map(chr, points))
        for pattern, kind in ((r"\p{L}+", LETTER), (r"\p{N}+", NUMBER), (r"\s+", WHITE)):
            found = pre_tokenizers.Split(Regex(pattern), "removed", invert=True).pre_tokenize_str(every)
            for _, (begin, end) in found:
                kinds[points[begin:end]] = kind
        for chars, kind in ((" ", SPACE), ("'", QUOTE), ("stmd", SINGLE), ("rv", BEFORE_E), ("l", ELL), ("e", E)):
            kinds[[ord(c) for c in chars]] = kind
        return kinds

    def cuts(self, kinds: np.ndarray) -> np.ndarray:
        """For each character whether a cut lies before it; the run must end with END."""
        n, width = len(kinds), self.chunk
        lanes = -(-n // width)
        grid = np.full(lanes * width, END, np.uint8)
        grid[:n] = kinds
        grid = np.ascontiguousarray(grid.reshape(lanes, width).T)
        element = np.zeros(lanes, np.uint16)
        for column in grid:
            element = self.then[element, column]
        reach = 1
        while reach < lanes:  # inclusive prefix scan: each round doubles what an element spans
            element[reach:] = self.product[element[:-reach], element[reach:]]
            reach *= 2
        state = np.full(lanes, START, np.uint8)
        state[1:] = self.maps[element[:-1], START]
        before = np.empty_like(grid)
        for i, column in enumerate(grid):
            before[i] = state
            state = self.next[state, column]
        cut = np.ascontiguousarray(self.cut[before, grid].T).reshape(-1)[:n]
        retro = np.ascontiguousarray(self.retro[before, grid].T).reshape(-1)[:n]
        cut[:-1] |= retro[1:]
        return cut


def _byte_letters() -> dict[str, int]:
    """The characters that stand for bytes in such vocabularies: printable ones for themselves, others from U+0100 on."""
    plain = [*range(0x21, 0x7F), *range(0xA1, 0xAD), *range(0xAE, 0x100)]
    others = [b for b in range(256) if b not in plain]
    return {chr(b): b for b in plain} | {chr(0x100 + i): b for i, b in enumerate(others)}


class WordCounter:
    """Tokens of words: the lazily built counting transducer of a vocabulary and its merges."""

    def __init__(self, vocab: dict[str, int], merges: list, most_states: int = 1 << 18) -> None:
        letters = _byte_letters()
        self.most_states = most_states
        pairs = [tuple(m.split(" ")) if isinstance(m, str) else tuple(m) for m in merges]
        self.rank = {(vocab[a], vocab[b]): i for i, (a, b) in enumerate(pairs)}
        self.made: dict[int, int] = {}
        self.parts: dict[int, tuple[int, int]] = {}
        for i, (a, b) in enumerate(pairs):
            token = vocab[a + b]
            if token not in self.made:
                self.made[token], self.parts[token] = i, (vocab[a], vocab[b])
        self.children: list[dict[int, int]] = [{}]
        self.token: list[int] = [-1]
        for text, token in vocab.items():
            if len(text) > 1 and token not in self.made:
                continue
            node = 0
            for c in text:
                child = self.children[node].get(letters[c])
                if child is None:
                    child = self.children[node][letters[c]] = len(self.children)
                    self.children.append({})
                    self.token.append(-1)
                node = child
            self.token[node] = token
        self.fits: dict[tuple[int, int], bool] = {}
        self.reset()

    def reset(self) -> None:
        self.states = {((0, -1, 0),): 0}
        self.keys = [((0, -1, 0),)]
        self.edges = 0
        self._table(1 << 16)

    def _table(self, slots: int) -> None:
        """Transitions by open addressing: edge (state and byte), next state, tokens added."""
        self.edge = np.full(slots, -1, np.int64)
        self.to = np.zeros(slots, np.int32)
        self.adds = np.zeros(slots, np.int8)

    def _slots(self, edges: np.ndarray) -> np.ndarray:
        """Where each edge stands, or the empty slot where it belongs."""
        mask = len(self.edge) - 1
        slots = ((edges * 0x9E3779B97F4A7C1) >> 20) & mask
        held = self.edge[slots]
        wrong = np.flatnonzero((held != edges) & (held >= 0))
        while len(wrong):
            slots[wrong] = (slots[wrong] + 1) & mask
            held = self.edge[slots[wrong]]
            wrong = wrong[(held != edges[wrong]) & (held >= 0)]
        return slots

    def _put(self, edges: np.ndarray, to: np.ndarray, adds: np.ndarray) -> None:
        if (self.edges + len(edges)) * 4 > len(self.edge):
            full = self.edge >= 0
            edges, to, adds = (np.concatenate(x) for x in ((self.edge[full], edges), (self.to[full], to), (self.adds[full], adds)))
            self.edges = 0
            self._table(1 << int(len(edges) * 8).bit_length())
        todo = np.arange(len(edges))
        while len(todo):  # of edges that want the same slot one gets it, the others look on
            slots = self._slots(edges[todo])
            self.edge[slots] = edges[todo]
            got = self.edge[slots] == edges[todo]
            done = todo[got]
            self.to[slots[got]], self.adds[slots[got]] = to[done], adds[done]
            todo = todo[~got]
        self.edges += len(edges)

    def _fit(self, left: int, right: int) -> bool:
        """Whether the merges leave these two tokens side by side: undone from the latest, no earlier merge spans them."""
        known = self.fits.get((left, right))
        if known is None:
            a, b, limit, known = left, right, len(self.rank) + 1, True
            while True:
                if self.rank.get((a, b), limit) < limit:
                    known = False
                    break
                made_a, made_b = self.made.get(a, -1), self.made.get(b, -1)
                if made_a > made_b:
                    limit, a = made_a, self.parts[a][1]
                elif made_b >= 0:
                    limit, b = made_b + 1, self.parts[b][0]
                else:
                    break
            self.fits[left, right] = known
        return known

    def _make(self, state: int, byte: int) -> tuple[int, int]:
        last, add, live = -1, 0, []
        for node, before, behind in self.keys[state]:  # longest suffix first
            child = self.children[node].get(byte)
            if child is None:
                continue
            token = self.token[child]
            if last < 0 and token >= 0 and (before < 0 or self._fit(before, token)):
                last, add = token, behind + 1
            if self.children[child]:
                live.append((child, before, behind))
        key = (*((node, before, behind - add) for node, before, behind in live), (0, last, 0))
        new = self.states.get(key)
        if new is None:
            new = self.states[key] = len(self.keys)
            self.keys.append(key)
        return new, add

    def count(self, raw: np.ndarray, starts: np.ndarray, ends: np.ndarray) -> np.ndarray:
        """Tokens of each word, all words a byte further at each step."""
        if len(self.keys) > self.most_states:
            self.reset()
        lengths = ends - starts
        order = np.argsort(-lengths, kind="stable")
        at = starts[order]
        sizes = -lengths[order]
        state, count = np.zeros(len(at), np.int64), np.zeros(len(at), np.int64)
        for k in range(int(-sizes[0]) if len(at) else 0):
            n = int(np.searchsorted(sizes, -k, "left"))  # words longer than k
            edge = state[:n] * 256 + raw[at[:n] + k]
            slots = self._slots(edge)
            missing = self.edge[slots] != edge
            if missing.any():
                new = np.unique(edge[missing])
                made = np.array([self._make(e >> 8, e & 255) for e in new.tolist()])
                self._put(new, made[:, 0], made[:, 1])
                slots = self._slots(edge)
            count[:n] += self.adds[slots]
            state[:n] = self.to[slots]
        out = np.empty_like(count)
        out[order] = count
        return out


class Tokenizer:
    """Counts tokens of texts as a byte-level BPE file gives them, special strings in texts being one token each."""

    def __init__(self, spec: str) -> None:
        loaded = json.loads(spec)
        self.specials = [t["content"].encode() for t in loaded["added_tokens"]]
        self.cutter = Cutter()
        self.words = WordCounter(loaded["model"]["vocab"], loaded["model"]["merges"])

    def counts(self, raw: np.ndarray, offsets: np.ndarray) -> np.ndarray:
        """Tokens of each row of a run of UTF-8 bytes."""
        data = raw.tobytes()
        char_at = np.flatnonzero((raw & 0xC0) != 0x80)
        kinds = self.cutter.kinds[np.frombuffer(data.decode().encode("utf-32-le"), np.uint32)]
        row_chars = np.searchsorted(char_at, offsets)
        special = np.zeros(len(offsets) - 1, np.int64)
        for mark in self.specials:
            found = data.find(mark)
            while found >= 0:
                row = int(np.searchsorted(offsets, found, "right")) - 1
                if found + len(mark) <= offsets[row + 1]:
                    a = int(np.searchsorted(char_at, found))
                    kinds[a : a + len(mark.decode())] = SPECIAL
                    special[row] += 1
                    found = data.find(mark, found + len(mark))
                else:
                    found = data.find(mark, found + 1)
        ended = np.insert(kinds, row_chars[1:], END)  # after each row
        place = np.arange(len(kinds)) + np.repeat(np.arange(len(row_chars) - 1), np.diff(row_chars))
        cut = self.cutter.cuts(ended)[place]
        cut[row_chars[:-1][np.diff(row_chars) > 0]] = True
        first = np.flatnonzero(cut)
        starts = char_at[first]
        ends = np.append(starts[1:], len(raw))
        ordinary = kinds[first] != SPECIAL
        starts, ends = starts[ordinary], ends[ordinary]
        hashes = streams.span_sums(streams.KEYED[raw], streams.BYTE_BASE, starts, ends)
        _, one, which = np.unique(streams.mix(hashes), return_index=True, return_inverse=True)
        total = np.zeros(len(starts) + 1, np.int64)
        np.cumsum(self.words.count(raw, starts[one], ends[one])[which], out=total[1:])
        bounds = np.searchsorted(starts, offsets)
        return total[bounds[1:]] - total[bounds[:-1]] + special
