"""Weighted acyclic automata of word sequences of up to three words.

An arc is labelled with a word; the weight of a sequence is that of its last arc
(0: the sequence is only the start of others).  Layers are kept as arrays: an
arc has a label, a weight and the state that it leads to; a state is a run
of arcs of the next layer.  States with one arc, which are most of them, are shared
when that arc is the same, so a word that is always followed alike is stored once.
Automata are built from sorted sequences, with array operations only.
"""

from __future__ import annotations

import struct

import numpy as np
import pyarrow as pa

WORDS = 3
BITS = 21  # of a label, where three fit into one sort key


def sort_keys(cols: list[np.ndarray], labels: int) -> np.ndarray:
    """One integer a row that sorts like the three label columns."""
    a, b, c = (x.astype(np.int64) for x in cols)
    if labels < (1 << BITS) - 1:
        return a << (2 * BITS) | b << BITS | c
    _, pair = np.unique(a * (labels + 2) + b, return_inverse=True)
    return pair.astype(np.int64) << 32 | c


def summed(cols: list[np.ndarray], weight: np.ndarray, labels: int):
    """Sorted distinct rows with the sums of their weights."""
    if not len(weight):
        return cols, weight
    keys = sort_keys(cols, labels)
    at = np.argsort(keys, kind="stable")
    keys = keys[at]
    first = np.ones(len(at), bool)
    first[1:] = keys[1:] != keys[:-1]
    starts = np.flatnonzero(first)
    return [x[at[starts]] for x in cols], np.add.reduceat(weight[at], starts)


def _shared(size: np.ndarray, cols: list[np.ndarray]):
    """States as runs of arcs: those with one arc once.  Returns the name
    of each state, the sizes of the named states and their arcs; state 0 is empty."""
    names = np.zeros(len(size), np.int64)
    start = np.cumsum(size) - size
    one = np.flatnonzero(size == 1)
    h = np.zeros(len(one), np.uint64)
    for c in cols:
        h = (h ^ c[start[one]].astype(np.uint64)) * np.uint64(0x9E3779B97F4A7C15)
        h ^= h >> np.uint64(29)
    _, rep, same = np.unique(h, return_index=True, return_inverse=True)
    if any((c[start[one[rep[same]]]] != c[start[one]]).any() for c in cols):
        rep, same = np.arange(len(one)), np.arange(len(one))  # two arcs with one hash: share nothing
    names[one] = same + 1
    many = np.flatnonzero(size > 1)
    names[many] = len(rep) + 1 + np.arange(len(many))
    sizes = np.concatenate([[0], np.ones(len(rep), np.int64), size[many]])
    n = size[many]
    flat = np.repeat(start[many] - (np.cumsum(n) - n), n) + np.arange(n.sum())
    arcs = np.concatenate([start[one[rep]], flat]).astype(np.int64)
    return names, sizes, [c[arcs] for c in cols]


def _spread(starts: np.ndarray, sizes: np.ndarray) -> np.ndarray:
    """The places of all arcs of the states, one after the other."""
    return np.repeat(starts - (np.cumsum(sizes) - sizes), sizes) + np.arange(sizes.sum())


class Automaton:
    """``words``: the labels in order.  Layer k: arrays ``label``, ``weight``,
    ``to`` (a state of layer k + 1) and the sizes of its states."""

    def __init__(self, words: list[bytes], layers: list[tuple]):
        self.words, self.layers = words, layers
        self._find = None

    @staticmethod
    def build(words: list[bytes], cols: list[np.ndarray], weight: np.ndarray) -> Automaton:
        """``cols``: for each place 1 + index of a word, or 0 beyond the end;
        rows sorted and distinct.  Only the words in use are kept."""
        used = np.unique(np.concatenate([c[c > 0] for c in cols]))
        table = np.zeros(int(used[-1]) + 1 if len(used) else 1, np.int64)
        table[used] = np.arange(1, len(used) + 1)
        cols = [table[c] for c in cols]
        layers = []
        rows = np.arange(len(weight))
        levels = []
        for k in range(WORDS):  # arcs of each layer, by the sequences' first k + 1 words
            rows = rows[cols[k][rows] > 0]
            new = np.ones(len(rows), bool)
            for c in cols[:k + 1]:
                v = c[rows]
                same = v[1:] == v[:-1]
                new[1:] = ~same if c is cols[0] else new[1:] | ~same
            arc = np.cumsum(new) - 1
            w = np.zeros(int(new.sum()), np.int64)
            ends = cols[k + 1][rows] == 0 if k + 1 < WORDS else np.ones(len(rows), bool)
            w[arc[ends]] = weight[rows[ends]]
            head = rows[new]
            levels.append((cols[k][head], w, head))
        below = None
        for k in range(WORDS - 1, -1, -1):
            label, w, head = levels[k]
            to = np.zeros(len(label), np.int64) if below is None else below
            if k:
                up = np.searchsorted(levels[k - 1][2], head, side="right") - 1
                size = np.bincount(up, minlength=len(levels[k - 1][2]))
                below, sizes, arcs = _shared(size, [label, w, to])
                layers.append((sizes, *arcs))
            else:
                layers.append((np.array([len(label)]), label, w, to))
        return Automaton([words[i - 1] for i in used], layers[::-1])

    def entries(self):
        """Columns as in ``build`` and weights, of the sequences with a weight; sorted."""
        cols, out = [], []
        to = np.zeros(1, np.int64)
        for k, (sizes, label, weight, nxt) in enumerate(self.layers):
            starts = np.cumsum(sizes) - sizes
            n = sizes[to]
            arc = _spread(starts[to], n)
            cols = [np.repeat(c, n) for c in cols] + [label[arc]]
            out.append((cols, weight[arc]))
            to = nxt[arc]
        full = [[np.concatenate([c[k] if k < len(c) else np.zeros(len(w), np.int64) for c, w in out])]
                for k in range(WORDS)]
        weight = np.concatenate([w for _, w in out])
        keep = weight > 0
        full, weight = [c[0][keep] for c in full], weight[keep]
        at = np.argsort(sort_keys(full, len(self.words)), kind="stable")
        return [c[at] for c in full], weight[at]

    def weights(self, parts: list[list[bytes]]) -> np.ndarray:
        """The weight of each sequence, 0 if unknown: the sequences, as an acceptor,
        are composed with the automaton layer by layer."""
        if self._find is None:
            index = {w: i + 1 for i, w in enumerate(self.words)}
            keys = [np.repeat(np.arange(len(s)), s) << 32 | label for s, label, _, _ in self.layers]
            self._find = index, [(np.argsort(k, kind="stable"), np.sort(k)) for k in keys]
        index, layers = self._find
        state, out = np.zeros(len(parts), np.int64), np.zeros(len(parts), np.int64)
        size = np.array([len(p) for p in parts], np.int64)
        on = np.arange(len(parts))
        for k in range(WORDS):
            on = on[size[on] > k]
            order, keys = layers[k]
            if not len(on) or not len(keys):
                break
            key = state[on] << 32 | np.array([index.get(parts[i][k], 0) for i in on], np.int64)
            at = np.searchsorted(keys, key)
            at[at == len(keys)] = 0
            hit = keys[at] == key
            on, arc = on[hit], order[at[hit]]
            _, _, weight, to = self.layers[k]
            last = size[on] == k + 1
            out[on[last]] = weight[arc[last]]
            state[on] = to[arc]
        return out

    def to_bytes(self) -> bytes:
        blob = b" ".join(self.words)
        parts = [struct.pack("<q", len(blob)), blob]
        for layer in self.layers:
            for x in layer:
                top = int(x.max()) if len(x) else 0
                kind = next(t for t in ("<u1", "<u2", "<u4", "<i8") if t == "<i8" or top <= np.iinfo(t).max)
                parts += [struct.pack("<cq", kind[-1].encode(), len(x)), x.astype(kind).tobytes()]
        raw = b"".join(parts)
        return struct.pack("<q", len(raw)) + pa.compress(raw, codec="zstd", asbytes=True)

    @staticmethod
    def from_bytes(data: bytes) -> Automaton:
        size, = struct.unpack_from("<q", data)
        raw = pa.decompress(data[8:], size, codec="zstd", asbytes=True)
        at, = struct.unpack_from("<q", raw)
        blob = raw[8:8 + at]
        at += 8
        layers = []
        for _ in range(WORDS):
            layer = []
            for _ in range(4):
                kind, n = struct.unpack_from("<cq", raw, at)
                wide = int(kind)
                t = np.dtype("<i8" if wide == 8 else f"<u{wide}")
                layer.append(np.frombuffer(raw, t, n, at + 9).astype(np.int64))
                at += 9 + n * wide
            layers.append(tuple(layer))
        return Automaton(blob.split(b" ") if blob else [], layers)


class Union:
    """The sum of automata: sequences are added up whenever ``most`` of them wait."""

    def __init__(self, most: int = 4_000_000):
        self.most = most
        self.index: dict[bytes, int] = {}
        self.parts: list[tuple] = []
        self.size = 0

    def add(self, a: Automaton) -> None:
        index = self.index
        names = np.zeros(len(a.words) + 1, np.int64)
        names[1:] = [index.setdefault(w, len(index) + 1) for w in a.words]
        cols, weight = a.entries()
        self.parts.append(([names[c] for c in cols], weight))
        self.size += len(weight)
        if self.size > 2 * self.most:
            self._sum()
            self.most = max(self.most, self.size)

    def _sum(self) -> None:
        cols = [np.concatenate([p[0][k] for p in self.parts]) for k in range(WORDS)]
        cols, weight = summed(cols, np.concatenate([p[1] for p in self.parts]), len(self.index))
        self.parts, self.size = [(cols, weight)], len(weight)

    def result(self, least: int = 1) -> tuple[Automaton, int]:
        """The automaton of the sequences with a sum of ``least`` or more, and the sum of
        all single words."""
        if not self.parts:
            return Automaton.build([], [np.zeros(0, np.int64)] * WORDS, np.zeros(0, np.int64)), 0
        self._sum()
        (cols, weight), = self.parts
        total = int(weight[cols[1] == 0].sum())
        keep = weight >= least
        cols, weight = [c[keep] for c in cols], weight[keep]
        words = sorted(self.index)
        rank = np.zeros(len(words) + 1, np.int64)
        rank[[self.index[w] for w in words]] = np.arange(1, len(words) + 1)
        cols, weight = summed([rank[c] for c in cols], weight, len(words))
        return Automaton.build(words, cols, weight), total
