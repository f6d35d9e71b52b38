"""Many keywords at once in the texts of an Arrow batch, by array operations on their bytes.

The texts are searched where they lie, ``PLACES`` bytes at a time.  A place is a candidate if its first two bytes
begin a gram and a hashed table knows the gram; only candidates are looked up, and only keywords filed under
the gram found are compared with the text, ``PAIRS`` at a time.  So memory is bounded, whatever the texts hold.
In UTF-8 a keyword's bytes occur in a text's bytes where the keyword occurs in the text, and nowhere else.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa

PLACES = 1 << 18
PAIRS = 1 << 20
# Bytes of a gram that are looked up, and of a keyword that are compared at once.
CODE = BLOCK = 8
_FACTOR = 0x9E3779B97F4A7C15


def batch_bytes(texts: pa.Array) -> tuple[np.ndarray, np.ndarray]:
    """The bytes of the texts one after the other, and where each text begins, the end beside them."""
    if texts.null_count:
        texts = texts.fill_null("")
    if not len(texts):
        return np.zeros(0, np.uint8), np.zeros(1, np.int64)
    kind = np.int64 if pa.types.is_large_string(texts.type) else np.int32
    _, begins, data = texts.buffers()
    begins = np.frombuffer(begins, kind)[texts.offset:texts.offset + len(texts) + 1].astype(np.int64)
    return np.frombuffer(data if data else b"", np.uint8)[:begins[-1]], begins


class Grams:
    """``number``: of each gram, that of its first ``CODE`` bytes; ``size`` numbers in all."""

    def __init__(self, grams: list[bytes]):
        sizes = np.array([min(len(g), CODE) for g in grams], np.int64)
        codes = np.array([int.from_bytes(g[:CODE], "little") for g in grams], np.uint64)
        self.number, self.size, self.kinds = np.zeros(len(grams), np.int64), 0, []
        for n in np.unique(sizes).tolist():
            at = np.flatnonzero(sizes == n)
            kind = np.uint32 if n <= 4 else np.uint64
            known, which = np.unique(codes[at].astype(kind), return_inverse=True)
            begins = np.zeros(1 << (8 * min(n, 2)), bool)
            begins[known & kind(len(begins) - 1)] = True
            bits = 8 * kind().itemsize
            factor = kind(_FACTOR >> (64 - bits) | 1)
            drop = kind(bits - min(24, max(16, len(known).bit_length() + 5)))
            table = np.zeros(1 << (bits - int(drop)), bool)
            table[known * factor >> drop] = True
            self.number[at] = self.size + which
            self.kinds.append((n, begins, factor, drop, table, known, self.size))
            self.size += len(known)

    def _candidates(self, data: np.ndarray, start: int, end: int) -> Iterator[tuple]:
        """By length: places from ``start`` to ``end`` where a gram may begin, and what is there."""
        for n, begins, factor, drop, table, known, base in self.kinds:
            last = min(end, len(data) - n + 1)
            if last <= start:
                continue
            here = data[start:last]
            if n > 1:
                here = here | data[start + 1:last + 1].astype(np.uint16) << 8
            at = np.flatnonzero(begins[here])
            code = here[at].astype(known.dtype)
            for k in range(2, n):
                code |= data[start + k:][at].astype(known.dtype) << known.dtype.type(8 * k)
            met = table[code * factor >> drop]
            yield n, at[met] + start, code[met], known, base

    def places(self, data: np.ndarray, start: int, end: int) -> Iterator[tuple[np.ndarray, np.ndarray]]:
        """Places where a gram begins, and its number."""
        for _, at, code, known, base in self._candidates(data, start, end):
            rank = np.minimum(np.searchsorted(known, code), len(known) - 1)
            met = known[rank] == code
            yield at[met], rank[met] + base

    def count(self, texts: pa.Array, out: np.ndarray) -> None:
        """Adds to ``out`` how often each number occurs."""
        data, begins = batch_bytes(texts)
        inner = begins[1:-1]
        for start in range(int(begins[0]), len(data), PLACES):
            end = min(start + PLACES, len(data))
            near = inner[np.searchsorted(inner, start, side="right"):np.searchsorted(inner, end + CODE)]
            for size, at, code, known, base in self._candidates(data, start, end):
                over = (near[:, None] - np.arange(1, size)).ravel() - start  # from these places on the next text is met
                cut = np.zeros(end - start, bool)
                cut[over[(over >= 0) & (over < end - start)]] = True
                code, n = np.unique(code[~cut[at - start]], return_counts=True)
                rank = np.minimum(np.searchsorted(known, code), len(known) - 1)
                met = known[rank] == code
                out[rank[met] + base] += n[met]


def every_block(data: np.ndarray) -> np.ndarray:
    """The ``BLOCK`` bytes from each place on, as one number."""
    return np.ndarray((max(0, len(data) - BLOCK + 1),), "<u8", data.data, strides=(1,))


def _distinct(keys: np.ndarray) -> np.ndarray:
    keys = np.sort(keys)
    return keys[np.concatenate([[True], keys[1:] != keys[:-1]])] if len(keys) else keys


def _runs(n: np.ndarray) -> Iterator[slice]:
    """Runs of entries with a sum of about ``PAIRS`` at most; one entry at least."""
    ends = np.cumsum(n)
    start = 0
    while start < len(n):
        end = max(start + 1, int(np.searchsorted(ends, ends[start] - n[start] + PAIRS, side="right")))
        yield slice(start, end)
        start = end


class Keywords:
    """Keywords under one gram each; ``filed``: pairs of gram and keyword, a keyword once."""

    def __init__(self, filed: list[tuple[str, str]]):
        self.grams = Grams([g.encode() for g, _ in filed])
        self.filed = np.bincount(self.grams.number, minlength=self.grams.size)
        self.begin = np.cumsum(self.filed) - self.filed
        filed = [filed[k] for k in np.argsort(self.grams.number, kind="stable").tolist()]  # those of a gram in a row
        self.words = [k for _, k in filed]
        self.bytes = [k.encode() for k in self.words]
        grams = [g.encode() for g, _ in filed]
        self.size = np.array([len(k) for k in self.bytes], np.int64)
        back = [k.index(g) for k, g in zip(self.bytes, grams, strict=True)]
        near = [max(0, min(at, len(k) - BLOCK)) for k, at in zip(self.bytes, back, strict=True)]
        self.back = np.array(back, np.int64)
        # the block that is compared first, how far before the gram it begins, and which of its bits count
        self.before = np.array([at - n for at, n in zip(back, near, strict=True)], np.int64)
        self.near = self._blocks(near)
        self.mask = np.array([(1 << 8 * min(len(k), BLOCK)) - 1 for k in self.bytes], np.uint64)
        self.first = self._blocks([0] * len(filed))
        self.last = self._blocks([max(0, len(k) - BLOCK) for k in self.bytes])

    def _blocks(self, at: list[int]) -> np.ndarray:
        return np.array([int.from_bytes(k[n:n + BLOCK], "little") for k, n in zip(self.bytes, at, strict=True)], np.uint64)

    def _pairs(self, data: np.ndarray, start: int, end: int) -> Iterator[tuple[np.ndarray, np.ndarray]]:
        """Keywords whose block around the gram is there, and where they would begin."""
        blocks = None
        for at, gram in self.grams.places(data, start, end):
            if blocks is None:
                low = max(0, start - BLOCK)
                span = np.zeros(end - low + 2 * BLOCK, np.uint8)
                part = data[low:end + BLOCK]
                span[:len(part)] = part
                blocks = every_block(span).copy()
            for run in _runs(self.filed[gram]):
                n = self.filed[gram[run]]
                word = np.arange(n.sum()) + np.repeat(self.begin[gram[run]] - (np.cumsum(n) - n), n)
                block = np.repeat(at[run] - low, n) - self.before[word]
                # a block that begins before the texts is taken from their end: its keyword begins in no text
                on = np.flatnonzero((blocks[block] ^ self.near[word]) & self.mask[word] == 0)
                word, block = word[on], block[on]
                yield word, block + low + self.before[word] - self.back[word]

    def found(self, texts: pa.Array) -> tuple[np.ndarray, np.ndarray]:
        """Rows and the numbers of the keywords in them; sorted, each pair once."""
        data, begins = batch_bytes(texts)
        keys = [np.zeros(0, np.int64)]
        for start in range(int(begins[0]), len(data), PLACES):
            for word, place in self._pairs(data, start, min(start + PLACES, len(data))):
                row = np.searchsorted(begins, place, side="right") - 1
                on = np.flatnonzero((row >= 0) & (place + self.size[word] <= begins[row + 1]))
                word, place, row = word[on], place[on], row[on]
                long = np.flatnonzero(self.size[word] > BLOCK)
                if len(long):
                    held = np.ones(len(word), bool)
                    held[long] = self._long(data, word[long], place[long])
                    word, row = word[held], row[held]
                keys.append(_distinct(row * len(self.words) + word))
        key = _distinct(np.concatenate(keys))
        return key // len(self.words), key % len(self.words)

    def _long(self, data: np.ndarray, word: np.ndarray, place: np.ndarray) -> np.ndarray:
        """Whether keywords of more than a block are at their places."""
        blocks = every_block(data)
        held = (blocks[place] == self.first[word]) & (blocks[place + self.size[word] - BLOCK] == self.last[word])
        more = np.flatnonzero(held & (self.size[word] > 2 * BLOCK))
        for k, w, p in zip(more.tolist(), word[more].tolist(), place[more].tolist(), strict=True):
            held[k] = data[p:p + len(self.bytes[w])].tobytes() == self.bytes[w]
        return held

    def counts(self, texts: pa.Array) -> pa.Array:
        """The number of distinct keywords of each text."""
        return pa.array(np.bincount(self.found(texts)[0], minlength=len(texts)), pa.int32())

    def lists(self, texts: pa.Array) -> pa.Array:
        """The distinct keywords of each text."""
        row, word = self.found(texts)
        cuts = np.searchsorted(row, np.arange(len(texts) + 1))
        return pa.ListArray.from_arrays(pa.array(cuts, pa.int32()), pa.array(self.words, pa.string()).take(pa.array(word)))
