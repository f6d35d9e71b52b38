"""Sequence packing by the sum-of-squares rule.

Each document becomes its token ids and an end id.  Full windows are cut off
its front; the rest, shorter than a window, goes to the fill level that
minimises the sum over levels of the squared number of open windows at that level.
``open_at[h]`` is the level array; a placement from level h to h + r changes the sum by
``(1 - 2 open_at[h]) + (1 + 2 open_at[h + r])`` with the terms of level 0 and
of a full window left out.

Every task packs the rows of its own input partition (no shuffle, no key),
so sequences never span tasks and a lost task repeats with the same result.
Open windows of a task are bounded by ``MAX_OPEN``: beyond it, and at the end
of the task, the emptiest windows are cut up to fill the fullest ones.  What then remains
is less than one window; it is cut into pieces of power-of-two length, which
need no padding.

Defined results: null text = '', which has the end id only; an empty table
gives an empty table; ids may be null or repeat; other columns are ignored.
"""

from __future__ import annotations

from array import array
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame

from moodindex.llm.chunks import ChunkEncoder
from moodindex.llm.common import give_back, partition_id, text_of

WINDOW = 1024
END_ID = 0
MAX_OPEN = 2048

SCHEMA = ("doc_id {id}, start long, length long, ids binary, doc_tokens long, "
          "sequence_id long, offset long")


class Packer:
    """Packs the pieces of one task.  A window is a list of pieces
    ``(doc, start, ids, doc_tokens)`` with ``ids`` as little-endian 32 bits."""

    def __init__(self, window: int = WINDOW, first_id: int = 0, max_open: int = MAX_OPEN):
        self.window, self.next_id, self.max_open = window, first_id, max_open
        self.open_at = np.zeros(window + 1, np.int64)
        self.bins: dict[int, list[list]] = {}
        self.n_open = 0
        self.out: list[tuple] = []

    def _emit(self, pieces: list) -> None:
        offset = 0
        for doc, start, ids, total in pieces:
            n = len(ids) // 4
            self.out.append((doc, start, n, ids, total, self.next_id, offset))
            offset += n
        self.next_id += 1

    def _level(self, r: int) -> int:
        """The level from which a piece of r tokens costs least; ties: the fullest."""
        w = self.window
        n = self.open_at[:w - r + 1]
        cost = np.where(n > 0, 1 - 2 * n, np.iinfo(np.int64).max // 2)
        cost[0] = 0
        after = 1 + 2 * self.open_at[r:w + 1]
        after[-1] = 0
        cost = cost + after
        return int(len(cost) - 1 - np.argmin(cost[::-1]))

    def _put(self, level: int, pieces: list) -> None:
        if level == self.window:
            self._emit(pieces)
            return
        self.bins.setdefault(level, []).append(pieces)
        self.open_at[level] += 1
        self.n_open += 1

    def _take(self, level: int) -> list:
        self.open_at[level] -= 1
        self.n_open -= 1
        return self.bins[level].pop()

    def add(self, doc, ids: bytes) -> None:
        total, step = len(ids) // 4, 4 * self.window
        for at in range(0, len(ids) - step + 1, step):
            self._emit([(doc, at // 4, ids[at:at + step], total)])
        r = total % self.window
        if r:
            rest = (doc, total - r, ids[4 * (total - r):], total)
            h = self._level(r)
            pieces = self._take(h) if h else []
            pieces.append(rest)
            self._put(h + r, pieces)
            if self.n_open > self.max_open:
                self._settle(self.max_open // 2)

    def _settle(self, most: int) -> None:
        """Cut the emptiest open windows to fill the fullest, until ``most`` are open."""
        levels = [h for h in sorted(self.bins) for _ in self.bins[h]]
        windows = [self._take(h) for h in levels]  # emptiest first
        low, loose = 0, []  # loose: pieces of the window that is being cut up
        while len(windows) - low > most:
            full = windows.pop()
            room = self.window - levels.pop()
            while room:
                if not loose:
                    if low == len(windows):
                        break
                    loose, low = windows[low], low + 1
                doc, start, ids, total = loose.pop()
                n = min(room, len(ids) // 4)
                full.append((doc, start, ids[:4 * n], total))
                if 4 * n < len(ids):
                    loose.append((doc, start + n, ids[4 * n:], total))
                room -= n
            if room:
                loose = full
                break
            self._emit(full)
        for h, w in zip(levels[low:], windows[low:], strict=True):
            self._put(h, w)
        if loose:
            self._put(sum(len(p[2]) for p in loose) // 4, loose)

    def finish(self) -> None:
        self._settle(0)
        for h in sorted(self.bins, reverse=True):
            while self.bins[h]:
                pieces, left = self._take(h), h
                while left:
                    size = 1 << (left.bit_length() - 1)
                    left -= size
                    part = []
                    while size:
                        doc, start, ids, total = pieces.pop(0)
                        n = min(size, len(ids) // 4)
                        part.append((doc, start, ids[:4 * n], total))
                        if 4 * n < len(ids):
                            pieces.insert(0, (doc, start + n, ids[4 * n:], total))
                        size -= n
                    self._emit(part)


_ENCODERS: dict[str, ChunkEncoder] = {}


def encoder(path: str) -> ChunkEncoder:
    """One encoder a worker process and vocabulary file."""
    if path not in _ENCODERS:
        import os
        os.environ["TOKENIZERS_PARALLELISM"] = "false"
        from tokenizers import Tokenizer
        tok = Tokenizer.from_file(path)
        tok.encode_special_tokens = True
        _ENCODERS[path] = ChunkEncoder(lambda texts: [
            array("I", e.ids).tobytes()
            for e in tok.encode_batch_fast(texts, add_special_tokens=False)])  # ids, no offsets
    return _ENCODERS[path]


def pack(docs: DataFrame, tokenizer: str, id_col: str = "doc_id", text_col: str = "text",
         window: int = WINDOW, end_id: int = END_ID) -> DataFrame:
    """One row per piece: ``doc_id``, ``start`` (ids of its document before
    it), ``length``, ``ids`` (little-endian unsigned 32 bits), ``doc_tokens``
    (with the end id), ``sequence_id``, ``offset``."""
    end = int(end_id).to_bytes(4, "little")
    id_type = docs.schema[id_col].dataType
    names = ["doc_id", "start", "length", "ids", "doc_tokens", "sequence_id", "offset"]

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        encode = encoder(tokenizer)
        packer = Packer(window, partition_id() << 32)
        kind = None

        def flush():
            rows, packer.out = packer.out, []
            cols = list(zip(*rows, strict=True))
            kinds = [kind, pa.int64(), pa.int64(), pa.binary(), pa.int64(), pa.int64(), pa.int64()]
            return pa.record_batch([pa.array(c, k) for c, k in zip(cols, kinds, strict=True)], names=names)

        try:
            for b in batches:
                kind = b.column(0).type
                for doc, ids in zip(b.column(0).to_pylist(), encode(b.column(1).to_pylist()), strict=True):
                    packer.add(doc, ids + end)
                    if len(packer.out) >= 2000:
                        yield flush()
            packer.finish()
            if packer.out:
                yield flush()
        finally:
            del packer
            give_back()

    return (docs.select(docs[id_col].alias("doc_id"), text_of(text_col).alias("text"))
            .mapInArrow(run, SCHEMA.format(id=id_type.simpleString())))
