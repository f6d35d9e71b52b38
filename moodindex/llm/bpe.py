"""Byte-level BPE encoding and decoding with a rank queue on a hierarchical
bitmap.

Pre-tokens are one linked list of bytes, with a barrier between any two of them
that no pair crosses.  Each adjacent pair that merges
has a rank; the queue has one bucket of list positions per rank and a bitmap
of the buckets that are not empty: words of 256 ranks under a summary word.
Find-first-set on both gives the lowest rank, and its bucket is drained from
left to right.  A position whose pair has changed since is
stale and skipped.  If a merge makes a pair of a lower rank than the bucket's, the
rest of the bucket goes back into the queue.  So each pre-token sees its lowest rank
at its leftmost place first, whatever it shares the list with.  A merge costs the same at any
length: a pre-token of n bytes takes O(n log n) steps (the log for the order of positions
within a bucket), not O(n^2).

Texts are split by the given pattern and never cut; pre-tokens that are
entries of the vocabulary are taken as they are; the ids of short chunks and
pre-tokens are remembered within a worker (bounded).

Defined results: null or empty text gives no ids and decodes to no bytes; an
empty table gives an empty table; other columns are carried along, but for
those with the names of the new columns, which are replaced.
"""

from __future__ import annotations

import base64
from collections.abc import Iterator

import numpy as np
import pandas as pd
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from moodindex.llm.chunks import CACHE_CHARS, ChunkEncoder, Memo
from moodindex.llm.common import fresh, give_back, text_of

# 256 ranks to a word of the bitmap; one summary word tells which words are not empty.
WORD_BITS = 8
WORD_MASK = (1 << WORD_BITS) - 1
# Bytes of the pre-tokens of one list (a longer pre-token has a list of its own).
LIST_BYTES = 1 << 17
# Bytes of each of the two memories (chunks, pre-tokens), a generation.
MEMO_BYTES = 64 << 20


class Vocabulary:
    """Ranks of a file with one ``base64 rank`` line per entry."""

    def __init__(self, path: str, pattern: str):
        import regex
        with open(path, "rb") as f:
            self.ranks = {base64.b64decode(a): int(b) for a, b in map(bytes.split, f)}
        self.entries: dict[int, bytes] = {v: k for k, v in self.ranks.items()}
        self.find = regex.compile(pattern).findall
        self.n_words = (max(self.entries) >> WORD_BITS) + 1
        self.byte = np.array([self.ranks[bytes([i])] for i in range(256)], np.int64)
        self.pairs = self._joins()
        self.first = np.full((256, 256), -1, np.int64)  # ranks of pairs of bytes
        for i, x in enumerate(self.byte.tolist()):
            for j, y in enumerate(self.byte.tolist()):
                self.first[i, j] = self.pairs.get(x << 32 | y, -1)
        self.table: pa.Array | None = None  # the entries by rank, for decoding
        self.memo = Memo(MEMO_BYTES)
        self.encode_texts = ChunkEncoder(self._encode_many, MEMO_BYTES)

    def _joins(self) -> dict[int, int]:
        """The rank of every entry by two entries that make it (``left << 32 | right``)."""
        ranks, out = self.ranks, {}
        for entry, r in ranks.items():
            for cut in range(1, len(entry)):
                left = ranks.get(entry[:cut])
                if left is not None:
                    right = ranks.get(entry[cut:])
                    if right is not None:
                        out[left << 32 | right] = r
        return out

    def encode_pieces(self, pieces: list[bytes]) -> list[bytes]:
        """Ids of pre-tokens, little-endian 32 bits: always the lowest rank of
        a pre-token, at its leftmost place."""
        ranks = self.ranks
        out = [ranks[p].to_bytes(4, "little") if p in ranks else b"" for p in pieces]
        block: list[int] = []
        size = 0
        for at, p in enumerate(pieces):
            if out[at] or not p:
                continue
            if block and size + len(p) > LIST_BYTES:
                self._fill(out, pieces, block)
                block, size = [], 0
            block.append(at)
            size += len(p)
        self._fill(out, pieces, block)
        return out

    def _fill(self, out: list[bytes], pieces: list[bytes], block: list[int]) -> None:
        if block:
            for at, ids in zip(block, self._encode_list([pieces[at] for at in block]), strict=True):
                out[at] = ids

    def encode_piece(self, piece: bytes) -> list[int]:
        """Ids of one pre-token."""
        return np.frombuffer(self.encode_pieces([piece])[0], "<u4").tolist()

    def _encode_list(self, pieces: list[bytes]) -> list[bytes]:
        sizes = np.fromiter(map(len, pieces), np.int64, len(pieces))
        total = int(sizes.sum())
        # a barrier (id -1, so no pair is found) before each piece, and one at the end
        barrier = np.concatenate([[0], np.cumsum(sizes + 1)])
        n = total + len(barrier)
        inside = np.ones(n, bool)
        inside[barrier] = False
        raw = np.zeros(n, np.uint8)
        raw[inside] = np.frombuffer(b"".join(pieces), np.uint8)
        ids_at = np.where(inside, self.byte[raw], -1)
        rank_at = np.full(n, -1, np.int64)
        rank_at[:-1] = np.where(inside[:-1] & inside[1:], self.first[raw[:-1], raw[1:]], -1)
        places = np.flatnonzero(rank_at >= 0)
        places = places[np.argsort(rank_at[places], kind="stable")]
        found, starts = np.unique(rank_at[places], return_index=True)
        buckets: dict[int, list[int]] = dict(zip(
            found.tolist(), (x.tolist() for x in np.split(places, starts[1:])), strict=True)) if len(found) else {}
        words, top = [0] * self.n_words, 0
        for r in buckets:
            words[r >> WORD_BITS] |= 1 << (r & WORD_MASK)
            top |= 1 << (r >> WORD_BITS)
        ids, waiting = ids_at.tolist(), rank_at.tolist()  # waiting: the rank of the pair that starts here
        after, before = list(range(1, n + 1)), list(range(-1, n - 1))
        known, bucket_of = self.pairs.get, buckets.get
        while top:
            # find first set: the summary word, then its word
            at = (top & -top).bit_length() - 1
            word = words[at]
            bit = word & -word
            words[at] = word = word ^ bit
            if not word:
                top ^= 1 << at
            rank = (at << WORD_BITS) + bit.bit_length() - 1
            bucket = buckets.pop(rank)
            if len(bucket) > 1:
                bucket.sort()
            rest = iter(bucket)
            left_key, lower = rank << 32, False
            for i in rest:
                if waiting[i] != rank:
                    continue  # stale
                j = after[i]
                k = after[j]
                h = before[i]
                ids[i] = rank
                ids[j] = waiting[j] = -1
                after[i] = k
                before[k] = i
                waiting[i] = r = known(left_key | ids[k], -1)
                if r >= 0:
                    held = bucket_of(r)
                    if held is not None:
                        held.append(i)
                    else:
                        buckets[r] = [i]
                        words[r >> WORD_BITS] |= 1 << (r & WORD_MASK)
                        top |= 1 << (r >> WORD_BITS)
                    lower = r < rank
                waiting[h] = r = known(ids[h] << 32 | rank, -1)
                if r >= 0:
                    held = bucket_of(r)
                    if held is not None:
                        held.append(h)
                    else:
                        buckets[r] = [h]
                        words[r >> WORD_BITS] |= 1 << (r & WORD_MASK)
                        top |= 1 << (r >> WORD_BITS)
                    lower = lower or r < rank
                if lower:
                    back = list(rest)
                    if back:
                        buckets[rank] = back
                        words[at] |= bit
                        top |= 1 << at
        made = np.array(ids, np.int64)
        kept = np.concatenate([[0], np.cumsum(made >= 0)])[barrier] * 4
        raw_ids = made[made >= 0].astype("<u4").tobytes()
        cuts = kept.tolist()
        return [raw_ids[a:b] for a, b in zip(cuts, cuts[1:])]

    def _encode_many(self, texts: list[str]) -> list[bytes]:
        split = list(map(self.find, texts))
        new = self.memo.missing(set().union(*split))
        memo = self.memo.now
        memo.update(zip(new, self.encode_pieces([p.encode() for p in new]), strict=True))
        out = [b"".join(map(memo.__getitem__, s)) for s in split]
        for p in new:
            if len(p) > CACHE_CHARS:
                del memo[p]
        return out

    def decode(self, ids: list[int]) -> bytes:
        return b"".join(map(self.entries.__getitem__, ids))

    def decode_lists(self, lists: pa.ListArray) -> pa.Array:
        """The bytes of every list of ids (null: no bytes), joined by Arrow."""
        if self.table is None:
            self.table = pa.array([self.entries.get(k) for k in range(max(self.entries) + 1)], pa.large_binary())
        ids = lists.flatten()
        found = self.table.take(ids)
        if found.null_count:
            raise KeyError(ids.filter(found.is_null())[0].as_py())
        cuts = np.concatenate([[0], np.cumsum(pc.fill_null(pc.list_value_length(lists), 0).to_numpy())])
        ends = np.frombuffer(found.buffers()[1], np.int64)[found.offset:found.offset + len(found) + 1] \
            if len(found) else np.zeros(1, np.int64)
        return pa.LargeBinaryArray.from_buffers(pa.large_binary(), len(lists), [
            None, pa.py_buffer(ends[cuts].tobytes()), found.buffers()[2] or pa.py_buffer(b"")])


_LOADED: dict[tuple[str, str], Vocabulary] = {}


def vocabulary(path: str, pattern: str) -> Vocabulary:
    """One vocabulary a worker process and file."""
    if (path, pattern) not in _LOADED:
        _LOADED[path, pattern] = Vocabulary(path, pattern)
    return _LOADED[path, pattern]


def _without(df: DataFrame, name: str) -> list:
    return [F.col(f"`{c}`") for c in df.columns if c.lower() != name.lower()]


def bpe_encode(df: DataFrame, path: str, pattern: str, text_col: str = "text",
               out: str = "ids") -> DataFrame:
    """Add ``out``: array<int>, the ids of the whole text."""

    @F.pandas_udf("array<int>")
    def ids_of(batches: Iterator[pd.Series]) -> Iterator[pd.Series]:
        v = vocabulary(path, pattern)
        try:
            for texts in batches:
                yield pd.Series([np.frombuffer(x, "<u4").astype(np.int32) for x in v.encode_texts(texts.tolist())],
                                dtype=object)
        finally:
            give_back()

    t = fresh(df, "_text")
    d = df.withColumn(t, text_of(text_col))
    return d.select(*_without(df, out), ids_of(F.col(t)).alias(out))


def bpe_decode(df: DataFrame, path: str, pattern: str, ids_col: str = "ids",
               out: str = "decoded") -> DataFrame:
    """Add ``out``: the bytes of an array of ids (null ids array: no bytes)."""

    @F.arrow_udf("binary")
    def bytes_of(ids: pa.Array) -> pa.Array:
        return vocabulary(path, pattern).decode_lists(ids).cast(pa.binary())

    return df.select(*_without(df, out), bytes_of(F.col(ids_col)).alias(out))
