"""Memoised encoding of whole texts, chunk by chunk.

The split pattern of byte-level tokenizers never joins a non-space character
with white space after it, and a single space belongs to the word that
follows.  So a text whose single spaces stand between non-space characters
can be cut before each space: chunks encode on their own, and a chunk that
was seen is not encoded again.  A text with any other space is encoded as a
whole.  Nor does the pattern join a letter with a punctuation mark after it (an apostrophe
apart), so chunks are also cut between a Latin letter and a mark.

Arrow splits the texts and numbers their chunks, so only the distinct chunks of
a group of texts are looked up in Python; ids are put together by numbers."""

from __future__ import annotations

from collections.abc import Callable, Iterator

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc

# Bytes that a memory may take in each of two generations, about, and the
# longest chunk remembered: a bound of memory, not of results.
CACHE_BYTES = 96 << 20
CACHE_CHARS = 64
# What an entry takes: a slot of the dictionary and the heads of key and value;
# key and value themselves are counted by the longest chunk's share.
ENTRY_BYTES = 240
# Put, with a space, where a chunk without a space before it begins (a text that holds it is encoded as a whole).
MARK = "\x01"
LETTER_AND_MARK = "([A-Za-zÀ-ÖØ-öø-ɏ])([.,;:!?*#$%&|<>])"
# Characters of the texts that are put together at once (a longer text alone).
GROUP_CHARS = 4 << 20


class Memo:
    """A bounded memory of two generations."""

    def __init__(self, most: int = CACHE_BYTES):
        self.size = most // ENTRY_BYTES
        self.now: dict = {}
        self.old: dict = {}

    def missing(self, keys: set) -> list:
        """Those of ``keys`` that aren't remembered; the others are in ``now`` after it."""
        if len(self.now) > self.size:
            self.old, self.now = self.now, {}
        out = []
        for k in keys.difference(self.now):
            got = self.old.get(k)
            if got is None:
                out.append(k)
            else:
                self.now[k] = got
        return out


class ChunkEncoder:
    """``encode`` maps texts to their ids as bytes (little-endian 32 bits)."""

    def __init__(self, encode: Callable[[list[str]], list[bytes]], most: int = CACHE_BYTES):
        self.encode = encode
        self.memo = Memo(most)

    def __call__(self, texts: list[str]) -> list[bytes]:
        return [ids for group in _groups(texts) for ids in self._group(group)]

    def _group(self, texts: list[str]) -> list[bytes]:
        given = pa.array(texts, pa.large_string())
        split = pc.split_pattern(pc.replace_substring_regex(given, LETTER_AND_MARK, rf"\1 {MARK}\2"), " ")
        bounds = split.offsets.to_numpy().astype(np.int64)
        first = bounds[:-1]  # where each text's first chunk is: it has no space before it
        coded = split.flatten().dictionary_encode()
        chunks = coded.dictionary.to_numpy(zero_copy_only=False).tolist()
        code = coded.indices.to_numpy().astype(np.int64)
        heads = [chunks[c] for c in code[first].tolist()]
        new = self.memo.missing(set(chunks))
        odd = {c for c in new
               if not c or c[0].isspace() or c[-1].isspace() or len(c) > CACHE_CHARS}
        new = [c for c in new if c not in odd]
        now = self.memo.now
        now.update(zip(new, self.encode([c[1:] if c[0] == MARK else " " + c for c in new]), strict=True))
        get = now.get
        known = [get(c, b"") for c in chunks]

        whole = np.fromiter((not h or h[0].isspace() or h[-1].isspace() for h in heads), bool, len(heads))
        whole &= np.diff(bounds) > 1
        whole |= pc.match_substring(given, MARK).to_numpy(zero_copy_only=False)
        if odd:
            bad = np.fromiter((c in odd for c in chunks), bool, len(chunks))[code]
            bad[first] = False
            whole |= np.add.reduceat(bad, first, dtype=np.int64) > 0
        heads = [t if w else h for t, h, w in zip(texts, heads, whole.tolist(), strict=True)]
        known += self.encode(heads)

        code[first] = np.arange(len(chunks), len(known))
        sizes = np.fromiter(map(len, known), np.int64, len(known)) // 4
        length = sizes[code]
        after = np.repeat(whole, np.diff(bounds))  # chunks of a text that its head stands for
        after[first] = False
        length[after] = 0
        end = np.cumsum(length)
        shift = (np.cumsum(sizes) - sizes)[code] - (end - length)
        ids = np.frombuffer(b"".join(known), "<u4")[np.repeat(shift, length) + np.arange(int(end[-1]))].tobytes()
        cuts = [0, *(4 * end[bounds[1:] - 1]).tolist()]
        return [ids[a:b] for a, b in zip(cuts, cuts[1:])]


def _groups(texts: list[str]) -> Iterator[list[str]]:
    group, size = [], 0
    for t in texts:
        if group and size + len(t) > GROUP_CHARS:
            yield group
            group, size = [], 0
        group.append(t)
        size += len(t)
    if group:
        yield group
