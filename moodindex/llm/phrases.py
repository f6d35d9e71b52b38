"""Phrase collocation mining with weighted acyclic automata.

Texts are lowered (A-Z), cut into pieces at ``.,;:!?`` and U+000A to U+000D and
those into words at spaces and tabs.  For each language every sequence of one to
three words within a piece is counted; a phrase of two or three words that occurs
``least`` times or more is scored by its weakest cut: with a its count, l and r the
counts of the parts before and after a cut, floor(1,000,000 a a / (l r)).

1. *Ranges.*  A sample of sequences gives the bounds of prefix ranges: intervals of the
   sorted sequences of about ``RANGE_SEQUENCES`` occurrences.  A frequent first word
   spans several ranges.  (The bounds decide where work is done, not results.)
2. *Shards.*  A task counts its texts in chunks of ``CHUNK_WORDS`` words: sequences of
   sorted labels, sorted and summed, are built into an automaton for each range.
3. *Union.*  The automata of a range are united and their weights summed; sequences below
   ``least`` go.  As a part of a phrase is as frequent as the phrase, all parts of what is left
   are left too.
4. *Parts.*  Each phrase asks the ranges of its parts for their counts.  In a task the parts
   that are asked for are composed with the range's automaton; a range that is
   asked often is copied, so that its questions are spread over tasks.
5. *Verdict.*  Answers meet by phrase, with the largest count of a longer phrase that holds
   it; products are decimals of 38 digits.  A window with a limit ranks each language.

Memory of a task: one chunk and the distinct sequences of one range.  Ranges beyond
``MAX_RANGES`` are cut by a hash of the sequence instead of more bounds, so the sample and
the bounds stay small at any size.

Defined results: a null text is empty, a null language is ``und``; equal scores
go by count, then by phrase in the order of its UTF-8 bytes; repeated rows count each time;
an empty table gives an empty table; other columns are ignored.
"""

from __future__ import annotations

import zlib
from bisect import bisect_left, bisect_right
from collections import defaultdict
from itertools import count

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql.window import Window

from moodindex.llm.automaton import BITS, WORDS, Automaton, Union, sort_keys, summed
from moodindex.llm.common import text_of

RANGE_SEQUENCES = 6_000_000
MAX_RANGES = 6_000
CHUNK_WORDS = 1_500_000
SLICE_BYTES = 1 << 20
# The sample that sets the bounds: documents and sequences of each.
SAMPLE_DOCS, SAMPLE_SEQUENCES = 8_000, 16
# Questions that one copy of a range answers.
QUESTIONS = 200_000

# What ends a piece, what ends a word.
PIECE_ENDS, WORD_ENDS = b".,;:!?\n\x0b\x0c\r", b" \t"
_TABLE = bytes(32 if c in WORD_ENDS else 10 if c in PIECE_ENDS else c + 32 if 65 <= c <= 90 else c for c in range(256))
_GAP = b"\xff"  # no byte of UTF-8: stands between pieces


def _slices(text: bytes):
    """Words and gaps of a text, in lists of bounded length; a gap ends the text."""
    t = text.translate(_TABLE)
    at = 0
    while len(t) - at > SLICE_BYTES:
        cut = t.find(b" ", at + SLICE_BYTES)
        if cut < 0:
            break
        yield t[at:cut].replace(b"\n", b" \xff ").split()
        at = cut
    yield (t[at:] + b"\n").replace(b"\n", b" \xff ").split()


# -- 1. ranges ---------------------------------------------------------------

class Ranges:
    """Bounds (language, words) of the ranges; each range is cut into ``parts`` by hash."""

    def __init__(self, bounds: list[tuple], parts: int):
        self.bounds, self.parts = bounds, parts

    def part(self, crcs: np.ndarray) -> np.ndarray:
        """The part for each row of word hashes (one column a place)."""
        h = np.zeros(len(crcs), np.uint64)
        for k in range(WORDS):
            h = (h ^ crcs[:, k].astype(np.uint64)) * np.uint64(0x9E3779B97F4A7C15)
            h ^= h >> np.uint64(31)
        return (h % np.uint64(self.parts)).astype(np.int64)

    def of(self, lang: bytes, words: list[bytes]) -> int:
        full = words + [b""] * (WORDS - len(words))
        n = bisect_right(self.bounds, (lang, *full)) * self.parts
        if self.parts == 1:
            return n
        crcs = np.array([[zlib.crc32(w) if w else 0 for w in full]])
        return n + int(self.part(crcs)[0])

    def cuts(self, lang: bytes, words: list[bytes], labels: list[np.ndarray]):
        """``(range, place)`` of the bounds that fall into the sorted rows of a language."""
        low = bisect_left(self.bounds, (lang,))
        high = bisect_left(self.bounds, (lang + b"\0",))
        found = []
        for b in self.bounds[low:high]:
            lo, hi = 0, len(labels[0])
            for k, w in enumerate(b[1:]):
                i = bisect_left(words, w) + 1 if w else 0
                known = not w or i <= len(words) and words[i - 1] == w
                lo, hi = (lo + int(np.searchsorted(labels[k][lo:hi], i, "left")),
                          lo + int(np.searchsorted(labels[k][lo:hi], i, "right")))
                if not known:
                    hi = lo
                if lo == hi:
                    break
            found.append(lo)
        return low, found


def sample_ranges(docs: DataFrame, size: int = RANGE_SEQUENCES) -> Ranges:
    total = docs.count()
    share = min(1.0, SAMPLE_DOCS / max(1, total))

    def run(batches):
        for b in batches:
            out = []
            for text, lang in zip(b.column(0).to_pylist(), b.column(1).to_pylist(), strict=True):
                rng = np.random.default_rng(zlib.crc32(text))
                words = [w for s in _slices(text) for w in s]
                for at, n in zip(rng.integers(0, len(words), SAMPLE_SEQUENCES),
                                 rng.integers(1, WORDS + 1, SAMPLE_SEQUENCES), strict=True):
                    w = words[at:at + n]
                    if _GAP not in w:
                        out.append((lang, *w, *[b""] * (WORDS - len(w)), WORDS * len(words) / SAMPLE_SEQUENCES))
            cols = list(zip(*out, strict=True)) or [()] * 5
            yield pa.record_batch([pa.array(c, pa.binary()) for c in cols[:4]] + [pa.array(cols[4], pa.float64())],
                                  names=["lang", "a", "b", "c", "weight"])

    rows = docs.sample(False, share, 11).mapInArrow(run, "lang binary, a binary, b binary, c binary, weight double").collect()
    rows = sorted((bytes(r[0]), bytes(r[1]), bytes(r[2]), bytes(r[3]), r[4]) for r in rows)  # SAMPLE_DOCS x SAMPLE_SEQUENCES, about
    mass = np.cumsum([r[4] for r in rows]) if rows else np.zeros(1)
    want = max(1, int(np.ceil(mass[-1] / share / size)))
    ranges = min(MAX_RANGES, want)
    at = np.searchsorted(mass, mass[-1] * np.arange(1, ranges) / ranges)
    return Ranges(sorted({rows[i][:4] for i in at}), -(-want // ranges))


# -- 2. shards ---------------------------------------------------------------

class _Chunk:
    """Words of one language as labels, gaps as -1."""

    def __init__(self):
        self.vocab: dict[bytes, int] = defaultdict(count().__next__)
        self.vocab[_GAP] = -1
        self.ids: list[np.ndarray] = []

    def add(self, words: list[bytes]) -> None:
        self.ids.append(np.fromiter(map(self.vocab.__getitem__, words), np.int64, len(words)))

    def counted(self):
        """Sorted words, label columns and counts of the sequences in whole pieces;
        what follows the last gap stays (a text may go on)."""
        ids = np.concatenate(self.ids)
        end = int(np.flatnonzero(ids == -1)[-1]) + 1 if (ids == -1).any() else 0
        rest, ids = ids[end:], ids[:end]
        names = {i: w for w, i in self.vocab.items() if i >= 0}
        words = sorted(names.values())
        rank = np.zeros(max(names, default=0) + 2, np.int64)  # the last one, 0, is that of a gap
        rank[[self.vocab[w] for w in words]] = np.arange(1, len(words) + 1)
        r = rank[ids]
        one, two, three = r, np.append(r[1:], 0), np.append(r[2:], [0, 0])[:len(r)]
        zero = np.zeros(len(r), np.int64)
        has1, has2 = one > 0, (one > 0) & (two > 0)
        has3 = has2 & (three > 0)
        cols = [np.concatenate([one[has1], one[has2], one[has3]]),
                np.concatenate([zero[has1], two[has2], two[has3]]),
                np.concatenate([zero[has1], zero[has2], three[has3]])]
        keys = np.sort(sort_keys(cols, len(words)))
        if len(words) < (1 << BITS) - 1:  # the labels can be read back from the keys
            first = np.flatnonzero(np.append(True, keys[1:] != keys[:-1])) if len(keys) else np.zeros(0, np.int64)
            n, keys = np.diff(np.append(first, len(keys))), keys[first]
            mask = (1 << BITS) - 1
            cols = [keys >> 2 * BITS, keys >> BITS & mask, keys & mask]
        else:
            cols, n = summed(cols, np.ones(len(keys), np.int64), len(words))
        tail = [names[i] for i in rest.tolist()]
        self.__init__()
        if tail:
            self.add(tail)
        return words, cols, n

    @property
    def size(self) -> int:
        return sum(map(len, self.ids))


def _automata(lang: bytes, words: list[bytes], cols: list[np.ndarray], n: np.ndarray, ranges: Ranges):
    """``(range, automaton)`` of a chunk."""
    first, cuts = ranges.cuts(lang, words, cols)
    bounds = [0, *cuts, len(n)]
    crcs = np.array([0] + [zlib.crc32(w) for w in words]) if ranges.parts > 1 else None
    for k, (lo, hi) in enumerate(zip(bounds, bounds[1:], strict=False)):
        if lo >= hi:
            continue
        piece = [c[lo:hi] for c in cols]
        name = (first + k) * ranges.parts
        if crcs is None:
            yield name, Automaton.build(words, piece, n[lo:hi])
            continue
        part = ranges.part(np.stack([crcs[c] for c in piece], axis=1))
        for p in np.unique(part):
            at = part == p
            yield name + int(p), Automaton.build(words, [c[at] for c in piece], n[lo:hi][at])


def shards(docs: DataFrame, ranges) -> DataFrame:
    """``range, lang, data``: the automata of all chunks."""

    def run(batches):
        chunks: dict[bytes, _Chunk] = defaultdict(_Chunk)

        def flush():
            for lang in list(chunks):
                c = chunks[lang]
                if c.size:
                    for k, a in _automata(lang, *c.counted(), ranges.value):
                        yield pa.record_batch([pa.array([k], pa.int64()), pa.array([lang], pa.binary()),
                                               pa.array([a.to_bytes()], pa.binary())], names=["range", "lang", "data"])
                if not c.size:
                    del chunks[lang]

        size, most = 0, CHUNK_WORDS
        for b in batches:
            for text, lang in zip(b.column(0).to_pylist(), b.column(1).to_pylist(), strict=True):
                for words in _slices(text):
                    chunks[lang].add(words)
                    size += len(words)
                    if size >= most:
                        yield from flush()
                        size = sum(c.size for c in chunks.values())  # of a piece that goes on
                        most = max(CHUNK_WORDS, 2 * size)
        yield from flush()

    return docs.mapInArrow(run, "range long, lang binary, data binary")


# -- 3. union ----------------------------------------------------------------

def united(parts: DataFrame, least: int) -> DataFrame:
    """``range, lang, data, total``: one automaton a range and language."""

    def run(batches):
        now, union = None, None

        def out():
            a, total = union.result(least)
            return pa.record_batch([pa.array([now[0]], pa.int64()), pa.array([now[1]], pa.binary()),
                                    pa.array([a.to_bytes()], pa.binary()), pa.array([total], pa.int64())],
                                   names=["range", "lang", "data", "total"])

        for b in batches:
            for k, lang, data in zip(*(c.to_pylist() for c in b.columns), strict=True):
                if (k, lang) != now:
                    if now is not None:
                        yield out()
                    now, union = (k, lang), Union()
                union.add(Automaton.from_bytes(data))
        if now is not None:
            yield out()

    return (parts.repartition("range").sortWithinPartitions("range", "lang")
            .mapInArrow(run, "range long, lang binary, data binary, total long"))


# -- 4. parts ----------------------------------------------------------------

_FACTS = "lang binary, phrase binary, a long, l1 long, r1 long, l2 long, r2 long, longer long"
_KINDS = ("a", "l1", "r1", "l2", "r2", "longer")


def _facts(lang, phrases, kind, numbers):
    """Rows with one known number each."""
    n = len(phrases)
    out = [pa.array([lang] * n, pa.binary()) if isinstance(lang, bytes) else pa.array(lang, pa.binary()),
           pa.array(phrases, pa.binary())]
    for k in _KINDS:
        out.append(pa.array(numbers if k == kind else [None] * n, pa.int64()))
    return pa.record_batch(out, names=["lang", "phrase", *_KINDS])


def phrases_of(automata: DataFrame) -> DataFrame:
    """What is known of phrases from their own automaton: their count, and the
    count of three words for both pairs within."""

    def run(batches):
        for b in batches:
            for lang, data in zip(b.column(0).to_pylist(), b.column(1).to_pylist(), strict=True):
                a = Automaton.from_bytes(data)
                (x, y, z), n = a.entries()
                w = [b"", *a.words]
                keep = np.flatnonzero(y > 0)
                for s in range(0, len(keep), 20_000):
                    at = keep[s:s + 20_000]
                    rows = list(zip(x[at].tolist(), y[at].tolist(), z[at].tolist(), n[at].tolist(), strict=True))
                    yield _facts(lang, [b" ".join((w[i], w[j], w[k])) if k else w[i] + b" " + w[j] for i, j, k, _ in rows],
                                 "a", n[at])
                    three = [r for r in rows if r[2]]
                    yield _facts(lang, [w[i] + b" " + w[j] for i, j, _, _ in three] + [w[j] + b" " + w[k] for _, j, k, _ in three],
                                 "longer", [r[3] for r in three] * 2)

    return automata.select("lang", "data").mapInArrow(run, _FACTS)


def questions(phrases: DataFrame, ranges) -> DataFrame:
    """``range, lang, phrase, kind``: where the count of each part is known."""

    def run(batches):
        for b in batches:
            out = []
            for lang, phrase in zip(b.column(0).to_pylist(), b.column(1).to_pylist(), strict=True):
                w = phrase.split(b" ")
                for k in range(1, len(w)):
                    out.append((ranges.value.of(lang, w[:k]), lang, phrase, 2 * k - 1))
                    out.append((ranges.value.of(lang, w[k:]), lang, phrase, 2 * k))
            cols = list(zip(*out, strict=True)) or [()] * 4
            yield pa.record_batch([pa.array(c, t) for c, t in zip(
                cols, (pa.int64(), pa.binary(), pa.binary(), pa.int32()), strict=True)], names=["range", "lang", "phrase", "kind"])

    return phrases.mapInArrow(run, "range long, lang binary, phrase binary, kind int")


def answers(asked: DataFrame, automata: DataFrame) -> DataFrame:
    """The counts of the parts that were asked for."""
    copies = asked.groupBy("range").agg(F.ceil(F.count("*") / QUESTIONS).cast("int").alias("copies"))
    asked = asked.join(copies, "range").select(
        "range", F.pmod(F.xxhash64("phrase", "kind"), F.col("copies")).cast("int").alias("copy"), "lang", "kind", "phrase")
    held = automata.join(copies, "range").select(
        "range", F.explode(F.sequence(F.lit(0), F.col("copies") - 1)).alias("copy"), "lang", F.lit(0).alias("kind"),
        F.col("data").alias("phrase"))

    def run(batches):
        now, lang, a, waiting = None, None, None, defaultdict(list)

        def flush():
            for kind, phrases in waiting.items():
                parts = []
                for p in phrases:
                    w = p.split(b" ")
                    k = (kind + 1) // 2
                    parts.append(w[:k] if kind % 2 else w[k:])
                yield _facts(lang, phrases, _KINDS[kind], a.weights(parts) if a else [0] * len(parts))
            waiting.clear()

        for b in batches:
            for k, c, g, kind, phrase in zip(*(x.to_pylist() for x in b.columns), strict=True):
                if (k, c, g) != now:
                    yield from flush()
                    now, lang, a = (k, c, g), g, None
                if not kind:
                    a = Automaton.from_bytes(phrase)
                else:
                    waiting[kind].append(phrase)
            yield from flush()

    return (asked.unionByName(held).repartition("range", "copy")
            .sortWithinPartitions("range", "copy", "lang", "kind")
            .select("range", "copy", "lang", "kind", "phrase").mapInArrow(run, _FACTS))


# -- 5. verdict --------------------------------------------------------------

def score_sql(a: str, left: str, right: str) -> str:
    """floor(1,000,000 a a / (l r)) in decimals of 38 digits: exact up to a of 10^15."""
    a, left, right = (f"CAST({x} AS DECIMAL(38,0))" for x in (a, left, right))
    return f"(1000000BD * {a} * {a}) div ({left} * {right})"


def collocations(docs: DataFrame, text_col: str = "text", lang_col: str = "lang", least: int = 10, contained: int = 50,
                 top: int = 2000, size: int = RANGE_SEQUENCES) -> DataFrame:
    """``lang, rank, phrase, a, l, r, n, score``: the best ``top`` phrases of each language."""
    d = docs.select(text_of(text_col).cast("binary").alias("text"),
                    F.coalesce(F.col(f"`{lang_col}`").cast("string"), F.lit("und")).cast("binary").alias("lang"))
    ranges = docs.sparkSession.sparkContext.broadcast(sample_ranges(d, size))  # MAX_RANGES bounds at most
    automata = united(shards(d, ranges), least).checkpoint()
    own = phrases_of(automata).checkpoint()
    asked = questions(own.filter("a IS NOT NULL").select("lang", "phrase"), ranges).checkpoint()
    facts = own.unionByName(answers(asked, automata)).groupBy("lang", "phrase").agg(*[F.max(k).alias(k) for k in _KINDS])
    facts = facts.filter(f"a IS NOT NULL AND NOT coalesce(100 * longer >= {int(contained)} * a, false)")

    def score(k):
        return (f"CASE WHEN l{k} > 0 AND r{k} > 0 THEN struct({score_sql('a', f'l{k}', f'r{k}')} AS score,"
                f" {k} AS k, l{k} AS l, r{k} AS r) END")

    best = facts.select(F.col("lang").cast("string").alias("lang"), F.col("phrase").cast("string").alias("phrase"), "a",
                        F.expr(f"least({score(1)}, {score(2)})").alias("cut"))
    order = Window.partitionBy("lang").orderBy(F.desc("cut.score"), F.desc("a"), "phrase")
    ranked = best.withColumn("rank", F.row_number().over(order)).filter(F.col("rank") <= top)
    totals = automata.groupBy(F.col("lang").cast("string").alias("lang")).agg(F.sum("total").alias("n"))
    return ranked.join(totals, "lang").select(
        "lang", F.col("rank").cast("long").alias("rank"), "phrase", "a", F.col("cut.l").alias("l"), F.col("cut.r").alias("r"),
        "n", F.col("cut.score").alias("score"))
