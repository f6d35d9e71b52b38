"""Language identification with interpolated Kneser-Ney character models.

One model per language: n-grams of characters up to ``ORDER``, absolute
discounting with a discount per order, continuation counts below the highest
order, interpolated down to the uniform distribution.  Letters are lowered;
every run of other characters is one space.

The n-grams of all languages lie in one array of 64-bit hashes per order,
sorted, with a matrix of their log probabilities (a column per language) and
one of the back-off weights of the n-gram as a context; look-ups are binary
searches over whole blocks of text.  The language with the lowest
cross-entropy per character wins.  A text is ``accepted`` if that
cross-entropy stays under the language's limit, which is calibrated on
training texts.

Learned from at most ``DOCS_PER_LANG`` labelled rows per language, taken by a
hash of the id, with their whole texts; scoring covers every row and whole
texts.

Defined results: ``und`` and score 0 for a null text or one without a letter,
or if there is nothing to learn from; ties go to the first language by name;
rows with a null id or null language are never learned from; an empty table
gives an empty table; extra columns are carried along by ``identify``.
"""

from __future__ import annotations

from collections import defaultdict

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.window import Window

from moodindex.llm.common import fresh

ORDER = 4
DOCS_PER_LANG = 400
# Characters that count as evidence in the score; more would round it to 1.
EVIDENCE = 64
# Training texts of at least so many characters calibrate the rejection, which allows
# the largest cross-entropy among them and a share of slack.
CALIBRATION_CHARS, SLACK = 50, 0.15
BLOCK_CHARS = 500_000
_K = np.uint64(0x9E3779B97F4A7C15)


def remainder(id_col: str) -> Column:
    """crc32 of the id as text, modulo 4; null for a null id."""
    return F.crc32(F.col(id_col).cast("string").cast("binary")) % 4


_TABLE: list[np.ndarray] = []


def _letters() -> np.ndarray:
    """Code point to lowered letter, or a space for all but letters."""
    if not _TABLE:
        t = np.full(0x110000, 32, np.uint32)
        for c in range(0x110000):
            s = chr(c)
            if s.isalpha():
                low = s.lower()
                t[c] = ord(low) if len(low) == 1 else c
        _TABLE.append(t)
    return _TABLE[0]


def normalise(text: str) -> np.ndarray:
    """Lowered letters, single spaces between them, a space at both ends;
    empty without a letter."""
    c = _letters()[np.frombuffer(text.encode("utf-32-le", "replace"), "<u4")]
    c = np.concatenate([[32], c, [32]]).astype(np.uint32)
    c = c[np.concatenate([[True], (c[1:] != 32) | (c[:-1] != 32)])]
    return c if len(c) > 1 else c[:0]


def hashes(chars: np.ndarray) -> list[np.ndarray]:
    """Hash of the n-gram that ends at each character, for n = 1 .. ORDER;
    the text is preceded by spaces."""
    with np.errstate(over="ignore"):
        one = (chars.astype(np.uint64) + np.uint64(1)) * _K
        one ^= one >> np.uint64(29)
        out = [one]
        space = (np.full(1, 32, np.uint64) + np.uint64(1)) * _K
        space ^= space >> np.uint64(29)
        before = space
        for _ in range(1, ORDER):
            prev = np.concatenate([before, out[-1][:-1]])
            out.append(prev * _K + one)
            before = before * _K + space
    return out


def gram_hash(gram: str) -> np.uint64:
    chars = np.array([ord(c) for c in gram], np.uint32)
    return hashes(np.concatenate([chars]))[len(gram) - 1][-1]


class Model:
    """Sorted hash arrays with one column per language."""

    def __init__(self, langs: list[str], counts: dict[str, dict[str, int]]):
        self.langs = langs
        tables = [self._estimate(counts[x], 1) for x in langs]
        self.keys, self.logp, self.back = [], [], []
        # one alphabet for all languages, with one place for characters never seen
        size = len({g for t in tables for g in t[0]}) + 1
        tables = [self._estimate(counts[x], size) for x in langs]
        self.unseen = np.array([np.log(t[2][""] / size) for t in tables], np.float32)
        for n in range(1, ORDER + 1):
            grams = sorted({g for t in tables for g in t[1][n]})
            logp = np.zeros((len(grams), len(langs)), np.float32)
            back = np.zeros((len(grams), len(langs)), np.float32)
            for k, (_, p, lam) in enumerate(tables):
                cache: dict[str, float] = {}

                def prob(g, p=p, lam=lam, cache=cache):
                    if not g:
                        return 1.0 / size
                    got = p[len(g)].get(g)
                    if got is None:
                        got = cache.get(g)
                        if got is None:
                            got = cache[g] = lam.get(g[:-1], 1.0) * prob(g[1:])
                    return got

                for i, g in enumerate(grams):
                    logp[i, k] = prob(g)
                    back[i, k] = lam.get(g, 1.0)
            keys = np.array([gram_hash(g) for g in grams], np.uint64)
            at = np.argsort(keys, kind="stable")
            self.keys.append(keys[at])
            self.logp.append(np.log(np.maximum(logp[at], 1e-30)))
            self.back.append(np.log(np.maximum(back[at], 1e-30)))
        self.limits = np.full(len(langs), np.inf)

    @staticmethod
    def _estimate(top: dict[str, int], alphabet: int):
        """Unigrams, probabilities by order, back-off weights by context."""
        counts: list[dict] = [{} for _ in range(ORDER + 1)]
        counts[ORDER] = top
        for n in range(ORDER - 1, 0, -1):
            c: dict[str, int] = defaultdict(int)
            for g in counts[n + 1]:
                c[g[1:]] += 1  # continuation count: distinct characters before
            counts[n] = dict(c)
        p: list[dict] = [{} for _ in range(ORDER + 1)]
        lam: dict[str, float] = {}
        for n in range(1, ORDER + 1):
            ones = sum(v == 1 for v in counts[n].values())
            twos = sum(v == 2 for v in counts[n].values())
            d = min(0.95, max(0.1, ones / max(1, ones + 2 * twos)))
            total: dict[str, int] = defaultdict(int)
            kinds: dict[str, int] = defaultdict(int)
            for g, v in counts[n].items():
                total[g[:-1]] += v
                kinds[g[:-1]] += 1
            for ctx, v in total.items():
                lam[ctx] = d * kinds[ctx] / v
            for g, v in counts[n].items():
                lower = p[n - 1].get(g[1:], 0.0) if n > 1 else 1.0 / alphabet
                p[n][g] = max(v - d, 0) / total[g[:-1]] + lam[g[:-1]] * lower
        return counts[1], p, lam

    def _find(self, n: int, h: np.ndarray) -> np.ndarray:
        keys = self.keys[n - 1]
        at = np.searchsorted(keys, h)
        at[at == len(keys)] = 0
        return np.where(keys[at] == h, at, -1)

    def log_probs(self, chars: np.ndarray) -> np.ndarray:
        """(characters, languages) log probabilities given what precedes."""
        hs = hashes(chars)
        out = np.empty((len(chars), len(self.langs)), np.float32)
        left = np.arange(len(chars))
        weight = np.zeros((len(chars), len(self.langs)), np.float32)
        for n in range(ORDER, 0, -1):
            at = self._find(n, hs[n - 1][left])
            hit = at >= 0
            rows = left[hit]
            out[rows] = weight[rows] + self.logp[n - 1][at[hit]]
            left = left[~hit]
            if not len(left):
                return out
            if n > 1:  # the context: the n - 1 characters before
                prev = left - 1
                ok = prev >= 0
                ctx = np.full(len(left), -1, np.int64)
                ctx[ok] = self._find(n - 1, hs[n - 2][prev[ok]])
                seen = ctx >= 0
                weight[left[seen]] += self.back[n - 2][ctx[seen]]
        out[left] = weight[left] + self.unseen
        return out

    def entropies(self, texts: list[str]) -> tuple[np.ndarray, np.ndarray]:
        """Characters and cross-entropy per character by language."""
        sums = np.zeros((len(texts), len(self.langs)))
        sizes = np.zeros(len(texts), np.int64)
        pend: list[tuple[int, np.ndarray]] = []
        skip = ORDER - 1  # context in front of each part, not scored

        def flush():
            lp = self.log_probs(np.concatenate([c for _, c in pend]))
            starts = np.cumsum([0] + [len(c) for _, c in pend[:-1]])
            lp[(starts[:, None] + np.arange(skip)).ravel()] = 0
            got = np.add.reduceat(lp, starts, axis=0, dtype=np.float64)
            for (i, _), row in zip(pend, got, strict=True):
                sums[i] += row
            pend.clear()

        size = 0
        for i, t in enumerate(texts):
            c = normalise(t)
            if not len(c):
                continue
            sizes[i] = len(c) - 1
            c = np.concatenate([np.full(skip - 1, 32, np.uint32), c])
            for k in range(skip, len(c), BLOCK_CHARS):
                pend.append((i, c[k - skip:k + BLOCK_CHARS]))
                size += len(pend[-1][1])
                if size >= BLOCK_CHARS:
                    flush()
                    size = 0
        if pend:
            flush()
        return sizes, -sums / np.maximum(sizes, 1)[:, None]

    def predict(self, texts: list[str]) -> pd.DataFrame:
        if not self.langs:
            return pd.DataFrame({"lang_pred": ["und"] * len(texts), "score": 0.0, "cross_entropy": np.nan,
                                 "accepted": False})
        sizes, h = self.entropies(texts)
        best = np.argmin(h, axis=1)
        low = h[np.arange(len(h)), best]
        odds = np.exp(-np.minimum(sizes, EVIDENCE)[:, None] * (h - low[:, None]))
        none = sizes == 0
        return pd.DataFrame({
            "lang_pred": np.where(none, "und", np.array(self.langs, object)[best]),
            "score": np.where(none, 0.0, 1.0 / odds.sum(axis=1)),
            "cross_entropy": np.where(none, np.nan, low),
            "accepted": ~none & (low <= self.limits[best])})


def training_rows(docs: DataFrame, id_col: str, text_col: str, lang_col: str, per_lang: int) -> DataFrame:
    """At most ``per_lang`` labelled rows a language, by a hash of the id."""
    ids = (docs.filter((remainder(id_col) != 2) & F.col(lang_col).isNotNull() & F.col(text_col).isNotNull())
           .select(F.col(id_col).alias("id"), F.col(lang_col).cast("string").alias("lang"),
                   F.monotonically_increasing_id().alias("row")))
    order = Window.partitionBy("lang").orderBy(F.xxhash64("id"), "id", "row")
    picked = ids.withColumn("k", F.row_number().over(order)).filter(F.col("k") <= per_lang)
    last = picked.groupBy("lang").agg(F.max(F.struct(F.xxhash64("id").alias("h"), "id", "row")).alias("last"))
    # one row a language: rows up to the last picked one are the picked ones
    return (docs.select(F.col(id_col).alias("id"), F.col(lang_col).cast("string").alias("lang"),
                        F.col(text_col).cast("string").alias("text"))
            .filter((remainder("id") != 2) & F.col("text").isNotNull())
            .join(F.broadcast(last), "lang")
            .filter(F.struct(F.xxhash64("id"), "id") <= F.struct("last.h", "last.id"))
            .select("lang", "text"))


def train(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", lang_col: str = "lang",
          per_lang: int = DOCS_PER_LANG) -> Model:
    rows = training_rows(docs, id_col, text_col, lang_col, per_lang).checkpoint()

    def count(batches):
        for b in batches:
            out: dict[tuple[str, str], int] = defaultdict(int)
            for lang, text in zip(*(c.to_pylist() for c in b.columns), strict=True):
                c = normalise(text)
                if not len(c):
                    continue
                c = np.concatenate([np.full(ORDER - 1, 32, np.uint32), c[1:]])
                h = hashes(c)[ORDER - 1][ORDER - 1:]
                _, at, n = np.unique(h, return_index=True, return_counts=True)
                s = c.astype("<u4").tobytes().decode("utf-32-le")
                for i, v in zip(at.tolist(), n.tolist(), strict=True):
                    out[lang, s[i:i + ORDER]] += v
            if out:
                yield pa.record_batch([pa.array([k[0] for k in out]), pa.array([k[1] for k in out]),
                                       pa.array(list(out.values()), pa.int64())], names=["lang", "gram", "n"])

    grams = (rows.mapInArrow(count, "lang string, gram string, n long")
             .groupBy("lang", "gram").agg(F.sum("n").alias("n")))
    counts: dict[str, dict[str, int]] = defaultdict(dict)
    for lang, gram, n in grams.toLocalIterator():  # bounded by the sample
        counts[lang][gram] = n
    model = Model(sorted(counts), counts)
    if counts:
        shared = rows.sparkSession.sparkContext.broadcast(model)

        def measure(batches):
            m = shared.value
            for b in batches:
                d = b.to_pandas()
                sizes, h = m.entropies(d["text"].tolist())
                col = d["lang"].map({x: i for i, x in enumerate(m.langs)}).to_numpy()
                yield pa.RecordBatch.from_pandas(pd.DataFrame(
                    {"lang": d["lang"], "chars": sizes, "h": h[np.arange(len(d)), col]}), preserve_index=False)

        limits = (rows.filter(F.col("lang").isin(model.langs)).mapInArrow(measure, "lang string, chars long, h double")
                  .filter(F.col("chars") >= CALIBRATION_CHARS).groupBy("lang")
                  .agg(F.max("h").alias("h")).collect())
        for r in limits:
            model.limits[model.langs.index(r["lang"])] = r["h"] * (1 + SLACK)
    return model


def identify(docs: DataFrame, model: Model, text_col: str = "text") -> DataFrame:
    """``docs`` with ``lang_pred``, ``score``, ``cross_entropy`` and ``accepted``."""
    shared = docs.sparkSession.sparkContext.broadcast(model)
    own = ["lang_pred", "score", "cross_entropy", "accepted"]

    @F.pandas_udf("lang_pred string, score double, cross_entropy double, accepted boolean")
    def predict(texts: pd.Series) -> pd.DataFrame:
        return shared.value.predict(texts.fillna("").tolist())

    p = fresh(docs, "_p")
    keep = [F.col(f"`{c}`") for c in docs.columns if c.lower() not in own]
    return (docs.select(*keep, predict(F.col(text_col).cast("string")).alias(p))
            .select(*keep, *[F.col(f"{p}.{c}").alias(c) for c in own]))
