"""Lexicons of any size as a table: an anchor index of q-grams.

A keyword of ``Q`` characters or more is filed under one of its q-grams, the one
that occurs least in the texts (its anchor); a shorter keyword under itself.
A text meets a keyword only where it holds the keyword's anchor, and the keyword is compared with the text there.
No text is paired with all words.

An index of up to ``BROADCAST_WORDS`` keywords is sent to the texts, whose bytes are searched batch by batch
(``functions.grams``): once to count the grams, once to probe.  Nothing shuffles but counts, by gram and by key.

A larger lexicon stays a table and is never collected: texts probe with their distinct windows of characters, which are
joined by gram, and keep the keywords that begin with the window.  A gram of many texts is spread by
the join's own skew handling (AQE).  Windows are made twice, to count the grams and to probe, and never written: they are many times
the texts.  Only keywords longer than a window are verified in the text.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from moodindex.functions.grams import Grams, Keywords

Q = 3
# Characters of a window at most.  Keywords up to which the index is sent to the texts.
WINDOW = 16
BROADCAST_WORDS = 100_000


def windows(text: Column, n: int, size: int) -> Column:
    """The distinct runs of ``size`` characters of a text, at its end down to ``n``."""
    return F.array_distinct(F.regexp_extract_all(text, F.lit(f"(?s)(?=(.{{{n},{size}}}))."), 1))  # on by a code point


def grams(text: Column, n: int) -> Column:
    """The distinct n-grams of a text."""
    return windows(text, n, n)


def keyword_table(lexicon: DataFrame, keyword: str = "keyword") -> DataFrame:
    """The distinct keywords that aren't blank."""
    k = F.col(keyword)
    return lexicon.where(k.isNotNull() & (k != "")).select(k.alias("keyword")).distinct()


def _keyword_grams(words: DataFrame) -> DataFrame:
    """``keyword, gram``: all grams under which a keyword could be filed."""
    filed = F.when(F.length("keyword") >= Q, grams(F.col("keyword"), Q)).otherwise(F.array("keyword"))
    return words.select("keyword", F.explode(filed).alias("gram"))


def _filed(seen: DataFrame, words: DataFrame) -> DataFrame:
    """``gram, keyword``: each keyword under its rarest gram.  ``seen`` has the number ``n`` of each
    ``gram`` of the texts.  A keyword with a gram that no text has occurs nowhere."""
    filed = _keyword_grams(words).join(seen, "gram", "left")
    rarest = F.struct(F.coalesce("n", F.lit(0)).alias("n"), "gram")
    return (filed.groupBy("keyword").agg(F.min(rarest).alias("at"))
            .where("at.n > 0").select(F.col("at.gram").alias("gram"), "keyword"))


def anchor_index(probes: DataFrame, words: DataFrame) -> DataFrame:
    """``gram, keyword``: each keyword under its rarest gram.  ``probes`` holds
    the ``gram`` of every probe of the texts."""
    return _filed(probes.groupBy("gram").agg(F.count(F.lit(1)).alias("n")), words)


def gram_counts(texts: DataFrame, named: list[str]) -> DataFrame:
    """``gram, n``: how often each of the named grams (of a long one, its first bytes) occurs in the texts, if it does."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        grams = Grams([g.encode() for g in named])
        n = np.zeros(grams.size, np.int64)
        for b in batches:
            grams.count(b["text"], n)
        n = n[grams.number]
        seen = np.flatnonzero(n)
        yield pa.RecordBatch.from_pydict({"gram": pa.array([named[k] for k in seen.tolist()], pa.string()), "n": n[seen]})

    return texts.select("text").mapInArrow(run, "gram string, n long").groupBy("gram").agg(F.sum("n").alias("n"))


def _probed(texts: DataFrame, words: DataFrame, counted: bool) -> DataFrame | None:
    """``id, found``: the keywords of each text, or their number; nothing if no text can have one."""
    named = [r["gram"] for r in _keyword_grams(words).select("gram").distinct().collect()]
    filed = [tuple(r) for r in _filed(gram_counts(texts, named), words).select("gram", "keyword").collect()] if named else []
    if not filed:
        return None
    index = Keywords(filed)
    probe, kind = (index.counts, "int") if counted else (index.lists, "array<string>")

    def found(text: pa.Array) -> pa.Array:
        return probe(text)

    # a row without a key has no hits.  Not deterministic: so that no rule of the planner evaluates it twice
    return texts.where("id IS NOT NULL").select("id", F.arrow_udf(found, kind).asNondeterministic()("text").alias("found"))


def _joined(texts: DataFrame, words: DataFrame) -> DataFrame | None:
    """``id, keyword``: the keywords of each text by joins; nothing if no text can have one."""
    # short keywords are filed under themselves, whole: only lengths in use are cut
    sizes = [r["n"] for r in words.select(F.least(F.length("keyword"), F.lit(Q)).alias("n")).distinct().collect()]  # Q at most
    longest = words.agg(F.max(F.length("keyword"))).first()[0]
    size = min(longest, WINDOW)
    cut = F.flatten(F.array(*[windows(F.col("text"), n, size if n == Q else n) for n in sorted(sizes)]))
    probes = texts.select(F.explode(cut).alias("window")).select(F.substring("window", 1, Q).alias("gram"))
    named = _keyword_grams(words).select("gram").distinct()
    index = anchor_index(probes.join(named, "gram", "left_semi"), words)
    # ``head``: the keyword as far as a window goes, its anchor within, ``at`` characters from its begin
    at = F.instr("keyword", F.col("gram")) - 1
    late = F.greatest(at + F.length("gram") - F.lit(size), F.lit(0))
    index = index.select("gram", "keyword", (at - late).alias("at"),
                         F.substring("keyword", late + 1, F.lit(size)).alias("head")).checkpoint()
    places = [r["at"] for r in index.select("at").distinct().collect()]  # WINDOW at most
    if not places:
        return None
    # keys may repeat: a keyword counts once a row.  A row without a key has no hits.
    probes = (texts.where("id IS NOT NULL").withColumn("row", F.monotonically_increasing_id())
              .select("row", "id", F.explode(cut).alias("window")).select("row", "id", "window", F.explode(F.lit(places)).alias("at")))
    probes = probes.withColumn("gram", F.substring("window", F.col("at") + 1, F.lit(Q)))
    met = (probes.join(index, ["gram", "at"]).where(F.startswith("window", F.col("head")))
           .select("row", "id", "keyword").distinct())
    if longest <= size:  # a window held them whole
        return met.drop("row")
    sure = F.length("keyword") <= size
    long = (met.where(~sure).select("id", "keyword").distinct().join(texts, "id")
            .where(F.contains(F.col("text"), F.col("keyword"))).select("id", "keyword"))
    return met.where(sure).drop("row").unionByName(long)


def _texts(df: DataFrame, lexicon: DataFrame, id_col: str, text: str) -> tuple[DataFrame, DataFrame, bool]:
    """``id, text`` of the rows with a text, the keywords, and whether their index is sent to the texts."""
    words = keyword_table(lexicon).checkpoint()
    texts = df.where(F.col(text).isNotNull()).select(F.col(id_col).alias("id"), F.col(text).alias("text"))
    return texts, words, words.count() <= BROADCAST_WORDS


def keyword_hits(df: DataFrame, lexicon: DataFrame, id_col: str, text: str) -> DataFrame:
    """``id, keyword``: the distinct keywords that occur in each text.  ``id_col`` names
    a row; a null text has no keywords."""
    texts, words, sent = _texts(df, lexicon, id_col, text)
    hits = _probed(texts, words, counted=False) if sent else _joined(texts, words)
    if hits is None:
        return texts.select("id", F.lit("").alias("keyword")).where("false")
    return hits.select("id", F.explode("found").alias("keyword")) if sent else hits


def _hits_by_id(df: DataFrame, lexicon: DataFrame, id_col: str, text: str) -> DataFrame:
    """``id, n``: the number of keywords of all rows of a key together, where there is one."""
    texts, words, sent = _texts(df, lexicon, id_col, text)
    hits = _probed(texts, words, counted=True) if sent else _joined(texts, words)
    if hits is None:
        hits, n = texts.where("false"), F.lit(0)
    else:
        n = F.col("found") if sent else F.lit(1)
    return hits.groupBy("id").agg(F.sum(n).alias("n")).where("n > 0")


def hit_counts(df: DataFrame, lexicon: DataFrame, id_col: str, text: str, out: str = "hits") -> DataFrame:
    """``df`` with ``out``: the number of distinct keywords in the text (0: none)."""
    n = _hits_by_id(df, lexicon, id_col, text).select(F.col("id").alias(id_col), F.col("n").cast("int").alias(out))
    return df.drop(out).join(n, id_col, "left").withColumn(out, F.coalesce(out, F.lit(0)))


def mentioning(df: DataFrame, lexicon: DataFrame, id_col: str, text: str, how: str = "left_anti") -> DataFrame:
    """The rows whose text holds no keyword (``left_anti``) or one at least (``left_semi``)."""
    if how not in ("left_anti", "left_semi"):
        raise ValueError("how must be 'left_anti' or 'left_semi'")
    ids = _hits_by_id(df, lexicon, id_col, text).select(F.col("id").alias(id_col))
    return df.join(ids, id_col, how)
