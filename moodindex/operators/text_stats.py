"""Corpus statistics: word frequency, TF-IDF keywords, token windows
(M1–M3, M6, A6, A7, O3, O4).

Plan shape (checked with ``explain``):

* words: ``explode`` -> partial count per task -> shuffle by word -> final
  count -> ``TakeOrderedAndProject`` for the top k (no global sort).
* TF-IDF: tokens are counted per (doc, term) once; that exchange is reused
  by the vocabulary statistics and by the scoring join.  The vocabulary
  is capped at ``max_features`` rows, so it is broadcast with a proven
  bound; the document count rides along as a sentinel token, read from the
  bounded top-k by a window (no second scan, no cross join).
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from moodindex.functions.text import clean_words, split_words, tokenize_words

PAD = "[PAD]"


def word_counts(df: DataFrame, text: str = "text_tfidf", normalized: bool = False) -> DataFrame:
    """Corpus frequency of white-space words after the word-count cleaner
    (A6, D2, M1).  A null text counts as ``''`` (P11).

    ``normalized=True`` declares that the column is the counting cleaner's
    output (only Hangul syllables, ASCII letters, digits and single inner
    blanks): the word-count cleaner is then just ``lower`` and words are
    split on the blank, with identical results.
    """
    t = F.coalesce(F.col(text), F.lit(""))
    if normalized:
        words = F.array_remove(F.split(F.lower(t), " "), "")
    else:
        words = split_words(clean_words(t))
    return (df.select(F.explode(words).alias("word"))
            .groupBy("word").agg(F.count(F.lit(1)).alias("count")))


def top_k(df: DataFrame, metric: str, key: str, k: int) -> DataFrame:
    """Top ``k`` by metric desc, ties by key asc."""
    return df.orderBy(F.desc(metric), F.asc(key)).limit(k)


def top_words(df: DataFrame, text: str = "text_tfidf", k: int = 50,
              normalized: bool = False) -> DataFrame:
    return top_k(word_counts(df, text, normalized), "count", "word", k)


def _counted(toks: DataFrame) -> DataFrame:
    """``doc_id, term, tf``.  The tokens are dealt out before they are counted: few repeat in a
    document, so a count in the scan's tasks would hold nearly all tokens of a split in memory
    and shuffle as many rows."""
    return toks.repartition("doc_id", "term").groupBy("doc_id", "term").agg(F.count(F.lit(1)).alias("tf"))


def term_frequencies(df: DataFrame, doc_id: str, text: str) -> DataFrame:
    """``doc_id, term, tf``: vectoriser tokens counted per document (M2)."""
    toks = df.select(F.col(doc_id).alias("doc_id"),
                     F.explode(tokenize_words(F.coalesce(F.col(text), F.lit("")))).alias("term"))
    # Tokens are never null; saying so up front keeps this subtree identical
    # wherever it is used (a join on ``term`` would otherwise infer the
    # filter on one side only and defeat exchange reuse).
    toks = toks.where(F.col("term").isNotNull())
    return _counted(toks)


def tfidf_scores(df: DataFrame, doc_id: str = "comment_id", text: str = "text_tfidf",
                 max_features: int = 1000) -> DataFrame:
    """Summed TF-IDF weight per vocabulary term.

    Vocabulary: the ``max_features`` terms with the highest corpus count
    (ties by term).  Weight: ``tf * (ln((1 + n) / (1 + df)) + 1)``, each
    document's weights scaled to unit length over vocabulary terms, then
    summed per term.  ``n`` counts every document, with or without tokens.

    One pass over the text.  Every document also emits one empty-string
    sentinel token (real tokens have two or more characters), so the term
    statistics from the single (doc, term) count shuffle also hold the
    document count.  The top-k keeps the sentinel first plus the vocabulary
    (``max_features + 1`` rows, a bounded set), and ``n`` is read from it by
    a window over those rows.  The sentinel is marked by a flag column, not
    by a condition on ``term``, which would be pushed into the shared
    subtree and defeat exchange reuse.
    """
    toks = df.select(F.col(doc_id).alias("doc_id"), F.explode(F.concat(
        F.array(F.lit("")), tokenize_words(F.coalesce(F.col(text), F.lit(""))))).alias("term"))
    # Tokens are never null; saying so up front keeps this subtree identical
    # wherever it is used (a join on ``term`` would otherwise infer the
    # filter on one side only).
    toks = toks.where(F.col("term").isNotNull())
    tf = _counted(toks)
    stats = tf.groupBy("term").agg(F.count(F.lit(1)).alias("df"), F.sum("tf").alias("tc"),
                                   F.max(F.col("term") == F.lit("")).alias("_doc"))
    top = (stats.orderBy(F.desc("_doc"), F.desc("tc"), F.asc("term")).limit(max_features + 1)
           .withColumn("_n", F.max(F.when(F.col("_doc"), F.col("df"))).over(Window.partitionBy())))
    vocab = top.where(~F.col("_doc")).select(
        "term", (F.log((F.lit(1.0) + F.col("_n")) / (F.lit(1.0) + F.col("df"))) + F.lit(1.0))
        .alias("idf"))
    # The vocabulary has at most max_features rows: a bounded broadcast.
    x = tf.join(F.broadcast(vocab), "term").select(
        "doc_id", "term", (F.col("tf") * F.col("idf")).alias("w"))
    norm = F.sqrt(F.sum(F.col("w") * F.col("w")).over(Window.partitionBy("doc_id")))
    return (x.select("term", (F.col("w") / norm).alias("u"))
            .groupBy("term").agg(F.sum("u").alias("score")))


def token_windows(df: DataFrame, text: Column, id_cols: list[str], size: int = 128,
                  pad: str = PAD) -> DataFrame:
    """Fixed-length token windows over the **whole** text (M6).

    The text's white-space tokens are cut into consecutive windows of
    ``size``; the last is padded with ``pad``.  An empty text gives one
    all-pad window.  Returns ``id_cols, chunk, n_real, tokens``.
    """
    toks = split_words(F.coalesce(text, F.lit("")))
    n = F.size(toks)
    n_win = F.greatest(F.lit(1), F.ceil(n / F.lit(size)).cast("int"))
    base = df.select(*id_cols, toks.alias("_toks"), n_win.alias("_nw"))
    ex = base.select(*id_cols, "_toks", F.explode(F.sequence(F.lit(0), F.col("_nw") - 1)).alias("chunk"))
    piece = F.slice(F.col("_toks"), F.col("chunk") * size + 1, F.lit(size))
    padded = F.slice(F.concat(piece, F.array_repeat(F.lit(pad), size)), 1, size)
    return ex.select(*id_cols, "chunk", F.size(piece).alias("n_real"), padded.alias("tokens"))
