"""Lexicon hits, weak labels and the label distribution.

"How many distinct lexicon words occur in each text" has one form for any
lexicon: the words are one array literal in the plan and each text filters
it by ``contains``.  Nothing shuffles, nothing is unrolled into generated
code, and no pair of text and word ever becomes a row.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from moodindex.functions.text import found_count, lexicon_found, lexicon_hit_count
from moodindex.sources.io import lexicon_words

# Class ids of the weak label.
FEAR, NEUTRAL, GREED = 0, 1, 2


def lexicon_hits(df: DataFrame, fear_words: Sequence[str], greed_words: Sequence[str],
                 text: str = "text_tfidf") -> DataFrame:
    """Add ``fear_hits`` and ``greed_hits``: distinct keywords of each
    lexicon found in the text (plain substrings; nested keywords each count;
    a null text has no hits).  Two long lexicons share one walk through the text."""
    found = lexicon_found(text, fear_words, greed_words)
    if found is not None:
        return df.withColumn("_found", found).withColumns({
            "fear_hits": found_count("_found", fear_words),
            "greed_hits": found_count("_found", greed_words),
        }).drop("_found")
    return df.withColumns({
        "fear_hits": lexicon_hit_count(text, fear_words),
        "greed_hits": lexicon_hit_count(text, greed_words),
    })


def label_from_hits(fear_hits: str = "fear_hits", greed_hits: str = "greed_hits"):
    f, g = F.col(fear_hits), F.col(greed_hits)
    return (F.when(f > g, F.lit(FEAR)).when(g > f, F.lit(GREED)).otherwise(F.lit(NEUTRAL))
            .cast("int"))


def weak_label(df: DataFrame, fear_words: Sequence[str], greed_words: Sequence[str],
               text: str = "text_tfidf", keep_hits: bool = False) -> DataFrame:
    """``label``: 0 fear when fear hits > greed hits, 2 greed when fewer,
    1 neutral on a tie (keywords in both lists cancel out) (M4, M5)."""
    out = lexicon_hits(df, fear_words, greed_words, text).withColumn("label", label_from_hits())
    return out if keep_hits else out.drop("fear_hits", "greed_hits")


def label_distribution(labeled: DataFrame, label: str = "label") -> DataFrame:
    """Rows per label, sorted by label (A5)."""
    return labeled.groupBy(label).agg(F.count(F.lit(1)).alias("n")).orderBy(label)


def lexicon_hits_join(df: DataFrame, lexicon: DataFrame, text: str, out: str = "hits") -> DataFrame:
    """``df`` plus ``out``, the distinct words of a ``keyword`` table found
    in the text (0 when nothing hits, blank keywords ignored)."""
    return df.withColumn(out, lexicon_hit_count(text, lexicon_words(lexicon)))
