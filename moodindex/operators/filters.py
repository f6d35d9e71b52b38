"""Comment filters and the preprocessing step."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from moodindex.functions.text import clean_bert, clean_tfidf, contains_any_nospace, has_url
from moodindex.operators.counts import Counts
from moodindex.sources.io import lexicon_words

KEEP_COLS = ("comment_id", "stock_code")


def url_filter(df: DataFrame, text: str = "text") -> DataFrame:
    """Keep rows whose raw text mentions no link (F3); null text is kept
    here (the null rule is F1's)."""
    return df.where(~F.coalesce(has_url(text), F.lit(False)))


def topic_filter(df: DataFrame, words: Sequence[str], text: str = "text",
                 how: str = "anti") -> DataFrame:
    """Drop (``how="anti"``) or keep only (``how="semi"``) rows whose text,
    with all white space removed, contains any topic keyword (F2)."""
    hit = contains_any_nospace(text, words)
    return df.where(~hit) if how == "anti" else df.where(hit)


def topic_filter_join(df: DataFrame, lexicon: DataFrame, text: str = "text",
                      how: str = "left_anti") -> DataFrame:
    """:func:`topic_filter` with the lexicon given as a ``keyword`` table
    (J1); blank keywords are ignored.  The words go into the plan, so no
    text is paired with a word."""
    return topic_filter(df, lexicon_words(lexicon), text, "anti" if how == "left_anti" else "semi")


def preprocess(comments: DataFrame, topic_words: Sequence[str], text: str = "text",
               time: str = "time", keep: Sequence[str] = KEEP_COLS, counts: Counts | None = None) -> DataFrame:
    """Filtered, cleaned comments (E1):

    null text or time dropped (F1) -> topic filter on white-space-free
    text (F2) -> URL filter on raw text (F3) -> ``raw_text``,
    ``text_tfidf``, ``text_bert``, ``time`` (P2–P4).  A text that cleans to
    ``''`` is kept (F4, N7).  One lazy projection, no Python per row.
    With ``counts``, the rows left by each filter are counted on the way (A8).
    """
    complete = F.col(text).isNotNull() & F.col(time).isNotNull()
    link, topic = has_url(text), contains_any_nospace(text, topic_words)
    if counts is None:
        # cheap substring test first: rows with a link skip the topic test
        df = comments.where(complete).where(~link & ~topic)
    else:
        df = counts.stage(comments, "raw").where(complete)
        df = counts.stage(df, "with_text_and_time").where(~topic)
        df = counts.stage(df, "off_topic").where(~link)
        df = counts.stage(df, "filtered")
    return df.select(
        *keep,
        F.col(text).alias("raw_text"),
        clean_tfidf(text).alias("text_tfidf"),
        clean_bert(text).alias("text_bert"),
        F.col(time).alias("time"),
    )


def train_input(labeled: DataFrame, text: str = "text_bert") -> DataFrame:
    """Training rows need text: null and empty both dropped."""
    return labeled.where(F.col(text).isNotNull() & (F.length(text) > 0))
