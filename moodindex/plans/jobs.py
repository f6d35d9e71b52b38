"""End-to-end jobs over all entities at once.

Each job is one lazy plan per output table; entities are a column, not a
loop.  Outputs are parquet tables partitioned by ``stock_code`` and
published with keyed upserts, so re-running a job for the same input
gives the same tables (E5).
"""

from __future__ import annotations

from collections.abc import Sequence
from dataclasses import dataclass

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from moodindex import schemas
from moodindex.operators import epochs as ep, filters, indicators as ind, lexicon, model, sampling
from moodindex.operators.counts import Counts
from moodindex.operators.upsert import publish_upsert
from moodindex.sources import io


@dataclass(frozen=True)
class Lexicons:
    topic: Sequence[str]
    fear: Sequence[str]
    greed: Sequence[str]

    @classmethod
    def from_files(cls, spark: SparkSession, topic: str, fear: str, greed: str) -> "Lexicons":
        """Load the three keyword files (stripped, blanks dropped; the label
        lexicons de-duplicated)."""
        return cls(io.lexicon_words(io.read_lexicon(spark, topic)),
                   io.lexicon_words(io.read_lexicon(spark, fear, distinct=True)),
                   io.lexicon_words(io.read_lexicon(spark, greed, distinct=True)))


def preprocess_job(comments: DataFrame, lex: Lexicons, out_path: str, counts: Counts | None = None) -> DataFrame:
    """Raw comments -> filtered, cleaned comments table.  ``counts`` gets the
    rows left by each filter from the plan that writes (A8)."""
    pre = filters.preprocess(comments, lex.topic, counts=counts)
    io.replace_table(pre, out_path)
    if counts is None:
        return pre
    counts.ran()
    return comments.sparkSession.read.parquet(out_path)


def label_job(pre: DataFrame, lex: Lexicons, out_path: str, test_size: float = 0.2,
              seed: int = 42) -> DataFrame:
    """Weak labels and a stratified train / valid split, one table with a
    ``split`` column (M5, X2)."""
    labeled = lexicon.weak_label(pre, lex.fear, lex.greed)
    split = sampling.stratified_split(labeled, "label", "comment_id", test_size, seed)
    io.write_table(split, out_path, partition_by=("split",))
    return split


def train_job(split: DataFrame, model_path: str) -> DataFrame:
    """Train on ``split='train'`` rows with text, evaluate on ``valid``,
    save the model (M7–M9).  Returns the metrics table."""
    data = filters.train_input(split)
    m = model.train(data.where(F.col("split") == "train"))
    model.save(m, model_path)
    return model.evaluate(m, data.where(F.col("split") == "valid"))


def epoch_job(spark: SparkSession, split: DataFrame, model_path: str, epochs: int, warm: bool = False,
              **params) -> DataFrame:
    """Train epoch by epoch (M7, M8), write the weights of the best epoch, return
    a row of metrics an epoch.  ``warm``: go on from the weights at ``model_path``."""
    data = ep.features(filters.train_input(split), "text_bert", "label", "split").checkpoint()
    start = ep.weights_of(spark.read.parquet(model_path)) if warm else None
    trained = ep.train(data, epochs, start=start, **params)
    io.replace_table(trained.table(spark), model_path)
    return trained.metrics(spark)


def score_job(pre: DataFrame, model_path: str, out_path: str) -> DataFrame:
    """Score every filtered comment (M10): probabilities + label."""
    scored = model.score(model.load(model_path), pre)
    io.replace_table(scored.drop("raw_text", "text_tfidf"), out_path)
    return scored


def daily_job(spark: SparkSession, scored: DataFrame, table_path: str,
              run_ts: Column | None = None) -> DataFrame:
    """Daily ratios upserted into the daily table (A1, K4)."""
    daily = ind.daily_sentiment(scored)
    return publish_upsert(spark, table_path, daily, schemas.DAILY_KEYS, schemas.DAILY_MEASURES,
                          run_ts if run_ts is not None else F.current_timestamp())


def indicator_job(spark: SparkSession, scored: DataFrame, base_path: str,
                  run_ts: Column | None = None) -> dict[str, DataFrame]:
    """Hourly score, monthly score and change rate, each upserted into
    its table under ``base_path`` (A2–A4, K5–K7).

    Two aggregates of the scored rows, checkpointed (small): by hour, which
    holds the score and the change, and by month.
    """
    ts = run_ts if run_ts is not None else F.current_timestamp()
    hours = ind.score_and_change(scored).checkpoint()
    out = {}
    for name, df, keys, measures in (
        ("hourly", hours.drop("change_rate"), schemas.HOURLY_KEYS, schemas.HOURLY_MEASURES),
        ("monthly", ind.monthly_score(scored), schemas.MONTHLY_KEYS, schemas.MONTHLY_MEASURES),
        ("change_rate", hours.drop("avg_score"), schemas.CHANGE_KEYS, schemas.CHANGE_MEASURES),
    ):
        out[name] = publish_upsert(spark, f"{base_path.rstrip('/')}/{name}", df, keys,
                                   measures, ts)
    return out


def plot_series(change: DataFrame, monthly: DataFrame, short: int = 7,
                long: int = 30) -> dict[str, DataFrame]:
    """The data behind the charts (no drawing): per-year change series,
    monthly means with moving averages and cross signals."""
    return {"yearly": ind.yearly_series(change),
            "monthly": ind.monthly_series(ind.cross_signal(ind.moving_average(monthly, short, long)))}
