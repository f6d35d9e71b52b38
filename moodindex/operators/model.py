"""Three-class text classifier, scoring, evaluation and batched user maps
(M7–M10, P14–P16, U3).

The classifier is a Spark ML pipeline (tokeniser -> hashed term counts ->
IDF -> multinomial logistic regression), trained and applied where the data
lives.  A heavier outside model plugs in through :func:`map_batches`
(Arrow batches into pandas, one call per batch, never per row).
"""

from __future__ import annotations

from collections.abc import Callable, Iterator

import pandas as pd
from pyspark.ml import Pipeline, PipelineModel
from pyspark.ml.classification import LogisticRegression, NaiveBayes
from pyspark.ml.feature import IDF, HashingTF, RegexTokenizer
from pyspark.ml.functions import vector_to_array
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from moodindex.functions.numeric import argmax
from moodindex.functions.text import NON_SPACE_RUN_RE

CLASS_NAMES = ("prob_fear", "prob_neutral", "prob_greed")


# Term buckets: no vocabulary is collected and no term is dropped.
BUCKETS = 1 << 18


def classifier_pipeline(text: str = "text_bert", label: str = "label", buckets: int = BUCKETS,
                        algo: str = "logistic", max_iter: int = 30,
                        reg: float = 0.01, smoothing: float = 1.0) -> Pipeline:
    """Re-aimed M7: the same inputs and outputs as the fine-tuned model
    (text -> three class probabilities), trained with Spark ML.

    ``algo="logistic"`` (default): TF-IDF + multinomial logistic regression,
    one pass per optimiser iteration.  ``"naive_bayes"``: multinomial Naive Bayes on
    term counts, trained in one aggregation pass; its probabilities
    saturate on long texts.
    """
    stages = [
        RegexTokenizer(inputCol=text, outputCol="_tokens", pattern=NON_SPACE_RUN_RE,
                       gaps=False, toLowercase=True),
        HashingTF(inputCol="_tokens", outputCol="_tf", numFeatures=buckets),
    ]
    common = dict(labelCol=label, probabilityCol="_prob", rawPredictionCol="_raw",
                  predictionCol="_pred")
    if algo == "naive_bayes":
        stages.append(NaiveBayes(featuresCol="_tf", modelType="multinomial",
                                 smoothing=smoothing, **common))
    elif algo == "logistic":
        stages += [IDF(inputCol="_tf", outputCol="_features"),
                   LogisticRegression(featuresCol="_features", family="multinomial",
                                      maxIter=max_iter, regParam=reg, **common)]
    else:
        raise ValueError("algo must be 'naive_bayes' or 'logistic'")
    return Pipeline(stages=stages)


def train(train_df: DataFrame, text: str = "text_bert", label: str = "label",
          **params) -> PipelineModel:
    """Fit the classifier on weakly labelled rows (M7).

    The texts are read and tokenised once: their term counts are checkpointed,
    and every pass of an estimator stage reads those.
    """
    data = train_df.where(F.col(text).isNotNull()).select(
        F.col(text), F.col(label).cast("double").alias(label))
    tokens, tf, *estimators = classifier_pipeline(text, label, **params).getStages()
    data = tf.transform(tokens.transform(data)).select("_tf", label).checkpoint()
    fitted = []
    for e in estimators:
        fitted.append(e.fit(data))
        data = fitted[-1].transform(data)
    return PipelineModel([tokens, tf, *fitted])


def score(model: PipelineModel, df: DataFrame, text: str = "text_bert",
          decimals: int = 4) -> DataFrame:
    """Batch scoring (M10): every input column kept, plus the three class
    probabilities rounded to ``decimals`` (P14) and ``pred_label``, the
    arg-max of the unrounded ones, first on ties (P16).  A null text is
    scored as ``''`` (P11)."""
    cols = df.columns
    # the model reads ``text``; score a filled copy, hand back the original
    filled = (df.withColumn("_orig_text", F.col(text))
              .withColumn(text, F.coalesce(F.col(text), F.lit(""))))
    out = model.transform(filled)
    p = vector_to_array(F.col("_prob"))
    probs = [p[i] for i in range(3)]
    return out.select(*[F.col("_orig_text").alias(c) if c == text else F.col(c) for c in cols],
                      *[F.round(probs[i], decimals).alias(CLASS_NAMES[i]) for i in range(3)],
                      argmax(probs).alias("pred_label"))


def evaluate(model: PipelineModel, valid_df: DataFrame, text: str = "text_bert",
             label: str = "label") -> DataFrame:
    """Validation metrics (M8) as rows ``metric, value``: accuracy, weighted
    F1 and log loss, from one pass over the scored rows."""
    data = valid_df.where(F.col(text).isNotNull() & F.col(label).isNotNull())
    return metrics(model.transform(data), label)


def metrics(pred: DataFrame, label: str = "label") -> DataFrame:
    """Metrics of rows with ``label``, ``_pred`` and ``_prob``: one aggregate
    by label and prediction, summed up from its few rows."""
    y, p = F.col(label).cast("int"), F.col("_pred").cast("int")
    own = F.element_at(vector_to_array("_prob"), y + 1)
    cells = pred.groupBy(y.alias("y"), p.alias("p")).agg(
        F.count(F.lit(1)).alias("n"), F.sum(-F.log(F.greatest(own, F.lit(1e-15)))).alias("loss"))
    by = cells.select(F.explode(F.array(
        F.struct(F.col("y").alias("c"), F.col("n").alias("real"), F.lit(0).cast("long").alias("said"),
                 F.when(F.col("y") == F.col("p"), F.col("n")).otherwise(0).alias("hit"), "loss"),
        F.struct(F.col("p").alias("c"), F.lit(0).cast("long").alias("real"), F.col("n").alias("said"),
                 F.lit(0).cast("long").alias("hit"), F.lit(0.0).alias("loss")))).alias("r")).select("r.*")
    by = by.groupBy("c").agg(*[F.sum(x).alias(x) for x in ("real", "said", "hit", "loss")])
    f1 = F.when(F.col("hit") > 0, 2 * F.col("hit") / (F.col("real") + F.col("said"))).otherwise(0.0)
    total = by.agg((F.sum("hit") / F.sum("real")).alias("accuracy"),
                   (F.sum(F.col("real") * f1) / F.sum("real")).alias("f1"),
                   (F.sum("loss") / F.sum("real")).alias("logLoss"))
    return total.selectExpr("stack(3, 'accuracy', accuracy, 'f1', f1, 'logLoss', logLoss) as (metric, value)")


def save(model: PipelineModel, path: str) -> None:
    model.write().overwrite().save(path)


def load(path: str) -> PipelineModel:
    return PipelineModel.load(path)


# ---------------------------------------------------------------------------

def map_batches(df: DataFrame, fn: Callable[[pd.DataFrame], pd.DataFrame], schema,
                batch_size: int = 32) -> DataFrame:
    """Apply ``fn`` to consecutive slices of at most ``batch_size`` rows.

    Spark hands each task Arrow batches; they are cut into ``batch_size``
    slices inside the task, so the session's Arrow settings stay untouched.
    """
    if batch_size < 1:
        raise ValueError("batch_size must be positive")

    def run(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for b in batches:
            for i in range(0, len(b), batch_size):
                yield fn(b.iloc[i:i + batch_size])

    return df.mapInPandas(run, schema)
