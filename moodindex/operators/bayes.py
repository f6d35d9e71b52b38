"""Multinomial Naive Bayes as tables.

The model is a coefficient table, one row a term: the log probability of the term in each of the
three classes, and one row (term null) for the classes' log priors.  Training is a count by (term,
class); scoring is a sparse product, a join of (document, term) with the
table, a row for every time that a term occurs: in texts few terms repeat, and a count by
document and term would shuffle as many rows once more.  Nothing is collected, the vocabulary is not capped, and the closed form can be
recomputed by any SQL engine.

With ``c`` the count of a term in a class, ``N`` all terms of the class and ``V`` the number of distinct
terms: ``ln((c + smoothing) / (N + smoothing * V))``; prior ``ln(documents of the class / documents)``.
A class without documents has a prior of minus infinity and probability 0.  Terms that
training never saw don't count.  A text without known terms is scored by the priors.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from moodindex.functions.text import split_words

CLASSES = (0, 1, 2)
PROB_NAMES = ("prob_fear", "prob_neutral", "prob_greed")


def terms(df: DataFrame, id_col: str, text: str) -> DataFrame:
    """``id, term``: lower-case words between white space, repeats included."""
    return df.select(id_col, F.explode(split_words(F.lower(F.coalesce(F.col(text), F.lit(""))))).alias("term"))


def train(df: DataFrame, id_col: str, text: str, label: str, smoothing: float = 1.0) -> DataFrame:
    """The coefficient table ``term, w0, w1, w2``."""
    d = df.where(F.col(text).isNotNull() & F.col(label).isin(list(CLASSES)))
    words = F.explode(split_words(F.lower(F.col(text))))
    counts = d.select(F.col(label).alias("y"), words.alias("term")).groupBy("term").agg(
        *[F.count(F.when(F.col("y") == c, 1)).alias(f"c{c}") for c in CLASSES]).checkpoint()
    sizes = counts.agg(F.count(F.lit(1)).alias("v"), *[F.coalesce(F.sum(f"c{c}"), F.lit(0)).alias(f"n{c}") for c in CLASSES])
    docs = d.agg(F.count(F.lit(1)).alias("n"), *[F.count(F.when(F.col(label) == c, 1)).alias(f"d{c}") for c in CLASSES])
    weights = counts.crossJoin(F.broadcast(sizes)).select("term", *[  # one row of totals
        F.log((F.col(f"c{c}") + smoothing) / (F.col(f"n{c}") + smoothing * F.col("v"))).alias(f"w{c}") for c in CLASSES])
    priors = docs.where("n > 0").select(F.lit(None).cast("string").alias("term"), *[
        F.when(F.col(f"d{c}") > 0, F.log(F.col(f"d{c}") / F.col("n"))).otherwise(F.lit(float("-inf"))).alias(f"w{c}")
        for c in CLASSES])
    return weights.unionByName(priors)


def _softmax(scores: list[Column]) -> list[Column]:
    top = F.greatest(*scores)
    e = [F.exp(s - top) for s in scores]
    total = e[0] + e[1] + e[2]
    return [x / total for x in e]


def score(model: DataFrame, df: DataFrame, id_col: str, text: str, decimals: int = 4) -> DataFrame:
    """``df`` with the class probabilities (rounded) and ``pred_label``, the largest of the
    unrounded scores, the first on ties.  ``id_col`` names a row; every row stays (J3)."""
    weights = model.where("term IS NOT NULL")
    priors = F.broadcast(model.where("term IS NULL").select(*[F.col(f"w{c}").alias(f"_p{c}") for c in CLASSES]))  # one row
    sums = terms(df, id_col, text).join(weights, "term").groupBy(id_col).agg(
        *[F.sum(f"w{c}").alias(f"_s{c}") for c in CLASSES])
    d = df.join(sums, id_col, "left").crossJoin(priors)
    total = [F.coalesce(f"_s{c}", F.lit(0.0)) + F.col(f"_p{c}") for c in CLASSES]
    d = d.withColumns({f"_t{c}": total[c] for c in CLASSES})
    t = [F.col(f"_t{c}") for c in CLASSES]
    best = F.when((t[0] >= t[1]) & (t[0] >= t[2]), 0).when(t[1] >= t[2], 1).otherwise(2)
    probs = _softmax(t)
    return d.select(*df.columns, *[F.round(p, decimals).alias(n) for p, n in zip(probs, PROB_NAMES, strict=True)],
                    probs[0].alias("_u0"), probs[1].alias("_u1"), probs[2].alias("_u2"), best.cast("int").alias("pred_label"))


def evaluate(scored: DataFrame, label: str = "label") -> DataFrame:
    """``metric, value``: accuracy and mean log loss of scored rows that have a label."""
    own = F.when(F.col(label) == 0, F.col("_u0")).when(F.col(label) == 1, F.col("_u1")).otherwise(F.col("_u2"))
    m = scored.where(F.col(label).isin(list(CLASSES))).agg(
        F.avg((F.col(label) == F.col("pred_label")).cast("double")).alias("accuracy"),
        F.avg(-F.log(F.greatest(own, F.lit(1e-15)))).alias("logLoss"))
    return m.selectExpr("stack(2, 'accuracy', accuracy, 'logLoss', logLoss) as (metric, value)")
