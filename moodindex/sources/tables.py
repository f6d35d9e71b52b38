"""Parquet tables and the views the pipeline reads.

The pipeline's own inputs are comment tables (text, time, entity) and
scored comments (three class probabilities).  These helpers derive both
shapes, lazily, from the generic tables a deployment provides:

* comments: ``documents`` joined to ``events`` on the id (a time per text),
  ``source`` as the entity;
* scored comments: ``events`` scored by a three-logit softmax (a stand-in
  scorer whose logits are plain columns, so an SQL engine can recompute
  it), ``event_type`` as the entity;
* a long monthly series: ``orders`` with ``o_orderstatus`` as the entity.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from moodindex.functions.numeric import argmax, softmax


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    """One table, listed anew on every call; Spark's split settings
    (``spark.sql.files.maxPartitionBytes``) decide the scan tasks."""
    return spark.read.parquet(f"{sf_dir.rstrip('/')}/{name}.parquet")


def comments(spark: SparkSession, sf_dir: str) -> DataFrame:
    """``comment_id, stock_code, text, time`` — every text, with its time
    where an event gives one (the preprocess step drops the others)."""
    d = table(spark, sf_dir, "documents").select("doc_id", "source", "text")
    e = table(spark, sf_dir, "events").select("event_id", "ts")
    return (d.join(e, d["doc_id"] == e["event_id"], "left")
            .select(F.col("doc_id").alias("comment_id"), F.col("source").alias("stock_code"),
                    "text", F.col("ts").alias("time")))


# Stand-in scorer logits (fear, neutral, greed) of one event, as SQL.
EVENT_LOGITS = ("value / 100.0D", "1.0D", "hour(ts) / 8.0D")


def scored_events(spark: SparkSession, sf_dir: str, decimals: int = 4) -> DataFrame:
    """``comment_id, stock_code, time, prob_fear, prob_neutral, prob_greed,
    pred_label`` — probabilities rounded to ``decimals`` like the scorer's
    output; the label is the arg-max of the unrounded values (first on
    ties)."""
    e = table(spark, sf_dir, "events").select(
        F.col("event_id").alias("comment_id"), F.col("event_type").alias("stock_code"),
        F.col("ts").alias("time"), *[F.expr(x).alias(f"_l{i}") for i, x in enumerate(EVENT_LOGITS)])
    p = ("_p0", "_p1", "_p2")
    e = e.select("comment_id", "stock_code", "time",
                 *[c.alias(n) for c, n in zip(softmax(["_l0", "_l1", "_l2"]), p)])
    return e.select("comment_id", "stock_code", "time",
                    F.round("_p0", decimals).alias("prob_fear"),
                    F.round("_p1", decimals).alias("prob_neutral"),
                    F.round("_p2", decimals).alias("prob_greed"), argmax(p).alias("pred_label"))


def order_series(spark: SparkSession, sf_dir: str) -> DataFrame:
    """``comment_id, stock_code, time, score`` over 80 months of orders."""
    o = table(spark, sf_dir, "orders")
    return o.select(F.col("o_orderkey").alias("comment_id"),
                    F.col("o_orderstatus").alias("stock_code"),
                    F.col("o_orderdate").alias("time"),
                    F.col("o_totalprice").alias("score"))
