"""Mergeable indicator states: a re-run of one day reads and writes one day.

A state is one row per (entity, date, hour) of scored comments: sums and counts of
the three probabilities and of the score, the first and the last score by (time, id), and the
sum and number of the changes between consecutive rows within the hour.  States add
up, so the indicator tables are folds of the state table:

* daily ratios, hourly and monthly scores: sums over counts;
* change rate: rows of an (entity, year) go by (hour, time, id), so an hour of a date is a run
  of consecutive rows.  Its inner changes are in the state; the change from the run before to
  its first row comes from a window over the states of the (entity, year), 24 rows a day at most.

The state table is partitioned by date.  :func:`refresh_days` computes the states of some
days from the source's rows of those days (a partition filter, if the source is partitioned by
date) and replaces their partitions, whatever was there before: running it again changes nothing.
Sums are DECIMAL(38, 12), so neither the order of rows nor that of days shows in a result.
"""

from __future__ import annotations

import datetime as dt
from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from moodindex.functions.numeric import finite
from moodindex.functions.time import as_timestamp, with_time_parts

PROBS = ("prob_fear", "prob_neutral", "prob_greed")
RATIOS = ("fear_ratio", "neutral_ratio", "greed_ratio")
_EXACT = "decimal(38,12)"
_RUN = ("stock_code", "date", "hour")


def _exact(c: str) -> Column:
    return F.col(c).cast(_EXACT)


def day_states(scored: DataFrame, time_col: str = "time", id_col: str = "comment_id") -> DataFrame:
    """The states of scored comments.  Rows without a time have no state."""
    drop = [c for c in ("date", "hour", "year", "month") if c in scored.columns]
    d = with_time_parts(scored.drop(*drop), time_col).withColumn("_ts", as_timestamp(scored, time_col))
    d = d.where("date IS NOT NULL").select(
        *_RUN, "_ts", F.col(id_col).alias("_id"), *[finite(p).alias(p) for p in PROBS])
    d = d.withColumn("_v", (F.col("prob_greed") * 100).cast(_EXACT))
    at = F.struct("_ts", "_id")
    sums = [x for p in PROBS for x in (F.sum(_exact(p)).alias(f"sum_{p}"), F.count(p).alias(f"n_{p}"))]
    out = d.groupBy(*_RUN).agg(
        F.count(F.lit(1)).alias("n_rows"), *sums, F.sum("_v").alias("sum_v"), F.count("_v").alias("n_v"),
        F.min_by("_v", at).alias("first_v"), F.max_by("_v", at).alias("last_v"))
    # without nulls the changes of a run telescope; runs that hold one are differenced row by row
    holed = out.where("n_v < n_rows").select(*_RUN)
    same = [F.col(c).eqNullSafe(F.col(f"_h_{c}")) for c in _RUN]
    rows = d.join(holed.select(*[F.col(c).alias(f"_h_{c}") for c in _RUN]), same, "left_semi")
    w = Window.partitionBy(*_RUN).orderBy("_ts", "_id")
    steps = (rows.withColumn("_d", F.col("_v") - F.lag("_v").over(w)).groupBy(*[F.col(c).alias(f"_h_{c}") for c in _RUN])
             .agg(F.sum("_d").alias("_sum_d"), F.count("_d").alias("_n_d")))
    plain = F.col("n_v") == F.col("n_rows")
    return (out.join(steps, same, "left").drop(*[f"_h_{c}" for c in _RUN])
            .withColumn("sum_d", F.when(plain, F.col("last_v") - F.col("first_v")).otherwise(
                F.coalesce("_sum_d", F.lit(0))).cast(_EXACT))
            .withColumn("n_d", F.when(plain, F.col("n_rows") - 1).otherwise(F.coalesce("_n_d", F.lit(0))))
            .drop("_sum_d", "_n_d"))


def day_rows(source: DataFrame, days: Sequence[dt.date], time_col: str = "time", date_col: str = "date") -> DataFrame:
    """The source's rows of some days: by its partition column, or by the time."""
    if date_col in source.columns:
        return source.where(F.col(date_col).isin(list(days)))
    return source.where(F.to_date(as_timestamp(source, time_col)).isin(list(days)))


def refresh_days(source: DataFrame, path: str, days: Sequence[dt.date] | None = None, time_col: str = "time",
                 id_col: str = "comment_id") -> None:
    """Replace the states of ``days`` (None: of all days the source has) in the table at ``path``.
    A day without rows any more loses its states."""
    spark = source.sparkSession
    rows = source if days is None else day_rows(source, days, time_col)
    states = day_states(rows, time_col, id_col)
    if days is not None:
        gone = spark.createDataFrame([(d,) for d in days], "date date").join(states.select("date").distinct(), "date", "left_anti")
        empty = gone.select(*[F.col("date") if f.name == "date" else F.lit(None).cast(f.dataType).alias(f.name)
                              for f in states.schema.fields])
        states = states.unionByName(empty)
    (states.write.mode("overwrite").option("partitionOverwriteMode", "dynamic").partitionBy("date").parquet(path))


def read_states(spark: SparkSession, path: str) -> DataFrame:
    return spark.read.parquet(path).where("n_rows IS NOT NULL")


# -- folds -------------------------------------------------------------------

def _mean(total: str, n: str) -> Column:
    return F.when(F.sum(n) > 0, F.sum(total).cast("double") / F.sum(n))


def fold_daily(states: DataFrame) -> DataFrame:
    return states.groupBy("stock_code", "date").agg(
        *[_mean(f"sum_{p}", f"n_{p}").alias(r) for p, r in zip(PROBS, RATIOS, strict=True)])


def fold_hourly(states: DataFrame) -> DataFrame:
    return states.groupBy("stock_code", F.year("date").cast("int").alias("year"), "hour").agg(
        _mean("sum_v", "n_v").alias("avg_score"))


def fold_monthly(states: DataFrame) -> DataFrame:
    return states.groupBy("stock_code", F.date_format("date", "yyyy-MM").alias("month")).agg(
        _mean("sum_v", "n_v").alias("avg_score"))


def fold_change(states: DataFrame) -> DataFrame:
    """Mean score and mean change per entity, year and hour."""
    s = states.withColumn("year", F.year("date").cast("int"))
    w = Window.partitionBy("stock_code", "year").orderBy("hour", "date")
    s = s.withColumn("_step", F.col("first_v") - F.lag("last_v").over(w))
    n = F.sum(F.col("n_d") + F.when(F.col("_step").isNotNull(), 1).otherwise(0))
    total = F.sum(F.col("sum_d") + F.coalesce("_step", F.lit(0).cast(_EXACT)))
    return s.groupBy("stock_code", "year", "hour").agg(
        _mean("sum_v", "n_v").alias("avg_score"), F.when(n > 0, total.cast("double") / n).alias("change_rate"))
