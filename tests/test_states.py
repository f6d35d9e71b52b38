"""Incremental states equal a full recomputation, whatever the order of days."""

import datetime as dt
import os
import random
import tempfile

import pytest
from pyspark.sql import functions as F

from moodindex.operators import indicators as ind
from moodindex.operators import states as S

SCHEMA = "comment_id long, stock_code string, time timestamp_ntz, prob_fear double, prob_neutral double, prob_greed double"


def scored(seed, n=600, nulls=0.1):
    rng = random.Random(seed)
    def p():
        return None if rng.random() < nulls else rng.choice([round(rng.random(), 4), float("nan"), 0.5, 0.25])
    rows = []
    for k in range(n):
        t = dt.datetime(2023, 12, 30) + dt.timedelta(minutes=rng.randint(0, 5 * 24 * 60) // 20 * 20)
        rows.append((k, rng.choice(["A", "B", None]), None if rng.random() < 0.03 else t, p(), p(), p()))
    return rows


def table(df, keys):
    return {tuple(r[k] for k in keys): tuple(None if r[c] is None else round(r[c], 9) for c in df.columns if c not in keys)
            for r in df.collect()}


def compare(spark, states, rows):
    full = spark.createDataFrame(rows, SCHEMA).where("time IS NOT NULL")
    for fold, direct, keys in (
            (S.fold_daily(states), ind.daily_sentiment(full), ("stock_code", "date")),
            (S.fold_hourly(states), ind.hourly_score(full), ("stock_code", "year", "hour")),
            (S.fold_monthly(states), ind.monthly_score(full), ("stock_code", "month")),
            (S.fold_change(states).drop("avg_score"), ind.change_rate_rows(full), ("stock_code", "year", "hour"))):
        assert table(fold, keys) == table(direct, keys)


@pytest.mark.parametrize("nulls", [0.0, 0.3])
def test_folds_equal_the_direct_definitions(spark, nulls):
    rows = scored(1, nulls=nulls)
    compare(spark, S.day_states(spark.createDataFrame(rows, SCHEMA)), rows)


def test_refreshing_days_in_any_order(spark):
    root = tempfile.mkdtemp(prefix="states-", dir="/tmp")
    src, path = os.path.join(root, "src"), os.path.join(root, "states")
    rows = scored(2)
    early = [r for r in rows if r[0] % 3]

    def write(part):
        (spark.createDataFrame(part, SCHEMA).withColumn("date", F.to_date("time")).write.mode("overwrite")
         .partitionBy("date").parquet(src))
        return spark.read.parquet(src)

    S.refresh_days(write(early), path)
    compare(spark, S.read_states(spark, path), early)
    days = sorted({r[2].date() for r in rows if r[2]}, reverse=True)
    source = write(rows)  # late rows of every day
    for d in days + days[:2]:
        S.refresh_days(source, path, [d])
    compare(spark, S.read_states(spark, path), rows)
    # a day whose rows are gone loses its states
    left = [r for r in rows if not r[2] or r[2].date() != days[0]]
    S.refresh_days(write(left), path, [days[0]])
    compare(spark, S.read_states(spark, path), left)


def test_one_day_reads_one_partition(spark):
    root = os.path.join(tempfile.mkdtemp(prefix="states-", dir="/tmp"), "src")
    spark.createDataFrame(scored(3), SCHEMA).withColumn("date", F.to_date("time")).write.partitionBy("date").parquet(root)
    source = spark.read.parquet(root)
    one = S.day_rows(source, [dt.date(2024, 1, 1)])
    plan = S.day_states(one)._jdf.queryExecution().toString()
    assert "date#" in plan.split("PartitionFilters: [")[1].split("]")[0]
    files = one.select("_metadata.file_path").distinct().collect()
    assert files and all("date=2024-01-01" in r.file_path for r in files)


def test_stream_reads_only_the_days_it_touches(spark):
    from moodindex.streaming.daily import start_daily_stream
    root = tempfile.mkdtemp(prefix="stream-", dir="/tmp")
    src, out, ckpt = (os.path.join(root, x) for x in ("src", "daily", "ckpt"))
    rows = [r for r in scored(4, 200, 0.0) if r[2]]
    seen = []
    for part in (rows[:120], rows[120:]):
        (spark.createDataFrame(part, SCHEMA).withColumn("day", F.to_date("time")).write.mode("append")
         .partitionBy("day").parquet(src))
        schema = spark.read.parquet(src).schema
        start_daily_stream(spark, src, schema, out, ckpt, date_col="day").awaitTermination(120)
        seen += part
        want = table(ind.daily_sentiment(spark.createDataFrame(seen, SCHEMA)).where("stock_code IS NOT NULL"), ("stock_code", "date"))
        got = table(spark.read.parquet(out).select("stock_code", "date", *S.RATIOS), ("stock_code", "date"))
        assert got == want
