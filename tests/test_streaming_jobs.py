"""Incremental daily stream equals the batch result; end-to-end jobs."""

import datetime as dt
import os
import tempfile

from pyspark.sql import functions as F

from moodindex.operators import indicators as ind
from moodindex.streaming.daily import start_daily_stream

SCHEMA = ("comment_id long, stock_code string, time timestamp, prob_fear double, "
          "prob_neutral double, prob_greed double")


def rows(start, n, offset):
    base = dt.datetime(2024, 1, 1)
    out = []
    for i in range(n):
        g = round(((i * 37) % 100) / 100, 4)
        out.append((offset + i, "AB"[i % 2], base + dt.timedelta(hours=start + 5 * i),
                    round((1 - g) / 2, 4), round((1 - g) / 2, 4), g))
    return out


def test_stream_matches_batch_and_replays_safely(spark):
    root = tempfile.mkdtemp(prefix="stream-", dir="/tmp")
    src, table, ckpt = (os.path.join(root, x) for x in ("src", "daily", "ckpt"))
    first, second = rows(0, 30, 0), rows(40, 30, 1000)   # days overlap; rows come late
    spark.createDataFrame(first, SCHEMA).write.parquet(os.path.join(src, "b1"))
    q = start_daily_stream(spark, os.path.join(src, "*"), spark.createDataFrame([], SCHEMA).schema,
                           table, ckpt)
    q.awaitTermination(120)
    spark.createDataFrame(second, SCHEMA).write.parquet(os.path.join(src, "b2"))
    q = start_daily_stream(spark, os.path.join(src, "*"), spark.createDataFrame([], SCHEMA).schema,
                           table, ckpt)
    q.awaitTermination(120)
    got = {(r["stock_code"], r["date"]): (r["fear_ratio"], r["greed_ratio"])
           for r in spark.read.parquet(table).collect()}
    want = {(r["stock_code"], r["date"]): (r["fear_ratio"], r["greed_ratio"])
            for r in ind.daily_sentiment(spark.createDataFrame(first + second, SCHEMA)).collect()}
    assert got.keys() == want.keys()
    for k in want:
        assert abs(got[k][0] - want[k][0]) < 1e-12 and abs(got[k][1] - want[k][1]) < 1e-12


def test_end_to_end_jobs(spark):
    from moodindex.plans import jobs, params as P
    from moodindex.sources import tables
    sf = "/root/testdata/sf0.001"
    root = tempfile.mkdtemp(prefix="jobs-", dir="/tmp")
    lex = jobs.Lexicons(P.TOPIC_WORDS, P.FEAR_WORDS, P.GREED_WORDS)
    pre = jobs.preprocess_job(tables.comments(spark, sf), lex, os.path.join(root, "pre"))
    split = jobs.label_job(spark.read.parquet(os.path.join(root, "pre")), lex,
                           os.path.join(root, "labels"))
    metrics = {r["metric"]: r["value"] for r in
               jobs.train_job(spark.read.parquet(os.path.join(root, "labels")),
                              os.path.join(root, "model")).collect()}
    assert 0.0 <= metrics["accuracy"] <= 1.0
    jobs.score_job(spark.read.parquet(os.path.join(root, "pre")), os.path.join(root, "model"),
                   os.path.join(root, "scored"))
    scored = spark.read.parquet(os.path.join(root, "scored"))
    ts = F.lit("2024-02-01").cast("timestamp")
    jobs.daily_job(spark, scored, os.path.join(root, "daily"), ts)
    once = sorted(map(tuple, spark.read.parquet(os.path.join(root, "daily")).collect()))
    jobs.daily_job(spark, scored, os.path.join(root, "daily"), ts)
    twice = sorted(map(tuple, spark.read.parquet(os.path.join(root, "daily")).collect()))
    assert once == twice and len(once) > 0
    out = jobs.indicator_job(spark, scored, os.path.join(root, "ind"), ts)
    assert set(out) == {"hourly", "monthly", "change_rate"}
    assert spark.read.parquet(os.path.join(root, "ind", "hourly")).count() > 0
    assert pre.count() == split.count()
