"""Counts taken by the plan that writes."""

import pytest

from moodindex.operators import counts as C
from moodindex.operators import filters
from moodindex.plans import jobs

SCHEMA = "comment_id long, stock_code string, text string, time timestamp_ntz"
WORDS = ("token",)


def comments(spark, n=200):
    import datetime as dt
    texts = ["fine day", "a to ken", "see http://x.y", None, "token www.a.b"]
    rows = [(k, "s", texts[k % 5], dt.datetime(2024, 1, 1) if k % 7 else None) for k in range(n)]
    return spark.createDataFrame(rows, SCHEMA).repartition(6)


def by_hand(rows):
    ok = [r for r in rows if r.text is not None and r.time is not None]
    off = [r for r in ok if "token" not in r.text.replace(" ", "")]
    return {"raw": len(rows), "with_text_and_time": len(ok), "off_topic": len(off),
            "filtered": sum("http" not in r.text and "www" not in r.text for r in off)}


def test_a_job_counts_what_it_writes(spark, tmp_path):
    d, seen = comments(spark), C.Counts()
    lex = jobs.Lexicons(WORDS, (), ())
    with pytest.raises(ValueError):
        seen.get()
    out = jobs.preprocess_job(d, lex, str(tmp_path / "pre"), seen)
    assert seen.get() == by_hand(d.collect())
    assert C.checked(seen, "filtered", out)
    plain = filters.preprocess(d, WORDS)
    assert sorted(map(tuple, out.select(plain.columns).collect())) == sorted(map(tuple, plain.collect()))


def test_one_scan_and_no_shuffle_for_the_counts(spark, tmp_path):
    comments(spark).write.parquet(str(tmp_path / "in"))
    pre = filters.preprocess(spark.read.parquet(str(tmp_path / "in")), WORDS, counts=C.Counts())
    plan = pre._jdf.queryExecution().executedPlan().toString()
    assert plan.count("FileScan") == 1 and "Exchange" not in plan


def test_parts_and_an_empty_input(spark, tmp_path):
    from pyspark.sql import functions as F
    seen = C.Counts()
    d = seen.stage(spark.range(10), "rows", even=F.col("id") % 2 == 0, none=F.lit(None).cast("boolean"))
    d.write.parquet(str(tmp_path / "a"))
    seen.ran()
    assert seen.get() == {"rows": 10, "even": 5, "none": 0}
    with pytest.raises(ValueError):
        seen.stage(d, "late")
    empty = C.Counts()
    filters.preprocess(spark.createDataFrame([], SCHEMA), WORDS, counts=empty).write.parquet(str(tmp_path / "b"))
    empty.ran()
    assert set(empty.get().values()) == {0} and len(empty.get()) == 4
