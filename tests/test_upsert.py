"""Set-wise upsert semantics (N13), publishing and constraint checks."""

import os
import tempfile

from pyspark.sql import functions as F

from moodindex.operators import upsert as U

KEYS, MEAS = ["stock_code", "date"], ["ratio"]


def ts(s):
    return F.lit(s).cast("timestamp")


def test_upsert_semantics(spark):
    first = spark.createDataFrame([("A", "d1", 0.1), ("A", "d2", 0.2)],
                                  "stock_code string, date string, ratio double")
    t = U.upsert(None, first, KEYS, MEAS, ts("2024-02-01"))
    upd = spark.createDataFrame([("A", "d2", None, 1), ("A", "d3", 0.3, 1), ("A", "d3", 0.33, 2),
                                 (None, "d9", 0.9, 1)],
                                "stock_code string, date string, ratio double, seq int")
    out = {(r["stock_code"], r["date"]): r for r in
           U.upsert(t, upd, KEYS, MEAS, ts("2024-02-02"), order_col="seq").collect()}
    assert set(out) == {("A", "d1"), ("A", "d2"), ("A", "d3")}
    assert out[("A", "d2")]["ratio"] is None            # null measure overwrites
    assert str(out[("A", "d2")]["created_at"]).startswith("2024-02-01")
    assert str(out[("A", "d2")]["updated_at"]).startswith("2024-02-02")
    assert out[("A", "d3")]["ratio"] == 0.33            # last by order wins
    assert str(out[("A", "d1")]["updated_at"]).startswith("2024-02-01")


def test_upsert_twice_equals_once(spark):
    base = spark.createDataFrame([("A", "d1", 0.1)], "stock_code string, date string, ratio double")
    upd = spark.createDataFrame([("A", "d1", 0.5), ("B", "d1", 0.7)],
                                "stock_code string, date string, ratio double")
    t = U.upsert(None, base, KEYS, MEAS, ts("2024-02-01"))
    once = U.upsert(t, upd, KEYS, MEAS, ts("2024-02-02"))
    twice = U.upsert(once, upd, KEYS, MEAS, ts("2024-02-02"))
    assert sorted(map(tuple, once.collect())) == sorted(map(tuple, twice.collect()))


def test_publish_upsert_rerun_and_other_entities_kept(spark):
    path = os.path.join(tempfile.mkdtemp(prefix="pub-", dir="/tmp"), "daily")
    a = spark.createDataFrame([("A", "d1", 0.1), ("B", "d1", 0.2)],
                              "stock_code string, date string, ratio double")
    U.publish_upsert(spark, path, a, KEYS, MEAS, ts("2024-02-01"))
    upd = spark.createDataFrame([("A", "d1", 0.9), ("A", "d2", 0.8)],
                                "stock_code string, date string, ratio double")
    U.publish_upsert(spark, path, upd, KEYS, MEAS, ts("2024-02-02"))
    U.publish_upsert(spark, path, upd, KEYS, MEAS, ts("2024-02-02"))
    got = {(r["stock_code"], r["date"]): r["ratio"] for r in spark.read.parquet(path).collect()}
    assert got == {("A", "d1"): 0.9, ("A", "d2"): 0.8, ("B", "d1"): 0.2}


def test_constraint_check(spark):
    df = spark.createDataFrame([("A", "d1", 0.1), ("A", "d1", 0.2), ("B", None, 0.3)],
                               "stock_code string, date string, ratio double")
    rows = {(r["kind"], r["column"]): r["n"] for r in
            U.constraint_check(df, KEYS, ["stock_code", "date", "ratio"]).collect()}
    assert rows == {("duplicate_key", "stock_code,date"): 1, ("null", "date"): 1}


def test_nan_measures_become_null(spark):
    from moodindex.functions.numeric import nan_to_null
    df = spark.createDataFrame([(float("nan"),), (1.5,), (None,)], "x double")
    assert [r["y"] for r in df.select(nan_to_null("x").alias("y")).collect()] == [None, 1.5, None]
    upd = spark.createDataFrame([("A", "d1", float("nan"))], "stock_code string, date string, ratio double")
    r = U.upsert(None, upd, KEYS, MEAS, ts("2024-02-01")).first()
    assert r["ratio"] is None


def test_duplicate_keys_need_an_order(spark):
    import pytest
    upd = spark.createDataFrame([("A", "d", 1.0, 1), ("A", "d", 2.0, 1)], "stock_code string, k string, v double, seq int")
    with pytest.raises(Exception, match="duplicate key"):
        U.upsert(None, upd, ["stock_code", "k"], ["v"], ts("2024-02-01")).collect()
    r = U.upsert(None, upd, ["stock_code", "k"], ["v"], ts("2024-02-01"), order_col="seq").collect()
    assert [x["v"] for x in r] == [2.0]  # a tie of the order: the larger measure


def test_one_entity_fails_and_the_others_publish(spark):
    path = os.path.join(tempfile.mkdtemp(prefix="each-", dir="/tmp"), "t")
    rows = spark.createDataFrame([("A", 1, 1.0), ("B", 1, 1.0), ("B", 1, 2.0), ("C", 1, 3.0)], "stock_code string, k int, v double")
    got = U.publish_each(spark, path, rows, ["stock_code", "k"], ["v"], ts("2024-02-01"), ["A", "B", "C"])
    assert got["A"] is None and got["C"] is None and "duplicate key" in str(got["B"])
    assert sorted(r["stock_code"] for r in spark.read.parquet(path).collect()) == ["A", "C"]
