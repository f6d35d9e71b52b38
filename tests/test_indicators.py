"""Indicators: segmented change rate equals the row-level definition;
ratios, moving averages, cross signals, typed table."""

import datetime as dt
import random

from pyspark.sql import functions as F

from moodindex.operators import indicators as ind

SCHEMA = ("comment_id long, stock_code string, time timestamp, prob_fear double, "
          "prob_neutral double, prob_greed double")


def scored_rows(n=400, seed=7, nulls=True, hot="A"):
    rnd = random.Random(seed)
    base = dt.datetime(2023, 12, 30)
    rows = []
    for i in range(n):
        code = hot if rnd.random() < 0.5 else rnd.choice(["B", "C"])
        t = base + dt.timedelta(minutes=rnd.randrange(0, 60 * 24 * 5))
        if nulls and rnd.random() < 0.03:
            t = None
        g = round(rnd.random(), 4)
        f = round((1 - g) * rnd.random(), 4)
        p_g = None if nulls and rnd.random() < 0.05 else g
        rows.append((i, code, t, f, round(1 - g - f, 4), p_g))
    # exact ties on time within one hour
    rows.append((n, hot, base + dt.timedelta(hours=1), 0.1, 0.1, 0.8))
    rows.append((n + 1, hot, base + dt.timedelta(hours=1), 0.1, 0.1, 0.2))
    return rows


def as_map(df, keys, val):
    return {tuple(r[k] for k in keys): r[val] for r in df.collect()}


def close(a, b):
    if a is None or b is None:
        return a is None and b is None
    return abs(a - b) < 1e-9


def test_change_rate_segmented_equals_row_level(spark):
    df = spark.createDataFrame(scored_rows(), SCHEMA)
    for order in ("hour", "arrival"):
        fast = as_map(ind.change_rate(df, order=order), ["stock_code", "year", "hour"], "change_rate")
        slow = as_map(ind.change_rate_rows(df, order=order), ["stock_code", "year", "hour"],
                      "change_rate")
        assert fast.keys() == slow.keys()
        for k in fast:
            assert close(fast[k], slow[k]), (order, k, fast[k], slow[k])


def test_change_rate_permutation_invariant(spark):
    rows = scored_rows(nulls=False)
    a = as_map(ind.change_rate(spark.createDataFrame(rows, SCHEMA)),
               ["stock_code", "year", "hour"], "change_rate")
    random.Random(3).shuffle(rows)
    b = as_map(ind.change_rate(spark.createDataFrame(rows, SCHEMA).repartition(5)),
               ["stock_code", "year", "hour"], "change_rate")
    assert a == b


def test_first_row_has_no_change(spark):
    df = spark.createDataFrame([(1, "A", dt.datetime(2024, 1, 1, 5), 0.2, 0.3, 0.5)], SCHEMA)
    r = ind.change_rate(df).first()
    assert r["change_rate"] is None and r["hour"] == 5


def test_daily_ratios_sum_to_one_and_null_date_group(spark):
    rows = [(1, "A", dt.datetime(2024, 1, 1, 1), 0.2, 0.3, 0.5),
            (2, "A", dt.datetime(2024, 1, 1, 2), 0.1, 0.1, 0.8),
            (3, "A", None, 0.5, 0.25, 0.25)]
    d = ind.daily_sentiment(spark.createDataFrame(rows, SCHEMA)).collect()
    assert len(d) == 2
    for r in d:
        assert abs(r["fear_ratio"] + r["neutral_ratio"] + r["greed_ratio"] - 1) < 1e-9
    day = [r for r in d if r["date"] is not None][0]
    assert abs(day["greed_ratio"] - 0.65) < 1e-12


def test_monthly_drops_null_month_hourly_keeps_null_key(spark):
    rows = [(1, "A", dt.datetime(2024, 1, 1, 1), 0.2, 0.3, 0.5), (2, "A", None, 0.2, 0.3, 0.5)]
    df = spark.createDataFrame(rows, SCHEMA)
    assert ind.monthly_score(df).count() == 1
    assert ind.hourly_score(df).count() == 2


def test_moving_average_and_cross(spark):
    vals = [1, 2, 3, 4, 5, 6, 7, 8, 20, 1, 1, 1, 1, 1, 1]
    m = spark.createDataFrame([("A", f"2020-{i + 1:02d}" if i < 12 else f"2021-{i - 11:02d}",
                                float(v)) for i, v in enumerate(vals)],
                              "stock_code string, month string, avg_score double")
    out = ind.cross_signal(ind.moving_average(m, 3, 5)).orderBy("month").collect()
    assert [r["short_ma"] is None for r in out[:2]] == [True, True]
    assert abs(out[2]["short_ma"] - 2.0) < 1e-12
    assert out[3]["long_ma"] is None and abs(out[4]["long_ma"] - 3.0) < 1e-12
    sig = [r["signal"] for r in out]
    assert sig[:5] == [None] * 5
    assert "dead" in sig and set(sig) <= {None, "none", "golden", "dead"}


def test_typed_indicators_half_up(spark):
    rows = [(1, "A", dt.datetime(2024, 1, 1, 1), 0.1234, 0.3, 0.1234),
            (2, "A", dt.datetime(2024, 1, 1, 1, 30), 0.1235, 0.3, 0.1235)]
    r = ind.typed_indicators(spark.createDataFrame(rows, SCHEMA),
                             created_at=F.lit("2024-02-01").cast("timestamp")).first()
    assert str(r["fear_ratio"]) == "0.1235"   # 0.12345 rounds half up
    assert str(r["fear_greed_index"]) == "12.35"
    assert r["date"] == dt.date(2024, 1, 1) and r["hour"] == 1


def test_typed_monthly(spark):
    rows = [(1, "A", dt.datetime(2024, 3, 1, 1), 0.1, 0.1, 0.1234),
            (2, "A", dt.datetime(2024, 3, 9, 1), 0.1, 0.1, 0.1235),
            (3, "A", None, 0.1, 0.1, 0.9)]
    out = ind.typed_monthly(spark.createDataFrame(rows, SCHEMA),
                            created_at=F.lit("2024-04-01").cast("timestamp")).collect()
    assert len(out) == 1
    r = out[0]
    assert (r["year"], r["month"]) == (2024, 3)
    assert str(r["avg_fear_greed"]) == "12.35"   # mean 12.345 rounds half up


def test_softmax_and_argmax_first_on_ties(spark):
    import math
    from moodindex.functions.numeric import argmax, softmax
    df = spark.createDataFrame([(1.0, 1.0, 0.0), (0.0, 2.0, 2.0), (3.0, -1.0, 0.5), (0.0, 0.0, 0.0)],
                               "a double, b double, c double")
    p = softmax(["a", "b", "c"])
    rows = df.select(*[x.alias(f"p{i}") for i, x in enumerate(p)],
                     argmax(p).alias("k"), argmax(["a", "b", "c"]).alias("k_raw")).collect()
    assert [r["k"] for r in rows] == [0, 1, 0, 0]
    assert [r["k_raw"] for r in rows] == [0, 1, 0, 0]
    for r, (a, b, c) in zip(rows, [(1.0, 1.0, 0.0), (0.0, 2.0, 2.0), (3.0, -1.0, 0.5), (0, 0, 0)]):
        z = math.exp(a) + math.exp(b) + math.exp(c)
        assert abs(r["p0"] - math.exp(a) / z) < 1e-12 and abs(r["p0"] + r["p1"] + r["p2"] - 1) < 1e-12


def test_change_rate_null_times_across_id_buckets(spark):
    rows = [(i * 40000, "A", None if i % 3 else dt.datetime(2024, 1, 1, i % 24), 0.1, 0.1,
             round((i * 7 % 100) / 100, 4)) for i in range(60)]
    df = spark.createDataFrame(rows, SCHEMA)
    fast = as_map(ind.change_rate(df), ["stock_code", "year", "hour"], "change_rate")
    slow = as_map(ind.change_rate_rows(df), ["stock_code", "year", "hour"], "change_rate")
    assert fast.keys() == slow.keys()
    for k in fast:
        assert close(fast[k], slow[k]), k


def test_bad_numbers_count_as_null(spark):
    nan, inf = float("nan"), float("inf")
    rows = [(1, "A", dt.datetime(2024, 1, 1, 1), nan, 0.5, 0.000004), (2, "A", dt.datetime(2024, 1, 1, 1, 5), inf, 0.25, nan),
            (3, "A", dt.datetime(2024, 1, 1, 1, 6), 0.000001, -inf, 0.000008), (4, "A", dt.datetime(2024, 1, 1, 2), 0.1, None, 0.5)]
    df = spark.createDataFrame(rows, SCHEMA)
    d = ind.daily_sentiment(df).first()
    assert abs(d["fear_ratio"] - 0.100001 / 2) < 1e-15 and d["neutral_ratio"] == 0.375
    assert abs(d["greed_ratio"] - 0.500012 / 3) < 1e-15
    h = {r["hour"]: r["avg_score"] for r in ind.hourly_score(df).collect()}
    assert abs(h[1] - 0.0006) < 1e-12 and h[2] == 50
    for order in ("hour", "arrival"):
        c = as_map(ind.change_rate(df, order), ["stock_code", "year", "hour"], "change_rate")
        w = as_map(ind.change_rate_rows(df, order), ["stock_code", "year", "hour"], "change_rate")
        assert c.keys() == w.keys() and all(close(c[k], w[k]) for k in c)
    assert ind.typed_indicators(df).count() == 2 and ind.typed_monthly(df).count() == 1
    text = df.selectExpr("comment_id", "stock_code", "time", "'oops' AS prob_fear", "'0.5' AS prob_neutral", "'x' AS prob_greed")
    d = ind.daily_sentiment(text).first()
    assert (d["fear_ratio"], d["neutral_ratio"], d["greed_ratio"]) == (None, 0.5, None)


def test_typed_rows_that_the_table_rejects_are_reported(spark):
    from moodindex import schemas
    rows = [(1, "A", dt.datetime(2024, 1, 1, 1), None, 0.5, 0.5), (2, "LONGER_THAN_TEN", dt.datetime(2024, 1, 1, 1), 0.2, 0.3, 0.5)]
    t = ind.typed_indicators(spark.createDataFrame(rows, SCHEMA))
    assert dict(t.dtypes)["hour"] == "tinyint" and dict(t.dtypes)["fear_ratio"] == "decimal(5,4)"
    bad = {(r["kind"], r["column"]): r["n"] for r in ind.typed_violations(t, schemas.TYPED_KEYS, schemas.TYPED_MEASURES).collect()}
    assert bad == {("null", "fear_ratio"): 1, ("too_long", "stock_code"): 1}


def test_monthly_rows_are_sorted(spark):
    rows = [(i, "BA"[i % 2], dt.datetime(2024, 1 + i * 5 % 12, 1), 0.1, 0.1, 0.5) for i in range(24)]
    m = [(r["stock_code"], r["month"]) for r in ind.monthly_series(ind.monthly_score(spark.createDataFrame(rows, SCHEMA))).collect()]
    assert m == sorted(m) and len(m) == 12
