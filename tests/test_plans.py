"""Plan-shape guards: heavy queries must not funnel rows through one
partition, top-k must not be a global sort, filters must reach the scan."""

import pytest

import __spark_entry__ as E

SF = "/root/testdata/sf0.001"


def final_plan(spark, key):
    df = E.queries()[key](spark, SF)
    df.collect()
    return df._jdf.queryExecution().executedPlan().toString().split("== Initial Plan ==")[0]


@pytest.mark.parametrize("key", ["daily_sentiment", "hourly_score", "change_rate_hourly",
                                 "moving_average", "word_top50", "sample_n", "weak_label",
                                 "typed_indicators", "upsert_daily"])
def test_no_single_partition_exchange(spark, key):
    assert "Exchange SinglePartition" not in final_plan(spark, key)


def test_top_k_is_not_a_global_sort(spark):
    p = final_plan(spark, "word_top50")
    assert "TakeOrderedAndProject" in p and "rangepartitioning" not in p


def test_url_filter_reaches_the_scan(spark):
    p = final_plan(spark, "preprocess")
    assert "PushedFilters: [IsNotNull(text), Not(StringContains(text,http://))" in p


def test_change_rate_has_no_row_window_without_nulls(spark):
    p = final_plan(spark, "change_rate_hourly")
    # one window only, over the runs of an (entity, year)
    assert sum("Window" in line for line in p.split("\n")) <= 1, p


def test_sample_is_one_scan_with_a_group_limit(spark):
    p = final_plan(spark, "sample_n")
    assert p.count("Scan parquet") == 1 and "WindowGroupLimit" in p


def test_table_sees_new_files(spark, tmp_path):
    from moodindex.sources.tables import table
    path = f"{tmp_path}/t.parquet"
    spark.range(5).write.parquet(path)
    assert table(spark, str(tmp_path), "t").count() == 5
    spark.range(4).write.mode("append").parquet(path)
    assert table(spark, str(tmp_path), "t").count() == 9


def test_publish_reads_touched_entities_only(spark, tmp_path):
    from pyspark.sql import functions as F

    from moodindex.operators import upsert as U
    path = f"{tmp_path}/pub"
    rows = spark.createDataFrame([(e, i, float(i)) for e in "AB" for i in range(3)], "stock_code string, k int, v double")
    ts = F.lit("2024-01-01").cast("timestamp")
    U.publish_upsert(spark, path, rows, ["stock_code", "k"], ["v"], ts)
    target, touched = spark.read.parquet(path), rows.where("stock_code = 'A'").select("stock_code").distinct()
    merged = U.upsert(target.join(touched, "stock_code", "left_semi"), rows.where("stock_code = 'A'"),
                      ["stock_code", "k"], ["v"], ts)
    plan = merged._jdf.queryExecution().optimizedPlan().toString()
    assert plan.index("FullOuter") < plan.index("LeftSemi")  # the cut is below the merge


def test_tfidf_reuses_the_term_count_shuffle(spark):
    df = E.queries()["tfidf_top30"](spark, SF)
    df.collect()
    full = df._jdf.queryExecution().executedPlan().toString()
    assert "ReusedExchange" in full and "hashpartitioning(doc_id" in full
