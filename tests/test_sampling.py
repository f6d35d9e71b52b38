"""Exact seeded sampling and the stratified split against brute force."""

import hashlib

from pyspark.sql import functions as F

from moodindex.operators import sampling


def md5_order(i, seed):
    return hashlib.md5(f"{i}:{seed}".encode()).hexdigest()


def test_sample_n_matches_brute_force_with_hot_group(spark):
    rows = [(i, "hot" if i % 3 else f"g{i % 5}") for i in range(3000)]
    df = spark.createDataFrame(rows, "id long, stock_code string")
    got = {r["id"] for r in sampling.sample_n(df, 250, 41, "id").collect()}
    want = set()
    groups = {}
    for i, g in rows:
        groups.setdefault(g, []).append(i)
    for g, ids in groups.items():
        want |= set(sorted(ids, key=lambda i: (md5_order(i, 41), i))[:250])
    assert got == want


def test_stratified_split_quota_and_brute_force(spark):
    labels = [0] * 58 + [1] * 341
    rows = [(i, lab) for i, lab in enumerate(labels)]
    df = spark.createDataFrame(rows, "doc_id long, label int")
    q = {r["label"]: r["quota"] for r in sampling.split_quotas(df, "label", 0.2).collect()}
    assert q == {0: 12, 1: 68}
    out = sampling.stratified_split(df, "label", "doc_id", 0.2, 42).collect()
    assert len(out) == len(rows) and len({r["doc_id"] for r in out}) == len(rows)
    valid = {r["doc_id"] for r in out if r["split"] == "valid"}
    want = set()
    for lab, k in q.items():
        ids = [i for i, l_ in rows if l_ == lab]
        want |= set(sorted(ids, key=lambda i: (md5_order(i, 42), i))[:k])
    assert valid == want


def test_sample_larger_than_group_returns_all(spark):
    df = spark.createDataFrame([(i, "a") for i in range(10)], "id long, stock_code string")
    assert sampling.sample_n(df, 1000, 1, "id").count() == 10


def test_quotas_of_huge_counts_are_exact(spark):
    n = {0: 10 ** 11 + 7, 1: 3 * 10 ** 11 + 1, 2: 5}
    counts = spark.createDataFrame(list(n.items()), "label int, _n long")
    got = {r["label"]: r["quota"] for r in sampling.quotas_from_counts(counts, "label", 0.25).collect()}
    tot = sum(n.values())
    k = -(-tot // 4)
    base = {c: v * k // tot for c, v in n.items()}
    rest = sorted(n, key=lambda c: (-(n[c] * k % tot), c))[:k - sum(base.values())]
    assert got == {c: b + (c in rest) for c, b in base.items()}


def test_rows_of_a_split_are_not_shuffled_by_label(spark):
    df = spark.range(5000).select(F.col("id"), (F.col("id") % 3).alias("label"), F.lit("text").alias("text"))
    out = sampling.stratified_split(df, "label", "id")
    assert out.groupBy("split").count().orderBy("split").collect() == [("train", 4000), ("valid", 1000)]
    plan = out._jdf.queryExecution().executedPlan().toString()
    assert "SortMergeJoin" not in plan and "BroadcastHashJoin" in plan
