"""Plans that must stay spread over the tasks, whatever the size of the tables."""

from pyspark.sql import functions as F

from moodindex.operators import bayes, model, text_stats
from moodindex.plans import queries as Q


def plan_of(df):
    return df._jdf.queryExecution().executedPlan().toString()


def test_tokens_are_dealt_out_before_they_are_counted(spark):
    df = spark.createDataFrame([(1, "aa bb aa"), (1, "aa"), (2, "cc"), (None, "cc cc")], "k long, t string")
    tf = text_stats.term_frequencies(df, "k", "t")
    assert sorted(((r.doc_id or 0), r.term, r.tf) for r in tf.collect()) == [
        (0, "cc", 2), (1, "aa", 3), (1, "bb", 1), (2, "cc", 1)]
    lines = [x for x in plan_of(text_stats.term_frequencies(df, "k", "t")).splitlines() if "Aggregate" in x or "Exchange" in x]
    assert "Exchange" in lines[-1]


def test_scoring_shuffles_no_counts_by_document_and_term(spark):
    df = spark.createDataFrame([(1, "a b", 0), (2, "c", 1), (3, "a d", 2)], "k long, t string, y int")
    m = bayes.train(df, "k", "t", "y").checkpoint()
    assert "term#" not in "".join(x.split("keys=[")[1] for x in plan_of(bayes.score(m, df, "k", "t")).splitlines() if "Aggregate(keys" in x)


def test_texts_are_tokenised_once_in_training(spark):
    seen = spark.sparkContext.accumulator(0)

    def text(k):
        seen.add(1)
        return f"word{k % 3} other{k % 2}"

    rows = spark.range(30).select(F.udf(text).asNondeterministic()("id").alias("t"), (F.col("id") % 3).cast("int").alias("y"))
    m = model.train(rows, "t", "y", buckets=64, max_iter=3)
    assert seen.value == 30
    assert model.score(m, spark.createDataFrame([(1, "word1 other1")], "k long, t string"), "t").count() == 1


def test_the_scanned_files_are_written_by_many_tasks(spark, tmp_path, monkeypatch):
    docs = spark.range(40).select(F.col("id").alias("doc_id"), F.lit("s").alias("source"), F.lit('a "q"\nb').alias("text"))
    docs.repartition(4).write.parquet(str(tmp_path / "documents.parquet"))
    parts = []
    monkeypatch.setattr(Q.io, "write_csv", lambda df, path, f=Q.io.write_csv: (parts.append(df.rdd.getNumPartitions()), f(df, path)))
    assert Q.q_scan_csv_split(spark, str(tmp_path)).count() == 40
    assert parts[0] > 1
