"""Lexicon hits and weak labels (N10), from lists, tables and files of any size."""

import os
import tempfile

from pyspark.sql import functions as F

from moodindex.operators import filters, lexicon

FEAR = ["하락", "하락장", "존버", "공포"]
GREED = ["상승", "존버", "가즈아", "떡"]


def labels(spark, texts):
    df = spark.createDataFrame([(i, t) for i, t in enumerate(texts)], "id long, text_tfidf string")
    out = lexicon.weak_label(df, FEAR, GREED, keep_hits=True).orderBy("id").collect()
    return [(r["fear_hits"], r["greed_hits"], r["label"]) for r in out]


def test_edge_labels(spark):
    got = labels(spark, ["존버", "하락장", None, "상승 가즈아", "공포 상승", "떡락 하락"])
    assert got == [(1, 1, 1), (2, 0, 0), (0, 0, 1), (0, 2, 2), (1, 1, 1), (1, 1, 1)]


def test_duplicate_keywords_count_once(spark):
    df = spark.createDataFrame([(1, "하락 하락 하락")], "id long, text_tfidf string")
    r = lexicon.lexicon_hits(df, ["하락", "하락"], []).first()
    assert r["fear_hits"] == 1 and r["greed_hits"] == 0


def test_table_form_equals_list_form(spark):
    texts = ["하락장 공포", "상승", "", None, "존버 하락 하락장", "xx공포xx"]
    df = spark.createDataFrame([(i, t) for i, t in enumerate(texts)], "id long, text string")
    lex = spark.createDataFrame([(w,) for w in FEAR + ["", "하락"]], "keyword string")
    listed = {r["id"]: r["fear_hits"] for r in lexicon.lexicon_hits(df, FEAR, [], text="text").collect()}
    got = {r["id"]: r["hits"] for r in lexicon.lexicon_hits_join(df, lex, "text").collect()}
    assert got == listed == {0: 3, 1: 0, 2: 0, 3: 0, 4: 3, 5: 1}
    assert {r["hits"] for r in lexicon.lexicon_hits_join(df, lex.limit(0), "text").collect()} == {0}


def test_lexicon_of_thousands_of_words(spark):
    words = [f"w{i:05d}" for i in range(20_000)]
    df = spark.createDataFrame([(1, "w00001 w19999 w2"), (2, None), (3, "x")], "id long, text string")
    got = {r["id"]: r["fear_hits"] for r in lexicon.lexicon_hits(df, words, [], text="text").collect()}
    assert got == {1: 2, 2: 0, 3: 0}


def test_files_are_stripped_and_blanks_dropped(spark):
    from moodindex.plans.jobs import Lexicons
    d = tempfile.mkdtemp(prefix="lex-", dir="/tmp")
    for name in ("t", "f", "g"):
        with open(os.path.join(d, name), "w", encoding="utf-8-sig") as f:
            f.write("abc\t\n\u3000한 글\u3000\n \n\nabc\xa0\nz\n")
    lex = Lexicons.from_files(spark, *[os.path.join(d, n) for n in ("t", "f", "g")])
    assert list(lex.topic) == ["abc", "한 글", "abc", "z"]
    assert sorted(lex.fear) == sorted(["abc", "한 글", "z"])


def test_generated_code_stays_small_at_350_words(spark):
    from moodindex.plans import params as P
    df = spark.createDataFrame([("a",)], "text_tfidf string")
    out = lexicon.weak_label(df, P.FEAR_WORDS_LONG, P.GREED_WORDS_LONG)
    assert len(P.FEAR_WORDS_LONG) + len(P.GREED_WORDS_LONG) == 350
    code = out._jdf.queryExecution().debug().codegenToSeq()
    sizes = [int(code.apply(i)._3().maxMethodCodeSize()) for i in range(code.size())]
    assert all(s < 8000 for s in sizes), sizes


def test_blank_topic_words_are_ignored(spark):
    df = spark.createDataFrame([("some text",), (None,)], "text string")
    lex = spark.createDataFrame([("",), ("zzz",)], "keyword string")
    assert filters.topic_filter_join(df, lex).count() == 2
    assert filters.topic_filter_join(df, lex, how="left_semi").count() == 0


def test_topic_filter_forms_agree(spark):
    texts = ["a token here", "li cense", "clean text", None, "tok en"]
    df = spark.createDataFrame([(i, t) for i, t in enumerate(texts)], "id long, text string")
    lex = spark.createDataFrame([("token",), ("license",)], "keyword string")
    anti = sorted(r["id"] for r in filters.topic_filter(df, ["token", "license"]).collect())
    anti_j = sorted(r["id"] for r in filters.topic_filter_join(df, lex, how="left_anti").collect())
    semi_j = sorted(r["id"] for r in filters.topic_filter_join(df, lex, how="left_semi").collect())
    assert anti == anti_j == [2, 3]
    assert semi_j == [0, 1, 4]


def test_label_distribution_sorted(spark):
    df = spark.createDataFrame([(2,), (0,), (2,), (1,)], "label int")
    rows = lexicon.label_distribution(df).collect()
    assert [(r["label"], r["n"]) for r in rows] == [(0, 1), (1, 1), (2, 2)]


def test_preprocess_edge_rows(spark):
    rows = [(1, "s", "정상 글", "2024-01-02 03:04:05"), (2, "s", None, "2024-01-02 03:04:05"),
            (3, "s", "글", None), (4, "s", "이 재 명", "2024-01-02 03:04:05"),
            (5, "s", "go http://x", "2024-01-02 03:04:05"), (6, "s", "!!!", "2024-01-02 03:04:05")]
    df = spark.createDataFrame(rows, "comment_id long, stock_code string, text string, time string")
    out = filters.preprocess(df, ["이재명"]).orderBy("comment_id").collect()
    assert [r["comment_id"] for r in out] == [1, 6]
    assert out[1]["text_tfidf"] == "" and out[1]["text_bert"] == "!!!"
    assert out[0]["raw_text"] == "정상 글"
    assert filters.train_input(filters.preprocess(df, ["이재명"]).withColumn(
        "text_bert", F.when(F.col("comment_id") == 6, F.lit("")).otherwise(F.col("text_bert")))
    ).count() == 1


def test_null_text_scored_as_empty(spark):
    from moodindex.operators import model
    train = spark.createDataFrame([(i, t, lab) for i, (t, lab) in enumerate(
        [("up up gain", 2), ("down fear", 0), ("flat", 1), ("gain more", 2), ("fear loss", 0),
         ("flat calm", 1)] * 3)], "comment_id long, text_bert string, label int")
    m = model.train(train)
    rows = model.score(m, spark.createDataFrame([(1, None), (2, "gain")],
                                                 "comment_id long, text_bert string")).collect()
    assert len(rows) == 2 and rows[0]["text_bert"] is None
    for r in rows:
        assert abs(r["prob_fear"] + r["prob_neutral"] + r["prob_greed"] - 1) < 3e-4
        assert r["pred_label"] in (0, 1, 2)
    assert rows[1]["pred_label"] == 2


def test_two_long_lexicons_share_one_walk(spark):
    from moodindex.plans import params as P
    texts = ["oner thin gain", "onon error reed", "", None, " ".join(P.FEAR_WORDS_LONG[:50] + P.GREED_WORDS_LONG[:60])]
    df = spark.createDataFrame([(k, t) for k, t in enumerate(texts)], "k int, t string")
    out = lexicon.lexicon_hits(df, P.FEAR_WORDS_LONG, P.GREED_WORDS_LONG, "t")
    assert {r.k: (r.fear_hits, r.greed_hits) for r in out.collect()} == {
        k: tuple(sum(w in (t or "") for w in ws) for ws in (P.FEAR_WORDS_LONG, P.GREED_WORDS_LONG)) for k, t in enumerate(texts)}
    assert out._jdf.queryExecution().executedPlan().toString().count("regexp_extract_all") == 1
