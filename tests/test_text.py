"""Cleaners, filters and tokenisers on hand-made edge rows."""

import re

import pytest
from pyspark.sql import functions as F

from moodindex.functions import text as T


def one(spark, value, expr):
    df = spark.createDataFrame([(value,)], "t string")
    return df.select(expr(F.col("t")).alias("o")).first()["o"]


@pytest.mark.parametrize("raw,tfidf,bert", [
    ("<b>x</b> http://a.b c", "x c", "x c"),
    ("!!!", "", "!!!"),
    ("a\u00a0b\u3000c", "a b c", "a b c"),
    ("é한ㅋㅋ_x①²", "한x", "é한ㅋㅋ_x①²"),
    ("  lots \t\n of   space  ", "lots of space", "lots of space"),
    ("www.site.kr/path?q=1 after", "after", "after"),
    ("emoji 😀 gone", "emoji gone", "emoji gone"),
])
def test_cleaners(spark, raw, tfidf, bert):
    assert one(spark, raw, T.clean_tfidf) == tfidf
    assert one(spark, raw, T.clean_bert) == bert


@pytest.mark.parametrize("raw,want", [
    ("Hello, 세계! <i>tag</i> http://x.y/z end", "Hello 세계 tag end"),
    ("\x1c sep \x85 nel \u2028 ls", "sep nel ls"),
    ("tab\tand\u205fmath", "tab and math"),
    ("숫자 123 ㄱㄴ ㅏ", "숫자 123"),
    ("ab\u200bcd zero-width", "abcd zerowidth"),
])
def test_clean_tfidf_literal_cases(spark, raw, want):
    assert one(spark, raw, T.clean_tfidf) == want


def test_complement_class_equals_negated_class():
    fast = re.compile(re.sub(r"\\x\{([0-9A-F]+)\}", lambda m: "\\U%08X" % int(m.group(1), 16),
                             T.COUNT_DROP_FAST_RE))
    slow = re.compile(r"[^가-힣a-zA-Z0-9\s]+")
    for cp in range(0, 0x110000, 7):
        c = chr(cp)
        assert (fast.fullmatch(c) is None) == (slow.fullmatch(c) is None), hex(cp)


def test_space_string_is_python_whitespace():
    assert sorted(T.SPACE_STRING) == sorted(chr(c) for c in range(0x110000) if chr(c).isspace())


def test_url_flag(spark):
    rows = [("see https://x",), ("www.a",), ("a.com",), ("b.kr",), ("HTTP://X",), ("plain",), (None,)]
    df = spark.createDataFrame(rows, "t string")
    got = [r["u"] for r in df.select(T.has_url("t").alias("u")).collect()]
    assert got == [True, True, True, True, False, False, None]


def test_topic_keyword_split_by_spaces(spark):
    df = spark.createDataFrame([("이 재 명 뉴스",), ("다른 글",), ("li\u00a0cen se",)], "t string")
    hit = T.contains_any_nospace("t", ["이재명", "license"])
    assert [r["h"] for r in df.select(hit.alias("h")).collect()] == [True, False, True]
    many = ["w%d" % i for i in range(20)] + ["이재명"]
    hit2 = T.contains_any_nospace("t", many)
    assert [r["h"] for r in df.select(hit2.alias("h")).collect()] == [True, False, False]


def test_keyword_with_inner_space_never_matches(spark):
    df = spark.createDataFrame([("a b",)], "t string")
    assert df.select(T.contains_any_nospace("t", ["a b"]).alias("h")).first()["h"] is False


def test_split_and_tokenize(spark):
    assert one(spark, "  a  b\u3000c ", T.split_words) == ["a", "b", "c"]
    assert one(spark, "", T.split_words) == []
    assert one(spark, "Ab c de_f 한국 x1", T.tokenize_words) == ["ab", "de_f", "한국", "x1"]
    assert one(spark, "ABC! 한글", T.clean_words) == "abc 한글"


def test_collapse_space_edges(spark):
    assert one(spark, None, T.collapse_space) is None
    assert one(spark, "", T.collapse_space) == ""
    assert one(spark, " \t　 ", T.collapse_space) == ""
    assert one(spark, "\x1ca  b  c\x85", T.collapse_space) == "a b c"


def test_word_counts_normalized_path_equal(spark):
    from moodindex.operators import text_stats
    texts = ["Hello 세계 hello", "", None, "a b  C", "<i>x</i> 1 2 2"]
    df = spark.createDataFrame([(t,) for t in texts], "raw string").select(
        T.clean_tfidf("raw").alias("text_tfidf"))
    a = {r["word"]: r["count"] for r in text_stats.word_counts(df).collect()}
    b = {r["word"]: r["count"] for r in text_stats.word_counts(df, normalized=True).collect()}
    assert a == b and a["hello"] == 2


def test_sql_built_lexicon_and_url_match_column_built(spark):
    words = ["하락", "it's", "back\\slash", "a`b", "x"]
    texts = ["하락 it's", "back\\slash", "a`b http://q", None, "nothing"]
    df = spark.createDataFrame([(t,) for t in texts], "t string")
    a = df.select(T.lexicon_hit_count("t", words).alias("n"), T.has_url("t").alias("u")).collect()
    b = df.select(T.lexicon_hit_count(F.col("t"), words).alias("n"),
                  T.has_url(F.col("t")).alias("u")).collect()
    assert a == b
    assert [r["n"] for r in a] == [2, 1, 1, 0, 0]
