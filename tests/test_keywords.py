import random
import re
from collections import Counter

import numpy as np
import pyarrow as pa
import pytest
from hypothesis import given, settings
from hypothesis import strategies as st
from pyspark.sql import functions as F

from moodindex.functions import grams as G
from moodindex.functions import keywords as K
from moodindex.functions import text as T
from moodindex.operators import keyword_index

WORD = st.text(alphabet="ab.é𝄞\\ \n", min_size=1, max_size=6)


def python_pattern(p):
    """Java and Python read these patterns alike."""
    return re.compile(p)


@settings(max_examples=150, deadline=None)
@given(st.lists(WORD, min_size=1, max_size=12), st.text(alphabet="ab.é𝄞\\ \n", max_size=30))
def test_patterns_find_what_substrings_find(words, text):
    assert bool(python_pattern(K.any_pattern(words)).search(text)) == any(w in text for w in words)
    longest = {m.group(1) for m in python_pattern(K.longest_pattern(words)).finditer(text)}
    found = longest | {p for p in K.prefixes(words) if any(w.startswith(p) for w in longest)}
    assert found == {w for w in words if w in text}


@given(st.lists(WORD, max_size=15))
def test_prefixes(words):
    assert set(K.prefixes(words)) == {p for p in words if any(w != p and w.startswith(p) for w in words)}


def corpus(seed):
    rng = random.Random(seed)
    parts = ["on", "er", "an", "th", "é", "𝄞", ".", "(", "[a]", "\\", "^", "$", " ", "\n", "공포", "x"]
    words = list({"".join(rng.choice(parts) for _ in range(rng.randint(1, 5))) for _ in range(160)})
    texts = ["".join(rng.choice(parts) for _ in range(rng.randint(0, 60))) for _ in range(80)] + [None, ""] + words[:5]
    return words, texts


@pytest.mark.parametrize("few", [0, 10_000])
def test_hits_and_mentions(spark, monkeypatch, few):
    monkeypatch.setattr(T, "FEW_WORDS", few)
    monkeypatch.setattr(T, "FEW_MENTIONS", few)
    words, texts = corpus(2)
    df = spark.createDataFrame(list(enumerate(texts)), "id long, text string")
    rows = df.select("id", T.lexicon_hit_count("text", [*words, "", None, words[0]]).alias("n"),
                     T.contains_any("text", words[:12]).alias("any"),
                     T.contains_any_nospace("text", words[:40]).alias("bare")).collect()
    for r in rows:
        t = texts[r.id] or ""
        bare = re.sub(r"\s", "", t)
        assert r.n == sum(w in t for w in words)
        assert r["any"] == any(w in t for w in words[:12])
        assert r.bare == any(w in bare for w in words[:40] if not re.search(r"\s", w))


def test_index_of_a_lexicon_table(spark):
    words, texts = corpus(3)
    df = spark.createDataFrame([(k, t, "y") for k, t in enumerate(texts)], "key long, body string, hits string")
    lexicon = spark.createDataFrame([(w,) for w in [*words, "", None, words[0], "nowhere at all"]], "keyword string")
    got = keyword_index.hit_counts(df, lexicon, "key", "body").collect()
    assert {(r.key, r.hits) for r in got} == {(k, sum(w in (t or "") for w in words)) for k, t in enumerate(texts)}
    few = lexicon.where(F.col("keyword").isin(words[:3]))
    hit = {k for k, t in enumerate(texts) if any(w in (t or "") for w in words[:3])}
    for how, want in (("left_semi", hit), ("left_anti", set(range(len(texts))) - hit)):
        assert {r.key for r in keyword_index.mentioning(df, few, "key", "body", how).collect()} == want
    none = lexicon.where("keyword = ''")
    assert keyword_index.keyword_hits(df, none, "key", "body").count() == 0
    assert [r.hits for r in keyword_index.hit_counts(df, none, "key", "body").collect()] == [0] * len(texts)


def test_a_keyword_is_filed_once_under_its_rarest_gram(spark):
    probes = spark.createDataFrame([(1, "abc"), (2, "abc"), (1, "bcd"), (3, "x")], "id long, gram string")
    words = spark.createDataFrame([("abcd",), ("x",), ("bcq",)], "keyword string")
    got = {(r.gram, r.keyword) for r in keyword_index.anchor_index(probes, words).collect()}
    assert got == {("bcd", "abcd"), ("x", "x")}


def test_keywords_longer_than_a_window_and_repeated_keys(spark):
    long = "a keyword that is longer than any window"
    df = spark.createDataFrame([(1, f"so {long}, abcd"), (1, "abcd"), (2, long[:-1] + "x"), (None, "abcd"), (3, None)],
                               "key long, body string")
    lexicon = spark.createDataFrame([(long,), ("abcd",), ("o",), ("longer than any wind",)], "keyword string")
    got = keyword_index.keyword_hits(df, lexicon, "key", "body").collect()
    assert sorted((r.id, r.keyword) for r in got) == sorted(
        [(1, long), (1, "abcd"), (1, "abcd"), (1, "o"), (1, "longer than any wind"), (2, "longer than any wind"), (2, "o")])


def test_texts_are_not_shuffled_by_gram(spark):
    df = spark.createDataFrame([(k, "same words in all texts") for k in range(40)], "key long, body string")
    hits = keyword_index.keyword_hits(df, spark.createDataFrame([("words",), ("texts",)], "keyword string"), "key", "body")
    plan = hits._jdf.queryExecution().executedPlan().toString()
    assert hits.count() == 80 and "SortMergeJoin" not in plan


def test_texts_are_searched_by_batch_without_windows(spark):
    df = spark.createDataFrame([(k, "same words in all texts") for k in range(40)], "key long, body string")
    lexicon = spark.createDataFrame([("words",), ("texts",), ("a",)], "keyword string")
    hits = keyword_index.hit_counts(df, lexicon, "key", "body")
    plan = hits._jdf.queryExecution().optimizedPlan().toString()
    assert "regexp_extract_all" not in plan and "Generate" not in plan  # a text is one row from its scan to its hits
    assert plan.count("ArrowEvalPython") == 1
    assert {r.hits for r in hits.collect()} == {3}


def _grams(word):
    return [word[i:i + keyword_index.Q] for i in range(len(word) - keyword_index.Q + 1)] or [word]


@pytest.mark.parametrize("places, pairs", [(1 << 18, 1 << 20), (23, 7)])
def test_bytes_of_a_batch_are_searched_as_its_texts(monkeypatch, places, pairs):
    monkeypatch.setattr(G, "PLACES", places)
    monkeypatch.setattr(G, "PAIRS", pairs)
    for seed in range(6):
        rng = random.Random(seed)
        words, texts = corpus(seed)
        words += ["공포 " * 9, "longer than three blocks of bytes", "longer than three blocks of letters", "\0a", "공", "aaaa"]
        texts += ["so longer than three blocks of bytes", "공포 " * 9 + "!", "\0a", "aaaaaa", words[0] * 20]
        index = G.Keywords([(rng.choice(_grams(w)), w) for w in words])
        for batch in (pa.array(texts), pa.array(texts).slice(5, 70), pa.array(texts, pa.large_string()), pa.array([None, ""], pa.string()),
                      pa.array([], pa.string())):
            want = [sorted(w for w in words if w in (t or "")) for t in batch.to_pylist()]
            assert [sorted(x) for x in index.lists(batch).to_pylist()] == want
            assert index.counts(batch).to_pylist() == [len(x) for x in want]


def test_grams_are_counted_wherever_they_begin(spark):
    words, texts = corpus(5)
    named = sorted({g for w in words for g in _grams(w) if len(g.encode()) <= G.CODE})
    got = keyword_index.gram_counts(spark.createDataFrame([(t,) for t in texts if t], "text string").repartition(3), named)
    want = Counter(g for g in named for t in texts for i in range(len(t or "")) if t.startswith(g, i))
    assert {r.gram: r.n for r in got.collect()} == want
    grams, n = G.Grams([g.encode() for g in named]), np.zeros(len(named), np.int64)
    grams.count(pa.array([], pa.string()), n)
    assert not n.any()


def test_an_index_that_is_not_sent_finds_the_same(spark, monkeypatch):
    words, texts = corpus(7)
    words += ["a keyword that is longer than any window", "keyword that is longer"]
    texts += [f"x {words[-2]} y", f"x {words[-2][:-1]} y", words[-1]]
    rows = [(k if k % 9 else None, t) for k, t in enumerate(texts)] + [(k, t) for k, t in enumerate(texts) if k % 5 == 1]
    df = spark.createDataFrame(rows, "key long, body string")
    lexicon = spark.createDataFrame([(w,) for w in words], "keyword string")

    def found():
        return (Counter(map(tuple, keyword_index.keyword_hits(df, lexicon, "key", "body").collect())),
                Counter(map(tuple, keyword_index.hit_counts(df, lexicon, "key", "body").collect())),
                Counter(map(tuple, keyword_index.mentioning(df, lexicon, "key", "body").collect())))

    sent = found()
    assert sent[0] == Counter((k, w) for k, t in rows if k is not None for w in words if w in (t or ""))
    monkeypatch.setattr(keyword_index, "BROADCAST_WORDS", 0)
    assert found() == sent
