import numpy as np
import pytest
from pyspark.sql import functions as F

from moodindex.llm import langid, quality, toxicity

SF = "/root/testdata/sf0.01"


@pytest.fixture(scope="module")
def tables(spark):
    return {t: spark.read.parquet(f"{SF}/{t}.parquet") for t in ("documents", "labels")}


# -- language ----------------------------------------------------------------

def toy_model():
    counts = {"a": {}, "b": {}}
    for lang, text in (("a", "the cat and the hat "), ("b", "der hund und das brot ")):
        s = "   " + text * 3
        for i in range(len(s) - 3):
            counts[lang][s[i:i + 4]] = counts[lang].get(s[i:i + 4], 0) + 1
    return langid.Model(["a", "b"], counts)


def test_kneser_ney_sums_to_one():
    m = toy_model()
    letters = sorted({c for k in ("the cat and hat", "der hund und das brot") for c in k})
    for ctx in ("the", " un", "zzz", "xat"):
        for k in range(2):
            p = [float(np.exp(m.log_probs(np.array([ord(c) for c in ctx + x], np.uint32))[-1][k])) for x in letters]
            unseen = float(np.exp(m.log_probs(np.array([ord(c) for c in ctx + "§"], np.uint32))[-1][k]))
            assert sum(p) + unseen == pytest.approx(1, abs=1e-4)


def test_blocks_do_not_change_scores(monkeypatch):
    m = toy_model()
    texts = ["the hat", "", "das brot und der hund " * 200, "123", None or "x"]
    _, whole = m.entropies(texts)
    _, alone = zip(*(m.entropies([t]) for t in texts), strict=True)
    assert np.allclose(whole, np.concatenate(alone), atol=1e-4)
    monkeypatch.setattr(langid, "BLOCK_CHARS", 50)
    assert np.allclose(m.entropies(texts)[1], whole, atol=1e-3)


def test_language_edges(make_docs):
    rows = [(i, "the cat and the hat", "en", None, None) for i in range(12)]
    rows += [(i, "der hund und das brot", "de", None, None) for i in range(20, 32)]
    rows += [(40, None, "en", None, None), (41, "123 !!", "en", None, None), (42, "", None, None, None),
             (None, "der hund", "de", None, None), (43, "the cat " * 30_000, None, None, None), (44, "xyz", None, None, None)]
    d = make_docs(rows).withColumn("SCORE", F.lit(3)).withColumn("_p", F.lit(3))
    got = langid.identify(d, langid.train(d)).collect()
    assert len(got) == len(rows)
    for r in got:
        if r.doc_id in (40, 41, 42):
            assert (r.lang_pred, r.score, r.accepted) == ("und", 0.0, False)
        elif r.doc_id == 43:
            assert r.lang_pred == "en" and r.score > 0.9
        elif r.doc_id != 44:
            assert r.lang_pred == r.lang and 0.5 < r.score <= 1
    empty = make_docs([])
    assert langid.identify(empty, langid.train(empty)).count() == 0
    assert {r.lang_pred for r in langid.identify(d, langid.train(empty)).collect()} == {"und"}


def test_language_held_out(spark, tables):
    d = tables["documents"]
    got = langid.identify(d, langid.train(d)).filter(langid.remainder("doc_id") == 2)
    assert got.agg(F.avg((F.col("lang") == F.col("lang_pred")).cast("int"))).first()[0] > 0.98


def test_training_sample_is_bounded(tables):
    rows = langid.training_rows(tables["documents"], "doc_id", "text", "lang", 30)
    assert {r["count"] for r in rows.groupBy("lang").count().collect()} == {30}


# -- toxicity ----------------------------------------------------------------

def test_grammar_scores_clauses():
    g = toxicity.Grammar(dict.fromkeys(toxicity.INSULTS, toxicity.SEED_WEIGHT))
    total = lambda t: g.total(t)[0]
    assert total("You are an idiot.") > total("An idiot.") > 0
    assert total("You are not an idiot.") == 0 and total('He said: "you idiot".') == 0
    assert total("I will kill you.") > 0 and total("They kill time") > 0 and total("kill the process") == 0
    assert total("You are not late. You idiot.") == total("You idiot.")
    assert total("stupidity and idiots") > 0 and total("a pidiot") == 0
    assert total("x " * 50_000 + "you idiot") > 0
    assert g.total("") == (0.0, 0)


def test_threats_weigh_what_they_do_where_they_stand():
    g = toxicity.Grammar(dict.fromkeys(toxicity.INSULTS, toxicity.SEED_WEIGHT))
    total = lambda t: g.total(t)[0]
    assert total("I would never kill any of you") == 0 and total('He "would kill" all of you') == 0
    assert total("I will kill all of you") == total("You I will kill") == total("Never kill a fly, I kill all of you") == toxicity.THREAT_WEIGHT
    assert [f.__name__ for f, _ in toxicity.MACHINES] == ["_negation", "_report", "_threat", "_target", "_insult"]


def test_quotes_go_on_over_clauses():
    g = toxicity.Grammar(dict.fromkeys(toxicity.INSULTS, toxicity.SEED_WEIGHT))
    total = lambda t: g.total(t)[0]
    assert total('It reads "go away. You idiot. You moron." there.') == 0 == total("Il \u00abva. Tu idiot\u00bb.")
    assert total('It reads "go away." You idiot.') == total('A 5" pipe. You idiot.') == total("You idiot.") > 0


def test_all_beginnings_that_qualify_are_learned(spark):
    from itertools import islice, product
    words = ["".join(w) + "zzzzzz" for w in islice(product("abcdefghijklmno", repeat=3), 2_500)]
    rows = spark.createDataFrame([(" ".join(words), 1)] * 3 + [("a fine day", 0)] * 60, "text string, toxic int")
    assert len(toxicity._learn(rows, {})) == 2_500


def test_long_whole_words_match():
    g = toxicity.Grammar({"a" * 24 + "$": 5.0})
    assert toxicity._beginnings("a" * 30) & g.stems.keys() and g.symbol("a" * 30) == (toxicity.I, 5.0)
    assert g.total("you " + "a" * 30)[0] > 0 == g.total("a" * 23)[0]


def test_composed_automaton_is_the_product():
    step, weight = toxicity.compose()
    assert len(step) == np.prod([n for _, n in toxicity.MACHINES])
    assert (weight[:, [toxicity.N, toxicity.R, toxicity.Q, toxicity.O]] == 0).all()


def test_toxicity_learns_other_languages(spark):
    d = spark.read.parquet("/root/testdata/sf0.1/documents.parquet")
    lab = spark.read.parquet("/root/testdata/sf0.1/labels.parquet")
    got = toxicity.score_toxicity(d, toxicity.train(d, lab)).join(lab, "doc_id").filter(langid.remainder("doc_id") == 2)
    n = {(r.toxic, r.predicted): r["count"] for r in got.groupBy("toxic", "predicted").count().collect()}
    recall = n[1, 1] / (n[1, 1] + n.get((1, 0), 0))
    precision = n[1, 1] / (n[1, 1] + n.get((0, 1), 0))
    assert recall > 0.9 and precision > 0.85


def test_toxicity_edges(spark, make_docs):
    d = make_docs([(1, None), (2, ""), (3, "you idiot"), (3, "you idiot"), (None, "fine")]).withColumn("score", F.lit(9))
    lab = spark.createDataFrame([(1, 0, 1), (None, 1, 1), (3, None, None)], "doc_id long, toxic int, text int")
    got = toxicity.score_toxicity(d, toxicity.train(d, lab)).collect()
    assert len(got) == 5
    assert {r.doc_id: r.predicted for r in got} == {1: 0, 2: 0, 3: 1, None: 0}
    assert all(0 <= r.score <= 1 for r in got)
    e = make_docs([])
    assert toxicity.score_toxicity(e, toxicity.train(e, lab.limit(0))).count() == 0


# -- quality -----------------------------------------------------------------

def test_quality_on_labels(tables):
    got = quality.classify(tables["documents"], tables["labels"]).join(tables["labels"], "doc_id")
    n = {(r.quality, r.kept): r["count"] for r in got.groupBy("quality", "kept").count().collect()}
    assert n[1, True] > 0.98 * (n[1, True] + n.get((1, False), 0))
    assert n[0, False] > 0.9 * (n[0, False] + n.get((0, True), 0))


def test_sparse_sites_shrink_toward_their_host_and_the_global_share(spark):
    rows = [("big", "p", 3.0)] * 400 + [("bad", "p", -3.0)] * 400 + [("bad", "one", 3.0)] + [("new", "one", 3.0)]
    ev = spark.createDataFrame(rows, "host string, path string, evidence double")
    model = quality.Classifier([], [], [], 0.0, 0.5)
    prior = {(r.host, r.path): r.prior for r in quality.group_priors(ev, model).collect()}
    assert prior["big", "p"] > 0.9 and prior["bad", "p"] < 0.1
    assert prior["bad", "one"] < 0.5 < prior["new", "one"] < prior["big", "p"]


def test_quality_edges(spark, make_docs, monkeypatch):
    rows = [(1, None, None, None, None), (2, "", "en", "https://A.org/x/y", None), (3, "fine text", "en", "https://a.org/x/z?q", 1),
            (3, "fine text", "en", "https://a.org/x/z?q", 1), (None, "w " * 50_000, None, "s", None)]
    d = make_docs(rows).withColumn("prior", F.lit(0)).withColumn("host", F.lit("h")).withColumn("_x", F.lit(1))
    lab = spark.createDataFrame([(1, 0), (None, 1)], "doc_id long, quality int")
    got = quality.classify(d, lab).collect()
    assert len(got) == 5 and all(0 < r.score < 1 for r in got)
    assert {(r.host, r.path) for r in got} == {(None, None), ("a.org", "x"), ("s", None)}
    kept = quality.keep_good(d, lab, keep_at=0.0)
    assert kept.columns == d.columns and kept.count() == 5
    monkeypatch.setattr(quality, "BROADCAST_GROUPS", 0)  # the salted join gives the same
    again = quality.classify(d, lab).collect()
    assert sorted(again, key=str) == sorted(got, key=str)
    e = make_docs([])
    assert quality.classify(e, lab).count() == 0 and quality.keep_good(e, lab.limit(0)).count() == 0
