"""Naive Bayes as tables against the formula by hand."""

import math
import random
from collections import Counter

from moodindex.operators import bayes

SCHEMA = "id long, text string, label int"


def rows(seed, n=60):
    rng = random.Random(seed)
    words = [["Down", "fall", "the"], ["flat", "the", "x"], ["up", "gain", "the"]]
    out = []
    for k in range(n):
        y = rng.choice([0, 1, 2, 2])
        out.append((k, " ".join(rng.choice(words[rng.choice([y, y, rng.randint(0, 2)])]) for _ in range(rng.randint(0, 9))), y))
    return out


def by_hand(train, text):
    n, d = [Counter() for _ in range(3)], Counter()
    for _, t, y in train:
        n[y].update(t.lower().split())
        d[y] += 1
    vocabulary = set().union(*n)
    s = [math.log(d[c] / sum(d.values())) if d[c] else -math.inf for c in range(3)]
    for w in (text or "").lower().split():
        if w in vocabulary:
            s = [s[c] + math.log((n[c][w] + 1) / (sum(n[c].values()) + len(vocabulary))) for c in range(3)]
    e = [math.exp(x - max(s)) for x in s]
    return [x / sum(e) for x in e], s.index(max(s))


def test_training_and_scoring_by_hand(spark):
    train = rows(1)
    model = bayes.train(spark.createDataFrame(train + [(99, None, 0), (98, "lost", None), (97, "lost", 7)], SCHEMA), "id", "text", "label")
    asked = [(k, t, 0) for k, t, _ in rows(2)] + [(100, None, 0), (101, "", 0), (102, "unheard of", 0), (103, "UP\n up\tgain", 0)]
    got = bayes.score(model, spark.createDataFrame(asked, SCHEMA), "id", "text", 12).collect()
    assert len(got) == len(asked)
    for r in got:
        probs, best = by_hand(train, r.text)
        assert all(abs(a - b) < 1e-9 for a, b in zip(probs, (r.prob_fear, r.prob_neutral, r.prob_greed), strict=True))
        assert r.pred_label == best


def test_a_class_without_documents_and_an_empty_table(spark):
    train = [(1, "up up", 2), (2, "down", 0)]
    model = bayes.train(spark.createDataFrame(train, SCHEMA), "id", "text", "label")
    r = bayes.score(model, spark.createDataFrame([(1, "up", 1)], SCHEMA), "id", "text").first()
    assert r.prob_neutral == 0.0 and r.pred_label == 2
    none = bayes.train(spark.createDataFrame([], SCHEMA), "id", "text", "label")
    assert none.count() == 0


def test_evaluate(spark):
    scored = spark.createDataFrame([(0, 0, 0.5, 0.3, 0.2), (2, 0, 0.6, 0.2, 0.2), (None, 1, 0.1, 0.8, 0.1)],
                                   "label int, pred_label int, _u0 double, _u1 double, _u2 double")
    got = {r.metric: r.value for r in bayes.evaluate(scored).collect()}
    assert got["accuracy"] == 0.5
    assert abs(got["logLoss"] + (math.log(0.5) + math.log(0.2)) / 2) < 1e-12


def test_no_cartesian_product_of_rows(spark):
    d = spark.createDataFrame(rows(3), SCHEMA)
    plan = bayes.score(bayes.train(d, "id", "text", "label"), d, "id", "text")._jdf.queryExecution().toString()
    assert "CartesianProduct" not in plan
