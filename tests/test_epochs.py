"""Training epoch by epoch against dense gradient descent written out by hand."""

import hashlib
import math
import random
from collections import Counter

import numpy as np
import pyarrow as pa

from moodindex.operators import epochs as E
from moodindex.plans import queries as Q

SCHEMA = "id long, text string, label int, split string"
B = 64


def rows(seed, n=80):
    rng = random.Random(seed)
    words = [["Down", "fall", "the"], ["flat", "the", "x"], ["up", "gain", "the"]]
    out = []
    for k in range(n):
        y = rng.choice([0, 1, 2, 2])
        text = " ".join(rng.choice(words[rng.choice([y, y, rng.randint(0, 2)])]) for _ in range(rng.randint(0, 9)))
        out.append((k, text, y, "valid" if k % 4 == 0 else "train"))
    return out


def vector(text):
    n = Counter(int(hashlib.md5(w.encode()).hexdigest()[:4], 16) % B for w in (text or "").lower().split())
    length = math.sqrt(sum(c * c for c in n.values()))
    x = np.zeros(B + 1)
    for b, c in n.items():
        x[b] = c / length
    x[B] = 1.0
    return x


def by_hand(data, epochs, rate, start=None):
    x = np.array([vector(t) for _, t, _, _ in data])
    y = np.array([r[2] for r in data])
    valid = np.array([r[3] == "valid" for r in data])
    w = np.zeros((B + 1, 3)) if start is None else start
    out = []
    for epoch in range(epochs + 1):
        p = np.exp(x @ w)
        p /= p.sum(axis=1, keepdims=True)
        loss = -np.log(p[np.arange(len(y)), y])
        out.append((epoch, loss[~valid].mean(), loss[valid].mean(), (p.argmax(axis=1) == y)[valid].mean()))
        kept = w
        w = w - rate * x[~valid].T @ (p - np.eye(3)[y])[~valid] / (~valid).sum()
    return out, kept


def made(spark, data):
    return E.features(spark.createDataFrame(data, SCHEMA).repartition(5), "text", "label", "split", B).checkpoint()


def test_epochs_by_hand_warm_start_and_scores(spark):
    data = rows(1)
    extra = [(900, "up", 7, "train"), (901, "up", None, "train")]  # no class: left out
    got = E.train(made(spark, data + extra), 6, 1.5, buckets=B)
    want, w = by_hand(data, 6, 1.5)
    assert np.allclose([r[:4] for r in got.rows], want)
    assert np.allclose(got.weights, w)
    losses = [r[1] for r in got.rows]
    assert losses == sorted(losses, reverse=True) and abs(losses[0] - math.log(3)) < 1e-12
    # three epochs, written as a table and read back, then three more: the same weights
    half = E.train(made(spark, data), 3, 1.5, buckets=B)
    rest = E.train(made(spark, data), 3, 1.5, buckets=B, start=E.weights_of(half.table(spark), B))
    assert np.allclose(rest.weights, w)
    asked = data + [(500, None, 0, "x"), (501, "", 0, "x"), (502, "unheard of", 0, "x")]
    scored = E.score(spark.createDataFrame(asked, SCHEMA), got, "text").collect()
    assert len(scored) == len(asked)
    for r in scored:
        z = vector(r.text) @ w
        p = np.exp(z) / np.exp(z).sum()
        assert np.allclose([r.prob_fear, r.prob_neutral, r.prob_greed], p) and r.pred_label == p.argmax()


def test_early_stop_keeps_the_best_epoch(spark):
    data = [(k, "up" if k % 2 else "down", 2 if k % 2 else 0, "train") for k in range(20)]
    data += [(50, "up", 0, "valid"), (51, "down", 2, "valid")]  # contrary: each epoch makes it worse
    got = E.train(made(spark, data), 9, 1.0, patience=2, buckets=B)
    assert [r[0] for r in got.rows] == [0, 1, 2] and got.best == 0
    assert not got.weights.any()


def test_no_rows_no_training_rows_no_validation_rows(spark):
    none = E.train(made(spark, []), 3, buckets=B)
    assert none.rows == [(0, None, None, None, None)] and not none.weights.any()
    only_valid = E.train(made(spark, [(1, "up", 2, "valid")]), 3, buckets=B)
    assert len(only_valid.rows) == 1 and only_valid.rows[0][1] is None and only_valid.rows[0][2] is not None
    only_train = E.train(made(spark, [(1, "up", 2, "train"), (2, "up", 2, None)]), 3, buckets=B)
    assert len(only_train.rows) == 4 and only_train.best == 3 and only_train.rows[-1][2] is None
    assert only_train.metrics(spark).columns == ["epoch", "train_loss", "valid_loss", "accuracy", "f1"]


def test_a_pass_reads_the_checkpoint_and_sends_no_more_than_the_buckets(spark):
    d = made(spark, rows(2))
    assert "Scan ExistingRDD" in d._jdf.queryExecution().toString()
    sums = E.one_pass(d, np.zeros((B + 1, 3)))
    assert len(sums) <= B + 12


def test_features_are_counts_and_slices_change_nothing(spark, monkeypatch):
    data = rows(3)
    d = made(spark, data + [(700, "the the The x", 0, "train")])
    for r in d.collect():
        assert list(r.terms.bucket) == sorted(set(r.terms.bucket)) and min(r.terms.n, default=1) > 0
    assert max(max(r.terms.n, default=0) for r in d.collect()) >= 3
    terms = d.select("terms").toArrow()["terms"].combine_chunks()
    w = np.random.default_rng(0).normal(size=(B + 1, 3))
    whole, _ = E.logits(terms, w)
    sliced = np.concatenate([E.logits(terms.slice(a, 7), w)[0] for a in range(0, len(terms), 7)])
    assert np.allclose(whole, sliced)
    words = pa.array([(t or "").lower().split() for _, t, _, _ in data], pa.list_(pa.string()))
    want = E._counts(words, B).to_pylist()
    monkeypatch.setattr(E, "SLICE_ROWS", 7)
    assert E._counts(words, B).to_pylist() == want and E._counts(words.slice(9, 20), B).to_pylist() == want[9:29]


def test_epoch_score_cleans_the_texts_once(spark, monkeypatch):
    data = [(k, "s", f"{t} number {k}", "2020-01-01") for k, t, _, _ in rows(4, 30)]
    calls = []

    def comments(spark, sf):
        calls.append(sf)
        return spark.createDataFrame(data, "comment_id long, stock_code string, text string, time string")

    monkeypatch.setattr(Q.tables, "comments", comments)
    got = Q.q_epoch_score(spark, "x").collect()
    assert sorted(r.comment_id for r in got) == list(range(30)) and len(calls) == 1
