import random
import re
from collections import Counter

import pytest
from pyspark.sql import functions as F

from moodindex.llm import jaccard
from moodindex.llm.shingles import shingle_set

WORD = re.compile(r"[^\x20\x09-\x0D]+")


def lowered(t):
    return "".join(chr(ord(c) + 32) if "A" <= c <= "Z" else c for c in t or "")


def shingles(t):
    w = WORD.findall(lowered(t))
    return {tuple(w[i:i + 5]) for i in range(max(1, len(w) - 4))} if w else set()


def brute(rows):
    sets = {i: shingles(t) for i, t in rows}
    root = {i: i for i in sets}

    def find(x):
        while root[x] != x:
            x = root[x]
        return x
    holders = {}
    for i, s in sets.items():
        for x in s:
            holders.setdefault(x, []).append(i)
    for i, s in sets.items():
        for j, n in Counter(j for x in s for j in holders[x] if j < i).items():
            if 100 * n >= 75 * (len(s) + len(sets[j]) - n):
                a, b = find(i), find(j)
                root[max(a, b)] = min(a, b)
    return {i: (len(sets[i]), find(i)) for i in sets}


def got_of(df):
    return {r.doc_id: (r.n_shingles, r.component_id) for r in jaccard.jaccard_components(df).collect()}


def test_shingle_counts():
    for t in ["", "a", "A b", " x\ty\x0bz\x0c\x1c é É", "a b c d e a b c d e", "İ k ſ"]:
        assert len(shingle_set(t)) == len(shingles(t))
    assert (shingle_set("A b c\nd E f") == shingle_set("a B c d e f")).all()


def chain(n, rnd):
    """Texts that drift: neighbours are similar, the ends are not."""
    w = [f"w{rnd.randrange(1000)}" for _ in range(60)]
    out = []
    for _ in range(n):
        w = w[:]
        w[rnd.randrange(60)] = f"x{rnd.randrange(10 ** 6)}"
        out.append(" ".join(w))
    return out


@pytest.mark.parametrize("seed", [1, 2])
def test_equals_brute_force(make_docs, monkeypatch, seed):
    monkeypatch.setattr(jaccard, "BLOCK", 16)
    monkeypatch.setattr(jaccard, "SUBGROUP", 4)
    rnd = random.Random(seed)
    texts = ["", None, " ", "a", "A", "a b c d", "a b c d", "a b c d e"]
    for _ in range(6):
        texts += chain(25, rnd)
    base = [f"b{i}" for i in range(120)]
    for _ in range(80):  # one large group of near copies
        w = base[:]
        for _ in range(rnd.randrange(4)):
            w[rnd.randrange(120)] = f"y{rnd.randrange(10 ** 6)}"
        texts.append(" ".join(w))
    passage = " ".join(f"p{i}" for i in range(30))
    texts += [passage + " " + " ".join(f"q{rnd.randrange(10 ** 6)}" for _ in range(rnd.randrange(60))) for _ in range(80)]
    texts += rnd.sample([t for t in texts if t], 40)  # exact copies
    rnd.shuffle(texts)
    rows = list(enumerate(texts))
    assert got_of(make_docs(rows).repartition(5)) == brute(rows)


def test_equals_brute_force_on_documents(spark):
    d = spark.read.parquet("/root/testdata/sf0.001/documents.parquet")
    assert got_of(d) == brute([(r.doc_id, r.text) for r in d.collect()])


def test_edge_rows_and_stage(make_docs):
    a = " ".join(f"w{i}" for i in range(60))
    rows = [(4, a), (2, a + " tail"), (2, a + " tail"), (None, a), (7, "other words of five here"), (8, None), (9, "")]
    d = make_docs(rows).withColumn("node", F.lit("n")).withColumn("_maybe", F.lit(0))
    got = sorted(((r.doc_id, r.n_shingles, r.component_id) for r in jaccard.jaccard_components(d).collect()), key=str)
    assert got == sorted([(4, 56, 2), (2, 57, 2), (2, 57, 2), (None, 56, None), (7, 1, 7), (8, 0, 8), (9, 0, 9)], key=str)
    kept = jaccard.drop_near_copies(d)
    assert kept.columns == d.columns
    assert sorted((r.doc_id for r in kept.collect()), key=str) == sorted([2, None, 7, 8, 9], key=str)
    assert jaccard.jaccard_components(make_docs([])).count() == 0
    assert jaccard.drop_near_copies(make_docs([])).count() == 0


def test_components_of_a_long_path(spark):
    n = 300
    e = spark.createDataFrame([(i + 1, i) for i in range(n)] + [(1000, 1001)], "u long, v long").repartition(4)
    got = {r.id: r.component for r in jaccard.components(e).collect()}
    assert got == {i: 0 for i in range(n + 1)} | {1000: 1000, 1001: 1000}


def test_only_the_finished_filter_reaches_the_driver(spark, monkeypatch):
    import numpy as np
    monkeypatch.setattr(jaccard, "SEGMENT_BITS", 1 << 16, raising=False)
    monkeypatch.setattr(jaccard, "FILTER_CELLS", 5_000, raising=False)
    nodes = spark.range(20_000, numPartitions=5).select(F.unhex(F.md5(F.col("id").cast("string").cast("binary"))).alias("node"))
    fetched = []
    plain = type(nodes).toLocalIterator

    def counted(df, *args, **kw):
        for r in plain(df, *args, **kw):
            fetched.append(sum(len(v) for v in r if isinstance(v, (bytes, bytearray))))
            yield r

    monkeypatch.setattr(type(nodes), "toLocalIterator", counted)
    got = np.frombuffer(jaccard._node_filter(nodes, 20_000), np.uint8)
    want = np.zeros(len(got) * 8, bool)
    want[jaccard._bits_of([bytes(r.node) for r in nodes.collect()], len(want)).ravel()] = True
    assert (got == np.packbits(want, bitorder="little")).all()
    assert sum(fetched) <= len(got) and len(fetched) <= len(want) >> 16
    assert not any(jaccard._node_filter(nodes.limit(0), 0))
