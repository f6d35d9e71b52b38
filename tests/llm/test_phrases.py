import random
import re
from collections import Counter

import numpy as np
import pytest

from moodindex.llm import automaton as A
from moodindex.llm import phrases as P
from moodindex.llm import queries, sql

DOCS = "text string, lang string"


def plain(rows, least=10, contained=50, top=2000):
    """The contract with dictionaries."""
    f, out = {}, []
    for text, lang in rows:
        low = "".join(c.lower() if "A" <= c <= "Z" else c for c in text or "")
        c = f.setdefault("und" if lang is None else lang, Counter())
        for piece in re.split("[.,;:!?\x0A-\x0D]", low):
            w = re.findall("[^\x20\x09]+", piece)
            c.update(tuple(w[i:i + k]) for k in (1, 2, 3) for i in range(len(w) - k + 1))
    for lang, c in f.items():
        n = sum(v for k, v in c.items() if len(k) == 1)
        found = []
        for p, a in c.items():
            if len(p) == 1 or a < least:
                continue
            if len(p) == 2 and any(100 * v >= contained * a for k, v in c.items()
                                   if len(k) == 3 and v >= least and p in (k[:2], k[1:])):
                continue
            score, k = min((10**6 * a * a // (c[p[:k]] * c[p[k:]]), k) for k in range(1, len(p)))
            found.append((-score, -a, " ".join(p).encode(), " ".join(p), c[p[:k]], c[p[k:]]))
        out += [(lang, i + 1, p, -a, left, right, n, -s) for i, (s, a, _, p, left, right) in enumerate(sorted(found)[:top])]
    return sorted(out)


def got(df):
    return sorted(tuple(r) for r in df.select("lang", "rank", "phrase", "a", "l", "r", "n", "score").collect())


def texts(seed, n=120):
    rng = random.Random(seed)
    words = ["a", "B", "b", "é", "É", "\x01x", "x\x00", "zz", " n", "𝄞", "\x1f"] + [f"w{i}" for i in range(6)]
    rows = []
    for _ in range(n):
        t = "".join(rng.choice(words) + rng.choice([" ", " ", " ", "\t", "  ", ". ", ",", "\n", "\r\n", "\v", "\f", "!?"])
                    for _ in range(rng.randint(0, 60)))
        rows.append((t, rng.choice(["en", "en", "de", None, "und", ""])))
    return rows + [(None, "en"), ("", None), (" \t", "fr"), ("one. two", "fr")] + rows[:5]


@pytest.mark.parametrize("size,ranges,chunk,asked", [(10**9, 6000, 10**6, 10**6), (60, 6000, 50, 5), (40, 3, 90, 2)])
def test_against_dictionaries(spark, monkeypatch, size, ranges, chunk, asked):
    monkeypatch.setattr(P, "MAX_RANGES", ranges)
    monkeypatch.setattr(P, "CHUNK_WORDS", chunk)
    monkeypatch.setattr(P, "QUESTIONS", asked)
    rows = texts(3)
    docs = spark.createDataFrame([(*r, "x", 1) for r in rows], DOCS + ", phrase string, a long")
    for least, top in ((2, 2000), (4, 5)):
        want = plain(rows, least, top=top)
        assert len(want) > 10
        assert got(P.collocations(docs, least=least, top=top, size=size)) == want


def test_one_piece_over_many_slices_and_chunks(spark, monkeypatch):
    monkeypatch.setattr(P, "CHUNK_WORDS", 1000)
    rng = random.Random(1)
    rows = [(" ".join(rng.choice("abcdefgh") * 40 for _ in range(60_000)), "en"), ("x" * 3_000_000, "en")]
    assert got(P.collocations(spark.createDataFrame(rows, DOCS), top=50)) == plain(rows, top=50)


def test_empty(spark):
    assert got(P.collocations(spark.createDataFrame([], DOCS))) == []
    assert got(P.collocations(spark.createDataFrame([(None, None), ("a b", "en")], DOCS))) == []


def test_products_pass_64_bits(spark):
    cases = [(10**15 - 1, 10**15, 10**15 + 7), (3 * 10**10, 4 * 10**10, 5 * 10**10), (10, 10, 10), (7, 3 * 10**9, 5 * 10**9)]
    for a, left, right in cases:
        got = spark.sql(f"SELECT {P.score_sql(f'{a}L', f'{left}L', f'{right}L')} AS s").first().s
        assert got == 10**6 * a * a // (left * right)


def sequences(seed, n=3000, words=40):
    rng = np.random.default_rng(seed)
    rows = np.unique(rng.integers(1, words, (n, 3)) * (np.arange(3) < rng.integers(1, 4, (n, 1))), axis=0)
    return [b"w%02d" % i for i in range(words)], [rows[:, k] for k in range(3)], rng.integers(1, 300_000, len(rows))


def table(a):
    cols, weight = a.entries()
    return {tuple(a.words[i - 1] for i in r if i): w for *r, w in zip(*cols, weight.tolist(), strict=True)}


@pytest.mark.parametrize("bits", [21, 4])
def test_automaton_round_trip_sum_and_lookup(monkeypatch, bits):
    monkeypatch.setattr(A, "BITS", bits)  # 4: labels don't fit into one key
    union, total = A.Union(most=500), Counter()
    for seed in range(5):
        words, cols, weight = sequences(seed)
        a = A.Automaton.build(words, cols, weight)
        want = {tuple(words[i - 1] for i in r if i): w for *r, w in zip(*cols, weight.tolist(), strict=True)}
        assert table(a) == want
        a = A.Automaton.from_bytes(a.to_bytes())
        assert table(a) == want
        asked = list(want) + [(b"nix",), (b"w01", b"nix"), (b"w01",) * 3]
        assert a.weights([list(k) for k in asked]).tolist() == [want.get(k, 0) for k in asked]
        union.add(a)
        total.update(want)
    a, ones = union.result(200_000)
    assert table(a) == {k: v for k, v in total.items() if v >= 200_000}
    assert ones == sum(v for k, v in total.items() if len(k) == 1)


def test_states_with_the_same_arc_are_shared():
    words = [b"%05d" % i for i in range(1000)] + [b"zz"]
    n = np.arange(1, 1001)
    a = A.Automaton.build(words, [n, np.full(1000, 1001), np.full(1000, 1)], np.ones(1000, np.int64))
    assert [len(x[1]) for x in a.layers] == [1000, 1, 1]


def test_query_against_sql(spark):
    import duckdb
    sf = "/root/testdata/sf0.01"
    con = duckdb.connect()
    con.execute(f"CREATE VIEW documents AS SELECT * FROM '{sf}/documents.parquet'")
    want = sorted(con.execute(sql.ORACLE["op11_phrases"]).fetchall())
    assert got(queries.QUERIES["op11_phrases"](spark, sf)) == want and len(want) > 100
