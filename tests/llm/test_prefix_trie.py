import hashlib
import random
import zlib
from collections import defaultdict

import pytest

from moodindex.llm import prefix_trie as T
from moodindex.llm import queries

COLS = "conv_id depth parent_conv_id n_convs n_children n_leaves saved_tokens ends_sha256".split()
SCHEMA = "conv_id long, turn long, role string, text string"


def plain(rows, rebuild):
    """The trie by dictionaries: rows are (conv, turn, role, text)."""
    convs = defaultdict(list)
    for c, t, r, x in rows:
        if c is not None:
            convs[c].append((t is not None, t or 0, r or "", x or ""))
    convs = {c: [(r, x) for _, _, r, x in sorted(v, key=lambda k: (k[:2], item(k[2], k[3])))] for c, v in convs.items()}
    seqs = {c: tuple(rebuild(c, v, convs)) for c, v in convs.items()}
    members = defaultdict(list)
    for c, s in seqs.items():
        for d in range(len(s) + 1):
            members[s[:d]].append(c)
    nodes = {}
    for p in sorted(members, key=len, reverse=True):
        kids = [k for k in nodes if len(k) == len(p) + 1 and k[:len(p)] == p]
        own = (len(members[p]) - 1) * (len(p[-1][1].encode()) if p else 0)
        ends = ",".join(str(c) for c in sorted(members[p]) if len(seqs[c]) == len(p))
        nodes[p] = (min(members[p]), len(p), min(members[p[:-1]]) if p else None, len(members[p]), len(kids),
                    sum(nodes[k][5] for k in kids) or 1, own + sum(nodes[k][6] for k in kids),
                    hashlib.sha256(ends.encode()).hexdigest())
    return sorted(nodes.values(), key=str)


def item(role, text):
    """The order of turns that share a number."""
    by, said = role.encode(), text.encode()
    return len(said).to_bytes(4, "big") + hashlib.sha256(str(len(by)).encode() + b":" + by + said).digest()[:16]


def rebuild(c, own, convs):
    h = zlib.crc32(str(c).encode()) % 9
    sign = -1 if c < 0 else 1
    return convs.get(c - sign * (abs(c) % 5), [])[:h] + own[h:]


def as_is(c, own, convs):
    return own


def got(df):
    return sorted((tuple(r[k] for k in COLS) for r in df.collect()), key=str)


def forest(seed, convs=150):
    rng = random.Random(seed)
    rows = []
    for c in rng.sample(range(-200, 400), convs):
        kind = rng.random()
        depth = 12 if kind < 0.2 else rng.randint(1, 6)
        for t in range(depth):
            text = "same" if kind < 0.2 else rng.choice(["a", "b", "é" * rng.randint(1, 3), "", None])
            rows.append((c, rng.choice([t, t, t, None]), rng.choice(["user", "user", None]), text))
    rows += [(None, 1, "user", "lost"), rows[0], rows[0]]
    rng.shuffle(rows)
    return rows


@pytest.mark.parametrize("limit", [T.CONTAINER_BYTES, 400, 1])
@pytest.mark.parametrize("seed", [1, 2])
def test_against_dictionaries(spark, seed, limit):
    rows = forest(seed)
    turns = T.turn_ids(spark.createDataFrame(rows, SCHEMA))
    assert got(T.prefix_trie(T.sequences(turns), limit)) == plain(rows, as_is)
    assert got(T.prefix_trie(T.sequences(turns, queries.rebuilt, 5), limit)) == plain(rows, rebuild)


@pytest.mark.parametrize("limit", [T.CONTAINER_BYTES, 1])
def test_long_shared_path_bursts_once(spark, monkeypatch, limit):
    rows = [(c, t, "user", f"t{t}") for c in (3, 4, 9) for t in range(700)]
    rows += [(c, 700, "assistant", f"end {c}") for c in (4, 9)]
    rounds = []
    monkeypatch.setattr(T, "_burst", lambda r, m, f=T._burst: rounds.append(1) or f(r, m))
    nodes = got(T.prefix_trie(T.sequences(T.turn_ids(spark.createDataFrame(rows, SCHEMA))), limit))
    assert nodes == plain(rows, as_is) and len(rounds) <= 2


def test_many_copies_are_hashed_in_order(spark, monkeypatch):
    monkeypatch.setattr(T, "CHUNK_IDS", 7)
    rows = [(c, 0, "user", "hi") for c in range(-50, 1000)] + [(2000, 0, "user", "other")]
    nodes = got(T.prefix_trie(T.sequences(T.turn_ids(spark.createDataFrame(rows, SCHEMA)))))
    assert nodes == plain(rows, as_is)


def test_salted_join_of_many_heads(spark, monkeypatch):
    rows = forest(7, 60)
    turns = T.turn_ids(spark.createDataFrame(rows, SCHEMA))
    monkeypatch.setattr(T, "BROADCAST_HEADS", 0)
    assert got(T.prefix_trie(T.sequences(turns), 1)) == plain(rows, as_is)


def test_turnless_and_empty(spark):
    none = spark.createDataFrame([], SCHEMA)
    assert got(queries.prefix_trie.prefix_trie(T.sequences(T.turn_ids(none)))) == []
    # conversation 7 keeps nothing of its one turn and has no donor
    c = next(c for c in range(1, 99) if c % 5 and zlib.crc32(str(c).encode()) % 9)
    rows = [(c, None, None, None)]
    d = spark.createDataFrame([(*r, "x") for r in rows], SCHEMA + ", item string")
    nodes = got(T.prefix_trie(T.sequences(T.turn_ids(d), queries.rebuilt, 5)))
    assert nodes == plain(rows, rebuild) and len(nodes) == 1


def test_query_against_dictionaries(spark):
    sf = "/root/testdata/sf0.001"
    rows = [tuple(r) for r in spark.read.parquet(f"{sf}/conversations.parquet")
            .select("conv_id", "turn", "role", "text").collect()]
    assert got(queries.QUERIES["op12_prefix_trie"](spark, sf)) == plain(rows, rebuild)
