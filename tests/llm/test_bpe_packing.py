import base64
import random
import zlib

import numpy as np
import pyarrow as pa
import public_tokenizers as P
import pytest
from pyspark.sql import functions as F

from moodindex.llm import bpe, packing
from moodindex.llm.chunks import MARK, ChunkEncoder, Memo

RANKS, JSON = P.path("byte_bpe_50k.tiktoken"), P.path("byte_bpe_50k.json")
HARD = ["", " ", "  a", "a  b ", "\n", " \n x", "it's 'tis I'll 's", "a\x00b c", "x \x1c a \x1d", "é" * 50, "ab" * 3000,
        "a" * 5001 + " b", " 123 4 ²x", "日本語 テキスト  \t x", "a \0b", "<|endoftext|> x", "don't  we'RE", "  a b"]


def texts():
    rnd = random.Random(5)
    return HARD + ["".join(rnd.choice(" \n\t'ab1é! \x1c\x00sl") for _ in range(rnd.randint(0, 40))) for _ in range(400)]


def tiktoken_encoding():
    import tiktoken
    ranks = {base64.b64decode(a): int(b) for a, b in map(bytes.split, open(RANKS, "rb"))}
    return tiktoken.Encoding("own", pat_str=P.PATTERN, mergeable_ranks=ranks, special_tokens={})


def test_bpe_equals_tiktoken():
    v, enc = bpe.vocabulary(RANKS, P.PATTERN), tiktoken_encoding()
    for t, ids in zip(texts(), v.encode_texts(texts()), strict=True):
        ids = np.frombuffer(ids, "<u4").tolist()
        assert ids == enc.encode_ordinary(t), repr(t)
        assert v.decode(ids) == t.encode()


def test_long_pre_token_is_not_quadratic():
    v, enc = bpe.vocabulary(RANKS, P.PATTERN), tiktoken_encoding()
    rnd = random.Random(1)
    t = "".join(rnd.choice("abcdefgh") for _ in range(60_000))
    assert v.encode_piece(t.encode()) == enc.encode_ordinary(t)


def test_memo_keeps_results_when_it_turns():
    m = Memo(2)
    m.now.update({"a": 1, "b": 2, "c": 3})
    assert sorted(m.missing({"a", "d"})) == ["d"] and m.now == {"a": 1}


def test_bpe_jobs(make_docs):
    d = make_docs([(1, "a b"), (1, "a b"), (2, None), (3, ""), (None, "word " * 20_000)]).withColumn("IDS", F.lit(7))
    got = bpe.bpe_decode(bpe.bpe_encode(d, RANKS, P.PATTERN), RANKS, P.PATTERN).collect()
    enc = tiktoken_encoding()
    assert len(got) == 5
    for r in got:
        assert list(r.ids) == enc.encode_ordinary(r.text or "")
        assert bytes(r.decoded) == (r.text or "").encode()
    assert bpe.bpe_encode(d.limit(0), RANKS, P.PATTERN).count() == 0


def check_pieces(rows, lens, window):
    fill, docs = {}, {}
    for doc, start, n, ids, total, seq, offset in sorted(rows, key=lambda r: (r[5], r[6])):
        assert 0 < n == len(ids) // 4 and offset == fill.get(seq, 0)
        fill[seq] = offset + n
        docs.setdefault(doc, []).append((start, ids))
        assert total == lens[doc]
    assert all(v <= window for v in fill.values())
    for doc, n in lens.items():
        assert b"".join(x for _, x in sorted(docs[doc])) == np.arange(n, dtype="<u4").tobytes()
    return [v for v in fill.values() if v != window]


@pytest.mark.parametrize("most", [2, 50, 2048])
@pytest.mark.parametrize("lengths", ["mixed", "awkward", "short"])
def test_packer(lengths, most):
    rng = np.random.default_rng(3)
    n = {"mixed": rng.integers(1, 300, 700), "awkward": np.full(300, 40), "short": rng.integers(1, 20, 900)}[lengths]
    p, lens = packing.Packer(64, 0, most), {}
    for d, k in enumerate(n.tolist()):
        lens[d] = k
        p.add(d, np.arange(k, dtype="<u4").tobytes())
        assert p.n_open <= most
    p.finish()
    rest = check_pieces(p.out, lens, 64)
    assert len(rest) <= 6 and all(v & (v - 1) == 0 for v in rest)  # no padding at all


def test_level_minimises_sum_of_squares():
    p = packing.Packer(16)
    rng = np.random.default_rng(0)
    for _ in range(300):
        r = int(rng.integers(1, 16))
        n = p.open_at.copy()

        def cost(h):
            m = n.copy()
            if h:
                m[h] -= 1
            if h + r < 16:
                m[h + r] += 1
            return int((m ** 2).sum())
        options = [h for h in range(17 - r) if h == 0 or n[h] > 0]
        assert cost(p._level(r)) == min(map(cost, options))
        p.add(0, np.zeros(r, "<u4").tobytes())


def test_packing_job(make_docs):
    from tokenizers import Tokenizer
    tok = Tokenizer.from_file(JSON)
    tok.encode_special_tokens = True
    rows = [(i, t) for i, t in enumerate(texts())] + [(9000, None), (9001, "word and " * 5000), (9001, "x")]
    got = packing.pack(make_docs(rows).repartition(3), JSON).withColumn("crc", F.crc32("ids")).collect()
    whole = {}
    for r in got:
        assert r.crc == zlib.crc32(bytes(r.ids)) and r.length == len(r.ids) // 4
        whole.setdefault((r.doc_id, r.doc_tokens), []).append((r.start, bytes(r.ids)))
    for i, t in rows:
        ids = tok.encode(t or "", add_special_tokens=False).ids + [0]
        assert b"".join(x for _, x in sorted(whole[i, len(ids)])) == np.array(ids, "<u4").tobytes()
    assert packing.pack(make_docs([]), JSON).count() == 0


def test_a_word_is_encoded_once_whatever_mark_follows():
    asked = []

    def encode(chunks):
        asked.extend(chunks)
        return [c.encode("utf-32-le") for c in chunks]

    e = ChunkEncoder(encode)
    given = ["x word, word. word; word", "x", "", "word!?", f"x a{MARK},b word, z.", "x  word.", "x word.\t y"]
    assert e(given) == [t.encode("utf-32-le") for t in given]
    assert asked.count(" word") == 1 and " word," not in asked and " word." not in asked
    assert given[4] in asked and given[5] in asked and given[6] in asked  # whole


def test_marks_against_tokenizers():
    from tokenizers import Tokenizer
    tok = Tokenizer.from_file(JSON)
    tok.encode_special_tokens = True
    rnd = random.Random(2)
    parts = ["a", "é", "×", " ", " ", "\n", ",", ".", "'s", "&&", MARK, "7", "漢", "ɏ", "\u3000"]
    given = ["".join(rnd.choice(parts) for _ in range(rnd.randint(0, 12))) for _ in range(2000)]
    got = packing.encoder(JSON)(given)
    for t, ids in zip(given, got, strict=True):
        assert np.frombuffer(ids, "<u4").tolist() == tok.encode(t, add_special_tokens=False).ids, repr(t)


def test_lists_of_ids_are_decoded_together():
    v = bpe.vocabulary(RANKS, P.PATTERN)
    lists = [[5, 300, 7], None, [], [40_000], [1, 2]]
    want = [v.decode(x or []) for x in lists]
    a = pa.array(lists, pa.list_(pa.int32()))
    assert v.decode_lists(a).to_pylist() == want
    assert v.decode_lists(a.slice(1, 3)).to_pylist() == want[1:4] and v.decode_lists(a.slice(0, 0)).to_pylist() == []
