"""The pipeline by hand: plain Python over all rows of a small table."""

import re
from collections import Counter

import public_tokenizers as P
from test_dedup_rules import measures, norm
from test_jaccard import brute

from moodindex.llm import quality


def _rejected(t):
    n, chars, symbols, dup, repeat = measures(t)
    letters = [c for c in t if c.isalpha()]
    return (n < 10 or 100 * repeat > 20 * n or chars < 2 * n or chars > 20 * n or 4 * symbols > n
            or dup > 1 and dup * 10 > 3 * (t.count("\n") + 1) or 4 * len(re.findall("[0-9]", t)) > chars
            or t.count("!") > n or 2 * len(letters) < chars or 2 * sum(c.isupper() for c in letters) > len(letters))


def pipeline_by_hand(spark, sf):
    docs = spark.read.parquet(f"{sf}/documents.parquet")
    good = quality.classify(docs, spark.read.parquet(f"{sf}/labels.parquet")).filter("kept").select("doc_id")
    rows = sorted((r.doc_id, r.text) for r in docs.join(good, "doc_id").collect())
    rows = [(i, t) for i, t in rows if not _rejected(t)]
    seen, first = Counter(), []
    for i, t in rows:
        if not seen[norm(t)]:
            first.append((i, t))
        seen[norm(t)] += 1
    comp = brute(first)
    kept = [(i, t) for i, t in first if comp[i][1] == i]
    from tokenizers import Tokenizer
    tok = Tokenizer.from_file(P.path("byte_bpe_50k.json"))
    tok.encode_special_tokens = True
    return [i for i, _ in kept], {i: len(tok.encode(t, add_special_tokens=False).ids) + 1 for i, t in kept}
