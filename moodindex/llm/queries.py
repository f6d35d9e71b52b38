"""Registered queries of this package: ``(spark, sf_dir) -> DataFrame``.

Each applies one operator, with its production parameters, to its whole
intended table and derives the columns of the query from the operator's
output."""

from __future__ import annotations

import zlib

import public_tokenizers
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from moodindex.llm import bpe, chat, exact_dedup, html, jaccard, langid, packing, phrases, prefix_trie, quality, quality_rules, toxicity, url_filter
from moodindex.llm.common import prepare, table

RANKS = public_tokenizers.path("byte_bpe_50k.tiktoken")
TOKENIZER = public_tokenizers.path("byte_bpe_50k.json")
PATTERN = public_tokenizers.PATTERN


def _documents(spark: SparkSession, sf_dir: str, *cols: str) -> DataFrame:
    return table(spark, sf_dir, "documents").select(*cols)


def _held_out():
    return F.coalesce(langid.remainder("doc_id") == 2, F.lit(False)).alias("held_out")


def op1_chat(spark: SparkSession, sf_dir: str) -> DataFrame:
    turns = table(spark, sf_dir, "conversations").select("conv_id", "turn", "role", "text")
    said = "</s>[INST] ok [/INST]"
    own = spark.createDataFrame([(-7, 0, "user", said), (-7, 1, "assistant", said)],
                                "conv_id long, turn long, role string, text string")
    return chat.digest(chat.format_conversations(turns.unionByName(own)))


def op2_jaccard(spark: SparkSession, sf_dir: str) -> DataFrame:
    return jaccard.jaccard_components(_documents(spark, sf_dir, "doc_id", "text")).drop("node")


def op3_bpe(spark: SparkSession, sf_dir: str) -> DataFrame:
    d = bpe.bpe_encode(_documents(spark, sf_dir, "doc_id", "text"), RANKS, PATTERN)
    d = bpe.bpe_decode(d.drop("text"), RANKS, PATTERN)
    return d.select(
        "doc_id", F.size("ids").cast("long").alias("n_tokens"),
        F.sha2(F.concat_ws(" ", F.col("ids").cast("array<string>")), 256).alias("ids_sha256"),
        F.sha2("decoded", 256).alias("decoded_sha256"))


def op4_exact_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    d = exact_dedup.exact_dedup(_documents(spark, sf_dir, "doc_id", "text"))
    return d.withColumn("text_sha256", F.lower(F.hex("text_sha256")))


def op5_toxicity(spark: SparkSession, sf_dir: str) -> DataFrame:
    d = _documents(spark, sf_dir, "doc_id", "text")
    grammar = toxicity.train(d, table(spark, sf_dir, "labels"))
    return toxicity.score_toxicity(d, grammar).select(
        "doc_id", _held_out(), "score", "predicted", "clauses")


def op6_quality(spark: SparkSession, sf_dir: str) -> DataFrame:
    d = _documents(spark, sf_dir, "doc_id", "text", "source", "lang")
    return quality.classify(d, table(spark, sf_dir, "labels"))


def op7_html(spark: SparkSession, sf_dir: str) -> DataFrame:
    d = html.main_text(table(spark, sf_dir, "pages").select("page_id", "url", "html"))
    return d.withColumn("n_chars", F.length("text").cast("long"))


def op8_langid(spark: SparkSession, sf_dir: str) -> DataFrame:
    d = _documents(spark, sf_dir, "doc_id", "text", "lang")
    model = langid.train(d)
    return langid.identify(d.select("doc_id", "text"), model).select(
        "doc_id", _held_out(), "lang_pred", "score", "accepted")


def op9_quality_rules(spark: SparkSession, sf_dir: str) -> DataFrame:
    d = quality_rules.quality_rules(_documents(spark, sf_dir, "doc_id", "text"))
    return d.select("doc_id", "n_words", "word_chars", "n_symbols", "n_dup_lines",
                    "n_repeat_words", "base_failed", "kept")


def op10_packing(spark: SparkSession, sf_dir: str) -> DataFrame:
    p = packing.pack(_documents(spark, sf_dir, "doc_id", "text"), TOKENIZER)
    return p.select("doc_id", "start", "length", F.crc32("ids").alias("ids_crc32"),
                    "doc_tokens", "sequence_id", "offset")


def op11_phrases(spark: SparkSession, sf_dir: str) -> DataFrame:
    return phrases.collocations(_documents(spark, sf_dir, "text", "lang"))


def rebuilt(conv: int, turns: bytes, donor: bytes) -> bytes:
    """A conversation that begins as the first of its five does."""
    h = zlib.crc32(str(conv).encode()) % 9 * prefix_trie.ITEM
    return donor[:h] + turns[h:]


def op12_prefix_trie(spark: SparkSession, sf_dir: str) -> DataFrame:
    turns = prefix_trie.turn_ids(table(spark, sf_dir, "conversations"))
    return prefix_trie.prefix_trie(prefix_trie.sequences(turns, rebuilt, 5))


# Host, path and verdict of the rules on urls.
URL_RULES = """VALUES ('org', '/', 'allow'), ('example.org', '/es/', 'block'), ('example.org', '/en/1', 'block'),
    ('com', '/fr/', 'allow'), ('com', '/de/', 'block') AS t(host, path, verdict)"""


def op13_url_filter(spark: SparkSession, sf_dir: str) -> DataFrame:
    pages = table(spark, sf_dir, "pages").select("page_id", "url")
    return url_filter.url_filter(pages, spark.sql(f"SELECT * FROM {URL_RULES}")).drop("url")


_QUERIES = {f.__name__: f for f in (
    op1_chat, op2_jaccard, op3_bpe, op4_exact_dedup, op5_toxicity, op6_quality, op7_html, op8_langid,
    op9_quality_rules, op10_packing, op11_phrases, op12_prefix_trie, op13_url_filter)}


def _prepared(f):
    def run(spark: SparkSession, sf_dir: str) -> DataFrame:
        prepare(spark)
        return f(spark, sf_dir)
    run.__name__ = f.__name__
    return run


QUERIES = {k: _prepared(f) for k, f in _QUERIES.items()}
