"""Corpus pipeline: quality classifier, quality rules, exact dedup, near
duplicates, packing.

Each stage takes ``(spark, docs, sf_dir)`` and returns a DataFrame, which is
written as Parquet and read again as the next stage's ``docs``.  All but the
last return the columns of ``documents``; the last returns the packed pieces.
"""

from __future__ import annotations

import public_tokenizers
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from moodindex.llm import exact_dedup, jaccard, packing, quality, quality_rules
from moodindex.llm.common import prepare, shared_folder, table
from moodindex.session import remove_path

TOKENIZER = public_tokenizers.path("byte_bpe_50k.json")


def quality_classifier(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that the hierarchical classifier rejects go."""
    prepare(spark)
    return quality.keep_good(docs, table(spark, sf_dir, "labels"))


def rules(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that a base measure or a rule of the cascade rejects go."""
    prepare(spark)
    return quality_rules.keep_good(docs)


def exact(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Of equal texts the one with the smallest doc_id stays."""
    prepare(spark)
    return exact_dedup.drop_copies(docs)


def near(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Of each component of similar texts the document with the smallest doc_id stays."""
    prepare(spark)
    return jaccard.drop_near_copies(docs)


def pack(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """The documents' tokens in sequences of at most 1024."""
    prepare(spark)
    p = packing.pack(docs, TOKENIZER)
    return p.select("doc_id", "start", "length", F.crc32("ids").alias("ids_crc32"),
                    "doc_tokens", "sequence_id", "offset")


STAGES = [
    ("quality_classifier", quality_classifier),
    ("quality_rules", rules),
    ("exact_dedup", exact),
    ("near_duplicates", near),
    ("packing", pack),
]

# The fitted classifier and the tokenizer have no SQL form; run() is tested
# against a brute-force version instead.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All stages over ``documents``.  Each stage's rows are written to the
    shared folder and read again, so a lost executor repeats one stage at
    most; a stage's input is deleted once the next has been written."""
    prepare(spark)
    docs, before = table(spark, sf_dir, "documents"), None
    for k, (name, stage) in enumerate(STAGES):
        path = shared_folder(spark, f"pipeline-{k}-{name}")
        stage(spark, docs, sf_dir).write.parquet(path)
        if before:
            remove_path(spark, before)
        docs, before = spark.read.parquet(path), path
    return docs
