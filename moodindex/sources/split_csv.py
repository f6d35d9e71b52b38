"""Quoted CSV of any file size, read by many tasks.

A line break inside quotes is text, so whether a line begins a record depends on the
number of quote characters before it.  Only its parity counts, and parities
add up: the file is split as plain lines, and a prefix sum over its splits tells
which of them begin inside quotes.

1. Each task counts the quote characters of its splits; a window over one small row
   a split gives the parity at which each begins.
2. Each task reads its splits again and puts lines together until the quotes are even.
   What ends a record of an earlier split, and what a split leaves open, are its two
   fragments at most; these meet by file and make up the records that cross splits.
3. Records are parsed by Spark's own CSV parser.

Doubled quotes inside a quoted field toggle twice and cancel out, so the parity is exact
for files that double their quotes.  ``\\n`` and ``\\r\\n`` end records.

The row of a split that all tasks get is broadcast: some 150 bytes for every
``spark.sql.files.maxPartitionBytes`` of input (100 TB in splits of 256 MiB: 60 MB).

Defined results: a file that is empty or has only a header has no rows; blank lines are
skipped; the first record of each file is its header, columns go by place; a quote that
is never closed takes the rest of its file into one record.  Records whose number of fields or whose
values don't fit the schema are told apart by :func:`scan_csv` and nulls in :func:`read_csv_split`.
"""

from __future__ import annotations

from collections.abc import Sequence

import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.types import StringType, StructField, StructType
from pyspark.sql.window import Window

CORRUPT = "_corrupt_record"
_PARSE = {"escape": '"', "mode": "PERMISSIVE", "multiLine": "true", "columnNameOfCorruptRecord": CORRUPT}
# Kinds of pieces: a record, the end of an earlier one, one left open, the middle of one.
_RECORD, _HEAD, _TAIL, _MIDDLE = range(4)


def _lines(spark: SparkSession, paths: str | Sequence[str]) -> DataFrame:
    """``file, at, value``: lines with the place where their split begins."""
    return (spark.read.option("lineSep", "\n").text(list(paths) if not isinstance(paths, str) else paths)
            .select(F.col("_metadata.file_path").alias("file"), F.col("_metadata.file_block_start").alias("at"), "value"))


def _quotes(value: str):
    return F.length(value) - F.length(F.replace(F.col(value), F.lit('"'), F.lit("")))


def _pieces(batches):
    """Lines in order, with ``odd`` (their split begins inside quotes), as pieces of records."""
    now, inside, kept, head = None, False, [], False

    def record(rows):
        cols = list(zip(*rows, strict=True)) or [()] * 5
        return pa.record_batch([pa.array(c, t) for c, t in zip(
            cols, (pa.string(), pa.int64(), pa.int64(), pa.int32(), pa.string()), strict=True)],
            names=["file", "at", "number", "kind", "text"])

    number = 0
    for b in batches:
        out = []
        for file, at, value, odd in zip(*(c.to_pylist() for c in b.columns), strict=True):
            if (file, at) != now:
                if kept:
                    out.append((*now, number, _MIDDLE if head else _TAIL, "\n".join(kept)))
                now, inside, kept, head, number = (file, at), odd, [], odd, 0
            kept.append(value)
            if value.count('"') % 2:
                inside = not inside
            if not inside:
                out.append((file, at, number, _HEAD if head else _RECORD, "\n".join(kept)))
                kept, head, number = [], False, number + 1
        yield record(out)
    if kept:
        yield record([(*now, number, _MIDDLE if head else _TAIL, "\n".join(kept))])


def records(spark: SparkSession, paths: str | Sequence[str]) -> DataFrame:
    """``file, at, number, text``: the records of the files, headers and blank lines left out."""
    lines = _lines(spark, paths)
    splits = lines.groupBy("file", "at").agg(F.sum(_quotes("value")).alias("quotes"))
    before = Window.partitionBy("file").orderBy("at").rowsBetween(Window.unboundedPreceding, -1)
    splits = splits.select("file", "at", (F.coalesce(F.sum("quotes").over(before), F.lit(0)) % 2 == 1).alias("odd"))
    met = lines.join(F.broadcast(splits), ["file", "at"])  # the lines stay in their order
    pieces = met.select("file", "at", "value", "odd").mapInArrow(
        _pieces, "file string, at long, number long, kind int, text string")
    # fragments: of one record, the tail of a split, middles, the head of a later one
    parts = pieces.where(F.col("kind") != _RECORD)
    order = Window.partitionBy("file").orderBy("at", F.desc(F.col("kind") == _HEAD)).rowsBetween(
        Window.unboundedPreceding, 0)
    begin = F.last(F.when(F.col("kind") == _TAIL, F.col("at")), ignorenulls=True).over(order)
    parts = parts.withColumn("begin", begin)
    whole = (parts.groupBy("file", "begin")
             .agg(F.array_sort(F.collect_list(F.struct("at", "number", "text"))).alias("p"))
             .select("file", F.col("p")[0]["at"].alias("at"), F.col("p")[0]["number"].alias("number"),
                     F.array_join(F.transform("p", lambda x: x["text"]), "\n").alias("text")))
    out = pieces.where(F.col("kind") == _RECORD).select("file", "at", "number", "text").unionByName(whole)
    text = F.regexp_replace("text", "\r$", "")
    return (out.where(~((F.col("at") == 0) & (F.col("number") == 0)))
            .withColumn("text", text).where(F.col("text") != ""))


def _parsed(spark, paths, schema: StructType) -> DataFrame:
    full = StructType([*schema.fields, StructField(CORRUPT, StringType())])
    ddl = ", ".join(f"`{f.name}` {f.dataType.simpleString()}" for f in full.fields)
    return records(spark, paths).withColumn("r", F.from_csv("text", ddl, _PARSE))


def read_csv_split(spark: SparkSession, paths: str | Sequence[str], schema: StructType) -> DataFrame:
    """The rows of the files; what doesn't parse is null."""
    return _parsed(spark, paths, schema).select(*[F.col("r")[f.name].alias(f.name) for f in schema.fields])


def scan_csv(spark: SparkSession, paths: str | Sequence[str], schema: StructType,
             required: Sequence[str] = ()) -> tuple[DataFrame, DataFrame]:
    """``good`` rows by the schema, and ``bad``: ``file, at, number, text, reason`` of the
    records that don't fit it (``malformed``) or lack a required value (``missing <column>``).
    Together they are all records."""
    d = _parsed(spark, paths, schema)
    lacks = F.coalesce(*[F.when(F.col("r")[c].isNull(), F.lit(f"missing {c}")) for c in required], F.lit(None).cast("string"))
    d = d.withColumn("reason", F.when(F.col("r")[CORRUPT].isNotNull(), F.lit("malformed")).otherwise(lacks))
    good = d.where("reason IS NULL").select(*[F.col("r")[f.name].alias(f.name) for f in schema.fields])
    return good, d.where("reason IS NOT NULL").select("file", "at", "number", "text", "reason")
