"""Helpers shared by the operators of this package."""

from __future__ import annotations

import ctypes
import uuid
from collections.abc import Callable

import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from moodindex.session import ensure_checkpoint_dir

# The white space that separates words in every operator here.
WS = "[\\x20\\x09-\\x0D]"
WS_CHARS = " \t\n\u000b\f\r"

# Rows of one Arrow batch: texts are long, so a batch stays a few MB.
ARROW_ROWS = 512


def prepare(spark: SparkSession) -> None:
    """Session settings that the operators rely on: a shared checkpoint
    folder and small Arrow batches (memory of a Python worker)."""
    spark.conf.set("spark.sql.session.timeZone", "UTC")
    spark.conf.set("spark.sql.execution.arrow.maxRecordsPerBatch", str(ARROW_ROWS))
    ensure_checkpoint_dir(spark)


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir.rstrip('/')}/{name}.parquet")


def text_of(col: str = "text") -> Column:
    """The text, null as empty."""
    return F.coalesce(F.col(col).cast("string"), F.lit(""))


def shared_folder(spark: SparkSession, name: str) -> str:
    """A new folder under the checkpoint folder that all executors share."""
    return f"{ensure_checkpoint_dir(spark).rstrip('/')}/llm-{name}-{uuid.uuid4().hex}"


def partition_id() -> int:
    ctx = TaskContext.get()
    return ctx.partitionId() if ctx else 0


def fresh(df: DataFrame, name: str) -> str:
    """A column name that ``df`` doesn't have (any case)."""
    have = {c.lower() for c in df.columns}
    while name.lower() in have:
        name = "_" + name
    return name


def give_back() -> None:
    """Hand the memory that a task no longer uses back to the machine: a Python
    worker lives on, and later stages need the room."""
    pa.default_memory_pool().release_unused()
    try:
        ctypes.CDLL(None).malloc_trim(0)
    except (OSError, AttributeError):
        pass  # not every C library has it


def freeing(run: Callable) -> Callable:
    """``run`` over the batches of a task, with its memory handed back at the end."""

    def out(batches):
        try:
            yield from run(batches)
        finally:
            give_back()

    return out
