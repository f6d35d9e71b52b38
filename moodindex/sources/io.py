"""Scans and sinks: comment CSVs, lexicons, per-entity files, tables."""

from __future__ import annotations

from collections.abc import Iterable, Sequence

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.types import StructType

from moodindex.functions.text import SPACE_CHARS

# Entity from a file name such as ``apple_scored.csv`` or
# ``nvidia_daily.csv``: everything before the first underscore.
ENTITY_FROM_FILE_RE = r"^([^_/.]+)_"

# The four companies of the original job.
KNOWN_ENTITIES = ("samsung", "apple", "nvidia", "skhynix")


# Quoting of the comment files: doubled quotes inside quoted fields.
CSV_OPTIONS = {"header": "true", "escape": '"', "encoding": "UTF-8", "mode": "PERMISSIVE"}


def read_csv(spark: SparkSession, paths: str | Sequence[str],
             schema: StructType | None = None, multi_line: bool = True) -> DataFrame:
    """CSV scan with header, UTF-8, quoted multi-line fields.

    A quoted line break makes a file unsplittable, so with ``multi_line``
    each file is one task: write many files of 128-256 MB.  Files without
    line breaks inside fields split at any size with ``multi_line=False``.
    A UTF-8 byte-order mark at the start of a file is dropped by the reader.
    Pass a schema in production; without one, columns are strings (no
    ``inferSchema`` pass over the data).
    """
    reader = spark.read.options(**CSV_OPTIONS).option("multiLine", multi_line)
    if schema is not None:
        reader = reader.schema(schema)
    return reader.csv(list(paths) if not isinstance(paths, str) else paths)


def read_lexicon(spark: SparkSession, path: str, distinct: bool = False) -> DataFrame:
    """One keyword per line: stripped of white space of any kind, blank
    lines dropped, optional de-dup.

    Returns ``keyword string``; a leading byte-order mark is stripped.
    """
    ends = f"^[{SPACE_CHARS}]+|[{SPACE_CHARS}]+$"
    df = spark.read.text(path).select(
        F.regexp_replace(F.regexp_replace("value", "^\ufeff", ""), ends, "").alias("keyword"))
    df = df.where(F.length("keyword") > 0)
    return df.distinct() if distinct else df


def lexicon_words(lexicon: DataFrame) -> list[str]:
    """A lexicon's words on the driver: hand-made lists that travel inside
    the plan as one array, whatever their number."""
    return [r["keyword"] for r in lexicon.select("keyword").collect() if r["keyword"]]


def read_entities(spark: SparkSession, base_dir: str, suffix: str,
                  entities: Iterable[str] = KNOWN_ENTITIES,
                  schema: StructType | None = None,
                  on_missing: str = "skip", fmt: str = "csv") -> DataFrame:
    """One multi-path scan over per-entity files ``{entity}{suffix}``.

    The entity becomes a real ``stock_code`` column taken from the file
    name, so every later key starts with it.  ``on_missing`` is ``"skip"``
    (drop absent entities) or ``"error"``.
    """
    if on_missing not in ("skip", "error"):
        raise ValueError("on_missing must be 'skip' or 'error'")
    jvm = spark.sparkContext._jvm
    hconf = spark.sparkContext._jsc.hadoopConfiguration()
    paths = []
    for e in entities:
        p = f"{base_dir.rstrip('/')}/{e}{suffix}"
        jpath = jvm.org.apache.hadoop.fs.Path(p)
        if jpath.getFileSystem(hconf).exists(jpath):
            paths.append(p)
        elif on_missing == "error":
            raise FileNotFoundError(p)
    if not paths:
        raise FileNotFoundError(f"no entity files under {base_dir} with suffix {suffix}")
    if fmt == "csv":
        df = read_csv(spark, paths, schema)
    else:
        df = spark.read.format(fmt).load(paths)
    entity = F.regexp_extract(F.col("_metadata.file_name"), ENTITY_FROM_FILE_RE, 1)
    return df.select(entity.alias("stock_code"), *[c for c in df.columns if c != "stock_code"])


def entity_filter(df: DataFrame, entity: str, allowed: Iterable[str] | None = None,
                  col: str = "stock_code") -> DataFrame:
    """Rows of one entity; the name is validated against a known list."""
    if allowed is not None and entity not in set(allowed):
        raise ValueError(f"unknown entity {entity!r}")
    return df.where(F.col(col) == F.lit(entity))


def write_csv(df: DataFrame, path: str, partition_by: Sequence[str] = ()) -> None:
    """CSV sink with header straight to the target URI (K1–K3)."""
    w = df.write.mode("overwrite").option("header", True).option("escape", '"')
    if partition_by:
        w = w.partitionBy(*partition_by)
    w.csv(path)


def write_table(df: DataFrame, path: str, partition_by: Sequence[str] = ("stock_code",),
                fmt: str = "parquet") -> None:
    """Publish per entity: only the entity partitions present in ``df`` are
    replaced (dynamic partition overwrite), so one entity is published whole
    or not at all and the others stay as they were (K8)."""
    w = df.write.mode("overwrite").format(fmt).option("partitionOverwriteMode", "dynamic")
    if partition_by:
        w = w.partitionBy(*partition_by)
    w.save(path)


def replace_table(df: DataFrame, path: str, partition_by: Sequence[str] = ("stock_code",),
                  fmt: str = "parquet") -> None:
    """Write a table that holds exactly ``df``: an entity without rows any
    more has no partition any more."""
    w = df.write.mode("overwrite").format(fmt).option("partitionOverwriteMode", "static")
    (w.partitionBy(*partition_by) if partition_by else w).save(path)


def path_exists(spark: SparkSession, path: str) -> bool:
    jvm = spark.sparkContext._jvm
    jpath = jvm.org.apache.hadoop.fs.Path(path)
    return jpath.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration()).exists(jpath)

