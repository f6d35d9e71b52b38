"""Versioned tables: snapshot folders and a manifest that is swapped last (K8).

A table folder holds ``data/`` with one folder a publishing, never changed once
written, and ``_manifests/`` with one small file a version: for each entity the
folder that holds its rows.  A reader takes the newest manifest and opens
only folders named there, so it sees a whole version whatever a writer does meanwhile
or leaves behind.

Publishing reads the updates once.  One aggregate finds the entities whose updates
break a rule (a key that occurs twice, a required value that is null): these keep their old
version and are reported.  The others are merged with their current rows and written in one
job; then the manifest of version n + 1 is claimed (created only if nobody has) and
moved into place.  A writer that read version n and comes second gets :class:`Conflict`
and has changed nothing.  A job that dies leaves a folder that no manifest names.

The manifest move needs a file system with an atomic rename (HDFS, local disks).  It
names one folder an entity, as a catalogue names partitions.
"""

from __future__ import annotations

import json
import uuid
from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from moodindex.operators.upsert import upsert
from moodindex.session import remove_path

_CODE = "_entity_code"


class Conflict(RuntimeError):
    """Another writer has published since the table was read."""


def _fs(spark: SparkSession, path: str):
    p = spark.sparkContext._jvm.org.apache.hadoop.fs.Path(path)
    return p.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration())


def _path(spark: SparkSession, path: str):
    return spark.sparkContext._jvm.org.apache.hadoop.fs.Path(path)


def _name(version: int) -> str:
    return f"{version:012d}.json"


def versions(spark: SparkSession, table: str) -> list[int]:
    """The versions of a table, in order."""
    folder = f"{table.rstrip('/')}/_manifests"
    if not _fs(spark, folder).exists(_path(spark, folder)):
        return []
    names = [s.getPath().getName() for s in _fs(spark, folder).listStatus(_path(spark, folder))]
    return sorted(int(n[:-5]) for n in names if n.endswith(".json"))


def manifest(spark: SparkSession, table: str, version: int | None = None) -> tuple[int, dict]:
    """``(version, {entity: folder})``; version 0 is the table before the first publishing."""
    if version is None:
        version = max(versions(spark, table), default=0)
    if not version:
        return 0, {}
    lines = spark.read.text(f"{table.rstrip('/')}/_manifests/{_name(version)}").collect()  # a line an entity
    rows = [json.loads(r["value"]) for r in lines]
    return version, {r["entity"]: r["folder"] for r in rows}


def read_snapshot(spark: SparkSession, table: str, version: int | None = None,
                  entities: Sequence | None = None) -> DataFrame | None:
    """The rows of one version (the newest), of all entities or of some; None if there are none."""
    _, folders = manifest(spark, table, version)
    paths = [f"{table.rstrip('/')}/{f}" for e, f in sorted(folders.items(), key=str) if entities is None or e in entities]
    return spark.read.parquet(*paths) if paths else None


def _write_manifest(spark: SparkSession, table: str, version: int, folders: dict) -> None:
    base = f"{table.rstrip('/')}/_manifests"
    fs = _fs(spark, base)
    fs.mkdirs(_path(spark, base))
    try:
        fs.create(_path(spark, f"{base}/{_name(version)}.claim"), False).close()
    except Exception as err:
        raise Conflict(f"version {version} of {table} is taken") from err
    draft = _path(spark, f"{base}/{_name(version)}.{uuid.uuid4().hex}")
    out = fs.create(draft, False)
    body = "".join(json.dumps({"entity": e, "folder": f}) + "\n" for e, f in sorted(folders.items(), key=str))
    out.write(bytearray(body.encode()))
    out.close()
    if not fs.rename(draft, _path(spark, f"{base}/{_name(version)}")):
        raise Conflict(f"version {version} of {table} could not be moved into place")


def broken_rules(updates: DataFrame, keys: Sequence[str], required: Sequence[str], entity: str) -> DataFrame:
    """``entity, reason`` of the entities whose updates must not be published, by one aggregate."""
    null = [F.sum(F.col(c).isNull().cast("long")).alias(f"_n{i}") for i, c in enumerate(required)]
    per_key = updates.groupBy(*dict.fromkeys([entity, *keys])).agg(F.count(F.lit(1)).alias("_rows"), *null)
    seen = per_key.groupBy(entity).agg(F.max("_rows").alias("_rows"), *[F.sum(f"_n{i}").alias(f"_n{i}") for i in range(len(null))])
    reason = F.concat_ws("; ", F.when(F.col("_rows") > 1, "duplicate key"),
                         *[F.when(F.col(f"_n{i}") > 0, f"null {c}") for i, c in enumerate(required)])
    return seen.select(F.col(entity).alias("entity"), reason.alias("reason"))


def publish(spark: SparkSession, table: str, updates: DataFrame, keys: Sequence[str], measures: Sequence[str],
            run_ts: Column, required: Sequence[str] = (), entity: str = "stock_code",
            read_version: int | None = None) -> dict:
    """Merge ``updates`` into the table as its next version; returns for each entity of the
    updates None, or why it kept its old version.  Rows with a null key go first (F6).
    ``read_version``: the version that the caller's work is based on (the newest)."""
    version, folders = manifest(spark, table)
    if read_version is not None and read_version != version:
        raise Conflict(f"{table} is at version {version}, not {read_version}")
    updates = updates.select(*dict.fromkeys([*keys, *measures])).dropna(subset=list(keys)).checkpoint()
    state = {r["entity"]: r["reason"] or None for r in broken_rules(updates, keys, required, entity).collect()}  # a row an entity
    fine = [e for e, why in state.items() if why is None]
    if not fine:
        return state
    good = updates.where(F.col(entity).isin(fine))
    target = read_snapshot(spark, table, version, fine) if version else None
    merged = upsert(target, good, keys, measures, run_ts)
    folder = f"data/{version + 1:012d}-{uuid.uuid4().hex}"
    code = F.md5(F.col(entity).cast("string"))
    merged.withColumn(_CODE, code).write.partitionBy(_CODE).parquet(f"{table.rstrip('/')}/{folder}")
    codes = {r["e"]: r["c"] for r in spark.createDataFrame([(e,) for e in fine], updates.select(entity).schema)
             .select(F.col(entity).alias("e"), code.alias("c")).collect()}
    _write_manifest(spark, table, version + 1, folders | {e: f"{folder}/{_CODE}={codes[e]}" for e in fine})
    return state


def vacuum(spark: SparkSession, table: str, keep: int = 2) -> list[str]:
    """Delete the folders that none of the newest ``keep`` versions names, and older manifests.
    Not beside a running writer: a folder not yet published has no manifest either."""
    have = versions(spark, table)
    kept, gone = have[-keep:], have[:-keep]
    named = {f.split("/")[1] for v in kept for f in manifest(spark, table, v)[1].values()}
    base = f"{table.rstrip('/')}/data"
    if not _fs(spark, base).exists(_path(spark, base)):
        return []
    old = [s.getPath().getName() for s in _fs(spark, base).listStatus(_path(spark, base))]
    old = sorted(n for n in old if n not in named)
    for v in gone:
        remove_path(spark, f"{table.rstrip('/')}/_manifests/{_name(v)}")
    for n in old:
        remove_path(spark, f"{base}/{n}")
    return old
