"""Keyed upsert, constraint checks and publishing.

``upsert`` is a set-wise MERGE: the target and the update batch are
joined once (full outer, equi-join on the keys) instead of one statement
per row.  Semantics of ``INSERT ... ON DUPLICATE KEY UPDATE`` (N13):

* a matched row takes the new measures, **even null ones**, and keeps
  its other columns and ``created_at``;
* an unmatched update is inserted with ``created_at = run_ts``;
* target rows without an update stay as they are;
* several updates of one key in a batch: the last by ``order_col`` wins;
  without an order they are an error when the merge runs.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from moodindex.functions.numeric import nan_to_null
from moodindex.sources.io import path_exists, write_table


def latest_per_key(updates: DataFrame, keys: Sequence[str], measures: Sequence[str],
                   order_col: str) -> DataFrame:
    """Collapse duplicate keys in a batch: the row with the largest
    ``order_col`` wins.  ``max_by`` is a partial aggregate, so a key that
    repeats a billion times costs one row per task before the shuffle."""
    packed = F.struct(*[F.col(m) for m in measures])
    # ties of the order: the larger measures, so that the choice is one
    order = F.struct(F.col(order_col), packed)
    g = updates.groupBy(*keys).agg(F.max_by(packed, order).alias("_m"))
    return g.select(*keys, *[F.col("_m")[m].alias(m) for m in measures])


def upsert(target: DataFrame | None, updates: DataFrame, keys: Sequence[str],
           measures: Sequence[str], run_ts: Column, order_col: str | None = None) -> DataFrame:
    """Merge ``updates`` into ``target`` on ``keys`` (see module notes).

    Rows of ``updates`` with a null key are dropped first (F6); NaN
    measures become null (P12).  Returns ``keys, measures, created_at,
    updated_at``.
    """
    keys, measures = list(keys), list(measures)
    u = updates.dropna(subset=keys)
    u = u.select(*keys, *[nan_to_null(F.col(m).cast("double")).alias(m) if _is_float(u, m)
                          else F.col(m) for m in measures],
                 *([order_col] if order_col else []))
    if order_col:
        u = latest_per_key(u, keys, measures, order_col)
    else:
        u = _unique(u, keys, measures)
    if target is None:
        return u.select(*keys, *measures, run_ts.alias("created_at"), run_ts.alias("updated_at"))

    t = target.select(*keys, *measures, "created_at", "updated_at", F.lit(True).alias("_in_t"))
    u = u.select(*keys, *[F.col(m).alias(f"_u_{m}") for m in measures], F.lit(True).alias("_in_u"))
    j = t.join(u, keys, "full_outer")
    in_u = F.coalesce(F.col("_in_u"), F.lit(False))
    in_t = F.coalesce(F.col("_in_t"), F.lit(False))
    return j.select(
        *keys,
        *[F.when(in_u, F.col(f"_u_{m}")).otherwise(F.col(m)).alias(m) for m in measures],
        F.when(in_t, F.col("created_at")).otherwise(run_ts).alias("created_at"),
        F.when(in_u, run_ts).otherwise(F.col("updated_at")).alias("updated_at"),
    )


def _unique(u: DataFrame, keys: Sequence[str], measures: Sequence[str]) -> DataFrame:
    """The rows as they are; a key that occurs twice raises an error."""
    said = F.concat(F.lit("duplicate key in the batch: "), F.concat_ws(",", *[F.col(k).cast("string") for k in keys]))
    g = u.groupBy(*keys).agg(F.first(F.struct(*measures)).alias("_m"), F.count(F.lit(1)).alias("_c"))
    # the check is part of a measure, so it can't be pruned away
    ok = F.when(F.col("_c") > 1, F.raise_error(said).cast(g.schema["_m"].dataType)).otherwise(F.col("_m"))
    return g.select(*keys, ok.alias("_m")).select(*keys, *[F.col("_m")[m].alias(m) for m in measures])


def _is_float(df: DataFrame, c: str) -> bool:
    return df.schema[c].dataType.typeName() in ("double", "float")


def constraint_check(df: DataFrame, keys: Sequence[str], not_null: Sequence[str]) -> DataFrame:
    """Primary-key and NOT NULL violations as rows (K10):
    ``kind`` ('duplicate_key' | 'null'), ``column``, ``n``.  Empty = valid.
    """
    dup = (df.groupBy(*keys).agg(F.count(F.lit(1)).alias("_c")).where(F.col("_c") > 1)
           .agg(F.count(F.lit(1)).alias("n"))
           .select(F.lit("duplicate_key").alias("kind"), F.lit(",".join(keys)).alias("column"), "n"))
    nulls = df.select(*[F.sum(F.col(c).isNull().cast("long")).alias(c) for c in not_null])
    stack = ", ".join(f"'{c}', `{c}`" for c in not_null)
    nulls = nulls.selectExpr(f"stack({len(not_null)}, {stack}) as (column, n)").select(
        F.lit("null").alias("kind"), "column", "n")
    return dup.unionByName(nulls).where(F.col("n") > 0)


def publish_upsert(spark, table_path: str, updates: DataFrame, keys: Sequence[str],
                   measures: Sequence[str], run_ts: Column, order_col: str | None = None,
                   partition_by: Sequence[str] = ("stock_code",)) -> DataFrame:
    """Upsert into a parquet table folder and publish it (K4–K8, E5).

    The target is first cut to the entity partitions that ``updates``
    touches, so the others are neither read nor rewritten.  The merged result
    is checkpointed to the cluster's checkpoint folder before it overwrites the table, so the
    write never reads the path it replaces.  Running the same batch twice gives the same table.
    """
    target = spark.read.parquet(table_path) if path_exists(spark, table_path) else None
    if target is not None and partition_by:
        touched = updates.select(*partition_by).distinct()
        target = target.join(touched, list(partition_by), "left_semi")
    merged = upsert(target, updates, keys, measures, run_ts, order_col).checkpoint(eager=True)
    write_table(merged, table_path, partition_by)
    return merged


def publish_each(spark, table_path: str, updates: DataFrame, keys: Sequence[str], measures: Sequence[str],
                 run_ts: Column, entities: Sequence[str], order_col: str | None = None,
                 entity_col: str = "stock_code") -> dict[str, Exception | None]:
    """Publish entity by entity (K8): each is written whole or not at all,
    and one that fails leaves the others to go on.  Returns the error of
    each entity, None where it was published."""
    out: dict[str, Exception | None] = {}
    for e in entities:
        try:
            publish_upsert(spark, table_path, updates.where(F.col(entity_col) == F.lit(e)), keys, measures,
                           run_ts, order_col, (entity_col,))
            out[e] = None
        except Exception as err:  # noqa: BLE001  (reported to the caller, entity by entity)
            out[e] = err
    return out
