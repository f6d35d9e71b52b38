"""Seeded, exact, order-free sampling and the stratified split.

Both pick, inside each group, the ``q`` rows with the smallest seeded hash
``md5(id || ':' || seed)`` (ties by id).  The pick is exact and does not
depend on input order or partitioning.

A plain ``row_number()`` window per group would sort a whole group in one
task, and a stratum can hold a third of all rows.  Instead:

1. count rows per (group, hash bucket) -- a partial aggregate, 65,536
   buckets from the hash's first four hex digits;
2. a running sum over those small counts finds, per group, the bucket
   where the quota is reached and how many rows to take from it;
3. rows in earlier buckets are in, later buckets out; only rows of the one
   boundary bucket per group (about 1/65,536 of it) are ranked by a window.

The rows stay where they are for step 3: what step 2 found, one row a group, is sent
to them.  (A shuffle by group would put a third of all rows into one task.)
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

# Bucket width of the hash (hex digits) -> 16**4 buckets.
BUCKET_HEX_DIGITS = 4
# Groups up to which the plan (one row a group) is broadcast.
BROADCAST_GROUPS = 100_000


def seeded_hash(id_col: str, seed: int | str) -> Column:
    """Hex md5 of ``id || ':' || seed``; orders rows pseudo-randomly."""
    return F.md5(F.concat(F.col(id_col).cast("string"), F.lit(f":{seed}")))


def _bucket(h: Column) -> Column:
    return F.conv(F.substring(h, 1, BUCKET_HEX_DIGITS), 16, 10).cast("int")


def bucket_counts(df: DataFrame, group_cols: Sequence[str], id_col: str, seed: int | str) -> DataFrame:
    """``group_cols, _bk, _c``: rows per group and hash bucket."""
    return df.groupBy(*group_cols, _bucket(seeded_hash(id_col, seed)).alias("_bk")).agg(F.count(F.lit(1)).alias("_c"))


def select_lowest(df: DataFrame, group_cols: Sequence[str], id_col: str, seed: int | str,
                  quotas: DataFrame, flag: str = "selected", counts: DataFrame | None = None) -> DataFrame:
    """Flag, per group, the ``quota`` rows with the smallest seeded hash.

    ``quotas`` has ``group_cols`` + ``quota`` (bigint).  Groups missing from
    it take no rows.  Returns every input row plus boolean ``flag``.
    ``counts``: the :func:`bucket_counts` of the rows, if they are known.
    """
    g = list(group_cols)
    h = seeded_hash(id_col, seed)
    base = df.withColumn("_h", h).withColumn("_bk", _bucket(F.col("_h")))

    counts = bucket_counts(df, g, id_col, seed) if counts is None else counts
    w = Window.partitionBy(*g).orderBy("_bk")
    cum = counts.withColumn("_cum", F.sum("_c").over(w.rowsBetween(Window.unboundedPreceding, 0)))
    cum = cum.join(quotas.select(*g, F.col("quota").cast("bigint").alias("_q")), g, "inner")
    # The boundary bucket: where the running count first reaches the quota.
    at = (F.col("_cum") - F.col("_c") < F.col("_q")) & (F.col("_cum") >= F.col("_q"))
    # Groups whose quota exceeds their size take everything.
    plan = (cum.groupBy(*g).agg(F.max("_cum").alias("_tot"), F.first("_q").alias("_q"),
                                F.max(F.when(at, F.col("_bk"))).alias("_bb"),
                                F.max(F.when(at, F.col("_q") - (F.col("_cum") - F.col("_c")))).alias("_take"))
            .select(*g, F.when(F.col("_tot") <= F.col("_q"), F.lit(1 << 30))
                    .otherwise(F.coalesce(F.col("_bb"), F.lit(-1))).alias("_bb"),
                    F.coalesce(F.col("_take"), F.lit(0)).alias("_take"))).checkpoint()
    # One row per group.  Adaptive execution wouldn't broadcast it by itself: with a few
    # groups most of its partitions are empty, and it is then kept as a shuffle by group.
    # Only a huge number of groups falls back to a shuffle join (with skew splitting).
    few = plan.count() <= BROADCAST_GROUPS
    tagged = base.join(F.broadcast(plan) if few else plan, g, "left")

    inner = tagged.where(F.col("_bk") == F.col("_bb"))
    rest = tagged.where(F.col("_bb").isNull() | (F.col("_bk") != F.col("_bb")))
    rw = Window.partitionBy(*g, "_bk").orderBy("_h", id_col)
    inner = inner.withColumn(flag, F.row_number().over(rw) <= F.col("_take"))
    rest = rest.withColumn(flag, F.coalesce(F.col("_bk") < F.col("_bb"), F.lit(False)))
    out = inner.unionByName(rest)
    return out.drop("_h", "_bk", "_bb", "_take")


def sample_n(df: DataFrame, n: int, seed: int, id_col: str,
             group_cols: Sequence[str] = ("stock_code",)) -> DataFrame:
    """``n`` rows per group, or all rows when a group is smaller.

    Returns only the sampled rows.  (The original sampler raised when ``n``
    exceeded the rows; here the whole group is returned.)
    """
    # row_number() <= n is a group limit: every task keeps its n lowest a
    # group before the shuffle, so a hot group moves n rows a task
    w = Window.partitionBy(*group_cols).orderBy("_h", id_col)
    return (df.withColumn("_h", seeded_hash(id_col, seed)).withColumn("_rn", F.row_number().over(w))
            .where(F.col("_rn") <= n).drop("_h", "_rn"))


def split_quotas(df: DataFrame, label: str, test_size: float = 0.2) -> DataFrame:
    """Test rows per label for a stratified split: ``k = ceil(test_size*N)``
    shared out by largest remainder (ties by label)."""
    return quotas_from_counts(df.groupBy(label).agg(F.count(F.lit(1)).alias("_n")), label, test_size)


def quotas_from_counts(counts: DataFrame, label: str, test_size: float = 0.2) -> DataFrame:
    """:func:`split_quotas` from ``label, _n``; products of counts are exact
    decimals, so they hold at any number of rows."""
    w_all = Window.partitionBy()
    whole = "decimal(38,0)"
    tot = F.sum("_n").over(w_all)
    k = F.ceil(F.lit(test_size) * tot).cast("bigint")
    c = counts.select(label, F.col("_n").cast("decimal(19,0)").alias("_n"),
                      tot.cast("decimal(19,0)").alias("_tot"), k.cast("decimal(19,0)").alias("_k"))
    c = c.withColumn("_p", (F.col("_n") * F.col("_k")).cast(whole)).select(
        label, "_k", F.expr("_p div _tot").alias("_b"), F.expr("_p % _tot").alias("_rem"))
    extra_rank = F.row_number().over(Window.partitionBy().orderBy(F.desc("_rem"), F.asc(label)))
    extra = F.col("_k") - F.sum("_b").over(w_all)
    return c.select(label, (F.col("_b") + F.when(extra_rank <= extra, 1).otherwise(0))
                    .cast("bigint").alias("quota"))


def stratified_split(df: DataFrame, label: str, id_col: str, test_size: float = 0.2,
                     seed: int = 42) -> DataFrame:
    """Every row with ``split`` = ``"valid"`` (the per-label quota of lowest
    hashes) or ``"train"`` (X2).  Exact sizes; disjoint and complete.

    ``df`` is read three times (the counts, the boundary buckets, the rest): hand in rows that
    were written or checkpointed once if they are costly."""
    if not 0.0 < test_size < 1.0:
        raise ValueError("test_size must be in (0, 1)")
    counts = bucket_counts(df, [label], id_col, seed).checkpoint()  # buckets of a label, not rows
    q = quotas_from_counts(counts.groupBy(label).agg(F.sum("_c").alias("_n")), label, test_size)
    sel = select_lowest(df, [label], id_col, seed, q, "_valid", counts)
    return sel.withColumn("split", F.when(F.col("_valid"), F.lit("valid")).otherwise(F.lit("train"))
                          ).drop("_valid")
