"""Fear-greed indicators: daily ratios, hourly / monthly scores, change rate,
moving averages, cross signals, plot-ready series.

Inputs are scored comments: ``stock_code, comment_id, time`` plus class
probabilities (``prob_fear, prob_neutral, prob_greed``) or a ``score``.
Every key starts with the entity column.

Scale notes
-----------
* Means are plain ``groupBy().agg`` -> partial aggregation before the
  shuffle, so a hot entity costs one partial row per task, not a hot task.
* Measures are read through :func:`moodindex.functions.numeric.finite`:
  NaN, infinities and text that is no number count as null.
* The change rate telescopes: within a run of consecutive rows the sum of
  the changes is the last value less the first, so a run (an hour of a year,
  or of a date) is one row of a partial aggregate and only those rows are ordered by a window.
  Runs that hold a null are differenced row by row, in minute segments.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from moodindex.functions.numeric import finite
from moodindex.functions.time import as_timestamp, with_time_parts
from moodindex.operators.upsert import constraint_check
from moodindex.schemas import STOCK_CODE_MAX_LEN

PROB_COLS = ("prob_fear", "prob_neutral", "prob_greed")
SCORE = "fear_greed_score"
# Consecutive ids per row-level segment for rows without a time.
ID_BUCKET = 1 << 16


def with_score(df: DataFrame, prob_greed: str = "prob_greed", out: str = SCORE) -> DataFrame:
    """fear-greed score = 100 x greed probability (P10)."""
    return df.withColumn(out, finite(prob_greed) * F.lit(100))


def daily_sentiment(scored: DataFrame, keys: Sequence[str] = ("stock_code",),
                    time_col: str = "time") -> DataFrame:
    """Mean class probabilities per entity and date.

    A null date is a group of its own (N5).
    """
    df = with_time_parts(scored, time_col)
    return df.groupBy(*keys, "date").agg(
        F.avg(finite("prob_fear")).alias("fear_ratio"),
        F.avg(finite("prob_neutral")).alias("neutral_ratio"),
        F.avg(finite("prob_greed")).alias("greed_ratio"),
    )


def _score_frame(scored: DataFrame, time_col: str, score: str | None) -> DataFrame:
    """Scored rows with time parts, the parsed time ``_ts`` and the value ``_v``."""
    df = with_time_parts(scored, time_col).withColumn("_ts", as_timestamp(scored, time_col))
    if score is None:
        return with_score(df, out="_v")
    return df.withColumn("_v", finite(score))


def hourly_score(scored: DataFrame, keys: Sequence[str] = ("stock_code",),
                 time_col: str = "time", score: str | None = None) -> DataFrame:
    """Mean score per entity, year and hour of day (A2); null key kept."""
    df = _score_frame(scored, time_col, score)
    return df.groupBy(*keys, "year", "hour").agg(F.avg("_v").alias("avg_score"))


def monthly_score(scored: DataFrame, keys: Sequence[str] = ("stock_code",),
                  time_col: str = "time", score: str | None = None) -> DataFrame:
    """Mean score per entity and ``yyyy-MM`` month (A3); null month dropped.
    Sort the published rows with :func:`monthly_series` (O1)."""
    df = _score_frame(scored, time_col, score)
    return (df.where(F.col("month").isNotNull())
            .groupBy(*keys, "month").agg(F.avg("_v").alias("avg_score")))


def monthly_series(monthly: DataFrame, keys: Sequence[str] = ("stock_code",)) -> DataFrame:
    """Monthly rows in the order of entity and month."""
    return monthly.orderBy(*keys, "month")


def _change_parts(scored: DataFrame, order: str, keys: Sequence[str], time_col: str,
                  id_col: str, score: str | None) -> DataFrame:
    """Per entity, year and hour: ``change_rate`` and ``avg_score``."""
    if order not in ("hour", "arrival"):
        raise ValueError("order must be 'hour' or 'arrival'")
    df = _score_frame(scored, time_col, score)
    # A run is contiguous in the total order of an (entity, year).
    run = ["hour"] if order == "hour" else ["date", "hour"]
    group = [*keys, "year", *run]
    df = df.select(*dict.fromkeys([*group, "date", "hour"]), "_ts", F.col(id_col).alias("_id"), "_v")
    at = F.struct("_ts", "_id")
    runs = df.groupBy(*group).agg(
        F.min_by("_v", at).alias("first_v"), F.max_by("_v", at).alias("last_v"),
        F.count(F.lit(1)).alias("n"), F.count("_v").alias("nv"), F.sum("_v").alias("sv"))
    none = F.lit(None).cast("long")
    parts = ["first_v", "last_v", "s_in", "c_in", "nv", "sv"]
    clean = runs.where("n = nv").select(
        *group, none.alias("_day"), none.alias("_min"), none.alias("_idb"), "first_v", "last_v",
        (F.col("last_v") - F.col("first_v")).alias("s_in"), (F.col("n") - 1).alias("c_in"), "nv", "sv")

    # Runs with a null: rows are differenced inside segments (one minute of one date; of
    # rows without a time 65,536 consecutive ids), so even a hot run is many partitions.
    holes = (df.groupBy(*group).agg(F.count(F.lit(1)).alias("n"), F.count("_v").alias("nv"))
             .where("n <> nv").select(*[F.col(c).alias(f"_k{i}") for i, c in enumerate(group)]))
    same = F.lit(True)
    for i, c in enumerate(group):
        same = same & F.col(c).eqNullSafe(F.col(f"_k{i}"))
    rows = df.join(holes, same, "left_semi")
    idb = F.floor(F.col("_id") / F.lit(ID_BUCKET)) if _is_integral(df, "_id") else F.lit(None)
    rows = rows.withColumns({
        "_day": F.datediff("date", F.lit("1970-01-01")).cast("long"),
        "_min": F.minute("_ts").cast("long"),
        "_idb": F.when(F.col("_ts").isNull(), idb).cast("long")})
    seg = [*group, "_day", "_min", "_idb"]
    w_row = Window.partitionBy(*seg).orderBy("_ts", "_id")
    rows = rows.select(*seg, "_v", (F.col("_v") - F.lag("_v").over(w_row)).alias("_d"),
                       F.lag(F.lit(1)).over(w_row).isNull().alias("_first"),
                       F.lead(F.lit(1)).over(w_row).isNull().alias("_last"))
    dirty = rows.groupBy(*seg).agg(
        F.max(F.when(F.col("_first"), F.col("_v"))).alias("first_v"),
        F.max(F.when(F.col("_last"), F.col("_v"))).alias("last_v"),
        F.sum("_d").alias("s_in"), F.count("_d").alias("c_in"),
        F.count("_v").alias("nv"), F.sum("_v").alias("sv"))

    segs = clean.unionByName(dirty.select(*seg, *parts))
    w_seg = Window.partitionBy(*keys, "year").orderBy(*run, "_day", "_min", "_idb")
    segs = segs.withColumn("_b", F.col("first_v") - F.lag("last_v").over(w_seg))
    total = F.coalesce(F.sum("s_in"), F.lit(0.0)) + F.coalesce(F.sum("_b"), F.lit(0.0))
    n = F.sum("c_in") + F.count("_b")
    return segs.groupBy(*keys, "year", "hour").agg(
        F.when(n > 0, total / n).alias("change_rate"),
        F.when(F.sum("nv") > 0, F.sum("sv") / F.sum("nv")).alias("avg_score"))


def change_rate(scored: DataFrame, order: str = "hour", keys: Sequence[str] = ("stock_code",),
                time_col: str = "time", id_col: str = "comment_id",
                score: str | None = None) -> DataFrame:
    """Mean row-to-row score change per entity, year and hour (W1/W2 + A4).

    Rows are differenced in a total order within ``(entity, year)``:
    ``order="hour"`` sorts by (hour of day, time, id) as the Spark job did;
    ``order="arrival"`` sorts by (time, id) as its pandas twin did.  The
    first row of an (entity, year) has no predecessor; a difference with a
    null side is null and skipped by the mean; an all-null group is null.

    Holds for any input (nulls included) and is skew-safe: see module notes.
    """
    return _change_parts(scored, order, keys, time_col, id_col, score).drop("avg_score")


def score_and_change(scored: DataFrame, order: str = "hour", keys: Sequence[str] = ("stock_code",),
                     time_col: str = "time", id_col: str = "comment_id",
                     score: str | None = None) -> DataFrame:
    """Mean score and mean change per entity, year and hour from one
    aggregate of the scored rows (E3)."""
    return _change_parts(scored, order, keys, time_col, id_col, score)


def _is_integral(df: DataFrame, c: str) -> bool:
    return df.schema[c].dataType.typeName() in ("long", "integer", "short", "byte")


def change_rate_rows(scored: DataFrame, order: str = "hour", keys: Sequence[str] = ("stock_code",),
                     time_col: str = "time", id_col: str = "comment_id",
                     score: str | None = None) -> DataFrame:
    """Row-level reference form of :func:`change_rate` (one window per
    entity-year).  Kept as the executable definition for tests; do not use
    it on skewed data."""
    df = _score_frame(scored, time_col, score)
    order_cols = ([F.col("hour"), F.col("_ts"), F.col(id_col)] if order == "hour"
                  else [F.col("_ts"), F.col(id_col)])
    w = Window.partitionBy(*keys, "year").orderBy(*order_cols)
    d = df.withColumn("_d", F.col("_v") - F.lag("_v").over(w))
    return d.groupBy(*keys, "year", "hour").agg(F.avg("_d").alias("change_rate"))


def moving_average(monthly: DataFrame, short: int = 7, long: int = 30,
                   keys: Sequence[str] = ("stock_code",), order_col: str = "month",
                   value: str = "avg_score") -> DataFrame:
    """Trailing means over the last ``short`` / ``long`` rows.

    Null until the window holds that many non-null values, like a pandas
    rolling mean.  Partitioned by entity, after the monthly aggregate, so
    each window task sees one entity's months only.
    """
    base = Window.partitionBy(*keys).orderBy(order_col)
    ws = base.rowsBetween(-(short - 1), 0)
    wl = base.rowsBetween(-(long - 1), 0)
    v = F.col(value)
    return monthly.select(
        "*",
        F.when(F.count(v).over(ws) == short, F.avg(v).over(ws)).alias("short_ma"),
        F.when(F.count(v).over(wl) == long, F.avg(v).over(wl)).alias("long_ma"),
    )


def cross_signal(ma: DataFrame, keys: Sequence[str] = ("stock_code",),
                 order_col: str = "month") -> DataFrame:
    """Golden / dead cross of the short vs the long average.

    ``golden`` when (short - long) goes from <= 0 to > 0, ``dead`` when it
    goes from >= 0 to < 0, ``none`` otherwise; null when either difference
    is unknown.
    """
    w = Window.partitionBy(*keys).orderBy(order_col)
    diff = F.col("short_ma") - F.col("long_ma")
    prev = F.lag(diff).over(w)
    sig = (F.when(diff.isNull() | prev.isNull(), F.lit(None).cast("string"))
           .when((prev <= 0) & (diff > 0), F.lit("golden"))
           .when((prev >= 0) & (diff < 0), F.lit("dead"))
           .otherwise(F.lit("none")))
    return ma.withColumn("signal", sig)


def yearly_series(change: DataFrame, keys: Sequence[str] = ("stock_code",)) -> DataFrame:
    """Plot-ready per-year change series: known years and hours, sorted by
    (entity, year, hour) (E4, F8, O2)."""
    return (change.where(F.col("year").isNotNull() & F.col("hour").isNotNull())
            .orderBy(*keys, F.asc_nulls_last("year"), F.asc_nulls_last("hour")))


def distinct_years(change: DataFrame, keys: Sequence[str] = ("stock_code",)) -> DataFrame:
    """Years present per entity."""
    return change.where(F.col("year").isNotNull()).select(*keys, "year").distinct()


def preview(df: DataFrame, keys: Sequence[str], n: int = 5) -> DataFrame:
    """First ``n`` rows in key order (O5): a top-k, not a full sort."""
    return df.orderBy(*keys).limit(n)


# Sums of measures for the typed tables: exact in this type, so that the
# published decimals do not depend on the order of the rows.
EXACT = "decimal(38,18)"


def _exact_mean(c: Column, decimals: str) -> Column:
    """Mean, half-up, as a decimal type; null without a value."""
    d = c.cast(EXACT)
    return F.when(F.count(d) > 0, (F.sum(d) / F.count(d)).cast(decimals))


def typed_indicators(scored: DataFrame, created_at: Column | None = None,
                     keys: Sequence[str] = ("stock_code",), time_col: str = "time") -> DataFrame:
    """The DDL-shaped table: one row per (entity, date, hour) with the three
    ratios as DECIMAL(5,4), ``fear_greed_index = 100 x greed`` as
    DECIMAL(5,2) and the hour as TINYINT, half-up from exact sums (K9, N14).

    Rows whose key would be null are left out; :func:`typed_violations`
    reports rows that the DDL's NOT NULL or lengths reject.
    """
    df = with_time_parts(scored, time_col).where(
        F.col("date").isNotNull() & F.col("hour").isNotNull())
    return df.groupBy(*keys, "date", F.col("hour").cast("tinyint").alias("hour")).agg(
        _exact_mean(finite("prob_fear"), "decimal(5,4)").alias("fear_ratio"),
        _exact_mean(finite("prob_neutral"), "decimal(5,4)").alias("neutral_ratio"),
        _exact_mean(finite("prob_greed"), "decimal(5,4)").alias("greed_ratio"),
        # 100 x the ratio that is published beside it
        (_exact_mean(finite("prob_greed"), "decimal(5,4)") * 100).cast("decimal(5,2)")
        .alias("fear_greed_index"),
    ).withColumn("created_at", created_at if created_at is not None else F.current_timestamp())


def typed_monthly(scored: DataFrame, created_at: Column | None = None,
                  keys: Sequence[str] = ("stock_code",), time_col: str = "time") -> DataFrame:
    """The DDL's monthly table: one row per (entity, year, month) with
    ``avg_fear_greed`` = mean score as DECIMAL(5,2), half-up from exact
    sums (K9).  Year SMALLINT, month TINYINT."""
    df = with_time_parts(scored, time_col).where(F.col("date").isNotNull())
    return df.groupBy(*keys, F.year("date").cast("smallint").alias("year"),
                      F.month("date").cast("tinyint").alias("month")).agg(
        _exact_mean(finite("prob_greed").cast(EXACT) * 100, "decimal(5,2)").alias("avg_fear_greed")
    ).withColumn("created_at", created_at if created_at is not None else F.current_timestamp())


def typed_violations(typed: DataFrame, keys: Sequence[str], measures: Sequence[str],
                     entity: str = "stock_code", max_len: int = STOCK_CODE_MAX_LEN) -> DataFrame:
    """What the DDL would reject, as rows ``kind, column, n``: duplicate
    keys, nulls, and entity codes longer than VARCHAR allows."""
    long = typed.where(F.length(entity) > max_len).agg(F.count(F.lit(1)).alias("n")).select(
        F.lit("too_long").alias("kind"), F.lit(entity).alias("column"), "n").where("n > 0")
    return constraint_check(typed, keys, [*keys, *measures]).unionByName(long)
