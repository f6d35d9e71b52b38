"""Explicit schemas and the typed indicator tables."""

from __future__ import annotations

from pyspark.sql.types import LongType, StringType, StructField, StructType

RAW_COMMENTS = StructType([
    StructField("comment_id", LongType()),
    StructField("stock_code", StringType()),
    StructField("text", StringType()),
    StructField("time", StringType()),
])

# Published tables: key columns, measure columns.
DAILY_KEYS = ("stock_code", "date")
DAILY_MEASURES = ("fear_ratio", "neutral_ratio", "greed_ratio")
HOURLY_KEYS = ("stock_code", "year", "hour")
HOURLY_MEASURES = ("avg_score",)
MONTHLY_KEYS = ("stock_code", "month")
MONTHLY_MEASURES = ("avg_score",)
CHANGE_KEYS = ("stock_code", "year", "hour")
CHANGE_MEASURES = ("change_rate",)

# The DDL's tables: keys and measures, all NOT NULL.
TYPED_KEYS = ("stock_code", "date", "hour")
TYPED_MEASURES = ("fear_ratio", "neutral_ratio", "greed_ratio", "fear_greed_index")
TYPED_MONTHLY_KEYS = ("stock_code", "year", "month")
TYPED_MONTHLY_MEASURES = ("avg_fear_greed",)

# DDL length of the entity code.
STOCK_CODE_MAX_LEN = 10
