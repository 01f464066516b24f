"""Unified candle schema: the shared Silver table both venues write."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

# The unified candle contract, in order.
CANDLE_SCHEMA = T.StructType([
    T.StructField("timestamp", T.TimestampNTZType()),
    T.StructField("exchange", T.StringType()),
    T.StructField("open_clp", T.DoubleType()),
    T.StructField("high_clp", T.DoubleType()),
    T.StructField("low_clp", T.DoubleType()),
    T.StructField("close_clp", T.DoubleType()),
    T.StructField("volume_btc", T.DoubleType()),
    T.StructField("buy_volume_btc", T.DoubleType()),
    T.StructField("sell_volume_btc", T.DoubleType()),
    T.StructField("trade_count", T.LongType()),
    T.StructField("is_interpolated", T.BooleanType()),
])
CANDLE_COLUMNS = [f.name for f in CANDLE_SCHEMA.fields]


def to_unified(bars: DataFrame, exchange=None, bucket: str = "bucket",
               venue_col: str | None = "venue") -> DataFrame:
    """Project continuous bars onto the 11-column contract with fixed types.
    ``exchange`` is a literal label, or taken from ``venue_col``."""
    ex = F.lit(exchange) if exchange is not None else F.col(venue_col)
    return bars.select(
        F.col(bucket).cast("timestamp_ntz").alias("timestamp"),
        ex.cast("string").alias("exchange"),
        F.col("open").cast("double").alias("open_clp"),
        F.col("high").cast("double").alias("high_clp"),
        F.col("low").cast("double").alias("low_clp"),
        F.col("close").cast("double").alias("close_clp"),
        F.col("volume").cast("double").alias("volume_btc"),
        F.col("buy_volume").cast("double").alias("buy_volume_btc"),
        F.col("sell_volume").cast("double").alias("sell_volume_btc"),
        F.col("trade_count").cast("bigint").alias("trade_count"),
        F.col("is_interpolated").cast("boolean").alias("is_interpolated"),
    )


def schema_matches(df: DataFrame, schema: T.StructType = CANDLE_SCHEMA) -> bool:
    """Type-contract check: names, order and types (nullability ignored)."""
    a = [(f.name, f.dataType) for f in df.schema.fields]
    b = [(f.name, f.dataType) for f in schema.fields]
    return a == b
