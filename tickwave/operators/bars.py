"""Trades -> fixed-width OHLCV bars (real buckets only)."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from tickwave.functions.timefn import bucket_start, epoch_seconds

BAR_COLUMNS = ["open", "high", "low", "close", "volume", "buy_volume",
               "sell_volume", "trade_count"]


def packed_order(df: DataFrame, ts: str, number: str) -> Column:
    """A value that orders like ``(ts, number)``: microseconds times 10^20 plus the
    number, as DECIMAL(38, 0), where both types allow it; else a struct.  A NULL
    number comes before all others, a NULL time before all times."""
    at, kind = df.schema[ts].dataType, df.schema[number].dataType
    if not isinstance(kind, T.IntegralType) or not isinstance(at, (T.TimestampType, T.TimestampNTZType)):
        return F.struct(F.col(ts), F.col(number))
    if isinstance(at, T.TimestampNTZType):
        micros = (epoch_seconds(ts) * F.lit(1_000_000).cast("decimal(7,0)")).cast("decimal(17,0)")
    else:
        micros = F.unix_micros(ts).cast("decimal(17,0)")
    first = F.lit(-(10 ** 17) + 1).cast("decimal(17,0)")
    low = F.lit(str(-(10 ** 19))).cast("decimal(20,0)")
    return (F.coalesce(micros, first) * F.lit(str(10 ** 20)).cast("decimal(21,0)")
            + F.coalesce(F.col(number).cast("decimal(20,0)"), low)).cast("decimal(38,0)")


def ohlcv_bars(trades: DataFrame, width: str = "1 minute",
               keys: Sequence[str] = ("venue",), ts: str = "ts",
               price: str = "price", amount: str = "amount", side: str = "side",
               trade_id: str = "trade_id", buy_side: str = "buy",
               as_window: bool = False) -> DataFrame:
    """One row per ``(keys, bucket)`` that holds at least one trade.

    open/close are the first/last price by ``(ts, trade_id)`` so trades in the
    same instant are ordered by id; volume is the sum of amounts, buy volume
    the sum over taker-buy trades (0 when a bucket has none), sell volume the
    residual ``volume - buy``, and trade_count counts the trades.

    ``as_window`` groups by the ``window`` column itself, which a stream needs
    to carry its watermark into the aggregate's state.

    Plan: one hash exchange on ``(keys, bucket)`` with a map-side partial
    aggregate, so a hot key is spread over its buckets before the shuffle.  Whole-
    number ids are packed with the time into one number to order by, which lets
    Spark hash the raw trades instead of sorting them.
    """
    order = packed_order(trades, ts, trade_id)
    amt = F.col(amount)
    bucket = F.window(ts, width).alias("bucket") if as_window else bucket_start(ts, width).alias("bucket")
    bars = (
        trades.groupBy(*keys, bucket)
        .agg(
            F.min_by(price, order).alias("open"),
            F.max(price).alias("high"),
            F.min(price).alias("low"),
            F.max_by(price, order).alias("close"),
            F.sum(amt).alias("volume"),
            F.sum(F.when(F.col(side) == buy_side, amt).otherwise(F.lit(0.0))).alias("buy_volume"),
            F.count(amt).alias("trade_count"),
        )
    )
    return bars.select(*keys, "bucket", "open", "high", "low", "close", "volume",
                       "buy_volume", (F.col("volume") - F.col("buy_volume")).alias("sell_volume"),
                       "trade_count")
