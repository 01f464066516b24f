"""How the driver's generic tables stand in for market data.

events   -> trades: series by ``user_id`` parity (even = premium venue T,
            odd = base venue K), price = ``value``, amount = ``k`` in
            ``props``, taker side buy = ``event_type = 'purchase'``,
            trade id = ``event_id``.
orders   -> daily reference rate on business days: average ``o_totalprice``
            per weekday ``o_orderdate`` (summed in integer cents, so every
            engine gets the same double).
lineitem -> facts to convert by local date (``l_shipdate``).
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from tickwave.operators.bars import ohlcv_bars
from tickwave.operators.candles import to_unified
from tickwave.operators.grid import continuous_bars

# Venue labels of the two stand-in series.
VENUE_T = "venue_t"
VENUE_K = "venue_k"


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def events_trades(spark: SparkSession, sf_dir: str) -> DataFrame:
    ev = table(spark, sf_dir, "events")
    return ev.select(
        F.when(F.col("user_id") % 2 == 0, F.lit(VENUE_T)).otherwise(F.lit(VENUE_K)).alias("venue"),
        F.col("ts"),
        F.col("event_id").alias("trade_id"),
        F.col("value").alias("price"),
        F.get_json_object("props", "$.k").cast("double").alias("amount"),
        F.when(F.col("event_type") == "purchase", F.lit("buy")).otherwise(F.lit("sell")).alias("side"),
    )


def events_candles(spark: SparkSession, sf_dir: str, width: str = "1 minute",
                   materialize: bool = True) -> DataFrame:
    """Both venues as continuous unified candles.  ``materialize`` writes them
    once (the stand-in for the Silver table, which the spread reads once per
    venue); a query that reads them once passes ``False``."""
    bars = ohlcv_bars(events_trades(spark, sf_dir), width)
    c = to_unified(continuous_bars(bars, width))
    if not materialize:
        return c
    from tickwave.session import materialize as write_once
    return write_once(c, "candles")


def weekday_rates(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Business-day rate series ``(fecha DATE, valor DOUBLE)``."""
    o = table(spark, sf_dir, "orders")
    d = F.to_date("o_orderdate")
    return (o.where(F.dayofweek(d).between(2, 6))
            .groupBy(d.alias("fecha"))
            .agg((F.sum(F.round(F.col("o_totalprice") * 100).cast("bigint")) / F.count(F.lit(1)) / 100.0)
                 .alias("valor")))


def event_rates(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Daily rate series for the event month: average ``value`` (in integer
    cents) of all events per Santiago calendar date, as ``(date, rate)``.  Its
    first and last dates bracket every event, so kline minutes are covered."""
    from tickwave.functions.timefn import local_date
    ev = table(spark, sf_dir, "events")
    return ev.groupBy(local_date("ts").alias("date")).agg(
        (F.sum(F.round(F.col("value") * 100).cast("bigint")) / F.count(F.lit(1)) / 100.0).alias("rate"))


def day_periods(spark: SparkSession, sf_dir: str, symbol: str, extra_days: int = 0) -> DataFrame:
    """Half-open UTC-day periods ``(symbol, start_ms, end_ms)`` covering the
    event range (plus ``extra_days`` after it, which hold no data)."""
    from tickwave.functions.timefn import epoch_ms
    ev = table(spark, sf_dir, "events")
    days = ev.agg(F.to_date(F.min("ts")).alias("a"), F.date_add(F.to_date(F.max("ts")), extra_days).alias("b"))
    d = days.select(F.explode(F.sequence("a", "b")).alias("d"))
    start = epoch_ms(F.col("d").cast("timestamp_ntz"))
    return d.select(F.lit(symbol).alias("symbol"), start.alias("start_ms"),
                    (start + F.lit(86_400_000)).alias("end_ms"))
