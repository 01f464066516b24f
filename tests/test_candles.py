import datetime as dt

from pyspark.sql import Window
from pyspark.sql import functions as F

from tests.paths import SF01
from tickwave.functions.timefn import ms_to_ts
from tickwave.operators.bars import ohlcv_bars
from tickwave.operators.grid import continuous_bars
from tickwave.plans.standins import events_trades


def trades_df(spark, rows):
    df = spark.createDataFrame(rows, "ts_ms long, amount double, price double, side string, trade_id long")
    return df.select(F.lit("x").alias("venue"), ms_to_ts("ts_ms").alias("ts"), "trade_id", "price", "amount", "side")


def test_hand_worked_minutes(spark):
    rows = [(1704067205000, 0.5, 100.0, "buy", 11), (1704067205000, 0.25, 101.0, "sell", 12),
            (1704067230000, 0.25, 99.0, "buy", 13), (1704067380000, 1.0, 102.0, "sell", 14),
            (1704067440000, 0.5, 103.0, "buy", 15)]
    c = continuous_bars(ohlcv_bars(trades_df(spark, rows)))
    got = [tuple(r) for r in c.orderBy("bucket").select(
        F.minute("bucket"), "open", "high", "low", "close", "volume", "buy_volume", "sell_volume",
        "trade_count", "is_interpolated").collect()]
    assert got == [
        (0, 100.0, 101.0, 99.0, 99.0, 1.0, 0.75, 0.25, 3, False),
        (1, 99.0, 99.0, 99.0, 99.0, 0.0, 0.0, 0.0, 0, True),
        (2, 99.0, 99.0, 99.0, 99.0, 0.0, 0.0, 0.0, 0, True),
        (3, 102.0, 102.0, 102.0, 102.0, 1.0, 0.0, 1.0, 1, False),
        (4, 103.0, 103.0, 103.0, 103.0, 0.5, 0.5, 0.0, 1, False),
    ]


def test_same_ms_ordered_by_id(spark):
    rows = [(1704067205000, 1.0, 5.0, "buy", 2), (1704067205000, 1.0, 7.0, "buy", 1)]
    r = ohlcv_bars(trades_df(spark, rows)).first()
    assert (r["open"], r["close"]) == (7.0, 5.0)


def test_gap_across_several_days(spark):
    # last trade of day 1 at 23:58, next trade on day 4 at 00:02
    t0 = 1704153480000  # 2024-01-01 23:58 UTC
    t1 = 1704412920000  # 2024-01-05 00:02 UTC
    c = continuous_bars(ohlcv_bars(trades_df(spark, [(t0, 1.0, 10.0, "buy", 1), (t1, 1.0, 20.0, "sell", 2)])))
    n = (t1 - t0) // 60000 + 1
    assert c.count() == n
    assert c.where("is_interpolated").agg(F.min("close"), F.max("close")).first() == (10.0, 10.0)
    assert c.select("bucket").distinct().count() == n


def naive_grid(bars):
    """Reference shape: full grid per key + unbounded forward fill."""
    rng = bars.groupBy("venue").agg(F.min("bucket").alias("a"), F.max("bucket").alias("b"))
    grid = rng.select("venue", F.explode(F.sequence("a", "b", F.expr("INTERVAL 1 MINUTE"))).alias("bucket"))
    j = grid.join(bars, ["venue", "bucket"], "left")
    w = Window.partitionBy("venue").orderBy("bucket").rowsBetween(Window.unboundedPreceding, 0)
    close = F.last("close", ignorenulls=True).over(w)
    interp = F.col("open").isNull()
    return j.select(
        "venue", "bucket",
        F.when(interp, close).otherwise(F.col("open")).alias("open"),
        F.when(interp, close).otherwise(F.col("high")).alias("high"),
        F.when(interp, close).otherwise(F.col("low")).alias("low"),
        close.alias("close"),
        F.coalesce("volume", F.lit(0.0)).alias("volume"),
        F.coalesce("buy_volume", F.lit(0.0)).alias("buy_volume"),
        F.coalesce("sell_volume", F.lit(0.0)).alias("sell_volume"),
        F.coalesce("trade_count", F.lit(0)).cast("bigint").alias("trade_count"),
        interp.alias("is_interpolated"))


def test_distributed_grid_equals_naive(spark):
    bars = ohlcv_bars(events_trades(spark, SF01), "1 minute")
    a = continuous_bars(bars)
    b = naive_grid(bars).select(*a.columns)
    assert a.count() == b.count()
    assert a.exceptAll(b).count() == 0 and b.exceptAll(a).count() == 0


def test_volume_identity_and_no_gaps(spark):
    c = continuous_bars(ohlcv_bars(events_trades(spark, SF01), "1 minute"))
    assert c.where(F.abs(F.col("buy_volume") + F.col("sell_volume") - F.col("volume")) > 1e-9).count() == 0
    span = c.groupBy("venue").agg(F.count(F.lit(1)).alias("n"), F.min("bucket").alias("a"), F.max("bucket").alias("b"))
    for r in span.collect():
        assert r["n"] == (r["b"] - r["a"]) // dt.timedelta(minutes=1) + 1


def test_schema_contract(spark):
    from tickwave.operators.candles import CANDLE_COLUMNS, schema_matches
    from tickwave.plans.standins import events_candles
    from tests.paths import SF001
    c = events_candles(spark, SF001, "1 minute")
    assert schema_matches(c)
    assert not schema_matches(c.select(*reversed(CANDLE_COLUMNS)))
    assert not schema_matches(c.withColumn("trade_count", F.col("trade_count").cast("int")))
