from pyspark.sql import functions as F

from tests.paths import SF001
from tickwave.functions.timefn import epoch_ms
from tickwave.operators.bars import ohlcv_bars
from tickwave.plans.standins import VENUE_T, events_trades
from tickwave.session import scratch_path
from tickwave.sinks.writers import trade_envelopes, write_envelopes
from tickwave.streaming.live_bars import LateRows, current_bars, run_incremental


def test_restart_resumes_and_equals_batch(spark):
    t = events_trades(spark, SF001).where(F.col("venue") == VENUE_T).select(
        F.col("venue").alias("symbol"), epoch_ms("ts").alias("ts_ms"), "trade_id", "amount", "price", "side",
        "ts")
    day = 86_400_000
    rng = t.agg(F.min("ts_ms").alias("a"), F.max("ts_ms").alias("b")).first()
    first = rng["a"] - rng["a"] % day
    periods = spark.range(first, rng["b"] + 1, day).select(
        F.lit(VENUE_T).alias("symbol"), F.col("id").alias("start_ms"), (F.col("id") + day).alias("end_ms"))
    mid = first + 15 * day
    root, out, ckpt = scratch_path(spark, "s-bronze"), scratch_path(spark, "s-out"), scratch_path(spark, "s-ckpt")
    env = trade_envelopes(t.drop("ts"), periods, "2024-02-01T00:00:00+00:00")
    write_envelopes(env.where(F.col("start_ms") < mid), root + "/part1")
    run_incremental(spark, root, out, ckpt, watermark="40 days", max_files=5)
    n1 = spark.read.parquet(out).select("batch_id").distinct().count()
    write_envelopes(env.where(F.col("start_ms") >= mid), root + "/part2")
    run_incremental(spark, root, out, ckpt, watermark="40 days", max_files=5)
    n2 = spark.read.parquet(out).select("batch_id").distinct().count()
    assert n2 > n1 >= 1
    got = current_bars(spark, out)
    want = ohlcv_bars(t.withColumnRenamed("symbol", "venue"), "1 minute").withColumnRenamed("venue", "symbol")
    cols = ["symbol", "bucket", "open", "high", "low", "close", "volume", "buy_volume", "sell_volume", "trade_count"]
    a, b = got.select(*cols), want.select(*cols)
    assert a.count() == b.count()
    assert a.exceptAll(b).count() == 0 and b.exceptAll(a).count() == 0


def test_watermark_removes_old_state(spark):
    """Days far apart: buckets the watermark has passed leave the state."""
    day = 86_400_000
    rows = [("s", 20 * i * day + 1000, i, 1.0, 10.0 + i, "buy") for i in range(5)]
    t = spark.createDataFrame(rows, "symbol string, ts_ms long, trade_id long, amount double, price double, side string")
    root, out, ckpt = scratch_path(spark, "w-bronze"), scratch_path(spark, "w-out"), scratch_path(spark, "w-ckpt")
    for i in range(5):
        p = spark.createDataFrame([("s", 20 * i * day, (20 * i + 1) * day)], "symbol string, start_ms long, end_ms long")
        write_envelopes(trade_envelopes(t, p, "2024-02-01T00:00:00+00:00"), f"{root}/p{i}")
        q = run_incremental(spark, root, out, ckpt)
    state = q.lastProgress["stateOperators"][0]
    assert state["numRowsTotal"] <= 1
    assert current_bars(spark, out).count() == 5


def test_late_rows_are_counted(spark):
    """A file older than the watermark gives a count and leaves the bars alone."""
    day, minute = 86_400_000, 60_000
    ddl = "symbol string, ts_ms long, trade_id long, amount double, price double, side string"
    root, out, ckpt = scratch_path(spark, "l-bronze"), scratch_path(spark, "l-out"), scratch_path(spark, "l-ckpt")

    def land(name, first, rows):
        p = spark.createDataFrame([("s", first * day, (first + 1) * day)], "symbol string, start_ms long, end_ms long")
        write_envelopes(trade_envelopes(spark.createDataFrame(rows, ddl), p, "2024-02-01T00:00:00+00:00"), f"{root}/{name}")

    late = LateRows()
    spark.streams.addListener(late)
    try:
        counts = []
        for name, first, rows in [
                ("a", 0, [("s", 1000, 1, 1.0, 10.0, "buy"), ("s", 5 * minute, 2, 1.0, 11.0, "buy")]),
                ("b", 20, [("s", 20 * day + 1000, 3, 1.0, 12.0, "sell")]),
                ("late", 0, [("s", i * minute + 2000, 4 + i, 9.0, 99.0, "buy") for i in range(3)])]:
            land(name, first, rows)
            counts.append(late.dropped(run_incremental(spark, root, out, ckpt)))
    finally:
        spark.streams.removeListener(late)
    assert counts == [0, 0, 3]
    got = {(r.open, r.high, r.trade_count) for r in current_bars(spark, out).collect()}
    assert got == {(10.0, 10.0, 1), (11.0, 11.0, 1), (12.0, 12.0, 1)}
