import os

from pyspark.sql import functions as F

from tests.paths import SF001
from tickwave.plans.standins import VENUE_K, VENUE_T, events_candles
from tickwave.session import scratch_path
from tickwave.sinks.writers import read_candles, write_candles_refresh


def _files(root):
    out = {}
    for d, _, fs in os.walk(root):
        for f in fs:
            if f.endswith(".parquet"):
                p = os.path.join(d, f)
                out[p] = os.stat(p).st_mtime_ns
    return out


def test_refresh_one_venue_keeps_the_other(spark):
    c = events_candles(spark, SF001, "1 minute")
    root = scratch_path(spark, "t-silver").replace("file:", "")
    write_candles_refresh(c, root, VENUE_T)
    write_candles_refresh(c, root, VENUE_K)
    k_before = {p: m for p, m in _files(root).items() if f"exchange={VENUE_K}" in p}
    # refresh T from a shorter input: its later months/rows must disappear
    write_candles_refresh(c.where(F.col("timestamp") < "2024-01-10"), root, VENUE_T)
    k_after = {p: m for p, m in _files(root).items() if f"exchange={VENUE_K}" in p}
    assert k_before == k_after and k_before
    t = read_candles(spark, root).where(F.col("exchange") == VENUE_T)
    assert t.agg(F.max("timestamp")).first()[0] < __import__("datetime").datetime(2024, 1, 10)
    assert read_candles(spark, root).where(F.col("exchange") == VENUE_K).count() == \
        c.where(F.col("exchange") == VENUE_K).count()
    assert any("month=01" in p for p in k_after)


def test_splitting_bronze_files_does_not_change_candles(spark):
    """Metamorphic: the same trades landed as daily files or as 7-hour files
    (period edges anywhere in the day) give identical Silver candles."""
    from tickwave.functions.timefn import epoch_ms
    from tickwave.plans import silver
    from tickwave.plans.standins import events_trades
    from tickwave.sinks.writers import trade_envelopes, write_envelopes
    t = events_trades(spark, SF001).where(F.col("venue") == VENUE_T).select(
        F.col("venue").alias("symbol"), epoch_ms("ts").alias("ts_ms"), "trade_id", "amount", "price", "side")
    rng = t.agg(F.min("ts_ms").alias("a"), F.max("ts_ms").alias("b")).first()
    out = []
    for step in (86_400_000, 7 * 3_600_000):
        first = rng["a"] - rng["a"] % step
        periods = spark.range(first, rng["b"] + 1, step).select(
            F.lit(VENUE_T).alias("symbol"), F.col("id").alias("start_ms"), (F.col("id") + step).alias("end_ms"))
        path = scratch_path(spark, "split")
        write_envelopes(trade_envelopes(t, periods, "2024-02-01T00:00:00+00:00"), path)
        out.append(silver.trades_to_candles(spark, path, VENUE_T))
    a, b = out
    assert a.count() == b.count() > 0
    assert a.exceptAll(b).count() == 0 and b.exceptAll(a).count() == 0


def test_dynamic_overwrite_replaces_only_given_partitions(spark):
    import datetime as dt
    from tickwave.operators.candles import CANDLE_SCHEMA
    from tickwave.sinks.writers import write_candles_dynamic

    def rows(venue, month, close):
        return [(dt.datetime(2024, month, d, 0, 0), venue, close, close, close, close, 1.0, 0.5, 0.5, 1, False)
                for d in (1, 2)]
    root = scratch_path(spark, "t-dyn").replace("file:", "")
    first = rows("a", 1, 1.0) + rows("a", 2, 1.0) + rows("b", 1, 1.0)
    write_candles_dynamic(spark.createDataFrame(first, CANDLE_SCHEMA), root)
    b_before = {p: m for p, m in _files(root).items() if "exchange=b" in p}
    write_candles_dynamic(spark.createDataFrame(rows("a", 2, 9.0), CANDLE_SCHEMA), root)
    got = {(r["exchange"], r["month"]): r["c"] for r in read_candles(spark, root).groupBy("exchange", "month")
           .agg(F.max("close_clp").alias("c")).collect()}
    assert got == {("a", 1): 1.0, ("a", 2): 9.0, ("b", 1): 1.0}
    assert {p: m for p, m in _files(root).items() if "exchange=b" in p} == b_before


def test_files_are_sorted_by_time(spark, tmp_path):
    import glob
    import pyarrow.parquet as pq
    from tickwave.operators.candles import CANDLE_COLUMNS
    from tickwave.sinks.writers import write_candles_refresh
    hours = spark.range(4000).select(F.expr("timestamp_ntz'2024-01-01' + make_dt_interval(0, int(id), 0, 0)").alias("timestamp"))
    cols = [F.lit("v").alias(c) if c == "exchange" else F.lit(False).alias(c) if c == "is_interpolated" else F.lit(1.0).alias(c)
            for c in CANDLE_COLUMNS if c != "timestamp"]
    write_candles_refresh(hours.select("timestamp", *cols).orderBy(F.rand(3)), str(tmp_path), "v")
    files = glob.glob(f"{tmp_path}/exchange=v/snapshot=*/*/*/*/*.parquet")
    assert len(files) > 3
    for f in files:
        t = pq.read_table(f, partitioning=None)["timestamp"].to_pylist()
        assert t == sorted(t)
