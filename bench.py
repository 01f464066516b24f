"""Benchmark the headline queries.

Steady-state timing: one untimed pass over every query at ``$BENCH_SF_DIR``
(JIT and code generation warm-up, which a long cluster job amortises), then a
second pass in which each full execution (``write.format("noop")``: every row computed, nothing
collected) is timed, on ``local[$BENCH_CPUS]``.  The Silver jobs are timed the
way the published baseline is: from landed Bronze files to the written
table.  Prints one JSON line.
"""

from __future__ import annotations

import json
import os
import sys
import time

sys.path.insert(0, os.path.dirname(os.path.abspath(__file__)))

HEADLINE = [
    "ohlcv_bars",
    "candles_continuous",
    "episodes_top20",
    "episodes_hourly",
    "jump_report",
    "fx_daily_filled",
    "fx_convert_local_date",
    "fx_asof",
    "interval_verdict",
]


def silver_jobs(spark, sf_dir: str, times: dict) -> dict:
    """The Silver jobs as the baseline times them: from landed Bronze files to
    the written candle table (Bronze preparation is not timed)."""
    from tickwave.operators.fx import fill_daily
    from tickwave.plans import bronze_queries as B
    from tickwave.plans import silver
    from tickwave.plans.standins import VENUE_K, VENUE_T, event_rates
    from tickwave.session import materialize, scratch_path
    trades_bronze = B._trade_bronze(spark, sf_dir)
    klines_bronze = B._kline_bronze(spark, sf_dir)
    from tickwave.plans.io_queries import _rate_envelope
    rate_env = _rate_envelope(spark, sf_dir)
    rates = materialize(fill_daily(event_rates(spark, sf_dir)), "bench-rates")
    out = {}
    t0 = time.perf_counter()
    m = silver.run_refresh(silver.trades_to_candles(spark, trades_bronze, VENUE_T),
                           scratch_path(spark, "bench-silver"), VENUE_T)
    times["job_trades_to_candles"] = round(time.perf_counter() - t0, 3)
    out["job_trades_to_candles_candles"] = round(m["rows_out"] / times["job_trades_to_candles"])
    t0 = time.perf_counter()
    m = silver.run_klines_refresh(spark, klines_bronze, rates, scratch_path(spark, "bench-silver"), VENUE_K)
    times["job_klines_to_candles"] = round(time.perf_counter() - t0, 3)
    out["job_klines_to_candles_candles"] = round(m["rows_out"] / times["job_klines_to_candles"])
    t0 = time.perf_counter()
    m = silver.run_rates(silver.rates_from_envelope(spark, rate_env), scratch_path(spark, "bench-rates-out"))
    times["job_rates_fill"] = round(time.perf_counter() - t0, 3)
    out["job_rates_fill_days"] = round(m["rows_total"] / times["job_rates_fill"])
    return out


def scale_point(spark, sf_dir: str, target_trades: int = 2_670_000) -> dict:
    """Job A at the published baseline's size: the stand-in trades repeated in
    time-shifted copies (31 days apart, ids offset) up to ~2.67 M trades, landed
    as weekly envelopes (untimed), then trades -> written candle table, timed."""
    import math

    from pyspark.sql import functions as F

    from tickwave.functions.timefn import epoch_ms
    from tickwave.plans import silver
    from tickwave.plans.standins import VENUE_T, events_trades
    from tickwave.session import materialize, scratch_path
    from tickwave.sinks.writers import trade_envelopes, write_envelopes
    t = events_trades(spark, sf_dir).where(F.col("venue") == VENUE_T).select(
        F.col("venue").alias("symbol"), epoch_ms("ts").alias("ts_ms"), "trade_id", "amount", "price", "side")
    n = t.count()
    copies = max(1, min(60, math.ceil(target_trades / max(n, 1))))
    shift, week = 31 * 86_400_000, 7 * 86_400_000
    big = t.withColumn("rep", F.explode(F.sequence(F.lit(0).cast("bigint"), F.lit(copies - 1).cast("bigint")))).select(
        "symbol", (F.col("ts_ms") + F.col("rep") * shift).alias("ts_ms"),
        (F.col("trade_id") + F.col("rep") * 1_000_000_000).alias("trade_id"), "amount", "price", "side")
    big = materialize(big, "scale-trades")
    rng = big.agg(F.min("ts_ms").alias("a"), F.max("ts_ms").alias("b")).first()
    first = rng["a"] - rng["a"] % week
    periods = spark.range(first, rng["b"] + 1, week).select(
        F.lit(VENUE_T).alias("symbol"), F.col("id").alias("start_ms"), (F.col("id") + week).alias("end_ms"))
    bronze = scratch_path(spark, "scale-bronze")
    write_envelopes(trade_envelopes(big, periods, "2024-02-01T00:00:00+00:00"), bronze)
    t0 = time.perf_counter()
    m = silver.run_refresh(silver.trades_to_candles(spark, bronze, VENUE_T), scratch_path(spark, "scale-silver"),
                           VENUE_T)
    sec = time.perf_counter() - t0
    return {"trades": n * copies, "files": periods.count(), "candles": m["rows_out"], "sec": round(sec, 3),
            "candles_per_sec": round(m["rows_out"] / sec), "trades_per_sec": round(n * copies / sec)}


def scale_point_klines(spark, sf_dir: str, target_klines: int = 4_567_534) -> dict:
    """Job B at the published size: the stand-in 1-minute klines and their
    daily rate series repeated in 31-day shifted copies (the rate series of
    one copy covers exactly 31 local dates, so copies tile without overlap) up
    to ~4.57 M klines, landed as monthly envelopes (untimed); then klines ->
    dedup -> grid -> rate of the Santiago date -> written table, timed."""
    import math

    from pyspark.sql import functions as F

    from tickwave.functions.timefn import epoch_ms, ms_to_ts
    from tickwave.operators.bars import ohlcv_bars
    from tickwave.operators.fx import fill_daily
    from tickwave.plans import silver
    from tickwave.plans.standins import VENUE_K, event_rates, events_trades
    from tickwave.session import materialize, scratch_path
    from tickwave.sinks.writers import kline_envelopes, write_envelopes
    b = ohlcv_bars(events_trades(spark, sf_dir).where(F.col("venue") == VENUE_K), "1 minute")
    k = b.select(F.col("venue").alias("symbol"), epoch_ms("bucket").alias("open_time_ms"),
                 "open", "high", "low", "close", "volume", "trade_count", "buy_volume")
    k = materialize(k, "scale-k0")
    n = k.count()
    copies = max(1, min(150, math.ceil(target_klines / max(n, 1))))
    shift = 31 * 86_400_000
    rep = F.explode(F.sequence(F.lit(0).cast("bigint"), F.lit(copies - 1).cast("bigint")))
    big = k.withColumn("rep", rep).withColumn("open_time_ms", F.col("open_time_ms") + F.col("rep") * shift) \
        .withColumn("close_time_ms", F.col("open_time_ms") + 59_999).drop("rep")
    big = materialize(big, "scale-klines")
    r0 = event_rates(spark, sf_dir)
    rates = r0.withColumn("rep", F.explode(F.sequence(F.lit(0), F.lit(copies - 1)))) \
        .select(F.date_add("date", F.col("rep") * 31).alias("date"), "rate")
    rates = materialize(fill_daily(rates), "scale-rates")
    month = F.trunc(F.to_date(ms_to_ts("open_time_ms")), "month")
    months = big.select(month.alias("m")).distinct()
    start = epoch_ms(F.col("m").cast("timestamp_ntz"))
    periods = months.select(F.lit(VENUE_K).alias("symbol"), start.alias("start_ms"),
                            epoch_ms(F.add_months("m", 1).cast("timestamp_ntz")).alias("end_ms"))
    periods = materialize(periods, "scale-kperiods")
    bronze = scratch_path(spark, "scale-kbronze")
    write_envelopes(kline_envelopes(big, periods, "2024-02-01T00:00:00+00:00"), bronze)
    t0 = time.perf_counter()
    m = silver.run_klines_refresh(spark, bronze, rates, scratch_path(spark, "scale-ksilver"), VENUE_K)
    sec = time.perf_counter() - t0
    return {"klines": n * copies, "files": periods.count(), "candles": m["rows_out"], "sec": round(sec, 3),
            "candles_per_sec": round(m["rows_out"] / sec)}


def main() -> None:
    sf_dir = os.environ.get("BENCH_SF_DIR", "/root/testdata/sf0.1")
    cpus = int(os.environ.get("BENCH_CPUS", "8"))
    from tickwave.session import build_session
    spark = build_session(master=f"local[{cpus}]", shuffle_partitions=max(cpus * 2, 8),
                          app="tickwave-bench", driver_memory=os.environ.get("BENCH_MEM", "8g"))
    from tickwave.plans.registry import QUERIES, load_all
    load_all()
    names = [n for n in HEADLINE if n in QUERIES]
    times: dict[str, float] = {}
    for n in names:  # warm-up pass over everything
        QUERIES[n](spark, sf_dir).write.format("noop").mode("overwrite").save()
    silver_jobs(spark, sf_dir, {})
    for n in names:  # timed pass
        t0 = time.perf_counter()
        QUERIES[n](spark, sf_dir).write.format("noop").mode("overwrite").save()
        times[n] = round(time.perf_counter() - t0, 3)
    rates = silver_jobs(spark, sf_dir, times)
    on = os.environ.get("BENCH_SCALE_POINT", "1") == "1"
    scale = scale_point(spark, sf_dir) if on else None
    scale_k = scale_point_klines(spark, sf_dir) if on else None
    sf = os.path.basename(sf_dir.rstrip("/")).replace("sf", "")
    print(json.dumps({"metric": "headline_total_sec", "value": round(sum(times.values()), 3),
                      "unit": "sec", "queries": times, "sf": sf, "rows_per_sec": rates,
                      "baseline_size_trades_to_candles": scale,
                      "baseline_size_klines_to_candles": scale_k}))
    spark.stop()


if __name__ == "__main__":
    main()
