"""Silver jobs: Bronze envelopes -> continuous unified candles / daily rates.

Each job is a lazy DataFrame plan plus a writer; the jobs' only eager steps are
bounded checks (a rate coverage probe that returns at most 10 dates, a
non-empty check on the rate file) and the final write, whose run summary is
collected with ``observe`` in the same pass.
"""

from __future__ import annotations

import time

from pyspark.sql import DataFrame, Observation, SparkSession
from pyspark.sql import functions as F

from tickwave.operators.bars import ohlcv_bars
from tickwave.operators.candles import to_unified
from tickwave.operators.dedup import keep_latest
from tickwave.functions.timefn import LOCAL_ZONE, local_date
from tickwave.operators.fx import (
    convert_by_local_date,
    fill_daily,
    latest_per_date,
)
from tickwave.operators.grid import continuous_bars
from tickwave.session import materialize
from tickwave.sinks.writers import write_candles_refresh, write_rates
from tickwave.sources import schemas as S
from tickwave.sources.bronze import assert_rates_present, decode_klines, decode_trades, rate_rows, read_json_docs


def trades_to_candles(spark: SparkSession, bronze_path: str, venue: str,
                      width: str = "1 minute", counts: Observation | None = None) -> DataFrame:
    """Trade envelopes of one symbol -> continuous candles for ``venue``.  The
    candle contract has no symbol, so several symbols are refused.  ``counts``
    observes the trades read, in the same pass."""
    env = read_json_docs(spark, bronze_path, S.TRADE_ENVELOPE_DDL)
    trades = decode_trades(env).drop("file")
    if counts is not None:
        trades = trades.observe(counts, F.count(F.lit(1)).alias("rows_in"))
    bars = _one_symbol(materialize(ohlcv_bars(trades, width, keys=["symbol"]), "trade-bars"), venue)
    return to_unified(continuous_bars(bars, width, keys=["symbol"], materialize=False), exchange=venue)


def _one_symbol(bars: DataFrame, venue: str) -> DataFrame:
    """``bars`` (stored) if they hold at most one symbol: the candle table is
    keyed by ``(timestamp, exchange)``, and a second symbol would repeat its keys."""
    r = bars.agg(F.min("symbol").alias("a"), F.max("symbol").alias("b")).first()
    if r["a"] != r["b"]:
        raise ValueError(f"candles of {venue}: more than one symbol ({r['a']}, {r['b']}, ...); write each to its own venue")
    return bars


def klines_usdt(spark: SparkSession, bronze_path: str) -> tuple[DataFrame, DataFrame]:
    """Kline envelopes -> de-duplicated on-grid klines (latest ingestion wins)
    and the off-grid rows that the minute grid drops (reported, not kept)."""
    k = _klines_latest(spark, bronze_path)
    return k.where(_on_grid()), k.where(~_on_grid())


def _klines_latest(spark: SparkSession, bronze_path: str, read: Observation | None = None) -> DataFrame:
    env = read_json_docs(spark, bronze_path, S.KLINE_ENVELOPE_DDL)
    k = decode_klines(env)
    if read is not None:
        k = k.observe(read, F.count(F.lit(1)).alias("rows_in"))
    return keep_latest(k, ["symbol", "open_time_ms"], ["ingestion_ts", "file"]).drop("file")


def _on_grid():
    return F.col("open_time_ms") % 60000 == 0


def klines_real_bars(spark: SparkSession, bronze_path: str, counts: Observation | None = None,
                     read: Observation | None = None) -> DataFrame:
    """De-duplicated on-grid klines as bars, written once to the shared
    checkpoint folder (they feed the grid's branches and the coverage probe).
    ``counts`` observes in the same pass the klines left after de-duplication
    and those among them that lie off the minute grid and are not kept; ``read``
    observes the klines before de-duplication."""
    k = _klines_latest(spark, bronze_path, read)
    if counts is not None:
        k = k.observe(counts, F.count(F.lit(1)).alias("klines"),
                      F.count(F.when(~_on_grid(), 1)).alias("off_grid"))
    k = k.where(_on_grid())
    bars = k.select("symbol", F.col("ts").alias("bucket"), "open", "high", "low", "close", "volume",
                    "buy_volume", (F.col("volume") - F.col("buy_volume")).alias("sell_volume"),
                    "trade_count")
    return materialize(bars, "kline-bars")


def klines_grid_usdt(spark: SparkSession, bronze_path: str, bars: DataFrame | None = None) -> DataFrame:
    bars = _one_symbol(bars if bars is not None else klines_real_bars(spark, bronze_path), "klines")
    return continuous_bars(bars, "1 minute", keys=["symbol"], materialize=False)


def klines_to_candles(spark: SparkSession, bronze_path: str, daily_rates: DataFrame,
                      venue: str, bars: DataFrame | None = None) -> DataFrame:
    """Klines in USDT -> continuous grid filled in USDT -> converted with the
    rate of each minute's Santiago date (fill first, convert after, as the
    reference does) -> unified candles.  A minute without a rate fails the job
    in-line; :func:`run_klines_refresh` checks coverage before writing."""
    grid = klines_grid_usdt(spark, bronze_path, bars)
    conv = convert_by_local_date(grid, daily_rates, "bucket", ["open", "high", "low", "close"])
    return to_unified(conv, exchange=venue)


def missing_grid_dates(bars: DataFrame, daily_rates: DataFrame, keys=("symbol",), bucket: str = "bucket",
                       zone: str = LOCAL_ZONE, limit: int = 10) -> DataFrame:
    """Local dates the continuous grid will need but the rate table lacks.

    The grid is continuous from each key's first to last real bar, so the
    dates it needs are exactly the calendar dates between the local dates of
    those two instants: a calendar-sized check on two aggregates of the real
    bars, not a pass over the grid."""
    rng = bars.groupBy(*keys).agg(F.min(bucket).alias("_a"), F.max(bucket).alias("_b"))
    need = rng.select(F.explode(F.sequence(local_date("_a", zone), local_date("_b", zone))).alias("local_date")) \
        .distinct()
    have = daily_rates.select(F.col("date").alias("local_date"))
    return need.join(have, "local_date", "left_anti").orderBy("local_date").limit(limit)


def run_klines_refresh(spark: SparkSession, bronze_path: str, daily_rates: DataFrame,
                       silver_root: str, venue: str) -> dict:
    """Job B.  Rate coverage is checked *before* the venue's refresh starts, so that
    nothing is written in vain: the check needs only the real bars' first and last
    instants, and raises naming up to 10 missing Santiago dates.  The in-line
    check inside the conversion stays as a safety net."""
    counts, read = Observation(f"klines_{venue}"), Observation(f"klines_read_{venue}")
    bars = klines_real_bars(spark, bronze_path, counts, read)
    missing = [r["local_date"] for r in missing_grid_dates(bars, daily_rates).collect()]  # <= 10 rows
    if missing:
        raise ValueError("rate coverage gap; missing local dates (up to 10 shown): "
                         + ", ".join(str(d) for d in missing))
    seen, rows_in = counts.get, read.get["rows_in"]
    return run_refresh(klines_to_candles(spark, bronze_path, daily_rates, venue, bars), silver_root, venue,
                       before={"rows_in": rows_in, "duplicates": rows_in - seen["klines"], "klines": seen["klines"],
                               "off_grid": seen["off_grid"]})


def run_trades_refresh(spark: SparkSession, bronze_path: str, silver_root: str, venue: str,
                       width: str = "1 minute") -> dict:
    """Job A with the same report: trade envelopes -> candles -> committed refresh."""
    counts = Observation(f"trades_{venue}")
    candles = trades_to_candles(spark, bronze_path, venue, width, counts)
    return run_refresh(candles, silver_root, venue, width, before={"rows_in": counts.get["rows_in"], "duplicates": 0, "off_grid": 0})


def rates_from_envelope(spark: SparkSession, path: str, max_back_days: int = 7) -> DataFrame:
    """Rate envelope -> every calendar day, last-wins on repeated dates."""
    env = read_json_docs(spark, path, S.RATE_ENVELOPE_DDL)
    assert_rates_present(env)
    src = latest_per_date(rate_rows(env), order="pos")
    return fill_daily(src, max_back_days)


def run_refresh(candles: DataFrame, silver_root: str, venue: str, width: str = "1 minute",
                before: dict | None = None) -> dict:
    """Write one venue's refresh and return the run report (one pass).  ``width`` is
    the bars' width, ``before`` what was counted on the way to the candles.  The
    commit of the refresh records the same figures: rows in, duplicates and
    off-grid rows left out, rows out, inserted rows, months and files written and
    candles that contradict themselves."""
    t0 = time.perf_counter()
    obs = Observation(f"refresh_{venue}")

    def figures() -> dict:
        m = obs.get
        rows, filled = m.get("rows") or 0, m.get("interpolated") or 0
        return {**(before or {}), "rows_out": rows, "interpolated": filled,
                "pct_interpolated": round(100.0 * filled / rows, 4) if rows else 0.0,
                "range_start": str(m.get("first")), "range_end": str(m.get("last")), "broken": m.get("broken") or 0}

    done = write_candles_refresh(candles, silver_root, venue, obs, width, figures=figures)
    return {"venue": venue, **done.figures, "months": len(done.months), "files": done.files,
            "elapsed_seconds": round(time.perf_counter() - t0, 2)}


def run_rates(filled: DataFrame, path: str) -> dict:
    obs = Observation("rates")
    f = filled.observe(obs, F.count(F.lit(1)).alias("rows"),
                       F.sum(F.col("is_ffilled").cast("bigint")).alias("filled"))
    write_rates(f, path)
    m = obs.get
    rows = m.get("rows") or 0
    return {"rows_total": rows, "rows_ffilled": m.get("filled") or 0,
            "pct_ffilled": round(100.0 * (m.get("filled") or 0) / rows, 2) if rows else 0.0}


