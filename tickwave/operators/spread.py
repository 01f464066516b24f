"""Inter-venue spread and sustained-premium episodes (the gold query)."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tickwave.functions.timefn import LOCAL_ZONE, local_wallclock
from tickwave.operators.islands import islands


# Partition columns of the candle table, derived from the time.
PARTITIONS = ("year", "month")


def venue_spread(candles: DataFrame, premium_venue: str, base_venue: str,
                 keys: Sequence[str] = (), real_premium_only: bool = True,
                 ts: str = "timestamp", venue: str = "exchange",
                 close: str = "close_clp") -> DataFrame:
    """Relative spread ``(P - B) / B`` per bucket where both venues have a
    candle.  The premium side keeps real buckets only (an interpolated bucket is
    absence of liquidity, not a premium); the base side keeps every bucket.

    The venue filters sit on the scan (partition pruning when ``exchange`` is a
    partition column) and the equi-join is on ``(keys, ts)``, with ``year`` and
    ``month`` where the candles have them: a bound on either side's months is then
    inferred for the other, and both scans are pruned by it.  A base close of 0
    gives NULL (``try_divide``), which never passes a threshold."""
    keys = list(keys)
    p = candles.where(F.col(venue) == premium_venue)
    if real_premium_only:
        p = p.where(~F.col("is_interpolated"))
    # a time has one year and month, so these keys change no row
    on = [*keys, *[c for c in PARTITIONS if c in candles.columns and c not in keys], ts]
    p = p.select(*on, F.col(close).alias("close_premium"))
    b = candles.where(F.col(venue) == base_venue).select(*on, F.col(close).alias("close_base"))
    j = p.join(b, on)
    return j.withColumn("spread", F.try_divide(F.col("close_premium") - F.col("close_base"),
                                               F.col("close_base")))


def spread_episodes(candles: DataFrame, premium_venue: str, base_venue: str,
                    threshold: float = 0.01, min_bars: int = 5, top: int | None = 20,
                    bar_seconds: int = 60, keys: Sequence[str] = (),
                    zone: str = LOCAL_ZONE, ts: str = "timestamp", venue: str = "exchange",
                    close: str = "close_clp", span: str = "1 day") -> DataFrame:
    """Episodes of consecutive buckets (exactly one bar apart) with spread
    strictly above ``threshold``, at least ``min_bars`` long, ranked by
    ``duration x mean spread`` (ties: earlier start first), top ``top``.

    Columns: keys, start_local, end_local (wall clock in ``zone``), minutes,
    hours, mean_spread_pct, max_spread_pct, area_pct_minutes."""
    keys = list(keys)
    s = venue_spread(candles, premium_venue, base_venue, keys, True, ts, venue, close)
    s = s.where(F.col("spread") > F.lit(threshold))
    isl = islands(s, ts, "spread", bar_seconds, keys, span)
    ep = episode_metrics(isl.where(F.col("n") >= min_bars), bar_seconds, keys, zone)
    if top is not None:
        ep = ep.orderBy(F.col("_rank_metric").desc(), F.col("_start_utc").asc(), *keys).limit(top)
    return ep.drop("_rank_metric", "_start_utc")


def episode_metrics(isl: DataFrame, bar_seconds: int, keys: Sequence[str] = (),
                    zone: str = LOCAL_ZONE) -> DataFrame:
    minutes = (F.col("n") * F.lit(bar_seconds) / F.lit(60)).cast("bigint")
    mean = F.col("v_sum") / F.col("n")
    return isl.select(
        *keys,
        local_wallclock("island_start", zone).alias("start_local"),
        local_wallclock("island_end", zone).alias("end_local"),
        minutes.alias("minutes"),
        F.round(minutes / F.lit(60.0), 2).alias("hours"),
        F.round(mean * 100, 2).alias("mean_spread_pct"),
        F.round(F.col("v_max") * 100, 2).alias("max_spread_pct"),
        F.round(minutes * mean * 100, 1).alias("area_pct_minutes"),
        (minutes * mean).alias("_rank_metric"),
        F.col("island_start").alias("_start_utc"),
    )


def episode_stats(episodes_all: DataFrame, top: int = 20) -> DataFrame:
    """Headline numbers over all episodes (not only the top list): count, total
    hours, median and mean minutes, longest, and the top-``top`` share of the
    total duration (top by area)."""
    totals = episodes_all.agg(
        F.count(F.lit(1)).alias("episodes"),
        F.round(F.sum("minutes") / F.lit(60.0), 2).alias("total_hours"),
        F.median("minutes").cast("double").alias("median_minutes"),
        F.round(F.avg("minutes"), 2).alias("mean_minutes"),
        F.max("minutes").alias("longest_minutes"),
        F.sum("minutes").alias("_total_minutes"),
    ).withColumn("_k", F.lit(1))
    top_minutes = (episodes_all.orderBy(F.col("_rank_metric").desc(), F.col("_start_utc").asc())
                   .limit(top).agg(F.sum("minutes").alias("_top_minutes"))
                   .withColumn("_k", F.lit(1)))
    return totals.join(top_minutes, "_k").select(
        "episodes", "total_hours", "median_minutes", "mean_minutes", "longest_minutes",
        F.round(F.try_divide(F.col("_top_minutes") * 100.0, F.col("_total_minutes")), 2)
        .alias("top_share_pct"))
