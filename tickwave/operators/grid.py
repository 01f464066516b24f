"""Continuous bar grid with forward-filled flat bars (gap expansion).

The pandas way is ``reindex`` to every bucket between the first and last real
bucket followed by a global forward fill.  A global ``Window.orderBy`` would
send a whole series to one task, so instead:

1. Real bars are windowed per ``(keys, span)`` (span = one day by default) and
   each learns the next real bucket with ``lead``.  The gap after the last bar
   of a span comes from a per-``(key, span)`` boundary table (first bucket,
   last bucket and close) and ``lead`` over it per key; that table is bounded
   by the calendar (keys x days), not by the data.
2. Only gaps survive (next bucket further than one step away).  Each gap is
   cut at span edges into segments, the small segment table is re-partitioned
   by ``(keys, span)`` and only then exploded into flat bars, so a long outage
   is filled by many tasks.
3. Real bars pass through untouched; filled bars carry the previous close as
   O=H=L=C with zero volume and count and ``is_interpolated = true``.

The grid starts at the first real bucket of each key, so no leading bar is
ever without a prior close (nothing to drop).
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from tickwave.functions.timefn import bucket_start, interval_of


def interval_expr(width: str):
    """``'15 minutes'`` -> ``INTERVAL '15' MINUTE`` column."""
    return interval_of(width)


def gap_segments(bars: DataFrame, step: str = "1 minute",
                 keys: Sequence[str] = ("venue",), span: str = "1 day",
                 bucket: str = "bucket", close: str = "close") -> DataFrame:
    """Missing-bucket runs between real bars, one row per run and span:
    ``(keys, seg_span, seg_first, seg_last, fill_close)`` (inclusive ends)."""
    one = interval_expr(step)
    real = bars.select(*keys, bucket, close).withColumn("_span", bucket_start(bucket, span))
    w = Window.partitionBy(*keys, "_span").orderBy(bucket)
    nxt = F.lead(bucket).over(w)
    inside = real.select(*keys, (F.col(bucket) + one).alias("_lo"), (nxt - one).alias("_hi"),
                         F.col(close).alias("fill_close"))
    inside = inside.where(F.col("_hi").isNotNull())

    # gaps across span edges: one boundary row per (key, span) -- first bucket,
    # last bucket and its close -- and the next span's first bucket per key
    # (keys x days rows, windowed per key)
    edges = real.groupBy(*keys, "_span").agg(
        F.min(bucket).alias("_first"), F.max(bucket).alias("_last"),
        F.max_by(close, bucket).alias("fill_close"))
    ws = Window.partitionBy(*keys).orderBy("_span")
    across = edges.select(*keys, (F.col("_last") + one).alias("_lo"),
                          (F.lead("_first").over(ws) - one).alias("_hi"), "fill_close")
    across = across.where(F.col("_hi").isNotNull())
    gaps = inside.unionByName(across)
    gaps = gaps.where(F.col("_lo") <= F.col("_hi"))
    span_iv = interval_expr(span)
    # one window() per projection: bucket each end in its own step
    gaps = gaps.withColumn("_slo", bucket_start("_lo", span)).withColumn("_shi", bucket_start("_hi", span))
    segs = gaps.select(
        *keys, "_lo", "_hi", "fill_close",
        F.explode(F.sequence("_slo", "_shi", span_iv)).alias("seg_span"))
    return segs.select(
        *keys, "seg_span",
        F.greatest("_lo", "seg_span").alias("seg_first"),
        F.least("_hi", F.col("seg_span") + span_iv - one).alias("seg_last"),
        "fill_close")


def continuous_bars(bars: DataFrame, step: str = "1 minute",
                    keys: Sequence[str] = ("venue",), span: str = "1 day",
                    bucket: str = "bucket", materialize: bool = True) -> DataFrame:
    """Real bars plus flat filled bars for every empty bucket between the first
    and last real bucket of each key.  Adds ``is_interpolated``.

    Expects bar columns open/high/low/close/volume/buy_volume/sell_volume/
    trade_count (see :func:`tickwave.operators.bars.ohlcv_bars`).

    The real bars feed three branches (pass-through, successor window, span
    firsts), each pruning different columns, so Spark cannot reuse one
    exchange for them.  ``materialize`` writes them once to the shared
    checkpoint folder (:func:`tickwave.session.materialize`) so the raw trades
    are scanned and shuffled once, and lineage is cut for executor loss."""
    if materialize:
        from tickwave.session import materialize as _write_once
        bars = _write_once(bars, "real-bars")
    one = interval_expr(step)
    segs = gap_segments(bars, step, keys, span, bucket)
    filled = (segs.repartition(*keys, "seg_span")
              .select(*keys, F.explode(F.sequence("seg_first", "seg_last", one)).alias(bucket),
                      F.col("fill_close")))
    c = F.col("fill_close")
    zero = F.lit(0.0)
    filled = filled.select(
        *keys, bucket, c.alias("open"), c.alias("high"), c.alias("low"), c.alias("close"),
        zero.alias("volume"), zero.alias("buy_volume"), zero.alias("sell_volume"),
        F.lit(0).cast("bigint").alias("trade_count"), F.lit(True).alias("is_interpolated"))
    real = bars.select(*keys, bucket, "open", "high", "low", "close", "volume", "buy_volume",
                       "sell_volume", F.col("trade_count").cast("bigint").alias("trade_count"),
                       F.lit(False).alias("is_interpolated"))
    return real.unionByName(filled)
