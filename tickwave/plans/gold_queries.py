"""Gold analytics on the stand-in candles: bars, grid, spread, episodes."""

from __future__ import annotations

from pyspark.sql import functions as F

from tickwave.functions.text import duration_text, grouped_number, pct_text
from tickwave.operators.bars import ohlcv_bars
from tickwave.operators.islands import islands, islands_session_window
from tickwave.operators.ordered import previous_value
from tickwave.operators.spread import episode_metrics, episode_stats, spread_episodes, venue_spread
from tickwave.plans import sql
from tickwave.plans.registry import register
from tickwave.plans.standins import VENUE_K, VENUE_T, events_candles, events_trades
from tickwave.session import materialize

EP_COLS = "start_local, end_local, minutes, hours, mean_spread_pct, max_spread_pct, area_pct_minutes"


@register("ohlcv_bars", f"""WITH {sql.TRADES}, {sql.bars('15 minutes')}
SELECT venue, bucket, open, high, low, close, volume, buy_volume,
       volume - buy_volume AS sell_volume, trade_count FROM bars""")
def q_ohlcv_bars(spark, sf_dir):
    return ohlcv_bars(events_trades(spark, sf_dir), "15 minutes")


@register("candles_continuous", f"""WITH {sql.TRADES}, {sql.bars('1 minute')}, {sql.grid('1 minute')}
SELECT * FROM candles""")
def q_candles_continuous(spark, sf_dir):
    return events_candles(spark, sf_dir, "1 minute", materialize=False)


@register("episodes_hourly", sql.episodes("60 minutes", 3600, 0.01, 2) + f"\nSELECT {EP_COLS} FROM out")
def q_episodes_hourly(spark, sf_dir):
    c = events_candles(spark, sf_dir, "60 minutes")
    return spread_episodes(c, VENUE_T, VENUE_K, 0.01, min_bars=2, top=None, bar_seconds=3600)


@register("episodes_top20", sql.episodes("15 minutes", 900, 0.01, 5)
          + f"\nSELECT {EP_COLS} FROM out ORDER BY rank_metric DESC, a LIMIT 20")
def q_episodes_top20(spark, sf_dir):
    c = events_candles(spark, sf_dir, "15 minutes")
    return spread_episodes(c, VENUE_T, VENUE_K, 0.01, min_bars=5, top=20, bar_seconds=900)


@register("episodes_session_window", sql.episodes("60 minutes", 3600, 0.01, 2) + f"\nSELECT {EP_COLS} FROM out")
def q_episodes_session_window(spark, sf_dir):
    c = events_candles(spark, sf_dir, "60 minutes")
    s = venue_spread(c, VENUE_T, VENUE_K).where(F.col("spread") > 0.01)
    isl = islands_session_window(s, "timestamp", "spread", 3600)
    return episode_metrics(isl.where(F.col("n") >= 2), 3600).drop("_rank_metric", "_start_utc")


@register("episode_stats", sql.episodes("60 minutes", 3600, 0.01, 2) + """,
top AS (SELECT minutes FROM out ORDER BY rank_metric DESC, a LIMIT 20)
SELECT count(*) AS episodes, round(sum(minutes) / 60.0, 2) AS total_hours,
       CAST(median(minutes) AS DOUBLE) AS median_minutes, round(avg(minutes), 2) AS mean_minutes,
       max(minutes) AS longest_minutes,
       round((SELECT sum(minutes) FROM top) * 100.0 / sum(minutes), 2) AS top_share_pct
FROM out""")
def q_episode_stats(spark, sf_dir):
    c = events_candles(spark, sf_dir, "60 minutes")
    s = venue_spread(c, VENUE_T, VENUE_K).where(F.col("spread") > 0.01)
    ep = episode_metrics(islands(s, "timestamp", "spread", 3600).where(F.col("n") >= 2), 3600)
    return episode_stats(ep, 20)


@register("spread_series", f"""WITH {sql.TRADES}, {sql.bars('15 minutes')}, {sql.grid('15 minutes')}
SELECT t."timestamp", t.close_clp AS close_premium, k.close_clp AS close_base,
       (t.close_clp - k.close_clp) / nullif(k.close_clp, 0) * 100 AS spread_pct
FROM candles t JOIN candles k USING ("timestamp")
WHERE t.exchange = 'venue_t' AND k.exchange = 'venue_k'""")
def q_spread_series(spark, sf_dir):
    """Every common bucket, interpolated ones included (the all-minutes form)."""
    c = events_candles(spark, sf_dir, "15 minutes")
    s = venue_spread(c, VENUE_T, VENUE_K, real_premium_only=False)
    return s.select("timestamp", "close_premium", "close_base",
                    (F.col("spread") * 100).alias("spread_pct"))


@register("flow_imbalance", f"""WITH {sql.TRADES}, {sql.bars('15 minutes')}, {sql.grid('15 minutes')}
SELECT exchange, "timestamp",
       (buy_volume_btc - sell_volume_btc) / nullif(volume_btc, 0) AS imbalance
FROM candles""")
def q_flow_imbalance(spark, sf_dir):
    c = events_candles(spark, sf_dir, "15 minutes", materialize=False)
    return c.select("exchange", "timestamp",
                    F.try_divide(F.col("buy_volume_btc") - F.col("sell_volume_btc"),
                                 F.col("volume_btc")).alias("imbalance"))


@register("activity_density", f"""WITH {sql.TRADES}, {sql.bars('1 minute')}, {sql.grid('1 minute')}
SELECT exchange, CAST("timestamp" AS DATE) AS day, count(*) AS minutes,
       CAST(sum(trade_count) AS BIGINT) AS trades,
       round(avg(trade_count), 6) AS trades_per_minute,
       round(avg(CASE WHEN is_interpolated THEN 0.0 ELSE 1.0 END) * 100, 4) AS active_pct
FROM candles GROUP BY 1, 2""")
def q_activity_density(spark, sf_dir):
    c = events_candles(spark, sf_dir, "1 minute", materialize=False)
    return c.groupBy("exchange", F.to_date("timestamp").alias("day")).agg(
        F.count(F.lit(1)).alias("minutes"),
        F.sum("trade_count").cast("bigint").alias("trades"),
        F.round(F.avg("trade_count"), 6).alias("trades_per_minute"),
        F.round(F.avg(F.when(F.col("is_interpolated"), 0.0).otherwise(1.0)) * 100, 4).alias("active_pct"))


@register("jump_report", f"""WITH {sql.TRADES}, {sql.bars('1 minute')}, {sql.grid('1 minute')},
l AS (SELECT exchange, "timestamp", close_clp,
             LAG(close_clp) OVER (PARTITION BY exchange ORDER BY "timestamp") AS prev_close
      FROM candles)
SELECT exchange, "timestamp", prev_close, close_clp,
       round((close_clp / nullif(prev_close, 0) - 1) * 100, 4) AS change_pct
FROM l WHERE abs(close_clp / nullif(prev_close, 0) - 1) > 0.10""")
def q_jump_report(spark, sf_dir):
    """One-bar moves above 10 %, reported, never filtered out of the table.  A
    filled minute repeats the close before it, so the real bars alone give every
    move and its previous close; no grid is built."""
    bars = materialize(ohlcv_bars(events_trades(spark, sf_dir), "1 minute").select(
        F.col("venue").alias("exchange"), F.col("bucket").alias("timestamp"), F.col("close").alias("close_clp")), "jump_bars")
    p = previous_value(bars, ["exchange"], "timestamp", "close_clp", "prev_close")
    ratio = F.try_divide(F.col("close_clp"), F.col("prev_close")) - 1
    return p.where(F.abs(ratio) > 0.10).select(
        "exchange", "timestamp", "prev_close", "close_clp", F.round(ratio * 100, 4).alias("change_pct"))


@register("ranked_episodes_text", sql.episodes("15 minutes", 900, 0.01, 5) + """,
top AS (SELECT * FROM out ORDER BY rank_metric DESC, a LIMIT 20),
r AS (SELECT *, row_number() OVER (ORDER BY mean_spread_pct DESC, rank_metric DESC, a) AS rank FROM top)
SELECT CAST(rank AS INTEGER) AS rank, strftime(start_local, '%Y-%m-%d %H:%M') AS start_text,
       strftime(end_local, '%Y-%m-%d %H:%M') AS end_text,
       CASE WHEN minutes < 60 THEN CAST(minutes AS VARCHAR) || ' min'
            WHEN minutes % 60 = 0 THEN CAST(minutes // 60 AS VARCHAR) || 'h'
            ELSE printf('%dh %02dm', minutes // 60, minutes % 60) END AS duration_text,
       printf('%.2f%%', mean_spread_pct) AS mean_text, printf('%.2f%%', max_spread_pct) AS max_text,
       format('{:,.1f}', area_pct_minutes) AS area_text,
       strftime(start_local, '%Y-%m-%d') = '2024-01-15' AS highlight
FROM r""")
def q_ranked_episodes_text(spark, sf_dir, highlight_date: str = "2024-01-15"):
    """Presentation table: the top 20 by area re-ranked by mean spread
    (stable), with formatted strings and a highlight flag for one date."""
    c = events_candles(spark, sf_dir, "15 minutes")
    s = venue_spread(c, VENUE_T, VENUE_K).where(F.col("spread") > 0.01)
    ep = episode_metrics(islands(s, "timestamp", "spread", 900).where(F.col("n") >= 5), 900)
    top = ep.orderBy(F.col("_rank_metric").desc(), F.col("_start_utc")).limit(20)
    return rank_episodes_text(top, highlight_date)


def rank_episodes_text(top, highlight_date: str):
    from pyspark.sql import Window
    # bounded input (a top-k list): one ordered window is fine here
    w = Window.orderBy(F.col("mean_spread_pct").desc(), F.col("_rank_metric").desc(), F.col("_start_utc"))
    return top.select(
        F.row_number().over(w).alias("rank"),
        F.date_format("start_local", "yyyy-MM-dd HH:mm").alias("start_text"),
        F.date_format("end_local", "yyyy-MM-dd HH:mm").alias("end_text"),
        duration_text("minutes").alias("duration_text"),
        pct_text("mean_spread_pct").alias("mean_text"),
        pct_text("max_spread_pct").alias("max_text"),
        grouped_number("area_pct_minutes", 1).alias("area_text"),
        (F.date_format("start_local", "yyyy-MM-dd") == F.lit(highlight_date)).alias("highlight"))


