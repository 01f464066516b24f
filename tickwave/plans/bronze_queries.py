"""Bronze round trips and Silver jobs over envelopes built from the tables.

Each query writes its envelopes (and Silver output) under a fresh folder of the
shared checkpoint directory, then reads them back through the same readers a
production job uses."""

from __future__ import annotations

from functools import reduce

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tickwave.functions.timefn import epoch_ms
from tickwave.operators.bars import ohlcv_bars
from tickwave.operators.candles import CANDLE_COLUMNS
from tickwave.operators.fx import fill_daily
from tickwave.operators.quality import envelope_ranges, ingest_health, interval_verdict
from tickwave.plans import silver, sql
from tickwave.plans.registry import register
from tickwave.plans.standins import VENUE_K, VENUE_T, day_periods, event_rates, events_candles, events_trades
from tickwave.session import materialize, scratch_path
from tickwave.sinks.writers import (
    kline_envelopes,
    read_candles,
    trade_envelopes,
    write_candles_refresh,
    write_envelopes,
)
from tickwave.sources import schemas as S
from tickwave.sources.bronze import decode_trades, read_json_docs

INGESTED = "2024-02-01T00:00:00+00:00"
REINGESTED = "2024-02-02T00:00:00+00:00"
# Every venue of the stand-in tape.
ALL_VENUES = (VENUE_T, VENUE_K)


def _periods(spark, sf_dir, venues, extra_days=0):
    return reduce(DataFrame.unionByName, [day_periods(spark, sf_dir, v, extra_days) for v in venues])


def _with_health(periods):
    """What a fetcher would note of each period: two nominal rates, throttled
    requests on some days, and a time that now and then is missing."""
    day = F.floor(F.col("start_ms") / 86_400_000)
    return (periods.withColumn("nominal_rps", F.when(day % 2 == 0, 0.5).otherwise(1.0))
            .withColumn("throttle_429_events", (day % 3).cast("bigint"))
            .withColumn("wall_clock_seconds", F.when(day % 5 != 0, (day % 7 + 4).cast("double"))))


def _trade_bronze(spark, sf_dir, extra_days=0, venues=(VENUE_T,)):
    t = events_trades(spark, sf_dir).where(F.col("venue").isin(*venues))
    t = t.select(F.col("venue").alias("symbol"), epoch_ms("ts").alias("ts_ms"), "trade_id", "amount",
                 "price", "side")
    path = scratch_path(spark, "bronze-trades")
    env = trade_envelopes(t, _with_health(_periods(spark, sf_dir, venues, extra_days)), INGESTED)
    write_envelopes(env, path)
    return path


def _kline_bronze(spark, sf_dir, venues=(VENUE_K,), off_grid=False):
    b = ohlcv_bars(events_trades(spark, sf_dir).where(F.col("venue").isin(*venues)), "1 minute")
    k = b.select(F.col("venue").alias("symbol"), epoch_ms("bucket").alias("open_time_ms"),
                 (epoch_ms("bucket") + 59_999).alias("close_time_ms"),
                 "open", "high", "low", "close", "volume", "trade_count", "buy_volume")
    if off_grid:  # every tenth minute once more, half a minute late
        late = k.where(F.col("open_time_ms") % 600_000 == 0)
        k = k.unionByName(late.withColumn("open_time_ms", F.col("open_time_ms") + 30_000))
    k = materialize(k, "klines-src")
    path = scratch_path(spark, "bronze-klines")
    periods = _periods(spark, sf_dir, venues)
    write_envelopes(kline_envelopes(k, periods, INGESTED), path + "/run1")
    # a second ingestion run re-fetches the first day: the same open times
    # arrive twice and the later ingestion must win
    first = periods.groupBy("symbol").agg(F.min("start_ms").alias("start_ms"),
                                          F.min_by("end_ms", "start_ms").alias("end_ms"))
    write_envelopes(kline_envelopes(k, first, REINGESTED), path + "/run2")
    return path


def q_bronze_roundtrip_trades(spark, sf_dir, venues=(VENUE_T,)):
    """Trades -> per-day envelopes (JSON, text tuples) -> read back and decode
    with strict casts: every trade returns once, at millisecond precision."""
    path = _trade_bronze(spark, sf_dir, venues=venues)
    back = decode_trades(read_json_docs(spark, path, S.TRADE_ENVELOPE_DDL))
    return back.select("symbol", "ts", "trade_id", "price", "amount", "side")


@register("bronze_roundtrip_trades", f"""WITH {sql.TRADES}
SELECT venue AS symbol, date_trunc('millisecond', ts) AS ts, trade_id, price, amount, side FROM trades""")
def q_bronze_roundtrip_trades_all(spark, sf_dir):
    """The same over every venue."""
    return q_bronze_roundtrip_trades(spark, sf_dir, ALL_VENUES)


def q_bronze_roundtrip_klines(spark, sf_dir, venues=(VENUE_K,)):
    """Klines -> envelopes (one day ingested twice) -> decode -> keep latest."""
    k, _ = silver.klines_usdt(spark, _kline_bronze(spark, sf_dir, venues))
    return k.select("symbol", "ts", "open", "high", "low", "close", "volume", "trade_count", "buy_volume")


@register("bronze_roundtrip_klines", f"""WITH {sql.TRADES}, {sql.bars('1 minute')}
SELECT venue AS symbol, bucket AS ts, open, high, low, close, volume, trade_count, buy_volume FROM bars""")
def q_bronze_roundtrip_klines_all(spark, sf_dir):
    """The same over every venue."""
    return q_bronze_roundtrip_klines(spark, sf_dir, ALL_VENUES)


@register("trades_to_candles", f"""WITH {sql.TRADES}, {sql.bars('1 minute')}, {sql.grid('1 minute')}
SELECT * FROM candles WHERE exchange = 'venue_t'""")
def q_trades_to_candles(spark, sf_dir):
    """Silver job A end to end: envelopes -> candles -> venue refresh of the
    shared table -> read back."""
    bronze = _trade_bronze(spark, sf_dir)
    root = scratch_path(spark, "silver-candles")
    silver.run_refresh(silver.trades_to_candles(spark, bronze, VENUE_T), root, VENUE_T)
    return read_candles(spark, root).select(*CANDLE_COLUMNS)


EVENT_RATES_SQL = """er AS (SELECT CAST((ts AT TIME ZONE 'UTC') AT TIME ZONE 'America/Santiago' AS DATE) AS d,
             sum(CAST(round(value * 100) AS BIGINT)) / count(*) / 100.0 AS v
      FROM events GROUP BY 1),
en AS (SELECT d, v, lead(d) OVER (ORDER BY d) AS nx FROM er),
efilled AS (SELECT CAST(unnest(generate_series(d, coalesce(nx - 1, d), INTERVAL 1 DAY)) AS DATE) AS date, v
            FROM en)"""


@register("klines_to_candles", f"""WITH {sql.TRADES}, {sql.bars('1 minute')}, {sql.grid('1 minute')},
{EVENT_RATES_SQL},
k AS (SELECT *, CAST(("timestamp" AT TIME ZONE 'UTC') AT TIME ZONE 'America/Santiago' AS DATE) AS ld
      FROM candles WHERE exchange = 'venue_k')
SELECT "timestamp", exchange, open_clp * v AS open_clp, high_clp * v AS high_clp, low_clp * v AS low_clp,
       close_clp * v AS close_clp, volume_btc, buy_volume_btc, sell_volume_btc, trade_count, is_interpolated
FROM k JOIN efilled ON k.ld = efilled.date""")
def q_klines_to_candles(spark, sf_dir):
    """Silver job B end to end: kline envelopes -> dedup -> grid in USDT ->
    rate of the Santiago date -> unified candles -> venue refresh -> read back."""
    bronze = _kline_bronze(spark, sf_dir)
    rates = fill_daily(event_rates(spark, sf_dir))
    root = scratch_path(spark, "silver-candles")
    silver.run_klines_refresh(spark, bronze, rates, root, VENUE_K)
    return read_candles(spark, root).select(*CANDLE_COLUMNS)


@register("silver_refresh", f"""WITH {sql.TRADES}, {sql.bars('1 minute')}, {sql.grid('1 minute')}
SELECT *, CAST(year("timestamp") AS INTEGER) AS year, CAST(month("timestamp") AS INTEGER) AS month
FROM candles""")
def q_silver_refresh(spark, sf_dir):
    """Two venues share one table; venue T is then refreshed again from the
    same input.  Reading the whole table gives both venues exactly once."""
    c = events_candles(spark, sf_dir, "1 minute")
    root = scratch_path(spark, "silver-shared")
    write_candles_refresh(c, root, VENUE_T)
    write_candles_refresh(c, root, VENUE_K)
    write_candles_refresh(c, root, VENUE_T)
    return read_candles(spark, root)


DAYS_SQL = """days AS (SELECT CAST(unnest(generate_series(CAST(min(ts) AS DATE), CAST(max(ts) AS DATE) + {extra},
                                              INTERVAL 1 DAY)) AS DATE) AS day FROM events)"""


def q_tolerant_scan(spark, sf_dir, tape=(VENUE_T,), kline=(VENUE_K,)):
    """Scan a folder of trade envelopes (with an empty trailing period), kline
    envelopes (the first day ingested twice) and one truncated file without
    failing; classify every file and give its range (file names are random,
    so they are left out of the compared result)."""
    tpath = _trade_bronze(spark, sf_dir, extra_days=1, venues=tape)
    kpath = _kline_bronze(spark, sf_dir, kline)
    bad = scratch_path(spark, "bronze-bad")
    one = spark.read.text(tpath, wholetext=True).limit(1)
    one.select(F.substring("value", 1, 200).alias("value")).write.mode("overwrite").text(bad)
    docs = read_json_docs(spark, [tpath, kpath], S.ANY_ENVELOPE_DDL, tolerant=True).unionByName(
        read_json_docs(spark, bad, S.ANY_ENVELOPE_DDL, tolerant=True, glob="*.txt"))
    return envelope_ranges(docs).drop("file")


@register("tolerant_scan", f"""WITH {sql.TRADES}, {sql.bars('1 minute')}, {DAYS_SQL.format(extra=1)},
t AS (SELECT venue, CAST(ts AS DATE) AS day, count(*) AS n FROM trades GROUP BY 1, 2),
k AS (SELECT venue, CAST(bucket AS DATE) AS day, count(*) AS n, epoch_ms(min(bucket)) AS s,
             epoch_ms(max(bucket)) + 60000 AS e FROM bars GROUP BY 1, 2),
v AS (SELECT DISTINCT venue FROM trades)
SELECT 'range' AS class, epoch_ms(CAST(day AS TIMESTAMP)) AS start_ms,
       epoch_ms(CAST(day AS TIMESTAMP)) + 86400000 AS end_ms, CAST(coalesce(t.n, 0) AS BIGINT) AS records
FROM days CROSS JOIN v LEFT JOIN t USING (venue, day)
UNION ALL SELECT 'derived', s, e, n FROM k
UNION ALL SELECT 'derived', s, e, n FROM k WHERE day = (SELECT min(day) FROM days)
UNION ALL SELECT 'failed', NULL, NULL, CAST(0 AS BIGINT)""")
def q_tolerant_scan_all(spark, sf_dir):
    """The same over every venue's envelopes of both kinds."""
    return q_tolerant_scan(spark, sf_dir, ALL_VENUES, ALL_VENUES)


def q_ingest_health(spark, sf_dir, venues=(VENUE_T,)):
    """Roll-up of the ingestion metadata carried by the trade envelopes."""
    docs = read_json_docs(spark, _trade_bronze(spark, sf_dir, venues=venues), S.TRADE_ENVELOPE_DDL)
    return ingest_health(docs)


@register("ingest_health", f"""WITH {sql.TRADES}, {DAYS_SQL.format(extra=0)},
t AS (SELECT venue, CAST(ts AS DATE) AS day, count(*) AS n FROM trades GROUP BY 1, 2),
v AS (SELECT DISTINCT venue FROM trades),
e AS (SELECT datediff('day', DATE '1970-01-01', day) AS n, ceil(coalesce(t.n, 0) / 100.0) AS pages, coalesce(t.n, 0) AS records
      FROM days CROSS JOIN v LEFT JOIN t USING (venue, day))
SELECT CASE WHEN n % 2 = 0 THEN 0.5 ELSE 1.0 END AS nominal_rps, count(*) AS runs, CAST(sum(n % 3) AS BIGINT) AS throttle_429_events,
       CAST(sum(pages) AS BIGINT) AS pages, CAST(sum(records) AS BIGINT) AS records,
       avg(CASE WHEN n % 5 <> 0 THEN pages / (n % 7 + 4) END) AS mean_effective_rps
FROM e GROUP BY 1""")
def q_ingest_health_all(spark, sf_dir):
    """The same over every venue."""
    return q_ingest_health(spark, sf_dir, ALL_VENUES)


def q_streaming_bars(spark, sf_dir, venues=(VENUE_T,)):
    """Incremental job over the landed envelopes (a few files per micro-batch)
    equals the batch bars once drained.  The watermark is the span of the tape
    because the files of one write land in no particular order."""
    from tickwave.plans.standins import table
    from tickwave.streaming.live_bars import current_bars, run_incremental
    bronze = _trade_bronze(spark, sf_dir, venues=venues)
    out, ckpt = scratch_path(spark, "stream-bars"), scratch_path(spark, "stream-ckpt")
    span = table(spark, sf_dir, "events").agg(F.min("ts").alias("a"), F.max("ts").alias("b")).first()
    days = (span["b"] - span["a"]).days + 2
    run_incremental(spark, bronze, out, ckpt, "1 minute", watermark=f"{days} days", max_files=8)
    return current_bars(spark, out).select("symbol", "bucket", "open", "high", "low", "close", "volume",
                                           "buy_volume", "sell_volume", "trade_count")


@register("streaming_bars", f"""WITH {sql.TRADES}, {sql.bars('1 minute')}
SELECT venue AS symbol, bucket, open, high, low, close, volume, buy_volume,
       volume - buy_volume AS sell_volume, trade_count FROM bars""")
def q_streaming_bars_all(spark, sf_dir):
    """The same over every venue."""
    return q_streaming_bars(spark, sf_dir, ALL_VENUES)


@register("gold_from_silver", sql.episodes("15 minutes", 900, 0.01, 5)
          + "\nSELECT start_local, end_local, minutes, hours, mean_spread_pct, max_spread_pct, area_pct_minutes"
          + " FROM out ORDER BY rank_metric DESC, a LIMIT 20")
def q_gold_from_silver(spark, sf_dir):
    """Entry C as deployed: both venues refresh the shared candle table, then
    the episode query scans it (venue filter prunes ``exchange=``, the time
    range prunes ``year=/month=``) -- the top 20 of 15-minute episodes."""
    import datetime as dt
    from tickwave.operators.spread import spread_episodes
    from tickwave.sources.silver_tables import load_candles
    c = events_candles(spark, sf_dir, "15 minutes")
    root = scratch_path(spark, "silver-15m")
    write_candles_refresh(c, root, VENUE_T)
    write_candles_refresh(c, root, VENUE_K)
    rng = c.agg(F.min("timestamp").alias("a"), F.max("timestamp").alias("b")).first()
    table_c = load_candles(spark, root, rng["a"], rng["b"] + dt.timedelta(minutes=15),
                           venues=[VENUE_T, VENUE_K])
    return spread_episodes(table_c, VENUE_T, VENUE_K, 0.01, min_bars=5, top=20, bar_seconds=900)


@register("silver_run_summary", f"""WITH {sql.TRADES}, {sql.bars('1 minute')}, {sql.grid('1 minute')}
SELECT 'venue_t' AS venue, count(*) AS rows_out, CAST(sum(CASE WHEN is_interpolated THEN 1 ELSE 0 END) AS BIGINT)
       AS interpolated, round(sum(CASE WHEN is_interpolated THEN 1 ELSE 0 END) * 100.0 / count(*), 4)
       AS pct_interpolated, min("timestamp") AS range_start, max("timestamp") AS range_end
FROM candles WHERE exchange = 'venue_t'""")
def q_silver_run_summary(spark, sf_dir):
    """The one-row run summary of job A, gathered with ``observe`` during the
    write (no second pass over the output)."""
    import datetime as dt
    bronze = _trade_bronze(spark, sf_dir)
    root = scratch_path(spark, "silver-candles")
    m = silver.run_refresh(silver.trades_to_candles(spark, bronze, VENUE_T), root, VENUE_T)
    row = (m["venue"], int(m["rows_out"]), int(m["interpolated"]), float(m["pct_interpolated"]),
           dt.datetime.fromisoformat(m["range_start"]), dt.datetime.fromisoformat(m["range_end"]))
    return spark.createDataFrame([row], "venue string, rows_out bigint, interpolated bigint, "
                                        "pct_interpolated double, range_start timestamp_ntz, "
                                        "range_end timestamp_ntz")


@register("fx_lookup_ms", f"""WITH {EVENT_RATES_SQL}
SELECT event_id, epoch_ms(date_trunc('millisecond', ts)) AS ts_ms, efilled.date AS local_date, v AS rate
FROM events JOIN efilled
  ON CAST((date_trunc('millisecond', ts) AT TIME ZONE 'UTC') AT TIME ZONE 'America/Santiago' AS DATE) = efilled.date""")
def q_fx_lookup_ms(spark, sf_dir):
    """Point lookup for any frame with an epoch-ms column: the rate of the
    Santiago date of each instant (strict: an instant outside the coverage
    fails the query)."""
    from tickwave.functions.timefn import ms_to_ts
    from tickwave.operators.fx import convert_by_local_date
    from tickwave.plans.standins import table
    ev = table(spark, sf_dir, "events").select("event_id", epoch_ms("ts").alias("ts_ms"))
    rates = fill_daily(event_rates(spark, sf_dir))
    j = convert_by_local_date(ev.withColumn("_t", ms_to_ts("ts_ms")), rates, "_t", [])
    return j.select("event_id", "ts_ms", "local_date", "rate")


@register("bronze_coverage", f"""WITH {sql.TRADES}, {sql.bars('1 minute')}, {DAYS_SQL.format(extra=1)},
k AS (SELECT venue, CAST(bucket AS DATE) AS day, epoch_ms(min(bucket)) AS s, epoch_ms(max(bucket)) + 60000 AS e
      FROM bars GROUP BY 1, 2),
iv AS (SELECT 'tape_' || venue AS source, epoch_ms(CAST(day AS TIMESTAMP)) AS s,
              epoch_ms(CAST(day AS TIMESTAMP)) + 86400000 AS e FROM days CROSS JOIN (SELECT DISTINCT venue FROM trades)
       UNION ALL SELECT 'kline_' || venue, s, e FROM k
       UNION ALL SELECT 'kline_' || venue, s, e FROM k WHERE day = (SELECT min(day) FROM days)),
nb AS (SELECT *, LAG(e) OVER (PARTITION BY source ORDER BY s, e) AS pe FROM iv),
v AS (SELECT source, count(*) AS intervals,
             CAST(sum(CASE WHEN s > pe THEN 1 ELSE 0 END) AS BIGINT) AS gaps,
             CAST(sum(CASE WHEN s < pe THEN 1 ELSE 0 END) AS BIGINT) AS "overlaps",
             make_timestamp(min(s) * 1000) AS first_start, make_timestamp(arg_max(e, (s, e)) * 1000) AS last_end,
             round(sum(e - s) / 1000.0 / 86400, 4) AS covered_days FROM nb GROUP BY source),
f AS (SELECT DISTINCT source, CAST(CASE WHEN source LIKE 'tape%' THEN 1 ELSE 0 END AS BIGINT) AS failed FROM iv)
SELECT v.source, intervals, gaps, "overlaps", first_start, last_end, covered_days, failed,
       gaps = 0 AND "overlaps" = 0 AND failed = 0 AS ok FROM v JOIN f USING (source)""")
def q_bronze_coverage(spark, sf_dir):
    """End-to-end Bronze check per source: classify every envelope file (tolerant
    scan), compare neighbouring ranges, count failed files, verdict.  Every venue is
    a source as tape and one as klines; each tape has a truncated file (not ok),
    each kline source its first day ingested twice (an overlap)."""
    return _coverage(spark, sf_dir, [(f"tape_{v}", v) for v in ALL_VENUES], [(f"kline_{v}", v) for v in ALL_VENUES])


def _coverage(spark, sf_dir, tapes, klines):
    from tickwave.operators.quality import ms_intervals
    found = []
    for source, venue in tapes:
        tpath = _trade_bronze(spark, sf_dir, extra_days=1, venues=(venue,))
        bad = scratch_path(spark, "bronze-bad")
        spark.read.text(tpath, wholetext=True).limit(1).select(F.substring("value", 1, 200).alias("value")) \
            .write.mode("overwrite").text(bad)
        docs = read_json_docs(spark, tpath, S.ANY_ENVELOPE_DDL, tolerant=True).unionByName(
            read_json_docs(spark, bad, S.ANY_ENVELOPE_DDL, tolerant=True, glob="*.txt"))
        found.append(envelope_ranges(docs).withColumn("source", F.lit(source)))
    for source, venue in klines:
        docs = read_json_docs(spark, _kline_bronze(spark, sf_dir, (venue,)), S.ANY_ENVELOPE_DDL, tolerant=True)
        found.append(envelope_ranges(docs).withColumn("source", F.lit(source)))
    r = reduce(DataFrame.unionByName, found)
    iv = ms_intervals(r, keep=["source"])
    failed = r.groupBy("source").agg(F.sum(F.when(F.col("class") == "failed", 1).otherwise(0)).cast("bigint")
                                     .alias("failed"))
    v = interval_verdict(iv, keys=["source"], failed=failed)
    return v.select("source", "intervals", "gaps", "overlaps", "first_start", "last_end", "covered_days",
                    "failed", "ok")


@register("silver_job_report", f"""WITH {sql.TRADES}, {sql.bars('1 minute')}, {sql.grid('1 minute')},
kb AS (SELECT bucket FROM bars WHERE venue = 'venue_k'),
k AS (SELECT bucket, false AS off FROM kb UNION ALL SELECT bucket, true FROM kb WHERE minute(bucket) % 10 = 0),
first AS (SELECT CAST(min(ts) AS DATE) AS d FROM events),
out AS (SELECT exchange AS venue, count(*) AS rows_out, CAST(count(*) FILTER (WHERE is_interpolated) AS BIGINT) AS inserted,
               count(DISTINCT date_trunc('month', "timestamp")) AS months FROM candles GROUP BY 1),
read AS (SELECT 'venue_t' AS venue, count(*) AS rows_in, CAST(0 AS BIGINT) AS duplicates, CAST(0 AS BIGINT) AS off_grid
         FROM trades WHERE venue = 'venue_t'
         UNION ALL
         SELECT 'venue_k', count(*) + count(*) FILTER (WHERE CAST(bucket AS DATE) = d),
                count(*) FILTER (WHERE CAST(bucket AS DATE) = d), count(*) FILTER (WHERE off) FROM k, first)
SELECT venue, rows_in, duplicates, off_grid, rows_out, inserted, months, CAST(0 AS BIGINT) AS broken FROM read JOIN out USING (venue)""")
def q_silver_job_report(spark, sf_dir):
    """The reports of both Silver jobs as their commits record them: rows in,
    duplicates, off-grid rows, rows out, inserted rows, months and broken candles."""
    from tickwave.sinks import snapshots
    root = scratch_path(spark, "silver-reported")
    silver.run_trades_refresh(spark, _trade_bronze(spark, sf_dir), root, VENUE_T)
    rates = fill_daily(event_rates(spark, sf_dir))
    silver.run_klines_refresh(spark, _kline_bronze(spark, sf_dir, off_grid=True), rates, root, VENUE_K)
    rows = []
    for venue in snapshots.venues(spark, root):  # one commit a venue
        c = snapshots.current(spark, root, venue)
        f = c.figures
        rows.append((venue, f["rows_in"], f["duplicates"], f["off_grid"], f["rows_out"], f["interpolated"], len(c.months), f["broken"]))
    return spark.createDataFrame(rows, "venue string, rows_in bigint, duplicates bigint, off_grid bigint, rows_out bigint, "
                                       "inserted bigint, months bigint, broken bigint")
