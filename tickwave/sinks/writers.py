"""Writers.

Candle table layout: ``root/exchange=<venue>/snapshot=<id>/year=<YYYY>/month=<MM>/part=<n>/``
with a zero-padded month directory.  Two venues share the table; a full refresh
of one venue writes a snapshot and then commits it (:mod:`snapshots`), so the other
venue's files are untouched, a month whose input vanished does not linger, and a
refresh that fails leaves the venue's rows as they were.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame, Observation, SparkSession, Window
from pyspark.sql import functions as F

from tickwave.functions.timefn import bucket_start, ms_to_ts, seconds_between, width_seconds
from tickwave.operators.candles import CANDLE_COLUMNS
from tickwave.operators.ordered import numbered
from tickwave.session import materialize
from tickwave.sinks.snapshots import Commit, commit, current, expire, new_snapshot, snapshot_path

# Pages of one envelope at most (100,000 trades at 100 a page, some MB of text).
ENVELOPE_PAGES = 1000
# Rows of one candle file at most.
FILE_ROWS = 1_000_000


def _str(c) -> F.Column:
    return F.col(c).cast("string") if isinstance(c, str) else c.cast("string")


def assign_periods(rows: DataFrame, periods: DataFrame, ts_ms: str = "ts_ms",
                   keys: Sequence[str] = ("symbol",)) -> DataFrame:
    """Attach ``(start_ms, end_ms)`` of the half-open period holding each row.

    A range join would be a nested loop; instead each period is expanded to the
    UTC days it touches (at most 31 per period) and rows are equi-joined on
    ``(keys, day)`` (broadcast) then filtered to ``start <= ts < end``."""
    keys = list(keys)
    pdays = periods.select(
        *keys, "start_ms", "end_ms",
        F.explode(F.sequence(F.to_date(ms_to_ts("start_ms")),
                             F.to_date(ms_to_ts(F.col("end_ms") - 1)))).alias("_day"))
    r = rows.withColumn("_day", F.to_date(ms_to_ts(ts_ms)))
    # period-days are bounded (periods x 31): broadcast after a size check so
    # a hot (symbol, day) never lands in one join task
    from tickwave.operators.fx import bounded_broadcast
    j = r.join(bounded_broadcast(pdays), [*keys, "_day"])
    return j.where((F.col(ts_ms) >= F.col("start_ms")) & (F.col(ts_ms) < F.col("end_ms"))).drop("_day")


def trade_envelopes(trades: DataFrame, periods: DataFrame, ingestion_ts: str,
                    source: str = "tape", page_size: int = 100,
                    nominal_rps: float | None = None, pages: int = ENVELOPE_PAGES) -> DataFrame:
    """Envelopes of a period: metadata + ascending ``[ts_ms, amount, price,
    side, trade_id]`` tuples as text.  Periods with no trade still get an
    envelope (``records_count 0``, empty ``data``).  An envelope holds at most
    ``pages`` full pages; a longer period is cut in time order into envelopes
    numbered ``part`` of ``parts``, so no row or task grows with a period.
    ``nominal_rps``, ``throttle_429_events`` and ``wall_clock_seconds`` are taken from
    the periods where they have such columns."""
    noted = [c for c in ("nominal_rps", "throttle_429_events", "wall_clock_seconds") if c in periods.columns]
    spans = periods.select("symbol", "start_ms", "end_ms")
    size = page_size * pages
    t = numbered(assign_periods(trades, spans), ["symbol", "start_ms", "end_ms"], ["ts_ms", "trade_id"])
    t = t.withColumn("_part", F.floor(F.col("_n") / size))
    tup = F.struct("ts_ms", "trade_id", "amount", "price", "side")
    agg = t.groupBy("symbol", "start_ms", "end_ms", "_part").agg(
        F.array_sort(F.collect_list(tup)).alias("_rows"), F.ceil(F.first("_total") / size).alias("_parts"))
    env = periods.select("symbol", "start_ms", "end_ms", *noted).join(agg, ["symbol", "start_ms", "end_ms"], "left")
    rows = F.coalesce(F.col("_rows"), F.array().cast(agg.schema["_rows"].dataType))
    data = F.transform(rows, lambda x: F.array(_str(x["ts_ms"]), _str(x["amount"]), _str(x["price"]),
                                                x["side"], _str(x["trade_id"])))
    n = F.size(rows).cast("bigint")
    fetched = F.ceil(n / page_size).cast("bigint")
    note = lambda c, other: F.col(c) if c in noted else F.lit(other)
    meta = F.struct(
        F.lit(source).alias("source"), F.lit(ingestion_ts).alias("ingestion_timestamp_utc"),
        F.lit("1.0").alias("schema_version"), F.col("symbol"),
        F.col("start_ms").alias("range_start_ms"), F.col("end_ms").alias("range_end_ms"),
        F.lit("half_open_[start,end)").alias("range_semantics"), n.alias("records_count"),
        fetched.alias("pages_fetched"),
        note("throttle_429_events", 0).cast("bigint").alias("throttle_429_events"),
        note("wall_clock_seconds", None).cast("double").alias("wall_clock_seconds"),
        F.try_divide(fetched.cast("double"), note("wall_clock_seconds", None).cast("double")).alias("effective_rps"),
        note("nominal_rps", nominal_rps).cast("double").alias("nominal_rps"),
        F.coalesce(F.col("_part"), F.lit(0)).cast("bigint").alias("part"),
        F.coalesce(F.col("_parts"), F.lit(1)).cast("bigint").alias("parts"))
    return env.select("start_ms", meta.alias("metadata"), data.alias("data"))


def kline_envelopes(klines: DataFrame, periods: DataFrame, ingestion_ts: str,
                    source: str = "kline", interval: str = "1m") -> DataFrame:
    """One envelope per period of 12-position kline tuples (positions 7, 10, 11
    are not used downstream and are written as ``"0"``).  Envelopes carry no
    range fields; coverage derives the range from the data."""
    k = assign_periods(klines, periods, ts_ms="open_time_ms")
    tup = F.struct("open_time_ms", "open", "high", "low", "close", "volume", "close_time_ms",
                   "trade_count", "buy_volume")
    agg = k.groupBy("symbol", "start_ms", "end_ms").agg(F.array_sort(F.collect_list(tup)).alias("_rows"))
    env = periods.select("symbol", "start_ms", "end_ms").join(agg, ["symbol", "start_ms", "end_ms"], "left")
    rows = F.coalesce(F.col("_rows"), F.array().cast(agg.schema["_rows"].dataType))
    zero = F.lit("0")
    data = F.transform(rows, lambda x: F.array(
        _str(x["open_time_ms"]), _str(x["open"]), _str(x["high"]), _str(x["low"]), _str(x["close"]),
        _str(x["volume"]), _str(x["close_time_ms"]), zero, _str(x["trade_count"]), _str(x["buy_volume"]),
        zero, zero))
    meta = F.struct(
        F.lit(source).alias("source"), F.lit(ingestion_ts).alias("ingestion_timestamp_utc"),
        F.lit("1.0").alias("schema_version"), F.col("symbol"), F.lit(interval).alias("interval"),
        F.size(rows).cast("bigint").alias("records_count"))
    return env.select("start_ms", meta.alias("metadata"), data.alias("data"))


def write_envelopes(env: DataFrame, path: str) -> None:
    """One JSON document a file, under ``year=YYYY/month=MM`` (from the period
    start, UTC); periods of several symbols may start together.  The parts of a
    period go to different tasks."""
    ts = ms_to_ts("start_ms")
    out = (env.withColumn("year", F.year(ts)).withColumn("month", F.date_format(ts, "MM"))
           .withColumn("period", F.col("start_ms")))
    part = ["metadata.part"] if "part" in env.schema["metadata"].dataType.names else []
    (out.repartition("period", "metadata.symbol", *part).select("metadata", "data", "year", "month", "period")
     .write.mode("overwrite").option("maxRecordsPerFile", 1).partitionBy("year", "month", "period").json(path))


def candle_partitions(candles: DataFrame) -> DataFrame:
    return (candles.withColumn("year", F.year("timestamp"))
            .withColumn("month", F.date_format("timestamp", "MM")))


def month_parts(df: DataFrame, ts: str = "timestamp", max_rows: int = FILE_ROWS, width: str | None = None,
                span: str = "1 hour") -> DataFrame:
    """Adds ``part``, which cuts each ``(year, month)`` of ``df`` into consecutive
    time ranges of at most ``max_rows`` rows; a month with no more is part 0.

    With ``width`` the rows are bars of that width, one an instant, so equal time
    ranges do and nothing is counted.  Without it the rows are counted by
    ``span`` (a calendar-sized table), and a part takes whole spans until it is
    full; only a span that alone has more than ``max_rows`` makes a larger part."""
    if width is not None:
        into = seconds_between(F.date_trunc("month", F.col(ts)).cast("timestamp_ntz"), ts)
        return df.withColumn("part", F.floor(into / F.lit(max_rows * width_seconds(width))).cast("int"))
    per = df.groupBy("year", "month", bucket_start(ts, span).alias("_span")).agg(F.count(F.lit(1)).alias("_k"))
    own = Window.partitionBy("year", "month")
    before = F.sum("_k").over(own.orderBy("_span")) - F.col("_k")
    total, most = F.sum("_k").over(own), F.max("_k").over(own)
    # spans whose first row falls into the same stretch of this many rows share a part
    stretch = F.greatest(F.lit(max_rows) - most + 1, F.lit(1))
    cut = per.select("_span", F.when(total <= max_rows, 0).otherwise(F.floor(before / stretch)).cast("int").alias("part"))
    d = df.withColumn("_at", bucket_start(ts, span))
    from tickwave.operators.fx import bounded_broadcast
    return d.join(bounded_broadcast(materialize(cut, "month_parts")), F.col("_at") == F.col("_span")).drop("_at", "_span")


def write_candles_refresh(candles: DataFrame, root: str, venue: str,
                          observation: Observation | None = None, width: str | None = None,
                          max_rows: int = FILE_ROWS, figures=None) -> Commit:
    """Full refresh of one venue as a new snapshot, committed when it is written.

    Each month is cut into sorted files that don't overlap, of ``max_rows`` rows
    at most (:func:`month_parts`); every part is a task's work of its own.  ``figures``
    is called after the write and gives what the commit records."""
    spark = candles.sparkSession
    begun = current(spark, root, venue)
    df = candle_partitions(candles.where(F.col("exchange") == venue)).select(
        *[c for c in CANDLE_COLUMNS if c != "exchange"], "year", "month")
    df = month_parts(df, max_rows=max_rows, width=width)
    if observation is not None:
        df = df.observe(observation,
                        F.count(F.lit(1)).alias("rows"),
                        F.sum(F.col("is_interpolated").cast("bigint")).alias("interpolated"),
                        F.min("timestamp").alias("first"), F.max("timestamp").alias("last"),
                        F.count(F.when(broken_candle(), 1)).alias("broken"))
    snapshot = new_snapshot()
    (df.repartition("year", "month", "part").sortWithinPartitions("year", "month", "part", "timestamp")
     .write.partitionBy("year", "month", "part").parquet(snapshot_path(root, venue, snapshot)))
    done = commit(spark, root, venue, snapshot, figures() if figures else None, begun.number if begun else 0)
    expire(spark, root, venue)
    return done


def broken_candle():
    """Whether a candle contradicts itself: high or low not around open and
    close, a negative volume, shares of the volume that don't add up to it, or
    trades in an interpolated bar."""
    c = F.col
    return ((c("high_clp") < F.greatest("open_clp", "close_clp")) | (c("low_clp") > F.least("open_clp", "close_clp"))
            | (c("volume_btc") < 0) | (F.abs(c("volume_btc") - c("buy_volume_btc") - c("sell_volume_btc")) > 1e-6 * F.greatest(F.abs("volume_btc"), F.lit(1.0)))
            | (c("is_interpolated") & (c("trade_count") > 0)))


def write_candles_dynamic(candles: DataFrame, root: str) -> None:
    """Incremental write: replace only the ``(exchange, year, month)``
    partitions present in ``candles``."""
    df = candle_partitions(candles)
    (df.repartition("exchange", "year", "month").sortWithinPartitions("exchange", "year", "month", "timestamp")
     .write.mode("overwrite").option("partitionOverwriteMode", "dynamic")
     .partitionBy("exchange", "year", "month").parquet(root))


def read_candles(spark: SparkSession, root: str) -> DataFrame:
    """Every venue's current snapshot (a venue without one is read as plain
    ``year=/month=`` folders)."""
    from tickwave.sources.silver_tables import load_candles
    return load_candles(spark, root)


def write_rates(filled: DataFrame, path: str) -> None:
    """The daily rate dimension as one file (bounded by the calendar)."""
    filled.select("date", F.col("rate").alias("usdclp"), "is_ffilled").orderBy("date") \
        .coalesce(1).write.mode("overwrite").parquet(path)


def write_json(df: DataFrame, path: str) -> None:
    df.coalesce(1).write.mode("overwrite").json(path)


def write_csv(df: DataFrame, path: str) -> None:
    df.coalesce(1).write.mode("overwrite").option("header", True).csv(path)


