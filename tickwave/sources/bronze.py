"""Bronze readers.

One envelope file is one JSON document (``multiLine``), so a file is one row
until ``explode``: files must stay modest (one period each, sized by the
period planner).  Everything after the explode is columnar and partitioned.
Casts are strict: under ANSI (Spark's default) text in a numeric position
fails the job (``CAST_INVALID_INPUT``), as the reference's strict casts do.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from tickwave.functions.timefn import ms_to_ts
from tickwave.sources import schemas as S


def read_json_docs(spark: SparkSession, path, ddl: str, tolerant: bool = False,
                   glob: str = "*.json") -> DataFrame:
    """All files matching ``glob`` under ``path`` (a folder or a list of
    folders, recursively), one row per document, with the file name.
    ``tolerant``: unreadable documents become rows with ``_corrupt_record``
    set instead of failing the scan."""
    r = (spark.read.schema(ddl).option("multiLine", True).option("recursiveFileLookup", True)
         .option("pathGlobFilter", glob))
    if tolerant:
        r = r.option("mode", "PERMISSIVE").option("columnNameOfCorruptRecord", "_corrupt_record")
    else:
        r = r.option("mode", "FAILFAST")
    return r.json(path).withColumn("file", F.col("_metadata.file_path"))


def decode_trades(env: DataFrame, symbol_col: str = "symbol") -> DataFrame:
    """Trade envelopes -> typed trades ``(symbol, ts, ts_ms, trade_id, price,
    amount, side)``; a missing or empty ``data`` yields no rows."""
    extra = ["file"] if "file" in env.columns else []
    t = env.select(F.col("metadata.symbol").alias(symbol_col), *extra, F.explode("data").alias("r"))
    r = F.col("r")
    ts_ms = r[S.TRADE_TS].cast("bigint")
    return t.select(
        symbol_col, *extra,
        ms_to_ts(ts_ms).alias("ts"),
        ts_ms.alias("ts_ms"),
        r[S.TRADE_ID].cast("bigint").alias("trade_id"),
        r[S.TRADE_PRICE].cast("double").alias("price"),
        r[S.TRADE_AMOUNT].cast("double").alias("amount"),
        r[S.TRADE_SIDE].alias("side"),
    )


def decode_klines(env: DataFrame, symbol_col: str = "symbol") -> DataFrame:
    """Kline envelopes -> ``(symbol, open_time_ms, ts, open, high, low, close,
    volume, close_time_ms, trade_count, buy_volume, ingestion_ts)``."""
    extra = ["file"] if "file" in env.columns else []
    t = env.select(F.col("metadata.symbol").alias(symbol_col), *extra,
                   F.col("metadata.ingestion_timestamp_utc").alias("ingestion_ts"),
                   F.explode("data").alias("r"))
    r = F.col("r")
    ot = r[S.KLINE_OPEN_TIME].cast("bigint")
    return t.select(
        symbol_col, *extra,
        ot.alias("open_time_ms"),
        ms_to_ts(ot).alias("ts"),
        r[S.KLINE_OPEN].cast("double").alias("open"),
        r[S.KLINE_HIGH].cast("double").alias("high"),
        r[S.KLINE_LOW].cast("double").alias("low"),
        r[S.KLINE_CLOSE].cast("double").alias("close"),
        r[S.KLINE_VOLUME].cast("double").alias("volume"),
        r[S.KLINE_CLOSE_TIME].cast("bigint").alias("close_time_ms"),
        r[S.KLINE_TRADE_COUNT].cast("bigint").alias("trade_count"),
        r[S.KLINE_TAKER_BUY].cast("double").alias("buy_volume"),
        F.to_timestamp("ingestion_ts").alias("ingestion_ts"),
    )


def rate_rows(env: DataFrame) -> DataFrame:
    """Rate envelope -> ``(pos, fecha, valor)``; ``pos`` is the position in the
    array, so a repeated date can be resolved last-wins."""
    return env.select(F.posexplode("data").alias("pos", "e")).select(
        "pos", F.substring("e.fecha", 1, 10).alias("fecha"), F.col("e.valor").cast("double").alias("valor"))


def assert_rates_present(env: DataFrame) -> None:
    """Reference rule: a rate file with no ``data`` key or an empty array is an
    error.  One small aggregate (no rows travel to the driver)."""
    r = env.agg(F.count(F.lit(1)).alias("files"),
                F.sum(F.coalesce(F.size("data"), F.lit(-1)).cast("bigint")).alias("n"),
                F.sum(F.when(F.col("data").isNull(), 1).otherwise(0)).alias("no_key")).first()
    if r["files"] == 0 or r["no_key"]:
        raise ValueError("rate file: missing 'data' key")
    if not r["n"]:
        raise ValueError("rate file: 'data' is empty")


def rate_pages(pages: DataFrame) -> DataFrame:
    """Landed yearly rate pages (newest first) -> ascending ``(fecha, valor)``;
    a page without a ``serie`` list contributes nothing."""
    e = pages.select(F.explode(F.coalesce("serie", F.array().cast("array<struct<fecha:string,valor:double>>")))
                     .alias("e"))
    return e.select(F.substring("e.fecha", 1, 10).alias("fecha"), F.col("e.valor").alias("valor"))


def trade_pages(pages: DataFrame, start_ms: int, end_ms: int) -> DataFrame:
    """Landed trade pages (newest first) -> typed trades with
    ``start <= ts < end``, one row per ``(symbol, trade_id)`` (overlapping pages
    never duplicate a trade).  Order is carried by ``(ts, trade_id)``."""
    e = pages.select(F.col("trades.market_id").alias("symbol"), F.explode("trades.entries").alias("r"))
    r = F.col("r")
    ts_ms = r[S.TRADE_TS].cast("bigint")
    t = e.where((ts_ms >= F.lit(start_ms)) & (ts_ms < F.lit(end_ms))).select(
        "symbol", ms_to_ts(ts_ms).alias("ts"), ts_ms.alias("ts_ms"),
        r[S.TRADE_ID].cast("bigint").alias("trade_id"),
        r[S.TRADE_PRICE].cast("double").alias("price"),
        r[S.TRADE_AMOUNT].cast("double").alias("amount"),
        r[S.TRADE_SIDE].alias("side"))
    return t.dropDuplicates(["symbol", "trade_id"])


def read_period_list(spark: SparkSession, path: str) -> DataFrame:
    doc = spark.read.schema(S.PERIOD_LIST_DDL).option("multiLine", True).json(path)
    return doc.select(F.inline("periodos"))


def read_volume_sample(spark: SparkSession, path: str) -> DataFrame:
    return spark.read.schema(S.VOLUME_SAMPLE_SCHEMA).option("multiLine", True).json(path)


def read_result_csv(spark: SparkSession, path: str, schema) -> DataFrame:
    return spark.read.schema(schema).option("header", True).csv(path)
