"""Explicit schemas for every JSON input (no inference anywhere)."""

from pyspark.sql import types as T

# Envelope and page layouts as the sources publish them.
TRADE_ENVELOPE_DDL = """
metadata STRUCT<source:STRING, ingestion_timestamp_utc:STRING, schema_version:STRING, symbol:STRING,
                range_start_ms:BIGINT, range_end_ms:BIGINT, range_semantics:STRING, records_count:BIGINT,
                pages_fetched:BIGINT, throttle_429_events:BIGINT, wall_clock_seconds:DOUBLE,
                effective_rps:DOUBLE, nominal_rps:DOUBLE, part:BIGINT, parts:BIGINT>,
data ARRAY<ARRAY<STRING>>"""

KLINE_ENVELOPE_DDL = """
metadata STRUCT<source:STRING, ingestion_timestamp_utc:STRING, schema_version:STRING,
                symbol:STRING, `interval`:STRING, records_count:BIGINT>,
data ARRAY<ARRAY<STRING>>"""

# union of both metadata layouts: used where files of either kind are scanned
ANY_ENVELOPE_DDL = """
metadata STRUCT<source:STRING, ingestion_timestamp_utc:STRING, schema_version:STRING, symbol:STRING,
                `interval`:STRING, range_start_ms:BIGINT, range_end_ms:BIGINT, range_semantics:STRING,
                records_count:BIGINT, pages_fetched:BIGINT, throttle_429_events:BIGINT,
                wall_clock_seconds:DOUBLE, effective_rps:DOUBLE, nominal_rps:DOUBLE, part:BIGINT, parts:BIGINT>,
data ARRAY<ARRAY<STRING>>,
_corrupt_record STRING"""

RATE_ENVELOPE_DDL = """
metadata STRUCT<source:STRING, indicator:STRING, ingestion_timestamp_utc:STRING, schema_version:STRING,
                year_start:INT, year_end:INT, years_fetched:INT, records_count:BIGINT,
                is_partial_current_year:BOOLEAN, current_year_fetched_through:STRING,
                serie_order_in_file:STRING, total_elapsed_seconds:DOUBLE,
                per_year_stats:ARRAY<STRUCT<year:INT, is_partial:BOOLEAN, records_in_year:BIGINT,
                  date_first:STRING, date_last:STRING, value_first:DOUBLE, value_last:DOUBLE,
                  elapsed_seconds:DOUBLE>>>,
data ARRAY<STRUCT<fecha:STRING, valor:DOUBLE>>"""

TRADE_PAGE_DDL = """
trades STRUCT<market_id:STRING, `timestamp`:STRING, last_timestamp:STRING, entries:ARRAY<ARRAY<STRING>>>"""

RATE_PAGE_DDL = """
codigo STRING, nombre STRING, unidad_medida STRING, serie ARRAY<STRUCT<fecha:STRING, valor:DOUBLE>>"""

PERIOD_LIST_DDL = """
periodos ARRAY<STRUCT<symbol:STRING, `interval`:STRING, start_ms:BIGINT, end_ms:BIGINT>>"""

VOLUME_SAMPLE_SCHEMA = T.StructType([
    T.StructField("year", T.IntegerType()),
    T.StructField("month", T.IntegerType()),
    T.StructField("trades_day_15", T.LongType()),
    T.StructField("pages_day_15", T.LongType()),
    T.StructField("trades_month_est", T.LongType()),
    T.StructField("pages_month_est", T.LongType()),
    T.StructField("lambda_time_est_s", T.DoubleType()),
    T.StructField("risk", T.StringType()),
])

# Kline tuple positions used downstream (0-5, 8, 9; 6 = close time).
KLINE_OPEN_TIME, KLINE_OPEN, KLINE_HIGH, KLINE_LOW, KLINE_CLOSE, KLINE_VOLUME = 0, 1, 2, 3, 4, 5
KLINE_CLOSE_TIME, KLINE_TRADE_COUNT, KLINE_TAKER_BUY = 6, 8, 9
# Trade tuple positions.
TRADE_TS, TRADE_AMOUNT, TRADE_PRICE, TRADE_SIDE, TRADE_ID = 0, 1, 2, 3, 4
