"""Backfill planning: month sequences, volume estimates and adaptive splits.

Every step is a column expression over a small month table (one row per
month), so a plan for any range is one Spark job with no driver loop.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tickwave.functions.timefn import days_in_month, epoch_ms

# Fetch budget model of the trade source.
PAGE_SIZE = 100
SECONDS_PER_PAGE = 3.0
TIMEOUT_SECONDS = 900
NEAR_TIMEOUT_SECONDS = 600
SAMPLE_DAY = 15
RISK_TIMEOUT = "⚠️ TIMEOUT"
RISK_OK = "✓"
# Granularity thresholds (seconds) of the current plan; the
# archived plan used 600 / 1500.
MONTHLY_MAX_SECONDS = 400
BIWEEKLY_MAX_SECONDS = 1000
# First day of each period for the three granularities.
MONTHLY_STARTS = [1]
BIWEEKLY_STARTS = [1, 16]
WEEKLY_STARTS = [1, 8, 15, 22, 29]


def months_between(first: Column, last: Column) -> Column:
    """Array of first-of-month dates from ``first``'s month to ``last``'s."""
    return F.sequence(F.trunc(first, "month"), F.trunc(last, "month"), F.expr("INTERVAL 1 MONTH"))


def _date_ms(d: Column) -> Column:
    return epoch_ms(d.cast("timestamp_ntz"))


def closed_monthly_periods(months: DataFrame, symbol: str, interval: str = "1m",
                           month: str = "month") -> DataFrame:
    """First ms of the month to its last ms, both inclusive (a source that
    treats the end as inclusive)."""
    m = F.col(month)
    return months.select(F.lit(symbol).alias("symbol"), F.lit(interval).alias("interval"),
                         _date_ms(m).alias("start_ms"),
                         (_date_ms(F.add_months(m, 1)) - 1).alias("end_ms"))


def volume_estimate(sample: DataFrame) -> DataFrame:
    """``(year, month, trades_day_15, pages_day_15)`` -> monthly estimates:
    trades x days in month (a failed sample, -1, stays -1), pages by
    ceiling division, fetch seconds = pages x 3, risk above 900 s."""
    first = F.make_date("year", "month", F.lit(1))
    n = F.col("trades_day_15")
    est = F.when(n >= 0, n * days_in_month(first)).otherwise(F.lit(-1)).cast("bigint")
    pages = F.when(est > 0, F.floor((est + PAGE_SIZE - 1) / PAGE_SIZE)).otherwise(F.lit(0)).cast("bigint")
    secs = (pages * F.lit(SECONDS_PER_PAGE)).cast("double")
    return sample.select(
        F.col("year").cast("int").alias("year"), F.col("month").cast("int").alias("month"),
        n.cast("bigint").alias("trades_day_15"), F.col("pages_day_15").cast("bigint").alias("pages_day_15"),
        est.alias("trades_month_est"), pages.alias("pages_month_est"), secs.alias("lambda_time_est_s"),
        F.when(secs > TIMEOUT_SECONDS, RISK_TIMEOUT).otherwise(RISK_OK).alias("risk"))


def estimate_rollup(est: DataFrame) -> DataFrame:
    """Total of the positive estimates, months over the timeout, months near it."""
    s = F.col("lambda_time_est_s")
    return est.agg(
        F.sum(F.when(F.col("trades_month_est") > 0, F.col("trades_month_est")).otherwise(0)).cast("bigint")
        .alias("total_trades_est"),
        F.sum(F.when(s > TIMEOUT_SECONDS, 1).otherwise(0)).cast("bigint").alias("months_over_timeout"),
        F.sum(F.when((s > NEAR_TIMEOUT_SECONDS) & (s <= TIMEOUT_SECONDS), 1).otherwise(0)).cast("bigint")
        .alias("months_near_timeout"))


def granularity(seconds: Column, monthly_max: float = MONTHLY_MAX_SECONDS,
                biweekly_max: float = BIWEEKLY_MAX_SECONDS) -> Column:
    return (F.when(seconds <= monthly_max, "monthly").when(seconds <= biweekly_max, "biweekly")
            .otherwise("weekly"))


def adaptive_periods(est: DataFrame, symbol: str, monthly_max: float = MONTHLY_MAX_SECONDS,
                     biweekly_max: float = BIWEEKLY_MAX_SECONDS) -> DataFrame:
    """One month -> 1, 2 or 4-5 half-open periods by its estimated fetch time.
    Output ``(symbol, year, month, granularity, start_ms, end_ms)``."""
    g = granularity(F.col("lambda_time_est_s"), monthly_max, biweekly_max)
    first = F.make_date("year", "month", F.lit(1))
    starts = (F.when(g == "monthly", F.array(*[F.lit(d) for d in MONTHLY_STARTS]))
              .when(g == "biweekly", F.array(*[F.lit(d) for d in BIWEEKLY_STARTS]))
              .otherwise(F.filter(F.array(*[F.lit(d) for d in WEEKLY_STARTS]),
                                  lambda d: d <= days_in_month(first))))
    m = est.select("year", "month", "lambda_time_est_s", g.alias("granularity"), starts.alias("_starts"),
                   first.alias("_first"))
    nxt = F.add_months("_first", 1)
    bounds = F.transform("_starts", lambda d, i: F.struct(
        F.make_date("year", "month", d).alias("s"),
        F.coalesce(F.make_date("year", "month", F.try_element_at("_starts", i + 2)), nxt).alias("e")))
    p = m.select("year", "month", "granularity", "lambda_time_est_s", F.inline(bounds))
    return p.select(F.lit(symbol).alias("symbol"), "year", "month", "granularity", "lambda_time_est_s",
                    _date_ms(F.col("s")).alias("start_ms"), _date_ms(F.col("e")).alias("end_ms"))


def period_breakdown(periods: DataFrame) -> DataFrame:
    """Months and periods per granularity and total estimated seconds."""
    per_month = periods.groupBy("year", "month", "granularity").agg(
        F.count(F.lit(1)).alias("_p"), F.max("lambda_time_est_s").alias("_s"))
    return per_month.groupBy("granularity").agg(
        F.count(F.lit(1)).alias("months"), F.sum("_p").cast("bigint").alias("periods"),
        F.sum("_s").alias("est_seconds"))
