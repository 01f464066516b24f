"""Backfill planning on the order history (orders stand in for trades)."""

from __future__ import annotations

from pyspark.sql import functions as F

from tickwave.operators.periods import (
    PAGE_SIZE,
    SAMPLE_DAY,
    adaptive_periods,
    closed_monthly_periods,
    estimate_rollup,
    months_between,
    period_breakdown,
    volume_estimate,
)
from tickwave.plans.registry import register
from tickwave.plans.standins import VENUE_K, VENUE_T, table

MONTHS_SQL = """m AS (SELECT unnest(generate_series(date_trunc('month', min(o_orderdate)),
                                  date_trunc('month', max(o_orderdate)), INTERVAL 1 MONTH)) AS month FROM orders)"""

EST_SQL = MONTHS_SQL + """,
c AS (SELECT date_trunc('month', o_orderdate) AS month,
             count(*) * (month(date_trunc('month', o_orderdate)) % 5) * (SELECT 1200000 // count(*) FROM orders) AS n
      FROM orders WHERE day(o_orderdate) = 15 GROUP BY 1),
s AS (SELECT CAST(year(m.month) AS INTEGER) AS year, CAST(month(m.month) AS INTEGER) AS month,
             coalesce(c.n, 0) AS trades_day_15, CAST(ceil(coalesce(c.n, 0) / 100.0) AS BIGINT) AS pages_day_15
      FROM m LEFT JOIN c ON m.month = c.month),
est AS (SELECT year, month, trades_day_15, pages_day_15,
               CAST(trades_day_15 * day(last_day(make_date(year, month, 1))) AS BIGINT) AS trades_month_est,
               CAST(CASE WHEN trades_day_15 * day(last_day(make_date(year, month, 1))) > 0
                    THEN (trades_day_15 * day(last_day(make_date(year, month, 1))) + 99) // 100 ELSE 0 END
                    AS BIGINT) AS pages_month_est
        FROM s),
est2 AS (SELECT *, CAST(pages_month_est * 3.0 AS DOUBLE) AS lambda_time_est_s,
                CASE WHEN pages_month_est * 3.0 > 900 THEN '⚠️ TIMEOUT' ELSE '✓' END AS risk FROM est)"""

PERIODS_SQL = EST_SQL + """,
g AS (SELECT *, CASE WHEN lambda_time_est_s <= 400 THEN 'monthly' WHEN lambda_time_est_s <= 1000 THEN 'biweekly'
                     ELSE 'weekly' END AS granularity FROM est2),
sd AS (SELECT g.*, unnest(CASE WHEN granularity = 'monthly' THEN [1] WHEN granularity = 'biweekly' THEN [1, 16]
                      WHEN day(last_day(make_date(year, month, 1))) >= 29 THEN [1, 8, 15, 22, 29]
                      ELSE [1, 8, 15, 22] END)
              AS d FROM g),
p AS (SELECT *, make_date(year, month, d) AS sdate,
             lead(make_date(year, month, d)) OVER (PARTITION BY year, month ORDER BY d) AS nx FROM sd),
periods AS (SELECT 'venue_t' AS symbol, year, month, granularity, lambda_time_est_s,
                   epoch_ms(CAST(sdate AS TIMESTAMP)) AS start_ms,
                   epoch_ms(CAST(coalesce(nx, make_date(year, month, 1) + INTERVAL 1 MONTH) AS TIMESTAMP)) AS end_ms
            FROM p)"""


def order_months(spark, sf_dir):
    o = table(spark, sf_dir, "orders")
    return o.agg(F.explode(months_between(F.to_date(F.min("o_orderdate")), F.to_date(F.max("o_orderdate"))))
                 .alias("month"))


def order_volume_sample(spark, sf_dir):
    """Day-15 counts per month (0 for a month with none), every month from the
    first to the last order month.  An order stands for as many trades as make
    1.2 million of the whole table, times 0 to 4 by month, so that months fall on
    every side of the planner's limits."""
    o = table(spark, sf_dir, "orders")
    d = F.to_date("o_orderdate")
    counts = o.where(F.dayofmonth(d) == SAMPLE_DAY).groupBy(F.trunc(d, "month").alias("month")) \
        .agg(F.count(F.lit(1)).alias("n"))
    weight = o.agg(F.floor(F.lit(1_200_000) / F.count(F.lit(1))).cast("bigint")).first()[0]
    counts = counts.withColumn("n", F.col("n") * (F.month("month") % 5) * F.lit(weight))
    m = order_months(spark, sf_dir).join(counts, "month", "left")
    n = F.coalesce(F.col("n"), F.lit(0)).cast("bigint")
    s = m.select(F.year("month").alias("year"), F.month("month").alias("month"), n.alias("trades_day_15"),
                 F.ceil(n / PAGE_SIZE).cast("bigint").alias("pages_day_15"))
    return volume_estimate(s)


@register("month_periods", f"""WITH {MONTHS_SQL}
SELECT 'venue_k' AS symbol, '1m' AS "interval", epoch_ms(month) AS start_ms,
       epoch_ms(month + INTERVAL 1 MONTH) - 1 AS end_ms FROM m""")
def q_month_periods(spark, sf_dir):
    """Closed monthly request ranges over the whole history."""
    return closed_monthly_periods(order_months(spark, sf_dir), VENUE_K)


@register("volume_sample", f"WITH {EST_SQL}\nSELECT * FROM est2")
def q_volume_sample(spark, sf_dir):
    return order_volume_sample(spark, sf_dir)


@register("volume_rollup", f"""WITH {EST_SQL}
SELECT CAST(sum(CASE WHEN trades_month_est > 0 THEN trades_month_est ELSE 0 END) AS BIGINT) AS total_trades_est,
       CAST(sum(CASE WHEN lambda_time_est_s > 900 THEN 1 ELSE 0 END) AS BIGINT) AS months_over_timeout,
       CAST(sum(CASE WHEN lambda_time_est_s > 600 AND lambda_time_est_s <= 900 THEN 1 ELSE 0 END) AS BIGINT)
         AS months_near_timeout FROM est2""")
def q_volume_rollup(spark, sf_dir):
    return estimate_rollup(order_volume_sample(spark, sf_dir))


@register("adaptive_periods", f"WITH {PERIODS_SQL}\nSELECT * FROM periods")
def q_adaptive_periods(spark, sf_dir):
    return adaptive_periods(order_volume_sample(spark, sf_dir), VENUE_T)


@register("period_breakdown", f"""WITH {PERIODS_SQL}
SELECT granularity, count(DISTINCT (year, month)) AS months, count(*) AS periods,
       sum(DISTINCT_S) AS est_seconds FROM (
  SELECT granularity, year, month, CASE WHEN row_number() OVER (PARTITION BY year, month ORDER BY start_ms) = 1
         THEN lambda_time_est_s ELSE 0 END AS DISTINCT_S FROM periods) GROUP BY granularity""")
def q_period_breakdown(spark, sf_dir):
    return period_breakdown(adaptive_periods(order_volume_sample(spark, sf_dir), VENUE_T))
