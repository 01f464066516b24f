"""Daily-rate queries: calendar fill, local-date conversion, as-of."""

from __future__ import annotations

from pyspark.sql import Window
from pyspark.sql import functions as F

from tickwave.operators.asof import asof_join
from tickwave.operators.fx import (
    apply_policy,
    asof_backward,
    attach_local_date,
    convert_by_local_date,
    fill_daily,
    missing_rate_dates,
)
from tickwave.plans.registry import register
from tickwave.plans.standins import table, weekday_rates

RATES_SQL = """r AS (SELECT CAST(o_orderdate AS DATE) AS d, sum(CAST(round(o_totalprice * 100) AS BIGINT)) / count(*) / 100.0 AS v
      FROM orders WHERE dayofweek(o_orderdate) BETWEEN 1 AND 5 GROUP BY 1),
n AS (SELECT d, v, lead(d) OVER (ORDER BY d) AS nx FROM r),
filled AS (SELECT CAST(unnest(generate_series(d, coalesce(nx - 1, d), INTERVAL 1 DAY)) AS DATE) AS date,
                  v, d FROM n)"""

LOCAL_SQL = "CAST((l_shipdate AT TIME ZONE 'UTC') AT TIME ZONE 'America/Santiago' AS DATE)"


def filled_rates(spark, sf_dir, max_back_days=7):
    src = weekday_rates(spark, sf_dir).select(F.col("fecha").alias("date"), F.col("valor").alias("rate"))
    return fill_daily(src, max_back_days)


@register("fx_daily_filled", f"""WITH {RATES_SQL}
SELECT date, v AS usdclp, date <> d AS is_ffilled, CAST(date - d AS INTEGER) AS age_days FROM filled""")
def q_fx_daily_filled(spark, sf_dir):
    f = filled_rates(spark, sf_dir)
    return f.select("date", F.col("rate").alias("usdclp"), "is_ffilled", "age_days")


@register("fx_year_stats", """WITH r AS (SELECT CAST(o_orderdate AS DATE) AS d, sum(CAST(round(o_totalprice * 100) AS BIGINT)) / count(*) / 100.0 AS v
      FROM orders WHERE dayofweek(o_orderdate) BETWEEN 1 AND 5 GROUP BY 1),
y AS (SELECT CAST(year(d) AS INTEGER) AS year, count(*) AS records_in_year, min(d) AS date_first, max(d) AS date_last,
             arg_min(v, d) AS value_first, arg_max(v, d) AS value_last FROM r GROUP BY 1)
SELECT *, year = (SELECT max(year) FROM y) AS is_partial FROM y""")
def q_fx_year_stats(spark, sf_dir):
    """Per-year stats of the source series; the last year is the partial one."""
    r = weekday_rates(spark, sf_dir)
    y = r.groupBy(F.year("fecha").alias("year")).agg(
        F.count(F.lit(1)).alias("records_in_year"),
        F.min("fecha").alias("date_first"), F.max("fecha").alias("date_last"),
        F.min_by("valor", "fecha").alias("value_first"), F.max_by("valor", "fecha").alias("value_last"))
    # one row per year: a global window over it is calendar-bounded
    return y.withColumn("is_partial", F.col("year") == F.max("year").over(Window.partitionBy()))


@register("fx_convert_local_date", f"""WITH {RATES_SQL},
f AS (SELECT l_orderkey, l_linenumber, l_shipdate, l_extendedprice, {LOCAL_SQL} AS local_date FROM lineitem)
SELECT l_orderkey, l_linenumber, l_shipdate, local_date, v AS rate,
       l_extendedprice * v AS price_local
FROM f LEFT JOIN filled ON f.local_date = filled.date""")
def q_fx_convert_local_date(spark, sf_dir):
    """Facts priced in the rate of their local (Santiago) calendar date; facts
    outside the rate coverage stay, with NULL rate and price (see ``fx_missing_dates``)."""
    li = table(spark, sf_dir, "lineitem").select("l_orderkey", "l_linenumber", "l_shipdate", "l_extendedprice")
    c = convert_by_local_date(li, filled_rates(spark, sf_dir), "l_shipdate", ["l_extendedprice"],
                              missing="null", suffix="_local")
    return c.select("l_orderkey", "l_linenumber", "l_shipdate", "local_date", "rate",
                    F.col("l_extendedprice_local").alias("price_local"))


@register("fx_conversion_summary", f"""WITH {RATES_SQL},
f AS (SELECT {LOCAL_SQL} AS local_date FROM lineitem),
j AS (SELECT f.local_date, filled.v, filled.d FROM f LEFT JOIN filled ON f.local_date = filled.date)
SELECT count(*) AS rows_in, count(v) AS rows_converted, count(DISTINCT local_date) AS local_dates,
       count(DISTINCT d) AS source_dates_used, min(v) AS rate_min, max(v) AS rate_max FROM j""")
def q_fx_conversion_summary(spark, sf_dir):
    li = table(spark, sf_dir, "lineitem").select("l_shipdate", "l_extendedprice")
    f = filled_rates(spark, sf_dir)
    c = convert_by_local_date(li, f, "l_shipdate", ["l_extendedprice"], missing="null",
                              carry=("source_date",))
    return c.agg(F.count(F.lit(1)).alias("rows_in"), F.count("rate").alias("rows_converted"),
                 F.countDistinct("local_date").alias("local_dates"),
                 F.countDistinct("source_date").alias("source_dates_used"),
                 F.min("rate").alias("rate_min"), F.max("rate").alias("rate_max"))


@register("fx_missing_dates", f"""WITH {RATES_SQL},
f AS (SELECT {LOCAL_SQL} AS local_date FROM lineitem)
SELECT local_date, count(*) AS "rows" FROM f
WHERE local_date NOT IN (SELECT date FROM filled)
GROUP BY 1""")
def q_fx_missing_dates(spark, sf_dir):
    """All local dates with facts but no rate (the strict conversion names the
    first ten in its error)."""
    li = table(spark, sf_dir, "lineitem").select("l_shipdate")
    return missing_rate_dates(li, filled_rates(spark, sf_dir), "l_shipdate", limit=None)


@register("fx_asof", f"""WITH r AS (SELECT CAST(o_orderdate AS DATE) AS d, sum(CAST(round(o_totalprice * 100) AS BIGINT)) / count(*) / 100.0 AS v
      FROM orders WHERE dayofweek(o_orderdate) BETWEEN 1 AND 5 GROUP BY 1),
f AS (SELECT l_orderkey, l_linenumber, {LOCAL_SQL} AS local_date FROM lineitem),
a AS (SELECT f.*, r.d, r.v FROM f ASOF LEFT JOIN r ON f.local_date >= r.d)
SELECT l_orderkey, l_linenumber, local_date,
       CASE WHEN local_date - d <= 7 THEN d END AS date_matched,
       CASE WHEN local_date - d <= 7 THEN v END AS rate
FROM a""")
def q_fx_asof(spark, sf_dir):
    """Backward as-of lookup of the source (unfilled) rate, 7-day tolerance."""
    src = weekday_rates(spark, sf_dir).select(F.col("fecha").alias("date"), F.col("valor").alias("rate"))
    # local dates through the zone calendar of the days the rates can serve
    days = src.agg(F.min("date").alias("a"), (F.max("date") + 7).alias("b")) \
        .select(F.explode(F.sequence("a", "b")).alias("date"))
    li = attach_local_date(table(spark, sf_dir, "lineitem").select("l_orderkey", "l_linenumber", "l_shipdate"),
                           "l_shipdate", days).drop("l_shipdate")
    return asof_backward(li, src, "local_date", "date", ["rate"], tolerance_days=7)


@register("fx_policy", f"""WITH {RATES_SQL}
SELECT date, v AS usdclp, date <> d AS is_ffilled, CAST(date - d AS INTEGER) AS age_days,
       1.0 / (CAST(date - d AS INTEGER) + 1) AS weight FROM filled""")
def q_fx_policy(spark, sf_dir):
    """Age-weighted policy for filled days (the consumer's choice)."""
    f = apply_policy(filled_rates(spark, sf_dir), "weight")
    return f.select("date", F.col("rate").alias("usdclp"), "is_ffilled", "age_days", "weight")


@register("fx_policy_drop", f"""WITH {RATES_SQL}
SELECT date, v AS usdclp FROM filled WHERE date = d""")
def q_fx_policy_drop(spark, sf_dir):
    f = apply_policy(filled_rates(spark, sf_dir), "drop")
    return f.select("date", F.col("rate").alias("usdclp"))


@register("asof_quotes", """WITH q AS (
  SELECT event_type, date_trunc('minute', ts) AS qt, arg_max(value, event_id) AS quote, max(event_id) AS quote_id
  FROM events WHERE user_id % 2 = 1 GROUP BY 1, 2),
a AS (SELECT e.event_id, e.event_type, e.ts, q.qt, q.quote, q.quote_id
      FROM (SELECT * FROM events WHERE user_id % 2 = 0) e
      ASOF LEFT JOIN q ON e.event_type = q.event_type AND e.ts >= q.qt)
SELECT event_id, event_type, ts, CASE WHEN ts - qt <= INTERVAL 10 MINUTE THEN qt END AS at_matched,
       CASE WHEN ts - qt <= INTERVAL 10 MINUTE THEN quote END AS quote,
       CASE WHEN ts - qt <= INTERVAL 10 MINUTE THEN quote_id END AS quote_id
FROM a""")
def q_asof_quotes(spark, sf_dir):
    """Every trade of one venue with the other venue's last quote of its kind, at
    most 10 minutes old.  Quotes are stamped by the minute, so many share a time;
    the one of the greatest id counts."""
    ev = table(spark, sf_dir, "events")
    quotes = ev.where(F.col("user_id") % 2 == 1).select("event_type", F.date_trunc("minute", "ts").cast("timestamp_ntz").alias("at"),
                                                        F.col("value").alias("quote"), F.col("event_id").alias("quote_id"))
    trades = ev.where(F.col("user_id") % 2 == 0).select("event_id", "event_type", F.col("ts").cast("timestamp_ntz").alias("ts"))
    return asof_join(trades, quotes, "ts", "at", ["quote", "quote_id"], ["event_type"], F.expr("INTERVAL '10' MINUTE"), "quote_id")


#: The rate series with some dates twice: a correction a day later in the list.
TWICE_SQL = """r0 AS (SELECT CAST(o_orderdate AS DATE) AS d, sum(CAST(round(o_totalprice * 100) AS BIGINT)) / count(*) / 100.0 AS v
      FROM orders WHERE dayofweek(o_orderdate) BETWEEN 1 AND 5 GROUP BY 1),
r AS (SELECT d, CASE WHEN day(d) % 5 = 0 THEN v + 1.0 ELSE v END AS v FROM r0)"""


def _rates_twice(spark, sf_dir):
    src = weekday_rates(spark, sf_dir).select(F.col("fecha").alias("date"), F.col("valor").alias("rate"), F.lit(1).alias("pos"))
    again = src.where(F.dayofmonth("date") % 5 == 0).select("date", (F.col("rate") + 1.0).alias("rate"), F.lit(2).alias("pos"))
    return src.unionByName(again)


@register("fx_filled_repeated_dates", f"""WITH {TWICE_SQL},
n AS (SELECT d, v, lead(d) OVER (ORDER BY d) AS nx FROM r)
SELECT CAST(unnest(generate_series(d, coalesce(nx - 1, d), INTERVAL 1 DAY)) AS DATE) AS date, v AS usdclp, d AS source_date FROM n""")
def q_fx_filled_repeated_dates(spark, sf_dir):
    """The daily fill of a series that corrects some of its dates: the last wins."""
    f = fill_daily(_rates_twice(spark, sf_dir), order="pos")
    return f.select("date", F.col("rate").alias("usdclp"), "source_date")


@register("fx_asof_repeated_dates", f"""WITH {TWICE_SQL},
f AS (SELECT l_orderkey, l_linenumber, CAST(l_shipdate AS DATE) AS day FROM lineitem)
SELECT l_orderkey, l_linenumber, day, CASE WHEN day - d <= 7 THEN d END AS date_matched, CASE WHEN day - d <= 7 THEN v END AS rate
FROM f ASOF LEFT JOIN r ON f.day >= r.d""")
def q_fx_asof_repeated_dates(spark, sf_dir):
    """The as-of lookup in the same series: no look-ahead, one row a fact."""
    li = table(spark, sf_dir, "lineitem").select("l_orderkey", "l_linenumber", F.to_date("l_shipdate").alias("day"))
    return asof_backward(li, _rates_twice(spark, sf_dir), "day", "date", ["rate"], tolerance_days=7, order="pos")


@register("fx_convert_two_series", """WITH r AS (
  SELECT CAST(o_orderdate AS DATE) AS d, o_orderstatus AS ccy, sum(CAST(round(o_totalprice * 100) AS BIGINT)) / count(*) / 100.0 AS v
  FROM orders WHERE o_orderstatus IN ('O', 'F') GROUP BY 1, 2),
f AS (SELECT l_orderkey, l_linenumber, l_linestatus AS ccy, l_quantity AS rate,
             CAST((l_shipdate AT TIME ZONE 'UTC') AT TIME ZONE 'America/Santiago' AS DATE) AS local_date FROM lineitem)
SELECT l_orderkey, l_linenumber, f.ccy, f.rate, local_date, v AS fx FROM f LEFT JOIN r ON f.local_date = r.d AND f.ccy = r.ccy""")
def q_fx_convert_two_series(spark, sf_dir):
    """Two rate series at once, keyed; the facts have a column called rate."""
    o = table(spark, sf_dir, "orders").where(F.col("o_orderstatus").isin("O", "F"))
    r = o.groupBy(F.to_date("o_orderdate").alias("date"), F.col("o_orderstatus").alias("ccy")).agg(
        (F.sum(F.round(F.col("o_totalprice") * 100).cast("bigint")) / F.count(F.lit(1)) / 100.0).alias("v"))
    f = table(spark, sf_dir, "lineitem").select("l_orderkey", "l_linenumber", F.col("l_linestatus").alias("ccy"),
                                               F.col("l_quantity").alias("rate"), "l_shipdate")
    return convert_by_local_date(f, r, "l_shipdate", [], missing="null", rate="v", keys=["ccy"], rate_as="fx").drop("l_shipdate")


@register("previous_value_null_keys", """WITH e AS (
  SELECT event_id, CASE WHEN event_type = 'click' THEN NULL ELSE event_type END AS kind, ts, value FROM events)
SELECT event_id, kind, LAG(value) OVER (PARTITION BY kind ORDER BY ts, event_id) AS prev FROM e""")
def q_previous_value_null_keys(spark, sf_dir):
    """The value before each event of its kind, for kinds that may be NULL."""
    from tickwave.operators.ordered import numbered, previous_value
    ev = table(spark, sf_dir, "events").select(
        "event_id", F.when(F.col("event_type") != "click", F.col("event_type")).alias("kind"), F.col("ts").cast("timestamp_ntz").alias("ts"), "value")
    # one row an instant and kind: places make the order total
    n = numbered(ev, ["kind"], ["ts", "event_id"])
    t = F.expr("TIMESTAMP_NTZ'2000-01-01'") + F.col("_n") * F.expr("INTERVAL '1' SECOND")
    return previous_value(n.withColumn("at", t), ["kind"], "at", "value", span="10 minutes").select("event_id", "kind", "prev")
