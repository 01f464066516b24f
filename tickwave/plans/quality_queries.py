"""Data-quality reports over the stand-in tables."""

from __future__ import annotations

from pyspark.sql import functions as F

from tickwave.operators.bars import ohlcv_bars
from tickwave.operators.fx import fill_daily
from tickwave.operators.ordered import first_rows
from tickwave.operators.quality import (
    chunk_count,
    coverage_span,
    interpolation_by,
    interval_neighbours,
    interval_verdict,
    invariant_report,
    source_alignment,
)
from tickwave.plans import sql
from tickwave.plans.registry import register
from tickwave.plans.standins import VENUE_K, event_rates, events_candles, events_trades, table

IV_SQL = """iv AS (SELECT CAST(l_orderkey AS VARCHAR) AS label, min(l_shipdate) AS "start", max(l_shipdate) AS "end"
       FROM lineitem GROUP BY l_orderkey),
nb AS (SELECT *, LAG("end") OVER (ORDER BY "start", "end", label) AS prev_end,
              LAG(label) OVER (ORDER BY "start", "end", label) AS prev_label FROM iv)"""


def ship_ranges(spark, sf_dir, keys):
    """First and last ship date of every key.  Rows are dealt out evenly before they
    are first grouped: file splits grow with the input, and so would a task's groups."""
    li = table(spark, sf_dir, "lineitem").select(*keys, "l_shipdate")
    return li.repartition(chunk_count(li.count()), *keys, "l_shipdate").groupBy(*keys).agg(
        F.min("l_shipdate").alias("start"), F.max("l_shipdate").alias("end"))


def order_intervals(spark, sf_dir):
    """One interval per order: ``[first ship date, last ship date)``."""
    return ship_ranges(spark, sf_dir, ["l_orderkey"]).select(F.col("l_orderkey").cast("string").alias("label"), "start", "end")


@register("interval_gaps", f"""WITH {IV_SQL}
SELECT prev_label, label, prev_end AS gap_start, "start" AS gap_end,
       CAST(epoch("start") - epoch(prev_end) AS DOUBLE) AS gap_seconds
FROM nb WHERE "start" > prev_end""")
def q_interval_gaps(spark, sf_dir):
    n = interval_neighbours(order_intervals(spark, sf_dir))
    return n.where(F.col("kind") == "gap").select(
        "prev_label", "label", F.col("prev_end").alias("gap_start"), F.col("start").alias("gap_end"),
        F.col("amount_seconds").cast("double").alias("gap_seconds"))


@register("interval_overlaps", f"""WITH {IV_SQL}
SELECT prev_label, label, CAST(epoch(prev_end) - epoch("start") AS DOUBLE) AS overlap_seconds
FROM nb WHERE "start" < prev_end""")
def q_interval_overlaps(spark, sf_dir):
    n = interval_neighbours(order_intervals(spark, sf_dir))
    return n.where(F.col("kind") == "overlap").select(
        "prev_label", "label", F.col("amount_seconds").cast("double").alias("overlap_seconds"))


@register("interval_verdict", f"""WITH {IV_SQL},
rm AS (SELECT *, max("end") OVER (ORDER BY "start", "end", label
                                  ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING) AS run_end FROM iv)
SELECT (SELECT count(*) FROM nb) AS intervals,
       (SELECT count(*) FROM nb WHERE "start" > prev_end) AS gaps,
       (SELECT count(*) FROM nb WHERE "start" < prev_end) AS overlaps,
       (SELECT count(*) FROM rm WHERE "start" > run_end) AS gaps_running_max,
       (SELECT count(*) FROM rm WHERE "start" < run_end) AS overlaps_running_max,
       (SELECT min("start") FROM iv) AS first_start,
       (SELECT arg_max("end", ("start", "end", label)) FROM iv) AS last_end,
       (SELECT round(sum(epoch("end") - epoch("start")) / 86400, 4) FROM iv) AS covered_days,
       CAST(0 AS BIGINT) AS failed,
       (SELECT count(*) FROM nb WHERE "start" <> prev_end) = 0 AS ok""")
def q_interval_verdict(spark, sf_dir):
    return interval_verdict(order_intervals(spark, sf_dir))


@register("source_alignment", """WITH r AS (
  SELECT 'events' AS source, min(ts) AS "start", max(ts) AS "end" FROM events
  UNION ALL SELECT 'orders', min(o_orderdate), max(o_orderdate) FROM orders
  UNION ALL SELECT 'lineitem', min(l_shipdate), max(l_shipdate) FROM lineitem),
a AS (SELECT count(*) AS sources, count("start") AS covered, max("start") AS cs, min("end") AS ce,
             arg_max(source, ("start", source)) AS start_limited_by,
             arg_min(source, ("end", source)) AS end_limited_by FROM r)
SELECT sources, covered, CASE WHEN cs < ce THEN cs END AS common_start, CASE WHEN cs < ce THEN ce END AS common_end,
       start_limited_by, end_limited_by,
       CASE WHEN cs < ce THEN round((epoch(ce) - epoch(cs)) / 86400, 4) END AS common_days,
       cs < ce AS has_common_range FROM a""")
def q_source_alignment(spark, sf_dir):
    """Common range of three sources (here they do not overlap: the events
    month lies after the order history, so the answer is 'no common range')."""
    def rng(name, col):
        t = table(spark, sf_dir, name)
        return t.agg(F.lit(name).alias("source"), F.min(col).alias("start"), F.max(col).alias("end"))
    r = rng("events", "ts").unionByName(rng("orders", "o_orderdate")).unionByName(rng("lineitem", "l_shipdate"))
    return source_alignment(r)


@register("source_alignment_orders", """WITH r AS (
  SELECT 'orders' AS source, min(o_orderdate) AS "start", max(o_orderdate) AS "end" FROM orders
  UNION ALL SELECT 'lineitem', min(l_shipdate), max(l_shipdate) FROM lineitem),
a AS (SELECT count(*) AS sources, count("start") AS covered, max("start") AS cs, min("end") AS ce,
             arg_max(source, ("start", source)) AS start_limited_by,
             arg_min(source, ("end", source)) AS end_limited_by FROM r)
SELECT sources, covered, CASE WHEN cs < ce THEN cs END AS common_start, CASE WHEN cs < ce THEN ce END AS common_end,
       start_limited_by, end_limited_by,
       CASE WHEN cs < ce THEN round((epoch(ce) - epoch(cs)) / 86400, 4) END AS common_days,
       cs < ce AS has_common_range FROM a""")
def q_source_alignment_orders(spark, sf_dir):
    def rng(name, col):
        t = table(spark, sf_dir, name)
        return t.agg(F.lit(name).alias("source"), F.min(col).alias("start"), F.max(col).alias("end"))
    return source_alignment(rng("orders", "o_orderdate").unionByName(rng("lineitem", "l_shipdate")))


@register("invariant_report", """SELECT 'customer' AS source, count(*) AS "rows",
       CAST(sum(CASE WHEN c_acctbal <= 0 THEN 1 ELSE 0 END) AS BIGINT) AS nonpositive_price,
       CAST(0 AS BIGINT) AS negative_volume,
       min(CASE WHEN c_acctbal <= 0 THEN c_custkey END) AS first_violation,
       max(CASE WHEN c_acctbal <= 0 THEN c_custkey END) AS last_violation FROM customer
UNION ALL
SELECT 'supplier', count(*), CAST(sum(CASE WHEN s_acctbal <= 0 THEN 1 ELSE 0 END) AS BIGINT), 0,
       min(CASE WHEN s_acctbal <= 0 THEN s_suppkey END), max(CASE WHEN s_acctbal <= 0 THEN s_suppkey END)
FROM supplier""")
def q_invariant_report(spark, sf_dir):
    c = table(spark, sf_dir, "customer").select(F.lit("customer").alias("source"),
                                                F.col("c_custkey").alias("k"), F.col("c_acctbal").alias("p"))
    s = table(spark, sf_dir, "supplier").select(F.lit("supplier").alias("source"),
                                                F.col("s_suppkey").alias("k"), F.col("s_acctbal").alias("p"))
    r = invariant_report(c.unionByName(s), "p", None, "k", ["source"])
    return r.select("source", "rows", F.col("nonpositive_price").cast("bigint").alias("nonpositive_price"),
                    F.col("negative_volume").cast("bigint").alias("negative_volume"),
                    "first_violation", "last_violation")


@register("candle_invariants", f"""WITH {sql.TRADES}, {sql.bars('1 minute')}, {sql.grid('1 minute')}
SELECT exchange, count(*) AS "rows",
       CAST(sum(CASE WHEN close_clp <= 0 THEN 1 ELSE 0 END) AS BIGINT) AS nonpositive_price,
       CAST(sum(CASE WHEN volume_btc < 0 THEN 1 ELSE 0 END) AS BIGINT) AS negative_volume,
       min(CASE WHEN close_clp <= 0 OR volume_btc < 0 THEN "timestamp" END) AS first_violation,
       max(CASE WHEN close_clp <= 0 OR volume_btc < 0 THEN "timestamp" END) AS last_violation
FROM candles GROUP BY 1""")
def q_candle_invariants(spark, sf_dir):
    c = events_candles(spark, sf_dir, "1 minute", materialize=False)
    r = invariant_report(c, "close_clp", "volume_btc", "timestamp", ["exchange"])
    return r.select("exchange", "rows", F.col("nonpositive_price").cast("bigint").alias("nonpositive_price"),
                    F.col("negative_volume").cast("bigint").alias("negative_volume"),
                    "first_violation", "last_violation")


@register("interpolation_by_period", f"""WITH {sql.TRADES}, {sql.bars('1 minute')}, {sql.grid('1 minute')}
SELECT exchange, CAST("timestamp" AS DATE) AS period, count(*) AS minutes,
       CAST(sum(CASE WHEN is_interpolated THEN 1 ELSE 0 END) AS BIGINT) AS interpolated,
       round(avg(CASE WHEN is_interpolated THEN 1.0 ELSE 0.0 END) * 100, 2) AS pct_interpolated
FROM candles GROUP BY 1, 2""")
def q_interpolation_by_period(spark, sf_dir):
    """Interpolated share per venue and day (the per-year table of the
    reference, at the grain the stand-in month allows)."""
    c = events_candles(spark, sf_dir, "1 minute", materialize=False)
    return interpolation_by(c, F.to_date("timestamp"))


@register("interpolation_totals", f"""WITH {sql.TRADES}, {sql.bars('1 minute')}, {sql.grid('1 minute')}
SELECT exchange, count(*) AS minutes,
       CAST(sum(CASE WHEN is_interpolated THEN 1 ELSE 0 END) AS BIGINT) AS interpolated,
       round(avg(CASE WHEN is_interpolated THEN 1.0 ELSE 0.0 END) * 100, 4) AS pct_interpolated
FROM candles GROUP BY 1""")
def q_interpolation_totals(spark, sf_dir):
    c = events_candles(spark, sf_dir, "1 minute", materialize=False)
    return interpolation_by(c, F.lit(1), digits=4).drop("period")


@register("coverage_span", f"""WITH {sql.TRADES}, {sql.bars('1 minute')}
SELECT venue, CAST((epoch(max(bucket)) - epoch(min(bucket))) / 60 + 1 AS BIGINT) AS span, count(*) AS observed,
       CAST((epoch(max(bucket)) - epoch(min(bucket))) / 60 + 1 AS BIGINT) - count(*) AS missing,
       round(count(*) * 100.0 / ((epoch(max(bucket)) - epoch(min(bucket))) / 60 + 1), 4) AS coverage_pct,
       round((((epoch(max(bucket)) - epoch(min(bucket))) / 60 + 1) - count(*)) * 100.0
             / ((epoch(max(bucket)) - epoch(min(bucket))) / 60 + 1), 4) AS inserted_pct
FROM bars GROUP BY venue""")
def q_coverage_span(spark, sf_dir):
    bars = ohlcv_bars(events_trades(spark, sf_dir), "1 minute")
    return coverage_span(bars, "bucket", ["venue"])


@register("rows_by_year", """SELECT CAST(year(o_orderdate) AS INTEGER) AS year, count(*) AS "rows",
       count(DISTINCT CAST(o_orderdate AS DATE)) AS distinct_dates FROM orders GROUP BY 1""")
def q_rows_by_year(spark, sf_dir):
    o = table(spark, sf_dir, "orders")
    return o.groupBy(F.year("o_orderdate").alias("year")).agg(
        F.count(F.lit(1)).alias("rows"), F.countDistinct(F.to_date("o_orderdate")).alias("distinct_dates"))


@register("fx_join_check", f"""WITH {sql.TRADES}, {sql.bars('1 minute')}, {sql.grid('1 minute')},
er AS (SELECT CAST((ts AT TIME ZONE 'UTC') AT TIME ZONE 'America/Santiago' AS DATE) AS d,
             sum(CAST(round(value * 100) AS BIGINT)) / count(*) / 100.0 AS v FROM events GROUP BY 1),
en AS (SELECT d, v, lead(d) OVER (ORDER BY d) AS nx FROM er),
efilled AS (SELECT CAST(unnest(generate_series(d, coalesce(nx - 1, d), INTERVAL 1 DAY)) AS DATE) AS date FROM en),
k AS (SELECT CAST(("timestamp" AT TIME ZONE 'UTC') AT TIME ZONE 'America/Santiago' AS DATE) AS ld
      FROM candles WHERE exchange = 'venue_k')
SELECT count(*) AS candles, count(efilled.date) AS joined, count(*) - count(efilled.date) AS unmatched,
       count(*) = count(efilled.date) AS no_rows_lost
FROM k LEFT JOIN efilled ON k.ld = efilled.date""")
def q_fx_join_check(spark, sf_dir):
    """Candle x rate join loses no rows: count, matched, unmatched."""
    from tickwave.operators.fx import convert_by_local_date
    c = events_candles(spark, sf_dir, "1 minute", materialize=False).where(F.col("exchange") == VENUE_K)
    rates = fill_daily(event_rates(spark, sf_dir)).select("date", F.lit(1).alias("_hit"))
    j = convert_by_local_date(c.select("timestamp"), rates, "timestamp", [], missing="null", rate="_hit") \
        .withColumnRenamed("rate", "_hit")
    return j.agg(F.count(F.lit(1)).alias("candles"), F.count("_hit").alias("joined"),
                 (F.count(F.lit(1)) - F.count("_hit")).alias("unmatched"),
                 (F.count(F.lit(1)) == F.count("_hit")).alias("no_rows_lost"))


IVK_SQL = """iv AS (SELECT l_returnflag AS source, CAST(l_orderkey AS VARCHAR) AS label, min(l_shipdate) AS "start",
              max(l_shipdate) AS "end" FROM lineitem GROUP BY l_returnflag, l_orderkey),
nb AS (SELECT *, LAG("end") OVER (PARTITION BY source ORDER BY "start", "end", label) AS prev_end FROM iv),
rm AS (SELECT *, max("end") OVER (PARTITION BY source ORDER BY "start", "end", label
                                  ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING) AS run_end FROM iv),
v AS (SELECT nb.source, count(*) AS intervals,
             CAST(sum(CASE WHEN nb."start" > prev_end THEN 1 ELSE 0 END) AS BIGINT) AS gaps,
             CAST(sum(CASE WHEN nb."start" < prev_end THEN 1 ELSE 0 END) AS BIGINT) AS "overlaps",
             CAST(sum(CASE WHEN rm."start" > run_end THEN 1 ELSE 0 END) AS BIGINT) AS gaps_running_max,
             CAST(sum(CASE WHEN rm."start" < run_end THEN 1 ELSE 0 END) AS BIGINT) AS overlaps_running_max,
             min(nb."start") AS first_start, arg_max(nb."end", (nb."start", nb."end", nb.label)) AS last_end,
             round(sum(epoch(nb."end") - epoch(nb."start")) / 86400, 4) AS covered_days
      FROM nb JOIN rm USING (source, label) GROUP BY nb.source)"""


def flag_intervals(spark, sf_dir):
    return ship_ranges(spark, sf_dir, ["l_returnflag", "l_orderkey"]).select(
        F.col("l_returnflag").alias("source"), F.col("l_orderkey").cast("string").alias("label"), "start", "end")


@register("interval_verdict_by_source", f"""WITH {IVK_SQL}
SELECT source, intervals, gaps, "overlaps", gaps_running_max, overlaps_running_max, first_start, last_end,
       covered_days, CAST(0 AS BIGINT) AS failed, gaps = 0 AND "overlaps" = 0 AS ok FROM v""")
def q_interval_verdict_by_source(spark, sf_dir):
    """One coverage verdict per source (orders grouped by return flag stand in
    for three file sources), each source partitioned on its own."""
    return interval_verdict(flag_intervals(spark, sf_dir), keys=["source"])


@register("coverage_rollup", f"""WITH {IVK_SQL}
SELECT count(*) AS sources, CAST(sum(CASE WHEN gaps = 0 AND "overlaps" = 0 THEN 1 ELSE 0 END) AS BIGINT) AS sources_ok,
       bool_and(gaps = 0 AND "overlaps" = 0) AS all_ok FROM v""")
def q_coverage_rollup(spark, sf_dir):
    """All-sources pass/fail roll-up of the per-source verdicts."""
    v = interval_verdict(flag_intervals(spark, sf_dir), keys=["source"])
    return v.agg(F.count(F.lit(1)).alias("sources"),
                 F.sum(F.col("ok").cast("bigint")).alias("sources_ok"),
                 F.every("ok").alias("all_ok"))


@register("dedup_latest", """SELECT user_id, event_type, event_id, ts, value FROM events
QUALIFY row_number() OVER (PARTITION BY user_id, event_type ORDER BY ts DESC, event_id DESC) = 1""")
def q_dedup_latest(spark, sf_dir):
    """Keep-latest per key: one row per ``(user_id, event_type)``, the latest by
    ``(ts, event_id)`` (the repeated-``open_time`` rule on a derived key)."""
    from tickwave.operators.dedup import keep_latest
    ev = table(spark, sf_dir, "events").select("user_id", "event_type", "event_id", "ts", "value")
    return keep_latest(ev, ["user_id", "event_type"], ["ts", "event_id"])


@register("interval_samples", f"""WITH {IV_SQL},
o AS (SELECT 'overlap' AS kind, prev_label, label, "start", "end" FROM nb WHERE "start" < prev_end
      ORDER BY "start", "end", label LIMIT 5),
g AS (SELECT 'gap' AS kind, prev_label, label, "start", "end" FROM nb WHERE "start" > prev_end
      ORDER BY "start", "end", label LIMIT 10)
SELECT * FROM o UNION ALL SELECT * FROM g""")
def q_interval_samples(spark, sf_dir):
    """The report's samples: the first 5 overlaps and the first 10 gaps in
    interval order (a top-k per kind, the limit is the feature)."""
    n = interval_neighbours(order_intervals(spark, sf_dir))
    cols = ["kind", "prev_label", "label", "start", "end"]
    first = lambda k, m: n.where(F.col("kind") == k).orderBy("start", "end", "label").limit(m).select(*cols)
    return first("overlap", 5).unionByName(first("gap", 10))


@register("interval_samples_by_source", """WITH iv AS (
  SELECT l_returnflag AS source, CAST(l_orderkey AS VARCHAR) AS label, min(l_shipdate) AS "start", max(l_shipdate) AS "end"
  FROM lineitem GROUP BY ALL),
nb AS (SELECT *, LAG("end") OVER w AS prev_end, LAG(label) OVER w AS prev_label FROM iv
       WINDOW w AS (PARTITION BY source ORDER BY "start", "end", label)),
k AS (SELECT source, CASE WHEN "start" < prev_end THEN 'overlap' ELSE 'gap' END AS kind, prev_label, label, "start", "end"
      FROM nb WHERE "start" <> prev_end)
SELECT source, kind, prev_label, label, "start", "end" FROM k
QUALIFY row_number() OVER (PARTITION BY source, kind ORDER BY "start", "end", label) <= 3""")
def q_interval_samples_by_source(spark, sf_dir):
    """The report's samples for every source: its first 3 gaps and overlaps."""
    n = interval_neighbours(flag_intervals(spark, sf_dir), keys=["source"]).where(F.col("kind").isNotNull())
    return first_rows(n.select("source", "kind", "prev_label", "label", "start", "end"), ["source", "kind"], ["start", "end", "label"], 3)
