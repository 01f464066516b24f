"""Sessionisation (gaps-and-islands) without a single-task window.

``LAG(ts) OVER (ORDER BY ts)`` + running sum is the textbook form, but with no
partition key Spark plans ``Exchange SinglePartition``: the whole series in one
task.  Here rows are sessionised per ``(keys, span)``; each span yields partial
islands with mergeable aggregates (first, last, count, sum, max, min).  A
partial that does not touch its span's first or last row is already a whole
island.  Only the first and last partial of each span can continue across a
span edge, so only those (at most two per key and span -- calendar-bounded)
are re-sessionised per key and merged.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from tickwave.functions.timefn import bucket_start, longer_than


def islands(rows: DataFrame, ts: str, value: str, max_gap_seconds: float,
            keys: Sequence[str] = (), span: str = "1 day") -> DataFrame:
    """Group rows into islands: a row starts a new island when it has no
    predecessor or its predecessor is more than ``max_gap_seconds`` earlier
    (so rows exactly ``max_gap_seconds`` apart stay together).

    Returns ``(keys, island_start, island_end, n, v_sum, v_max, v_min)``."""
    keys = list(keys)
    r = rows.select(*keys, F.col(ts).alias("_ts"), F.col(value).alias("_v")) \
        .withColumn("_span", bucket_start("_ts", span))
    w = Window.partitionBy(*keys, "_span").orderBy("_ts")
    prev = F.lag("_ts").over(w)
    r = r.withColumn("_new", F.when(prev.isNull() | longer_than(prev, F.col("_ts"), max_gap_seconds), 1)
                     .otherwise(0))
    r = r.withColumn("_local", F.sum("_new").over(w.rowsBetween(Window.unboundedPreceding, 0)))
    r = r.withColumn("_nlocal", F.max("_local").over(Window.partitionBy(*keys, "_span")))
    partial = r.groupBy(*keys, "_span", "_local").agg(
        F.min("_ts").alias("island_start"), F.max("_ts").alias("island_end"),
        F.count(F.lit(1)).alias("n"), F.sum("_v").alias("v_sum"),
        F.max("_v").alias("v_max"), F.min("_v").alias("v_min"),
        F.max(((F.col("_local") == 1) | (F.col("_local") == F.col("_nlocal")))).alias("_edge"))
    cols = [*keys, "island_start", "island_end", "n", "v_sum", "v_max", "v_min"]
    interior = partial.where(~F.col("_edge")).select(*cols)

    edges = partial.where(F.col("_edge")).select(*cols)
    we = Window.partitionBy(*keys).orderBy("island_start")
    pe = F.lag("island_end").over(we)
    edges = edges.withColumn("_new", F.when(pe.isNull() | longer_than(pe, F.col("island_start"), max_gap_seconds), 1)
                             .otherwise(0))
    edges = edges.withColumn("_gid", F.sum("_new").over(we.rowsBetween(Window.unboundedPreceding, 0)))
    merged = edges.groupBy(*keys, "_gid").agg(
        F.min("island_start").alias("island_start"), F.max("island_end").alias("island_end"),
        F.sum("n").alias("n"), F.sum("v_sum").alias("v_sum"),
        F.max("v_max").alias("v_max"), F.min("v_min").alias("v_min")).select(*cols)
    return interior.unionByName(merged)


def islands_naive(rows: DataFrame, ts: str, value: str, max_gap_seconds: float,
                  keys: Sequence[str] = ()) -> DataFrame:
    """Reference form: one window per key ordered by time (single task per key).
    Kept as the check for :func:`islands`."""
    keys = list(keys)
    w = Window.partitionBy(*keys).orderBy(ts)
    prev = F.lag(ts).over(w)
    r = rows.withColumn("_new", F.when(prev.isNull() | longer_than(prev, F.col(ts), max_gap_seconds), 1).otherwise(0))
    r = r.withColumn("_id", F.sum("_new").over(w.rowsBetween(Window.unboundedPreceding, 0)))
    return r.groupBy(*keys, "_id").agg(
        F.min(ts).alias("island_start"), F.max(ts).alias("island_end"),
        F.count(F.lit(1)).alias("n"), F.sum(value).alias("v_sum"),
        F.max(value).alias("v_max"), F.min(value).alias("v_min")).drop("_id")


def islands_session_window(rows: DataFrame, ts: str, value: str, max_gap_seconds: int,
                           keys: Sequence[str] = ()) -> DataFrame:
    """Native ``session_window`` form.  A session closes when no row arrives
    within the gap, so rows exactly ``max_gap_seconds`` apart merge; a row
    exactly at ``last + gap`` is included by adding one microsecond."""
    sw = F.session_window(ts, f"{int(max_gap_seconds * 1_000_000) + 1} microseconds")
    return rows.groupBy(*keys, sw.alias("_s")).agg(
        F.min(ts).alias("island_start"), F.max(ts).alias("island_end"),
        F.count(F.lit(1)).alias("n"), F.sum(value).alias("v_sum"),
        F.max(value).alias("v_max"), F.min(value).alias("v_min")).drop("_s")
