"""Ordered look-backs that stay partitioned by ``(keys, span)``."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from tickwave.functions.timefn import bucket_start
from tickwave.session import materialize


def null_safe_join(left: DataFrame, right: DataFrame, keys: Sequence[str], how: str = "inner") -> DataFrame:
    """An equi-join on ``keys`` in which NULL equals NULL; the left side's keys stay."""
    keys = list(keys)
    other = {k: f"{k}__right" for k in keys}
    r = right.select(*[F.col(k).alias(other[k]) if k in other else F.col(k) for k in right.columns])
    on = F.lit(True)
    for k in keys:
        on &= F.col(k).eqNullSafe(F.col(other[k]))
    return left.join(r, on, how).drop(*other.values())


def first_rows(df: DataFrame, keys: Sequence[str], order: Sequence, n: int) -> DataFrame:
    """The first ``n`` rows of every key in ``order``.  Spark keeps at most ``n``
    rows a key and task before it shuffles (a window group limit), so no key is
    gathered."""
    own = Window.partitionBy(*keys).orderBy(*order)
    return df.withColumn("_place", F.row_number().over(own)).where(F.col("_place") <= n).drop("_place")


def numbered(df: DataFrame, keys: Sequence[str], order: Sequence[str], number: str = "_n",
             total: str = "_total", chunks: int | None = None) -> DataFrame:
    """Rows with their place (from 0) in ``order`` among the rows of their
    ``keys``, and the count of these rows.  No key is gathered:
    ``repartitionByRange`` cuts the ordered rows into chunks, each
    ``(chunk, key)`` is numbered on its own, and the rows before a chunk come
    from a table with one row per ``(key, chunk)``."""
    keys, order = list(keys), list(order)
    by = [*keys, *order]
    # the chunk id is written with the rows, so both branches read the same one
    d = materialize((df.repartitionByRange(chunks, *by) if chunks else df.repartitionByRange(*by))
                    .withColumn("_chunk", F.spark_partition_id()), "numbered_chunks")
    per = d.groupBy(*keys, "_chunk").agg(F.count(F.lit(1)).alias("_k"))
    own = Window.partitionBy(*keys)
    per = per.select(*keys, "_chunk", F.sum("_k").over(own).alias(total),
                     (F.sum("_k").over(own.orderBy("_chunk")) - F.col("_k")).alias("_before"))
    d = d.withColumn("_row", F.row_number().over(Window.partitionBy("_chunk", *keys).orderBy(*order)))
    d = null_safe_join(d, per, [*keys, "_chunk"])
    return d.withColumn(number, F.col("_before") + F.col("_row") - 1).drop("_before", "_row", "_chunk")


def previous_value(df: DataFrame, keys: Sequence[str], ts: str, value: str,
                   out: str = "prev", span: str = "1 day") -> DataFrame:
    """``lag(value) OVER (PARTITION BY keys ORDER BY ts)`` without sending a
    key's whole series to one task: lag inside each ``(keys, span)``, and the
    first row of a span takes the last value of the key's previous non-empty
    span from a calendar-bounded (keys x spans) carry table."""
    keys = list(keys)
    d = df.withColumn("_span", bucket_start(ts, span))
    w = Window.partitionBy(*keys, "_span").orderBy(ts)
    d = d.withColumn(out, F.lag(value).over(w)).withColumn("_first", F.row_number().over(w) == 1)
    lasts = d.groupBy(*keys, "_span").agg(F.max_by(value, ts).alias("_last"))
    ws = Window.partitionBy(*keys).orderBy("_span")
    carry = lasts.select(*keys, "_span", F.lag("_last").over(ws).alias("_carry"))
    d = null_safe_join(d, carry, [*keys, "_span"], "left")
    return d.withColumn(out, F.when(F.col("_first"), F.col("_carry")).otherwise(F.col(out))).drop("_span", "_carry", "_first")
