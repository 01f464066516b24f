"""Backward as-of join on instants, without gathering a key.

Both sides are put into one table and read in the order of (keys, time), right
rows before left rows of the same time.  Range partitioning cuts that order into
chunks of about equal size; within each (chunk, key) the last right row so far is
carried along, and what a chunk has to start with comes from a table with one row
per (key, chunk).  A key that holds a third of all rows is spread over many chunks.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from tickwave.operators.ordered import null_safe_join
from tickwave.session import materialize


def asof_join(left: DataFrame, right: DataFrame, left_on: str, right_on: str, values: Sequence[str],
              keys: Sequence[str] = (), tolerance: Column | None = None, order: str | None = None,
              chunks: int | None = None) -> DataFrame:
    """Every left row with the right row of the greatest ``right_on <= left_on``
    among those of equal ``keys``: ``<right_on>_matched`` and ``values``, or NULLs
    where there is none or it lies more than ``tolerance`` (an interval, or a number
    for numeric times) before.

    Times may be instants, dates or numbers.  Of right rows with equal keys and
    time the one greatest in ``order``, then in its values, serves.  A NULL key or
    time matches nothing, on either side; every left row comes back once."""
    keys, values = list(keys), list(values)
    matched = f"{right_on}_matched"
    if clash := {matched, *values} & set(left.columns):
        raise ValueError(f"left side already has {sorted(clash)}; rename them")
    named = [F.col(k).alias(f"k{i}") for i, k in enumerate(keys)]
    ks = [f"k{i}" for i in range(len(keys))]
    tie = F.struct(*[F.col(c).alias(f"o{i}") for i, c in enumerate(([order] if order else []) + values)])
    known = F.col(right_on).isNotNull()
    for k in keys:
        known &= F.col(k).isNotNull()
    r = right.where(known).select(*named, F.col(right_on).alias("t"), F.lit(0).alias("side"), tie.alias("o"),
                                  F.struct(F.col(right_on).alias("at"), *[F.col(v).alias(f"v{i}") for i, v in enumerate(values)]).alias("r"))
    types = r.schema
    lft = left.select(*named, F.col(left_on).alias("t"), F.lit(1).alias("side"), F.lit(None).cast(types["o"].dataType).alias("o"),
                      F.lit(None).cast(types["r"].dataType).alias("r"), F.struct(*left.columns).alias("l"))
    both = r.withColumn("l", F.lit(None).cast(lft.schema["l"].dataType)).unionByName(lft)
    by = [*ks, "t", "side", "o"]
    # the chunk id is written with the rows, so both branches read the same one
    d = materialize((both.repartitionByRange(chunks, *by) if chunks else both.repartitionByRange(*by))
                    .withColumn("c", F.spark_partition_id()), "asof_chunks")
    own = Window.partitionBy("c", *ks).orderBy("t", "side", "o").rowsBetween(Window.unboundedPreceding, Window.currentRow)
    lefts = d.withColumn("near", F.last("r", ignorenulls=True).over(own)).where(F.col("side") == 1)
    per = d.groupBy(*ks, "c").agg(F.max_by("r", F.when(F.col("side") == 0, F.struct("t", "o"))).alias("r"))
    before = Window.partitionBy(*ks).orderBy("c").rowsBetween(Window.unboundedPreceding, -1)
    carry = per.select(*ks, "c", F.last("r", ignorenulls=True).over(before).alias("carry"))
    j = null_safe_join(lefts.select(*ks, "c", "t", "l", "near"), carry, [*ks, "c"], "left")
    got = F.coalesce("near", "carry")
    here = F.col("t").isNotNull()
    if tolerance is not None:
        here &= F.col("t") - got["at"] <= tolerance
    j = j.withColumn("got", F.when(here, got))
    return j.select(*[F.col("l")[c].alias(c) for c in left.columns], F.col("got")["at"].alias(matched),
                    *[F.col("got")[f"v{i}"].alias(v) for i, v in enumerate(values)])
