"""Keep-latest de-duplication."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame
from pyspark.sql import functions as F


def keep_latest(df: DataFrame, keys: Sequence[str], order: Sequence[str]) -> DataFrame:
    """One row per ``keys``: the row greatest in ``order`` (e.g. ingestion time,
    then file name as a tie-break).  A grouped ``max_by`` with a map-side
    partial aggregate, so repeated copies collapse before the shuffle."""
    keys = list(keys)
    rest = [c for c in df.columns if c not in keys]
    o = F.struct(*[F.col(c) for c in order])
    got = df.groupBy(*keys).agg(F.max_by(F.struct(*rest), o).alias("_row"))
    return got.select(*keys, *[F.col("_row")[c].alias(c) for c in rest])
