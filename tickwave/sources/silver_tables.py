"""Catalogued scans of the Silver tables."""

from __future__ import annotations

import datetime as dt

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from tickwave.operators.candles import CANDLE_COLUMNS, CANDLE_SCHEMA
from tickwave.sinks import snapshots


#: Columns of a candle file; exchange, year and month come from its folders.
FILE_SCHEMA = T.StructType([f for f in CANDLE_SCHEMA if f.name != "exchange"]
                           + [T.StructField("year", T.IntegerType()), T.StructField("month", T.IntegerType())])


def load_candles(spark: SparkSession, root: str, ts_from: dt.datetime | None = None,
                 ts_to: dt.datetime | None = None, year_min: int | None = None,
                 year_max: int | None = None, venues: list[str] | None = None, common: bool = False) -> DataFrame:
    """Scan of declared venues, years and months with a fixed schema.

    The folders to read are made from the declaration: the venues, the years
    ``year_min`` to ``year_max`` and the months that ``[ts_from, ts_to)`` touches.
    A venue with commits is read from its current snapshot, whose months its
    commit names; of a plain venue those declared months that exist (all of them
    where nothing bounds the years).  Absent months are skipped, no file is
    opened to find a schema or rows, and a declared scan with nothing in it is an
    empty table.  ``common`` leaves only the months that every venue has: an
    inner join of the venues on time loses nothing by it."""
    names = venues if venues is not None else snapshots.venues(spark, root)
    low = max([x for x in (year_min and year_min * 100, ts_from and ts_from.year * 100 + ts_from.month) if x], default=None)
    last = ts_to - dt.timedelta(microseconds=1) if ts_to else None
    high = min([x for x in (year_max and year_max * 100 + 12, last and last.year * 100 + last.month) if x], default=None)
    found = {}
    for v in names:
        folder, months = _venue_months(spark, root, v, low, high)
        found[v] = folder, {m for m in months if (low is None or m >= low) and (high is None or m <= high)}
    if common and found:
        shared = set.intersection(*(m for _, m in found.values()))
        found = {v: (folder, shared) for v, (folder, _) in found.items()}
    out = None
    for v, (folder, months) in found.items():
        paths = [f"{folder}/year={m // 100}/month={m % 100:02d}" for m in sorted(months)]
        if not paths:
            continue
        one = (spark.read.schema(FILE_SCHEMA).option("basePath", folder).parquet(*paths)
               .select(*[F.lit(v).alias("exchange") if c == "exchange" else F.col(c) for c in CANDLE_COLUMNS], "year", "month"))
        out = one if out is None else out.unionByName(one)
    if out is None:
        out = spark.createDataFrame([], T.StructType([*CANDLE_SCHEMA, *FILE_SCHEMA[-2:]]))
    if ts_from is not None:
        out = out.where(F.col("timestamp") >= _ntz(ts_from))
    if ts_to is not None:
        out = out.where(F.col("timestamp") < _ntz(ts_to))
    return out


def _venue_months(spark: SparkSession, root: str, venue: str, low: int | None, high: int | None) -> tuple[str, list[int]]:
    """The folder that holds a venue's months, and its months as YYYYMM."""
    done = snapshots.current(spark, root, venue)
    if done is not None:
        return snapshots.snapshot_path(root, venue, done.snapshot), [int(m.replace("-", "")) for m in done.months]
    base = snapshots.venue_root(root, venue)
    folder = snapshots.Folder(spark, base)
    if low is not None and high is not None:
        declared = [y * 100 + m for y in range(low // 100, high // 100 + 1) for m in range(1, 13)]
        return base, [m for m in declared if folder.exists(f"year={m // 100}/month={m % 100:02d}")]
    return base, [int(y[5:]) * 100 + int(m[6:]) for y, is_year, _ in folder.entries() if is_year and y.startswith("year=")
                  for m, is_month, _ in folder.entries(y) if is_month and m.startswith("month=")]


def _ntz(t: dt.datetime):
    """A wall-clock literal parsed as TIMESTAMP_NTZ (no session or driver zone
    involved, unlike a Python datetime literal)."""
    return F.to_timestamp_ntz(F.lit(t.strftime("%Y-%m-%d %H:%M:%S.%f")))


def load_rates(spark: SparkSession, path: str) -> DataFrame:
    """The daily rate dimension ``(date, usdclp, is_ffilled)``."""
    return spark.read.parquet(path)
