"""Refreshes are seen whole or not at all; months are cut into ordered files; scans read what is declared."""

import datetime as dt
import glob
import os

import pyarrow.parquet as pq
import pytest
from pyspark.sql import functions as F

from tickwave.operators.candles import CANDLE_COLUMNS, CANDLE_SCHEMA
from tickwave.operators.spread import venue_spread
from tickwave.session import scratch_path
from tickwave.sinks import snapshots
from tickwave.sinks.writers import read_candles, write_candles_refresh
from tickwave.sources.silver_tables import load_candles


def candles(spark, venue, first, n, step="1 HOUR", close=1.0):
    t = F.expr(f"TIMESTAMP_NTZ'{first}' + id * INTERVAL {step}")
    cols = {"timestamp": t, "exchange": F.lit(venue), "trade_count": F.lit(1).cast("long"), "is_interpolated": F.lit(False),
            "volume_btc": F.lit(1.0), "buy_volume_btc": F.lit(0.5), "sell_volume_btc": F.lit(0.5)}
    return spark.range(n).select(*[cols.get(c, F.lit(close)).alias(c) for c in CANDLE_COLUMNS])


@pytest.fixture
def root(spark):
    return scratch_path(spark, "t-snap").replace("file:", "")


def total(df):
    return df.agg(F.count(F.lit(1)), F.sum("close_clp")).first()


def test_failed_refresh_leaves_the_old_rows(spark, root):
    write_candles_refresh(candles(spark, "a", "2024-01-01", 2000), root, "a")
    bad = candles(spark, "a", "2024-01-01", 3000, close=2.0).withColumn(
        "close_clp", F.when(F.col("timestamp") > F.lit("2024-04-01").cast("timestamp_ntz"), F.raise_error(F.lit("broken input")).cast("double")).otherwise(F.col("close_clp")))
    with pytest.raises(Exception, match="broken input"):
        write_candles_refresh(bad, root, "a")
    assert tuple(total(read_candles(spark, root))) == (2000, 2000.0)
    assert len(snapshots.commits(spark, root, "a")) == 1
    # what the failed refresh left is no commit's folder; it goes once it is old
    left = {n for n, d, _ in snapshots.Folder(spark, f"{root}/exchange=a").entries() if n.startswith("snapshot=")}
    assert snapshots.expire(spark, root, "a", orphan_seconds=-60) == sorted(x[9:] for x in left if x[9:] != snapshots.current(spark, root, "a").snapshot)
    assert tuple(total(read_candles(spark, root))) == (2000, 2000.0)


def test_a_reader_keeps_its_snapshot(spark, root):
    write_candles_refresh(candles(spark, "a", "2024-01-01", 100), root, "a")
    write_candles_refresh(candles(spark, "b", "2024-01-01", 10), root, "b")
    begun = read_candles(spark, root)
    write_candles_refresh(candles(spark, "a", "2024-03-01", 50, close=7.0), root, "a")
    assert tuple(total(begun)) == (110, 110.0)
    assert tuple(total(read_candles(spark, root))) == (60, 360.0)
    write_candles_refresh(candles(spark, "a", "2024-03-01", 20), root, "a")
    assert [c.number for c in snapshots.commits(spark, root, "a")] == [2, 3]
    assert len(glob.glob(f"{root}/exchange=a/snapshot=*")) == 2
    assert snapshots.current(spark, root, "a").months == ["2024-03"]


def test_two_refreshes_that_end_together(spark, root):
    write_candles_refresh(candles(spark, "a", "2024-01-01", 5), root, "a")
    late = snapshots.new_snapshot()
    candles(spark, "a", "2024-01-01", 9).write.parquet(snapshots.snapshot_path(root, "a", late))
    write_candles_refresh(candles(spark, "a", "2024-01-01", 7), root, "a")
    with pytest.raises(RuntimeError, match="another refresh"):
        snapshots.commit(spark, root, "a", late, after=1)
    assert total(read_candles(spark, root))[0] == 7
    # a commit file that is still being written is none yet
    with open(f"{root}/exchange=a/_commits/00000003.json", "w") as f:
        f.write('{"number": 3, "snap')
    assert total(read_candles(spark, root))[0] == 7


@pytest.mark.parametrize("width", [None, "1 minute"])
def test_large_months_are_cut_into_ordered_files(spark, root, width):
    n, most = 50_000, 9_000  # January and a part of February by the minute
    write_candles_refresh(candles(spark, "a", "2024-01-01", n, "1 MINUTE").orderBy(F.rand(1)), root, "a", width=width, max_rows=most)
    write_candles_refresh(candles(spark, "b", "2024-01-01", 80, "12 HOUR"), root, "b", width=width and "12 hours", max_rows=most)
    months = {}
    for f in glob.glob(f"{root}/exchange=a/snapshot=*/*/*/*/*.parquet"):
        t = pq.read_table(f, partitioning=None)["timestamp"].to_pylist()
        assert t == sorted(t) and len(t) <= most
        months.setdefault(f.split("month=")[1][:2], []).append((t[0], t[-1], len(t)))
    assert sum(x[2] for v in months.values() for x in v) == n and len(months["01"]) >= 5 and len(months["02"]) == 1
    for v in months.values():
        v.sort()
        assert all(a[1] < b[0] for a, b in zip(v, v[1:]))
    assert len(glob.glob(f"{root}/exchange=b/snapshot=*/*/month=01/*/*.parquet")) == 1
    assert total(read_candles(spark, root))[0] == n + 80


def test_uneven_months_without_a_width(spark, root):
    # a third of all rows in one hour of the middle
    c = candles(spark, "a", "2024-01-01", 700).unionByName(candles(spark, "a", "2024-01-15 03:00:00", 350, "1 SECOND"))
    write_candles_refresh(c, root, "a", max_rows=400)
    sizes = [pq.read_metadata(f).num_rows for f in glob.glob(f"{root}/exchange=a/snapshot=*/*/*/*/*.parquet")]
    assert sum(sizes) == 1050 and max(sizes) <= 400


def test_declared_scan_opens_no_file(spark, root):
    for v, first in (("a", "2023-11-01"), ("b", "2023-12-01")):
        write_candles_refresh(candles(spark, v, first, 3000), root, v)
    month = glob.glob(f"{root}/exchange=a/snapshot=*/year=2024/month=02/part=0")[0]
    with open(os.path.join(month, "part-broken.parquet"), "wb") as f:
        f.write(b"no footer here")
    df = load_candles(spark, root)  # a scan that looked for a schema would fail here
    assert df.columns == [*CANDLE_COLUMNS, "year", "month"] and [f.dataType for f in df.schema][:11] == [f.dataType for f in CANDLE_SCHEMA]
    one = load_candles(spark, root, ts_from=dt.datetime(2023, 12, 15), ts_to=dt.datetime(2024, 1, 1), venues=["a"])
    assert {p.split("exchange=a/")[1].split("/", 1)[1].rsplit("/", 2)[0] for p in one.inputFiles()} == {"year=2023/month=12"}
    assert one.count() == 17 * 24
    assert load_candles(spark, root, year_min=2030, year_max=2031).count() == 0
    assert load_candles(spark, root, venues=["nowhere"]).columns == df.columns
    years = load_candles(spark, root, year_max=2023)
    assert {r[0] for r in years.select("year").distinct().collect()} == {2023}


def test_plain_folders_are_scanned_by_declaration(spark, root):
    from tickwave.sinks.writers import write_candles_dynamic
    write_candles_dynamic(candles(spark, "a", "2023-11-01", 3000), root)
    got = load_candles(spark, root, year_min=2023, year_max=2023, venues=["a"])
    assert got.count() == 61 * 24 and all("year=2023" in p for p in got.inputFiles())
    assert read_candles(spark, root).count() == 3000


def test_venue_join_prunes_both_sides(spark, root):
    write_candles_refresh(candles(spark, "a", "2023-11-01", 4000, close=2.0), root, "a")
    write_candles_refresh(candles(spark, "b", "2023-12-01", 4000), root, "b")
    both = venue_spread(load_candles(spark, root, venues=["a", "b"], common=True), "a", "b")
    assert both.count() == 4000 - 30 * 24
    assert not any("month=11" in p for p in both.inputFiles()) and any("month=12" in p for p in both.inputFiles())
    # a bound on the joined month reaches both scans
    jan = both.where((F.col("year") == 2024) & (F.col("month") == 1))
    plan = jan._jdf.queryExecution().executedPlan().toString()
    scans = [x for x in plan.split("\n") if "FileScan" in x]
    assert len(scans) == 2 and all("(month" in x and "(year" in x and "= 2024" in x for x in scans), scans
    assert jan.count() == 31 * 24
