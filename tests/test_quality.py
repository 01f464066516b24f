import datetime as dt
import json
import os

import pytest
from pyspark.sql import Observation
from pyspark.sql import functions as F

from tickwave.functions.timefn import ms_to_ts
from tickwave.operators.dedup import keep_latest
from tickwave.operators.quality import (
    envelope_ranges,
    interval_neighbours,
    interval_verdict,
    source_alignment,
)
from tickwave.plans import silver
from tickwave.session import scratch_path
from tickwave.sources import schemas as S
from tickwave.sources.bronze import decode_trades, read_json_docs, read_period_list


def iv(spark, pairs, day=dt.datetime(2024, 1, 1)):
    rows = [(day + dt.timedelta(minutes=a), day + dt.timedelta(minutes=b), f"f{i}") for i, (a, b) in enumerate(pairs)]
    return spark.createDataFrame(rows, "start timestamp_ntz, `end` timestamp_ntz, label string")


def kinds(df, mode="neighbour"):
    n = interval_neighbours(df, mode=mode).orderBy("start", "end", "label").collect()
    return [(r["kind"], None if r["amount_seconds"] is None else float(r["amount_seconds"]) / 60) for r in n[1:]]


def test_interval_rules(spark):
    assert kinds(iv(spark, [(0, 10), (10, 20)])) == [(None, None)]
    assert kinds(iv(spark, [(0, 10), (12, 20)])) == [("gap", 2.0)]
    assert kinds(iv(spark, [(0, 10), (8, 20)])) == [("overlap", 2.0)]
    nested = iv(spark, [(0, 30), (5, 10), (30, 40)])
    assert kinds(nested) == [("overlap", 25.0), ("gap", 20.0)]
    assert kinds(nested, "running_max") == [("overlap", 25.0), (None, None)]


def test_interval_rules_across_chunks(spark):
    # one interval per chunk at most: every comparison goes through the carry
    nested = iv(spark, [(0, 3000), (5, 10), (3000, 4000), (4000, 6000)])
    for chunks in (1, 2, 4, 8):
        n = interval_neighbours(nested, chunks=chunks).orderBy("start", "end", "label").collect()
        assert [(r["kind"], r["prev_label"]) for r in n] == [(None, None), ("overlap", "f0"), ("gap", "f1"),
                                                             (None, "f2")]
        r = interval_neighbours(nested, mode="running_max", chunks=chunks).orderBy("start").collect()
        assert [x["kind"] for x in r] == [None, "overlap", None, None]
    v = interval_verdict(nested).first()
    assert (v["intervals"], v["gaps"], v["overlaps"], v["gaps_running_max"], v["ok"]) == (4, 1, 1, 0, False)


def test_interval_chunks_with_keys_and_hot_key(spark):
    """A key holding most rows spreads over chunks; results equal one window."""
    from pyspark.sql import Window
    rows = [("hot", i * 2, i * 2 + 3, f"h{i}") for i in range(400)] + \
           [(f"k{j}", j, j + 1, f"c{j}") for j in range(0, 40, 3)]
    base = dt.datetime(2024, 1, 1)
    df = spark.createDataFrame([(k, base + dt.timedelta(minutes=a), base + dt.timedelta(minutes=b), l)
                                for k, a, b, l in rows], "src string, start timestamp_ntz, `end` timestamp_ntz, label string")
    w = Window.partitionBy("src").orderBy("start", "end", "label")
    want = df.select("src", "label", F.lag("end").over(w).alias("prev_end"),
                     F.max("end").over(w.rowsBetween(Window.unboundedPreceding, -1)).alias("run"))
    for chunks in (3, 16):
        got = interval_neighbours(df, ["src"], chunks=chunks).select("src", "label", "prev_end")
        assert got.exceptAll(want.select("src", "label", "prev_end")).count() == 0
        got = interval_neighbours(df, ["src"], mode="running_max", chunks=chunks).select("src", "label", "prev_end")
        assert got.exceptAll(want.select("src", "label", F.col("run").alias("prev_end"))).count() == 0


def test_period_list_tilings(spark, tmp_path):
    """Half-open months tile a range; months that end on their last ms leave a gap each."""
    import calendar
    ms = lambda y, m: calendar.timegm((y, m, 1, 0, 0, 0)) * 1000
    months = [(y, m) for y in range(2022, 2025) for m in range(1, 13)]
    ends = [ms(y + m // 12, m % 12 + 1) for y, m in months]
    for closed, gaps in ((0, 0), (1, 35)):
        path = tmp_path / f"list{closed}.json"
        path.write_text(json.dumps({"periodos": [
            {"symbol": "s", "interval": "1m", "start_ms": ms(*p), "end_ms": e - closed} for p, e in zip(months, ends)]}))
        p = read_period_list(spark, str(path))
        for add, want in ((0, gaps), (closed, 0)):
            v = interval_verdict(p.select(ms_to_ts("start_ms").alias("start"), ms_to_ts(F.col("end_ms") + add).alias("end"),
                                          F.col("start_ms").cast("string").alias("label"))).first()
            assert (v["intervals"], v["gaps"], v["overlaps"]) == (36, want, 0)


def _write(path, name, text):
    os.makedirs(path, exist_ok=True)
    with open(os.path.join(path, name), "w") as f:
        f.write(text)


def test_envelope_classes_and_decoding(spark, tmp_path):
    d = str(tmp_path / "bronze")
    trade = {"metadata": {"symbol": "s", "range_start_ms": 0, "range_end_ms": 100, "records_count": 1},
             "data": [["50", "0.5", "100", "buy", 7]]}
    kl = {"metadata": {"symbol": "k", "interval": "1m", "records_count": 2},
          "data": [["60000", "1", "1", "1", "1", "1", "119999", "0", "1", "1", "0", "0"],
                   ["120000", "1", "1", "1", "1", "1", "179999", "0", "1", "1", "0", "0"]]}
    _write(d, "a.json", json.dumps(trade))
    _write(d, "b.json", json.dumps(kl))
    _write(d, "c.json", json.dumps({"metadata": {"symbol": "s", "records_count": 0}, "data": []}))
    _write(d, "d.json", json.dumps({"metadata": {"symbol": "s"}}))
    _write(d, "e.json", json.dumps(trade)[:40])
    _write(d, "skip.txt", "not json")
    docs = read_json_docs(spark, d, S.ANY_ENVELOPE_DDL, tolerant=True)
    got = {r["file"].split("/")[-1]: (r["class"], r["start_ms"], r["end_ms"]) for r in envelope_ranges(docs).collect()}
    assert got == {"a.json": ("range", 0, 100), "b.json": ("derived", 60000, 180000),
                   "c.json": ("empty", None, None), "d.json": ("failed", None, None),
                   "e.json": ("failed", None, None)}
    t = decode_trades(read_json_docs(spark, [d + "/a.json", d + "/c.json", d + "/d.json"], S.TRADE_ENVELOPE_DDL))
    assert [(r["trade_id"], r["price"], r["amount"], r["side"]) for r in t.collect()] == [(7, 100.0, 0.5, "buy")]


def test_text_in_numeric_position_fails(spark, tmp_path):
    d = str(tmp_path / "bad")
    _write(d, "a.json", json.dumps({"metadata": {"symbol": "s"}, "data": [["50", "abc", "100", "buy", 7]]}))
    with pytest.raises(Exception, match="CAST_INVALID_INPUT|cannot be cast"):
        decode_trades(read_json_docs(spark, d, S.TRADE_ENVELOPE_DDL)).collect()


def test_klines_dedup_latest_and_off_grid(spark, tmp_path):
    d = str(tmp_path / "k")
    row = lambda t, c: [str(t), "1", "2", "0.5", str(c), "3", str(t + 59999), "0", "4", "1", "0", "0"]
    _write(d + "/r1", "a.json", json.dumps({"metadata": {"symbol": "k", "ingestion_timestamp_utc": "2024-01-01T00:00:00+00:00"},
                                            "data": [row(60000, 10), row(120000, 11), row(150000, 99)]}))
    _write(d + "/r2", "b.json", json.dumps({"metadata": {"symbol": "k", "ingestion_timestamp_utc": "2024-01-02T00:00:00+00:00"},
                                            "data": [row(120000, 12)]}))
    on, off = silver.klines_usdt(spark, d)
    assert sorted((r["open_time_ms"], r["close"]) for r in on.collect()) == [(60000, 10.0), (120000, 12.0)]
    assert [r["open_time_ms"] for r in off.collect()] == [150000]
    counts = Observation("klines-test")
    assert silver.klines_real_bars(spark, d, counts).count() == 2
    assert counts.get == {"klines": 3, "off_grid": 1}


def test_candles_refuse_a_second_symbol(spark, tmp_path):
    d = str(tmp_path / "two")
    for s in ("a", "b"):
        _write(d, f"{s}.json", json.dumps({"metadata": {"symbol": s}, "data": [["50", "1", "100", "buy", 7]]}))
    with pytest.raises(ValueError, match="more than one symbol"):
        silver.trades_to_candles(spark, d, "venue_t")


def test_keep_latest(spark):
    df = spark.createDataFrame([(1, "a", 1), (1, "b", 3), (2, "c", 1)], "k int, v string, ts int")
    assert sorted(tuple(r) for r in keep_latest(df, ["k"], ["ts"]).collect()) == [(1, "b", 3), (2, "c", 1)]


def test_alignment(spark):
    t = lambda d: dt.datetime(2024, 1, d)
    r = spark.createDataFrame([("a", t(1), t(20)), ("b", t(5), t(25)), ("c", t(3), t(15))],
                              "source string, start timestamp_ntz, `end` timestamp_ntz")
    a = source_alignment(r).first()
    assert (a["common_start"], a["common_end"], a["start_limited_by"], a["end_limited_by"], a["common_days"]) == \
        (t(5), t(15), "b", "c", 10.0)
    none = spark.createDataFrame([("a", t(1), t(2)), ("b", t(5), t(6))], "source string, start timestamp_ntz, `end` timestamp_ntz")
    assert source_alignment(none).first()["has_common_range"] is False
    missing = spark.createDataFrame([("a", t(1), t(20)), ("b", None, None)], "source string, start timestamp_ntz, `end` timestamp_ntz")
    assert source_alignment(missing).first()["has_common_range"] is False


def test_scratch_under_checkpoint_dir(spark):
    p = scratch_path(spark, "x")
    assert p.startswith(spark.sparkContext.getCheckpointDir())


def test_kline_job_reports_missing_rate_dates(spark, tmp_path):
    import datetime as _dt
    d = str(tmp_path / "k2")
    row = lambda t: [str(t), "1", "2", "0.5", "1", "3", str(t + 59999), "0", "4", "1", "0", "0"]
    _write(d, "a.json", json.dumps({"metadata": {"symbol": "k", "ingestion_timestamp_utc": "2024-01-01T00:00:00+00:00"},
                                    "data": [row(1704153600000), row(1704153660000)]}))
    rates = spark.createDataFrame([(_dt.date(2023, 12, 1), 1.0)], "date date, rate double")
    with pytest.raises(ValueError, match="2024-01-01"):
        silver.run_klines_refresh(spark, d, rates, str(tmp_path / "out"), "k")


def test_failed_kline_refresh_keeps_previous_data(spark, tmp_path):
    import datetime as _dt
    d = str(tmp_path / "k3")
    row = lambda t: [str(t), "1", "2", "0.5", "1", "3", str(t + 59999), "0", "4", "1", "0", "0"]
    _write(d, "a.json", json.dumps({"metadata": {"symbol": "k", "ingestion_timestamp_utc": "2024-01-01T00:00:00+00:00"},
                                    "data": [row(1704153600000), row(1704153780000)]}))
    out = str(tmp_path / "silver")
    good = spark.createDataFrame([(_dt.date(2024, 1, 1), 900.0)], "date date, rate double")
    m = silver.run_klines_refresh(spark, d, good, out, "k")
    assert m["rows_out"] == 4
    bad = spark.createDataFrame([(_dt.date(2023, 12, 1), 1.0)], "date date, rate double")
    with pytest.raises(ValueError, match="2024-01-01"):
        silver.run_klines_refresh(spark, d, bad, out, "k")
    kept = spark.read.parquet(out)
    assert kept.count() == 4 and kept.agg(F.max("close_clp")).first()[0] == 900.0


def test_interval_scan_with_payload_and_small_partitions(spark):
    """Extra columns and many chunks change nothing, and runs agree."""
    from pyspark.sql import Window
    from tickwave.operators.quality import interval_scan
    iv = spark.range(20_000).select(
        (F.col("id") % 3).alias("k"), F.timestamp_seconds(F.pmod(F.xxhash64("id"), F.lit(10_000_000))).alias("start"),
        F.col("id").cast("string").alias("label"), F.sha2(F.col("id").cast("string"), 256).alias("payload"))
    iv = iv.withColumn("end", F.col("start") + F.expr("make_dt_interval(0, 0, 0, pmod(xxhash64(label), 5000))"))
    w = Window.partitionBy("k").orderBy("start", "end", "label")
    cols = ["label", "prev_end", "prev_label", "run_end"]
    want = sorted(map(str, iv.select("label", F.lag("end").over(w).alias("prev_end"), F.lag("label").over(w).alias("prev_label"),
                                     F.max("end").over(w.rowsBetween(Window.unboundedPreceding, -1)).alias("run_end")).collect()))
    for chunks in (8, 8, 31):
        got = interval_scan(iv, ["k"], chunks=chunks).select(*cols).collect()
        assert sorted(map(str, got)) == want


def test_verdict_keeps_sources_with_only_failed_files(spark):
    from tickwave.operators.quality import interval_verdict
    iv = spark.sql("select 'a' source, timestamp_ntz'2024-01-01' start, timestamp_ntz'2024-01-02' end, 'f' label")
    failed = spark.createDataFrame([("b", 3)], "source string, failed long")
    rows = {r.source: r for r in interval_verdict(iv, ["source"], failed=failed).collect()}
    assert rows["a"].ok and rows["a"].failed == 0
    assert (rows["b"].ok, rows["b"].failed, rows["b"].intervals) == (False, 3, 0)
