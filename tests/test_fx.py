import datetime as dt

import pytest
from pyspark.sql import functions as F

from tests.paths import SF001, SF01
from tickwave.functions.timefn import local_date, local_wallclock
from tickwave.operators.fx import (
    asof_backward,
    assert_rate_coverage,
    convert_by_local_date,
    fill_daily,
    latest_per_date,
)
from tickwave.plans.fx_queries import filled_rates


def rates(spark, rows):
    return spark.createDataFrame(rows, "date date, rate double")


def test_eight_days_apart_passes_nine_fails(spark):
    d = dt.date(2024, 1, 1)
    ok = fill_daily(rates(spark, [(d, 1.0), (d + dt.timedelta(days=8), 2.0)])).orderBy("date").collect()
    assert len(ok) == 9 and sum(r["is_ffilled"] for r in ok) == 7
    assert ok[-1]["date"] == d + dt.timedelta(days=8) and not ok[-1]["is_ffilled"]
    assert max(r["age_days"] for r in ok) == 7
    with pytest.raises(Exception, match="exceeds max_back_days=7"):
        fill_daily(rates(spark, [(d, 1.0), (d + dt.timedelta(days=9), 2.0)])).collect()


def test_duplicate_date_last_position_wins(spark):
    src = spark.createDataFrame([(0, "2024-01-01", 1.0), (1, "2024-01-02", 2.0), (2, "2024-01-02", 3.0)],
                                "pos int, fecha string, valor double")
    got = {r["date"]: r["rate"] for r in latest_per_date(src).collect()}
    assert got == {dt.date(2024, 1, 1): 1.0, dt.date(2024, 1, 2): 3.0}


def test_santiago_dates_golden(spark):
    rows = [(dt.datetime(2024, 1, 9, 0, 0), dt.date(2024, 1, 8)),
            (dt.datetime(2024, 1, 9, 2, 30), dt.date(2024, 1, 8)),
            (dt.datetime(2024, 1, 9, 3, 0), dt.date(2024, 1, 9)),
            (dt.datetime(2024, 9, 8, 3, 59), dt.date(2024, 9, 7)),
            (dt.datetime(2024, 9, 8, 4, 0), dt.date(2024, 9, 8))]
    df = spark.createDataFrame(rows, "ts timestamp_ntz, want date")
    for tz in ("UTC", "America/Los_Angeles", "Asia/Tokyo"):
        spark.conf.set("spark.sql.session.timeZone", tz)
        try:
            got = df.select(local_date("ts").alias("d"), "want", local_wallclock("ts").alias("w")).collect()
        finally:
            spark.conf.set("spark.sql.session.timeZone", "UTC")
        assert all(r["d"] == r["want"] for r in got), tz
        assert got[-1]["w"] == dt.datetime(2024, 9, 8, 1, 0)


def test_rate_of_local_date_applied(spark):
    fx = rates(spark, [(dt.date(2024, 1, 8), 893.07), (dt.date(2024, 1, 9), 901.31)])
    facts = spark.createDataFrame([(dt.datetime(2024, 1, 9, 2, 30), 1.0), (dt.datetime(2024, 1, 9, 3, 0), 1.0)],
                                  "ts timestamp_ntz, p double")
    got = [r["p_clp"] for r in convert_by_local_date(facts, fill_daily(fx), "ts", ["p"], suffix="_clp")
           .orderBy("ts").collect()]
    assert got == [893.07, 901.31]


def test_missing_rate_fails_naming_dates(spark):
    fx = fill_daily(rates(spark, [(dt.date(2024, 1, 8), 1.0)]))
    facts = spark.createDataFrame([(dt.datetime(2024, 1, 20, 12, 0), 1.0)], "ts timestamp_ntz, p double")
    with pytest.raises(ValueError, match="2024-01-20"):
        assert_rate_coverage(facts, fx, "ts")
    with pytest.raises(Exception, match="no rate for local date 2024-01-20"):
        convert_by_local_date(facts, fx, "ts", ["p"]).collect()


def test_strict_fill_raises_on_sparse_history(spark):
    with pytest.raises(Exception, match="exceeds max_back_days"):
        filled_rates(spark, SF001).collect()
    assert filled_rates(spark, SF01).count() > 0


def test_asof_matches_brute_force(spark):
    import random
    rnd = random.Random(7)
    base = dt.date(2023, 11, 1)
    right = sorted({base + dt.timedelta(days=rnd.randrange(0, 120)) for _ in range(40)})
    rvals = [(d, float(i)) for i, d in enumerate(right)]
    left = [(i, base + dt.timedelta(days=rnd.randrange(-5, 130))) for i in range(300)]
    r = spark.createDataFrame(rvals, "date date, rate double")
    l = spark.createDataFrame(left, "id int, d date")
    got = {x["id"]: (x["date_matched"], x["rate"]) for x in asof_backward(l, r, "d", "date", ["rate"], tolerance_days=7).collect()}
    for i, d in left:
        prior = [(rd, v) for rd, v in rvals if rd <= d]
        want = prior[-1] if prior and (d - prior[-1][0]).days <= 7 else (None, None)
        assert got[i] == want, (i, d)


def test_zone_calendar_agrees_with_row_conversion(spark):
    """Every 7 minutes through 2024 (both DST changes included): the local date
    found through the UTC-bucket calendar equals convert_timezone per row."""
    days = spark.range(0, 368).select(F.date_add(F.lit("2023-12-31").cast("date"), F.col("id").cast("int"))
                                      .alias("date"), F.lit(1.0).alias("rate"))
    facts = spark.range(0, 366 * 24 * 60 // 7).select(
        (F.lit(dt.datetime(2024, 1, 1)).cast("timestamp_ntz") + F.col("id") * F.expr("INTERVAL '7' MINUTE"))
        .alias("ts"))
    got = convert_by_local_date(facts, days, "ts", [], missing="raise")
    bad = got.where(F.col("local_date") != local_date("ts"))
    assert bad.count() == 0
    assert got.count() == facts.count()


def _brute_fill(src, max_back):
    """Walk every day from the first to the last source date, carrying the
    last value; fail when a filled day is more than ``max_back`` days old."""
    vals = {}
    for d, v in src:
        vals[d] = v  # later rows win
    out, d, last = [], min(vals), None
    while d <= max(vals):
        if d in vals:
            last = (d, vals[d])
        elif max_back is not None and (d - last[0]).days > max_back:
            raise ValueError("gap")
        out.append((d, last[1], d != last[0], (d - last[0]).days))
        d += dt.timedelta(days=1)
    return out


def test_fill_matches_brute_force(spark):
    import random
    for seed in range(6):
        rnd = random.Random(seed)
        base = dt.date(2024, 1, 1)
        src = [(base + dt.timedelta(days=rnd.randrange(0, 60)), float(i)) for i in range(rnd.randrange(5, 25))]
        src = list(dict(src).items())  # one value per date (duplicates resolved before filling)
        for bound in (7, 3, None):
            try:
                want = _brute_fill(src, bound)
            except ValueError:
                want = None
            df = fill_daily(spark.createDataFrame(src, "date date, rate double"), bound)
            if want is None:
                with pytest.raises(Exception, match="exceeds max_back_days"):
                    df.collect()
            else:
                got = sorted((r["date"], r["rate"], r["is_ffilled"], r["age_days"]) for r in df.collect())
                assert got == want, (seed, bound)


def test_offsets_off_the_quarter_hour(spark):
    """Santiago in 1905 was 4:42:46 behind UTC: local midnight cuts a bucket."""
    fx = rates(spark, [(dt.date(1905, 6, d), float(d)) for d in (2, 3, 4)])
    start = dt.datetime(1905, 6, 3)
    facts = spark.createDataFrame([(start + dt.timedelta(minutes=m), 1.0) for m in range(0, 24 * 60, 3)],
                                  "ts timestamp_ntz, p double")
    for missing in ("raise", "null", "drop"):
        got = convert_by_local_date(facts, fx, "ts", ["p"], missing=missing).withColumn("want", local_date("ts")).collect()
        assert len(got) == 480
        assert all(r["local_date"] == r["want"] and r["p"] == r["want"].day for r in got)
        assert {r["want"].day for r in got} == {2, 3}
