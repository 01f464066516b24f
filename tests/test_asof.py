"""As-of join on instants, repeated dates, NULL keys and clashing names."""

import datetime as dt
import random

import pytest
from pyspark.sql import functions as F

from tickwave.operators.asof import asof_join
from tickwave.operators.fx import asof_backward, convert_by_local_date, fill_daily
from tickwave.operators.ordered import first_rows, numbered, previous_value
from tickwave.operators.quality import interval_scan

BASE = dt.datetime(2024, 1, 1)


def brute(lefts, rights, tolerance=None):
    out = []
    for k, t, i in lefts:
        fit = [r for r in rights if None not in (k, t, r[0], r[1]) and r[0] == k and r[1] <= t]
        best = max(fit, key=lambda r: (r[1], r[2], r[3]), default=None)
        if best and tolerance is not None and t - best[1] > tolerance:
            best = None
        out.append((k, t, i, *((best[1], best[3]) if best else (None, None))))
    return sorted(out, key=str)


@pytest.mark.parametrize("chunks", [1, 9, None])
@pytest.mark.parametrize("minutes", [None, 7])
def test_asof_equals_brute_force(spark, chunks, minutes):
    rnd = random.Random(4)
    keys = ["hot"] * 6 + ["a", "b", None]
    at = lambda: rnd.choice([None] + [BASE + dt.timedelta(seconds=30 * rnd.randrange(600))] * 9)
    lefts = [(rnd.choice(keys), at(), i) for i in range(400)] + [("no right", BASE, 1000)]
    rights = [(rnd.choice(keys), at(), rnd.randrange(3), float(rnd.randrange(50))) for _ in range(150)]
    l = spark.createDataFrame(lefts, "k string, t timestamp_ntz, side int")
    r = spark.createDataFrame(rights, "k string, t timestamp_ntz, o int, v double")
    tol = minutes and dt.timedelta(minutes=minutes)
    got = asof_join(l, r, "t", "t", ["v"], ["k"], minutes and F.expr(f"INTERVAL '{minutes}' MINUTE"), "o", chunks)
    assert got.columns == ["k", "t", "side", "t_matched", "v"]
    assert sorted(map(tuple, got.collect()), key=str) == brute(lefts, rights, tol)


def test_asof_spreads_a_hot_key_and_takes_numbers(spark):
    l = spark.range(20_000).select((F.col("id") * 3).alias("x"), F.lit("one").alias("k"))
    r = spark.range(6_000).select((F.col("id") * 10).alias("y"), F.lit("one").alias("k"), F.col("id").alias("n"))
    got = asof_join(l, r, "x", "y", ["n"], ["k"], F.lit(4), chunks=8)
    assert got.where(F.col("n").isNull() != ((F.col("x") % 10 > 4) | (F.col("x") - F.floor(F.col("x") / 10) * 10 > 4))).count() == 0
    assert got.where(F.col("n").isNotNull() & (F.col("n") != F.floor(F.col("x") / 10))).count() == 0
    assert asof_join(l.limit(0), r, "x", "y", ["n"]).count() == 0 and asof_join(l, r.limit(0), "x", "y", ["n"]).where("n IS NOT NULL").count() == 0
    with pytest.raises(ValueError, match="already has"):
        asof_join(l, r.withColumn("x", F.lit(1)), "x", "y", ["x"])


def day(n):
    return dt.date(2024, 1, n)


def test_repeated_right_dates(spark):
    r = spark.createDataFrame([(day(5), 1.0, 0), (day(5), 9.0, 2), (day(5), 5.0, 1), (day(8), 2.0, 0)], "date date, rate double, pos int")
    l = spark.createDataFrame([(i, day(i)) for i in range(3, 12)], "id int, d date")
    got = {x["id"]: (x["date_matched"], x["rate"]) for x in asof_backward(l, r, "d", "date", ["rate"], tolerance_days=2, order="pos").collect()}
    assert got == {3: (None, None), 4: (None, None), 5: (day(5), 9.0), 6: (day(5), 9.0), 7: (day(5), 9.0), 8: (day(8), 2.0),
                   9: (day(8), 2.0), 10: (day(8), 2.0), 11: (None, None)}
    assert asof_backward(l, r, "d", "date", ["rate"]).count() == 9
    f = fill_daily(r, order="pos").orderBy("date").collect()
    assert [(x["date"], x["rate"], x["age_days"]) for x in f] == [(day(5), 9.0, 0), (day(6), 9.0, 1), (day(7), 9.0, 2), (day(8), 2.0, 0)]


def test_null_keys_keep_rows_and_carries(spark):
    rows = [(None if i % 3 else "a", BASE + dt.timedelta(hours=7 * i), float(i)) for i in range(30)]
    df = spark.createDataFrame(rows, "k string, t timestamp_ntz, v double")
    n = numbered(df, ["k"], ["t"], chunks=5).collect()
    assert len(n) == 30 and sorted(r["_n"] for r in n if r["k"] is None) == list(range(20))
    want, last = {}, {}
    for k, t, v in rows:
        want[t] = last.get(k)
        last[k] = v
    assert {r["t"]: r["prev"] for r in previous_value(df, ["k"], "t", "v").collect()} == want
    # a NULL before a row is its previous value, across days too
    holes = spark.createDataFrame([("a", BASE, 1.0), ("a", BASE + dt.timedelta(hours=1), None), ("a", BASE + dt.timedelta(hours=2), 3.0),
                                   ("a", BASE + dt.timedelta(days=2), 4.0)], "k string, t timestamp_ntz, v double")
    assert [r["prev"] for r in previous_value(holes, ["k"], "t", "v").orderBy("t").collect()] == [None, 1.0, None, 3.0]
    iv = spark.createDataFrame([(None, BASE + dt.timedelta(hours=i), BASE + dt.timedelta(hours=i + 1), str(i)) for i in range(40)],
                               "k string, start timestamp_ntz, `end` timestamp_ntz, label string")
    assert interval_scan(iv, ["k"], chunks=7).where("prev_end IS NULL").count() == 1


def test_conversion_refuses_what_it_can_not_name(spark):
    facts = spark.createDataFrame([(1, BASE + dt.timedelta(hours=12), 2.0, "x", "y")], "id int, ts timestamp_ntz, p double, _ld string, _rate string")
    rate = spark.createDataFrame([(day(1), 10.0)], "date date, rate double")
    got = convert_by_local_date(facts, rate, "ts", ["p"]).first()
    assert (got["p"], got["_ld"], got["_rate"], got["rate"], got["local_date"]) == (20.0, "x", "y", 10.0, day(1))
    with pytest.raises(ValueError, match="rate"):
        convert_by_local_date(facts.withColumn("rate", F.lit(1)), rate, "ts", ["p"])
    kept = convert_by_local_date(facts.withColumn("rate", F.lit(1)), rate, "ts", ["p"], rate_as="fx").first()
    assert (kept["rate"], kept["fx"]) == (1, 10.0)
    two = rate.unionByName(spark.createDataFrame([(day(1), 11.0)], "date date, rate double"))
    with pytest.raises(ValueError, match="more than one rate"):
        convert_by_local_date(facts, two, "ts", ["p"])


def test_first_rows_are_limited_before_the_shuffle(spark):
    df = spark.range(1000).select((F.col("id") % 3).alias("k"), "id")
    got = first_rows(df, ["k"], ["id"], 2)
    assert sorted((r["k"], r["id"]) for r in got.collect()) == [(0, 0), (0, 3), (1, 1), (1, 4), (2, 2), (2, 5)]
    assert "WindowGroupLimit" in got._jdf.queryExecution().executedPlan().toString()
