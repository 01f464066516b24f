import datetime as dt
import json

import pytest
from pyspark.sql import functions as F

from tickwave.operators.periods import (
    RISK_OK,
    RISK_TIMEOUT,
    adaptive_periods,
    closed_monthly_periods,
    estimate_rollup,
    months_between,
    period_breakdown,
    volume_estimate,
)
from tickwave.sources.bronze import read_volume_sample
from tickwave.sources.schemas import VOLUME_SAMPLE_SCHEMA

#: year, month, trades on day 15, pages, then by hand: estimate, pages a month, seconds, risk, granularity, periods
MONTHS = [
    (2021, 2, 400, 4, 11200, 112, 336.0, RISK_OK, "monthly", [(1, 1)]),
    (2021, 3, 800, 8, 24800, 248, 744.0, RISK_OK, "biweekly", [(1, 16), (16, 1)]),
    (2021, 4, 1000, 10, 30000, 300, 900.0, RISK_OK, "biweekly", [(1, 16), (16, 1)]),
    (2021, 5, 1100, 11, 34100, 341, 1023.0, RISK_TIMEOUT, "weekly", [(1, 8), (8, 15), (15, 22), (22, 29), (29, 1)]),
    (2021, 6, -1, 0, -1, 0, 0.0, RISK_OK, "monthly", [(1, 1)]),
    (2021, 7, 0, 0, 0, 0, 0.0, RISK_OK, "monthly", [(1, 1)]),
    (2023, 2, 1300, 13, 36400, 364, 1092.0, RISK_TIMEOUT, "weekly", [(1, 8), (8, 15), (15, 22), (22, 1)]),
]


def _ms(year, month, day):
    return int(dt.datetime(year, month, day, tzinfo=dt.timezone.utc).timestamp() * 1000)


def _periods(year, month, parts):
    nxt = (year + month // 12, month % 12 + 1, 1)
    return [(_ms(year, month, a), _ms(*nxt) if b == 1 else _ms(year, month, b)) for a, b in parts]


@pytest.fixture
def sample(spark, tmp_path):
    names = [f.name for f in VOLUME_SAMPLE_SCHEMA]
    fields = dict(year=0, month=1, trades_day_15=2, pages_day_15=3, trades_month_est=4, pages_month_est=5,
                  lambda_time_est_s=6, risk=7)
    path = tmp_path / "sample.json"
    path.write_text(json.dumps([{n: m[fields[n]] for n in names} for m in MONTHS], ensure_ascii=False))
    return read_volume_sample(spark, str(path))


def test_estimates_equal_hand_figures(sample):
    assert sample.count() == len(MONTHS)
    e = volume_estimate(sample.select("year", "month", "trades_day_15", "pages_day_15"))
    assert e.exceptAll(sample.select(*e.columns)).count() == 0
    r = estimate_rollup(e).first()
    assert (r["total_trades_est"], r["months_over_timeout"], r["months_near_timeout"]) == (136500, 2, 2)


@pytest.mark.parametrize("mmax,bmax,months", [
    (400, 1000, {"monthly": 3, "biweekly": 2, "weekly": 2}),
    (800, 1050, {"monthly": 4, "biweekly": 2, "weekly": 1}),
])
def test_adaptive_plan_equals_hand_figures(sample, mmax, bmax, months):
    p = adaptive_periods(sample, "s", mmax, bmax)
    assert {r["granularity"]: r["months"] for r in period_breakdown(p).collect()} == months
    if mmax == 400:
        want = sorted((m[8], *iv) for m in MONTHS for iv in _periods(m[0], m[1], m[9]))
        assert sorted((r["granularity"], r["start_ms"], r["end_ms"]) for r in p.collect()) == want


def test_closed_monthly_periods_every_month(spark):
    m = spark.range(1).select(F.explode(months_between(F.lit("2017-01-01").cast("date"),
                                                       F.lit("2026-04-01").cast("date"))).alias("month"))
    got = sorted(tuple(r) for r in closed_monthly_periods(m, "s").collect())
    firsts = [(y, k) for y in range(2017, 2027) for k in range(1, 13) if (y, k) <= (2026, 4)]
    assert len(got) == 112
    assert got == [("s", "1m", _ms(y, k, 1), _ms(y + k // 12, k % 12 + 1, 1) - 1) for y, k in firsts]


def test_weekly_split_february(spark):
    est = spark.createDataFrame([(2023, 2, 2000.0), (2024, 2, 2000.0), (2024, 3, 500.0)],
                                "year int, month int, lambda_time_est_s double")
    p = adaptive_periods(est, "s")
    counts = {(r["year"], r["month"]): r["count"] for r in p.groupBy("year", "month").count().collect()}
    assert counts == {(2023, 2): 4, (2024, 2): 5, (2024, 3): 2}


def test_published_row_arithmetic(spark):
    from tickwave.operators.fx import fill_daily
    src = spark.createDataFrame([(dt.date(2015, 1, 2), 1.0), (dt.date(2026, 5, 6), 2.0)], "date date, rate double")
    assert fill_daily(src, max_back_days=None).count() == 4143
    def months(a, b):
        return spark.range(1).select(F.size(months_between(F.lit(a).cast("date"), F.lit(b).cast("date")))).first()[0]
    assert months("2015-03-01", "2026-04-30") == 134
    assert months("2017-08-17", "2026-04-30") == 105


def test_adaptive_periods_tile_the_range(spark):
    """Whatever the estimates, the periods tile the months exactly."""
    import random
    from tickwave.functions.timefn import ms_to_ts
    from tickwave.operators.quality import interval_verdict
    rnd = random.Random(11)
    rows = [(y, m, float(rnd.choice([0, 350, 401, 999, 1001, 5000]))) for y in range(2015, 2031) for m in range(1, 13)]
    p = adaptive_periods(spark.createDataFrame(rows, "year int, month int, lambda_time_est_s double"), "s")
    iv = p.select(ms_to_ts("start_ms").alias("start"), ms_to_ts("end_ms").alias("end"),
                  F.col("start_ms").cast("string").alias("label"))
    v = interval_verdict(iv).first()
    assert (v["gaps"], v["overlaps"], v["ok"]) == (0, 0, True)
    assert str(v["first_start"]) == "2015-01-01 00:00:00" and str(v["last_end"]) == "2031-01-01 00:00:00"
