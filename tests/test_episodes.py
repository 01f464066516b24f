import datetime as dt

from pyspark.sql import functions as F

from tests.paths import SF01
from tickwave.operators.bars import ohlcv_bars
from tickwave.operators.candles import CANDLE_SCHEMA
from tickwave.operators.islands import islands, islands_naive, islands_session_window
from tickwave.operators.spread import spread_episodes, venue_spread
from tickwave.plans.standins import VENUE_K, VENUE_T, events_candles


def candles(spark, closes_t, close_k=100.0, start=dt.datetime(2024, 1, 1)):
    rows = []
    for m, c in closes_t.items():
        ts = start + dt.timedelta(minutes=m)
        rows.append((ts, "T", c, c, c, c, 1.0, 0.5, 0.5, 1, False))
    for m in range(0, max(closes_t) + 1):
        ts = start + dt.timedelta(minutes=m)
        rows.append((ts, "K", close_k, close_k, close_k, close_k, 1.0, 0.5, 0.5, 1, False))
    return spark.createDataFrame(rows, CANDLE_SCHEMA)


def test_hand_worked_episodes(spark):
    closes = {0: 102, 1: 103, 2: 102, 3: 101, 4: 102, 5: 102, 6: 104, 7: 102, 8: 110, 11: 120}
    c = candles(spark, {k: float(v) for k, v in closes.items()})
    ep = spread_episodes(c, "T", "K", 0.01, min_bars=1, top=None).orderBy("start_local")
    got = [(r["minutes"], r["mean_spread_pct"], r["max_spread_pct"], r["area_pct_minutes"]) for r in ep.collect()]
    assert got == [(3, 2.33, 3.0, 7.0), (5, 4.0, 10.0, 20.0), (1, 20.0, 20.0, 20.0)]
    kept = spread_episodes(c, "T", "K", 0.01, min_bars=5, top=20)
    assert [r["minutes"] for r in kept.collect()] == [5]


def test_interpolated_premium_minutes_excluded(spark):
    c = candles(spark, {0: 105.0, 1: 105.0, 2: 105.0})
    c = c.withColumn("is_interpolated", (F.col("exchange") == "T") & (F.minute("timestamp") == 1))
    ep = spread_episodes(c, "T", "K", 0.01, min_bars=1, top=None)
    assert sorted(r["minutes"] for r in ep.collect()) == [1, 1]


def _rows(spark, secs):
    base = dt.datetime(2024, 1, 1, 23, 59)
    return spark.createDataFrame([(base + dt.timedelta(seconds=s), 1.0) for s in secs], "ts timestamp_ntz, v double")


def test_gap_exactly_60_merges_61_splits(spark):
    for form in (islands, islands_naive, islands_session_window):
        r = form(_rows(spark, [0, 60, 120]), "ts", "v", 60)
        assert r.count() == 1, form.__name__
        r = form(_rows(spark, [0, 61, 122]), "ts", "v", 60)
        assert r.count() == 3, form.__name__


def test_island_across_midnight(spark):
    # 23:59, 00:00, 00:01 of the next day form one island
    r = islands(_rows(spark, [0, 60, 120, 500]), "ts", "v", 60).orderBy("island_start").collect()
    assert [x["n"] for x in r] == [3, 1]


def _key(df):
    return df.select("island_start", "island_end", "n", F.round("v_sum", 9).alias("s"),
                     F.round("v_max", 12).alias("mx"), F.round("v_min", 12).alias("mn"))


def test_distributed_islands_equal_naive(spark):
    for width, secs in (("15 minutes", 900), ("1 minute", 60)):
        c = events_candles(spark, SF01, width)
        s = venue_spread(c, VENUE_T, VENUE_K).where(F.col("spread") > 0.01)
        a = _key(islands(s, "timestamp", "spread", secs))
        b = _key(islands_naive(s, "timestamp", "spread", secs))
        assert a.count() == b.count()
        assert a.exceptAll(b).count() == 0 and b.exceptAll(a).count() == 0


def test_ranked_by_area_with_start_tiebreak(spark):
    c = events_candles(spark, SF01, "15 minutes")
    ep = spread_episodes(c, VENUE_T, VENUE_K, 0.01, min_bars=5, top=20, bar_seconds=900).collect()
    areas = [r["minutes"] * r["mean_spread_pct"] for r in ep]
    assert 0 < len(ep) <= 20
    assert all(areas[i] >= areas[i + 1] - 1e-6 for i in range(len(areas) - 1))


def test_bars_partial_aggregation_plan(spark, capsys):
    from tickwave.plans.standins import events_trades
    ohlcv_bars(events_trades(spark, SF01), "1 minute").explain()
    plan = capsys.readouterr().out
    assert "partial_min_by" in plan and "ReadSchema: struct<event_id:bigint,ts:timestamp_ntz" in plan


def test_distributed_islands_equal_naive_random(spark):
    """Seeded random series (gaps of 1-3 bars, straddling midnights, a hot key
    holding most rows): distributed islands equal the single-window form."""
    import random
    for seed in (1, 2, 3):
        rnd = random.Random(seed)
        rows = []
        for key, n in (("hot", 900), ("cold", 60)):
            t = dt.datetime(2024, 3, 1, 22, 0)
            for _ in range(n):
                t += dt.timedelta(minutes=rnd.choice([1, 1, 1, 2, 3]))
                rows.append((key, t, rnd.random()))
        df = spark.createDataFrame(rows, "k string, ts timestamp_ntz, v double")
        a = islands(df, "ts", "v", 60, keys=["k"]).select("k", "island_start", "island_end", "n",
                                                          F.round("v_sum", 9).alias("s"), "v_max", "v_min")
        b = islands_naive(df, "ts", "v", 60, keys=["k"]).select("k", "island_start", "island_end", "n",
                                                                F.round("v_sum", 9).alias("s"), "v_max", "v_min")
        assert a.count() == b.count()
        assert a.exceptAll(b).count() == 0 and b.exceptAll(a).count() == 0, seed
