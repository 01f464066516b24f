"""Plan shape: operators over raw rows never gather a series into one task."""

import io
from contextlib import redirect_stdout

from pyspark.sql import functions as F

from tests.paths import SF01
from tickwave.operators.bars import ohlcv_bars
from tickwave.operators.fx import convert_by_local_date, fill_daily
from tickwave.operators.grid import continuous_bars
from tickwave.plans.fx_queries import filled_rates
from tickwave.plans.standins import events_trades, table


def plan(df) -> str:
    buf = io.StringIO()
    with redirect_stdout(buf):
        df.explain()
    return buf.getvalue()


def test_bars_and_grid_have_no_single_partition(spark):
    bars = ohlcv_bars(events_trades(spark, SF01), "1 minute")
    p = plan(bars)
    assert "SinglePartition" not in p and "partial_max_by" in p
    g = plan(continuous_bars(bars, "1 minute"))
    assert "SinglePartition" not in g


def test_fact_conversion_is_broadcast_and_not_shuffled(spark):
    li = table(spark, SF01, "lineitem").select("l_orderkey", "l_shipdate", "l_extendedprice")
    c = convert_by_local_date(li, filled_rates(spark, SF01), "l_shipdate", ["l_extendedprice"], missing="drop")
    p = plan(c)
    assert "BroadcastHashJoin" in p
    # the only exchanges are on the (small) rate side: none above the lineitem scan
    fact_side = p.split("BroadcastHashJoin")[1].split("BroadcastExchange")[0]
    assert "Exchange hashpartitioning" not in fact_side
    assert "ReadSchema: struct<l_orderkey:bigint,l_extendedprice:double,l_shipdate:timestamp_ntz>" in p


def test_fill_is_calendar_sized(spark):
    f = fill_daily(filled_rates(spark, SF01).select("date", "rate").where(~F.col("is_ffilled")))
    assert f.count() == filled_rates(spark, SF01).count()


def test_raw_trades_are_hashed_not_sorted(spark):
    import random
    from tickwave.operators.bars import ohlcv_bars, packed_order
    from tickwave.plans.standins import events_trades
    plan = ohlcv_bars(events_trades(spark, SF01))._jdf.queryExecution().executedPlan().toString()
    assert "HashAggregate" in plan and "SortAggregate" not in plan
    rnd = random.Random(1)
    rows = [(f"2024-01-0{rnd.randint(1, 3)} 00:00:0{rnd.randint(0, 2)}.{rnd.choice(['000001', '000002', '9'])}" if rnd.random() < 0.9 else None,
             rnd.choice([None, 0, 1, -1, 2**63 - 1, -2**63, 7])) for _ in range(300)]
    for kind in ("timestamp_ntz", "timestamp"):
        df = spark.createDataFrame(rows, "t string, n long").select(F.col("t").cast(kind).alias("t"), "n")
        by = [r["s"] for r in df.select(F.struct("t", "n").alias("s"), packed_order(df, "t", "n").alias("k")).orderBy("k").collect()]
        assert by == [r["s"] for r in df.select(F.struct("t", "n").alias("s")).orderBy("s").collect()]
