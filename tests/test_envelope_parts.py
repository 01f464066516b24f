"""A hot period is landed as bounded, numbered envelopes that read as one."""

from pyspark.sql import functions as F

from tickwave.operators.ordered import numbered
from tickwave.operators.quality import envelope_ranges, ingest_health
from tickwave.session import scratch_path
from tickwave.sinks.writers import trade_envelopes, write_envelopes
from tickwave.sources import schemas as S
from tickwave.sources.bronze import decode_trades, read_json_docs

DAY = 86_400_000


def test_hot_period(spark):
    rows = [("hot", DAY + (i * 7919) % 4000, i, 1.0, 2.0, "buy") for i in range(2530)] + [("cold", DAY + 5, 9000, 1.0, 2.0, "sell")]
    t = spark.createDataFrame(rows, "symbol string, ts_ms long, trade_id long, amount double, price double, side string")
    periods = spark.createDataFrame([(s, d * DAY, (d + 1) * DAY) for s in ("hot", "cold") for d in (1, 2)],
                                    "symbol string, start_ms long, end_ms long")
    path = scratch_path(spark, "parts")
    write_envelopes(trade_envelopes(t, periods, "2024-02-01T00:00:00+00:00", nominal_rps=0.5, pages=5), path)
    docs = read_json_docs(spark, path, S.TRADE_ENVELOPE_DDL)
    got = docs.select("metadata.symbol", "metadata.range_start_ms", "metadata.part",
                      F.size("data").alias("n")).collect()
    assert sorted((r["symbol"], r["range_start_ms"] // DAY, r["part"], r["n"]) for r in got) == [
        ("cold", 1, 0, 1), ("cold", 2, 0, 0), *(("hot", 1, p, 500) for p in range(5)), ("hot", 1, 5, 30), ("hot", 2, 0, 0)]
    back = decode_trades(docs).select("symbol", "ts_ms", "trade_id")
    assert sorted(map(tuple, back.collect())) == sorted((r[0], r[1], r[2]) for r in rows)
    h = ingest_health(docs).first()
    assert (h["runs"], h["pages"], h["records"]) == (4, 27, 2531)
    assert sorted((r["class"], r["records"]) for r in envelope_ranges(docs).collect()) == [
        ("range", 0), ("range", 0), ("range", 1), ("range", 2530)]
    lost = envelope_ranges(docs.where("metadata.part <> 3")).where("class = 'failed'").collect()
    assert [(r["start_ms"], r["records"]) for r in lost] == [(None, 2030)]


def test_numbers_across_chunks(spark):
    d = spark.range(1000).select((F.col("id") % 10 == 0).alias("k"), (F.col("id") * 37 % 1000).alias("v"))
    got = numbered(d, ["k"], ["v"], chunks=7).collect()
    for k in (False, True):
        mine = sorted((r["v"], r["_n"]) for r in got if r["k"] == k)
        assert [n for _, n in mine] == list(range(len(mine)))
        assert {r["_total"] for r in got if r["k"] == k} == {len(mine)}
