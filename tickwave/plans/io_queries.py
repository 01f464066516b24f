"""Landed pages, rate files, period lists, samples and CSV results: written from
the tables by Spark, read back through the library's readers."""

from __future__ import annotations

from pyspark.sql import functions as F
from pyspark.sql import types as T

from tickwave.functions.timefn import epoch_ms
from tickwave.plans import silver, sql
from tickwave.plans.fx_queries import RATES_SQL
from tickwave.plans.planning_queries import PERIODS_SQL, EST_SQL, order_volume_sample
from tickwave.operators.ordered import numbered
from tickwave.operators.periods import adaptive_periods
from tickwave.plans.registry import register
from tickwave.plans.standins import VENUE_K, VENUE_T, events_trades, table, weekday_rates
from tickwave.plans.gold_queries import EP_COLS, q_episodes_top20  # noqa: F401
from tickwave.session import scratch_path
from tickwave.sinks.writers import write_csv, write_json
from tickwave.sources import schemas as S
from tickwave.sources.bronze import (
    rate_pages,
    read_json_docs,
    read_period_list,
    read_result_csv,
    read_volume_sample,
    trade_pages,
)
from tickwave.sources.silver_tables import load_rates

# Descriptive fields of the rate pages.
RATE_CODE, RATE_NAME, RATE_UNIT = "dolar", "Dólar observado", "Pesos"
PAGE_ENTRIES = 100


def _rate_envelope(spark, sf_dir, current_year: int | None = None, last_year: int | None = None):
    """One rate document: metadata + ascending ``data`` (the series is one row
    per business day, so the array is calendar-bounded), up to ``last_year``."""
    r = weekday_rates(spark, sf_dir)
    if last_year is not None:
        r = r.where(F.year("fecha") <= last_year)
    doc = r.agg(
        F.array_sort(F.collect_list(F.struct(
            F.date_format("fecha", "yyyy-MM-dd").alias("fecha"), F.col("valor")))).alias("data"),
        F.min(F.year("fecha")).alias("ys"), F.max(F.year("fecha")).alias("ye"))
    cy = F.col("ye") if current_year is None else F.lit(current_year)
    meta = F.struct(
        F.lit("rates").alias("source"), F.lit(RATE_CODE).alias("indicator"),
        F.lit("2024-02-01T00:00:00+00:00").alias("ingestion_timestamp_utc"), F.lit("1.0").alias("schema_version"),
        F.col("ys").alias("year_start"), F.col("ye").alias("year_end"),
        (F.col("ye") - F.col("ys") + 1).alias("years_fetched"), F.size("data").cast("bigint").alias("records_count"),
        (F.col("ye") == cy).alias("is_partial_current_year"),
        F.element_at("data", -1)["fecha"].alias("current_year_fetched_through"),
        F.lit("asc").alias("serie_order_in_file"))
    path = scratch_path(spark, "bronze-rates")
    doc.select(meta.alias("metadata"), "data").coalesce(1).write.mode("overwrite").json(path)
    return path


@register("fx_silver", f"""WITH {RATES_SQL}
SELECT date, v AS usdclp, date <> d AS is_ffilled FROM filled""")
def q_fx_silver(spark, sf_dir):
    """Silver rate job: rate envelope -> checked non-empty -> last-wins per
    date -> calendar fill -> single file -> read back."""
    env_path = _rate_envelope(spark, sf_dir)
    out = scratch_path(spark, "silver-rates")
    silver.run_rates(silver.rates_from_envelope(spark, env_path), out)
    return load_rates(spark, out)


@register("rate_file_check", """WITH r AS (SELECT CAST(o_orderdate AS DATE) AS d FROM orders
      WHERE dayofweek(o_orderdate) BETWEEN 1 AND 5 GROUP BY 1),
now AS (SELECT year(max(o_orderdate)) AS y FROM orders),
f AS (SELECT 'current' AS file, d, true AS flag FROM r UNION ALL
      SELECT 'stale', d, true FROM r, now WHERE year(d) < y UNION ALL
      SELECT 'closed', d, false FROM r, now WHERE year(d) < y)
SELECT file, count(*) AS records, strftime(min(d), '%Y-%m-%d') AS date_first, strftime(max(d), '%Y-%m-%d') AS date_last,
       any_value(flag) AS is_partial, any_value(flag) = (max(year(d)) = any_value(y)) AS partial_ok,
       any_value(flag) = (max(year(d)) = any_value(y)) AS ok FROM f, now GROUP BY file""")
def q_rate_file_check(spark, sf_dir):
    """Rate file verdicts: non-empty, and the partial-year flag holds exactly for
    a file that ends in the current year.  That year comes from the orders, not
    from the files: one file ends in it, one ends a year before but still says
    that its year is partial (it fails), and one ends there and doesn't."""
    now = table(spark, sf_dir, "orders").agg(F.max(F.year("o_orderdate"))).first()[0]
    files = {"current": _rate_envelope(spark, sf_dir, now), "stale": _rate_envelope(spark, sf_dir, now - 1, now - 1),
             "closed": _rate_envelope(spark, sf_dir, now, now - 1)}
    out = None
    for name, path in files.items():
        v = rate_file_verdict(read_json_docs(spark, path, S.RATE_ENVELOPE_DDL), now).select(F.lit(name).alias("file"), "*")
        out = v if out is None else out.unionByName(v)
    return out


def rate_file_verdict(docs, current_year=None):
    m = F.col("metadata")
    cy = m["year_end"] if current_year is None else F.lit(current_year)
    expected = m["year_end"] == cy
    n = F.coalesce(F.size("data"), F.lit(0))
    return docs.select(
        F.coalesce(m["records_count"], n.cast("bigint")).alias("records"),
        F.element_at("data", 1)["fecha"].alias("date_first"),
        F.element_at("data", -1)["fecha"].alias("date_last"),
        m["is_partial_current_year"].alias("is_partial"),
        (m["is_partial_current_year"] == expected).alias("partial_ok"),
        ((n > 0) & (m["is_partial_current_year"] == expected)).alias("ok"))


@register("fx_pages_normalised", """WITH r AS (SELECT CAST(o_orderdate AS DATE) AS d,
        sum(CAST(round(o_totalprice * 100) AS BIGINT)) / count(*) / 100.0 AS v
      FROM orders WHERE dayofweek(o_orderdate) BETWEEN 1 AND 5 GROUP BY 1)
SELECT strftime(d, '%Y-%m-%d') AS fecha, v AS valor FROM r""")
def q_fx_pages_normalised(spark, sf_dir):
    """Yearly rate pages as the source serves them (newest first, timestamped
    dates, plus a year page with no series) -> ascending dated rows."""
    r = weekday_rates(spark, sf_dir)
    pages = r.groupBy(F.year("fecha").alias("y")).agg(F.sort_array(F.collect_list(F.struct(
        F.date_format("fecha", "yyyy-MM-dd'T'03:00:00.000'Z'").alias("fecha"), "valor")), asc=False).alias("serie"))
    empty = r.agg((F.max(F.year("fecha")) + 1).alias("y")).withColumn(
        "serie", F.lit(None).cast("array<struct<fecha:string,valor:double>>"))
    out = pages.unionByName(empty).select(F.lit(RATE_CODE).alias("codigo"), F.lit(RATE_NAME).alias("nombre"),
                                          F.lit(RATE_UNIT).alias("unidad_medida"), "serie")
    path = scratch_path(spark, "landed-rate-pages")
    out.write.mode("overwrite").json(path)
    return rate_pages(spark.read.schema(S.RATE_PAGE_DDL).json(path))


def q_trade_pages_normalised(spark, sf_dir, venues=(VENUE_T,)):
    """Trade pages of at most 100 entries of an hour, newest first, with the
    first day fetched twice -> half-open range filter, one row per trade id."""
    t = events_trades(spark, sf_dir).where(F.col("venue").isin(*venues))
    tup = F.struct(epoch_ms("ts").alias("ms"), F.col("trade_id").alias("id"), "amount", "price", "side")
    t = numbered(t.withColumn("h", F.window("ts", "1 hour").start), ["venue", "h"], ["ts", "trade_id"])
    pages = t.groupBy("venue", "h", F.floor(F.col("_n") / PAGE_ENTRIES).alias("page")).agg(
        F.sort_array(F.collect_list(tup), asc=False).alias("_e"))
    entries = F.transform("_e", lambda x: F.array(x["ms"].cast("string"), x["amount"].cast("string"),
                                                 x["price"].cast("string"), x["side"], x["id"].cast("string")))
    landed = pages.select(F.struct(F.col("venue").alias("market_id"), F.lit(None).cast("string").alias("timestamp"),
                                   F.lit(None).cast("string").alias("last_timestamp"),
                                   entries.alias("entries")).alias("trades"), "h")
    first_day = landed.agg(F.min(F.to_date("h")).alias("d"))
    refetch = landed.join(first_day, F.to_date("h") == F.col("d")).select("trades", "h")
    path = scratch_path(spark, "landed-trade-pages")
    landed.unionByName(refetch).drop("h").write.mode("overwrite").json(path)
    # range bounds: two scalars from one aggregate (the fetch request's range)
    ev = table(spark, sf_dir, "events").agg(F.min("ts").alias("a"), F.max("ts").alias("b")).first()
    start, end = _day_ms(ev["a"]), _day_ms(ev["b"])
    got = trade_pages(spark.read.schema(S.TRADE_PAGE_DDL).json(path), start, end)
    return got.select("symbol", "ts", "trade_id", "price", "amount", "side")


@register("trade_pages_normalised", f"""WITH {sql.TRADES}
SELECT venue AS symbol, date_trunc('millisecond', ts) AS ts, trade_id, price, amount, side FROM trades
WHERE ts >= (SELECT date_trunc('day', min(ts)) FROM events) AND ts < (SELECT date_trunc('day', max(ts)) FROM events)""")
def q_trade_pages_normalised_all(spark, sf_dir):
    """The same over every venue."""
    return q_trade_pages_normalised(spark, sf_dir, (VENUE_T, VENUE_K))


def _day_ms(dt) -> int:
    import calendar
    return calendar.timegm(dt.date().timetuple()) * 1000


@register("period_list_roundtrip", f"WITH {PERIODS_SQL}\nSELECT symbol, start_ms, end_ms FROM periods")
def q_period_list_roundtrip(spark, sf_dir):
    """Planned periods -> ``{{periodos: [...]}}`` document -> read back."""
    p = adaptive_periods(order_volume_sample(spark, sf_dir), VENUE_T)
    doc = p.agg(F.array_sort(F.collect_list(F.struct(
        "start_ms", "symbol", F.lit(None).cast("string").alias("interval"), "end_ms"))).alias("_p"))
    doc = doc.select(F.transform("_p", lambda x: F.struct(x["symbol"].alias("symbol"), x["interval"].alias("interval"),
                                                          x["start_ms"].alias("start_ms"),
                                                          x["end_ms"].alias("end_ms"))).alias("periodos"))
    path = scratch_path(spark, "period-list")
    write_json(doc, path)
    return read_period_list(spark, path).select("symbol", "start_ms", "end_ms")


@register("volume_sample_roundtrip", f"WITH {EST_SQL}\nSELECT * FROM est2")
def q_volume_sample_roundtrip(spark, sf_dir):
    """Volume sample written as one JSON array document, read back by schema."""
    est = order_volume_sample(spark, sf_dir)
    arr = est.agg(F.to_json(F.array_sort(F.collect_list(F.struct(*est.columns)))).alias("value"))
    path = scratch_path(spark, "volume-sample")
    arr.coalesce(1).write.mode("overwrite").text(path)
    return read_volume_sample(spark, path)


@register("episodes_csv_roundtrip", sql.episodes("15 minutes", 900, 0.01, 5)
          + f"\nSELECT {EP_COLS} FROM out ORDER BY rank_metric DESC, a LIMIT 20")
def q_episodes_csv_roundtrip(spark, sf_dir):
    """The top-20 episode table written as CSV with a header and read back with
    an explicit schema."""
    ep = q_episodes_top20(spark, sf_dir)
    path = scratch_path(spark, "episodes-csv")
    write_csv(ep, path)
    schema = T.StructType([
        T.StructField("start_local", T.TimestampNTZType()), T.StructField("end_local", T.TimestampNTZType()),
        T.StructField("minutes", T.LongType()), T.StructField("hours", T.DoubleType()),
        T.StructField("mean_spread_pct", T.DoubleType()), T.StructField("max_spread_pct", T.DoubleType()),
        T.StructField("area_pct_minutes", T.DoubleType())])
    return read_result_csv(spark, path, schema)

