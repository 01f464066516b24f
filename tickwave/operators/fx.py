"""Daily reference rates: calendar fill, local-date conversion, as-of lookup.

A rate series has at most one row per calendar day, so its size is bounded by
the calendar (366 rows a year per series), never by the fact volume.  That
bound is what lets the filled series be windowed per series and broadcast to
the facts; :func:`bounded_broadcast` still checks it before broadcasting.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from tickwave.functions.timefn import LOCAL_ZONE, bucket_start, floor_to, interval_of, local_date
from tickwave.session import materialize

# Forward-fill bound of the daily rate (days) and the most rows
# and bytes a dimension may have to be broadcast.
DEFAULT_MAX_BACK_DAYS = 7
MAX_BROADCAST_ROWS = 2_000_000
MAX_BROADCAST_BYTES = 256 << 20
# UTC bucket of the zone calendar.  A bucket that straddles a local midnight
# has a row for each of its days.
ZONE_STEP = "15 minutes"


def latest_per_date(src: DataFrame, date: str = "fecha", value: str = "valor",
                    order: str | None = "pos", keys: Sequence[str] = ()) -> DataFrame:
    """Source rows -> one value per date; for a repeated date the row latest in
    ``order`` (position in the source array) wins."""
    keys = list(keys)
    d = F.to_date(F.col(date))
    if order is None:
        return src.select(*keys, d.alias("date"), F.col(value).cast("double").alias("rate")) \
            .groupBy(*keys, "date").agg(F.max("rate").alias("rate"))
    return src.groupBy(*keys, d.alias("date")).agg(
        F.max_by(F.col(value).cast("double"), F.col(order)).alias("rate"))


def fill_daily(rates: DataFrame, max_back_days: int | None = DEFAULT_MAX_BACK_DAYS,
               keys: Sequence[str] = (), date: str = "date", rate: str = "rate",
               order: str | None = None) -> DataFrame:
    """Every calendar day from the first to the last source date, carrying the
    last published rate forward.

    Output ``(keys, date, rate, is_ffilled, age_days, source_date)``.  A filled
    day more than ``max_back_days`` after its source date fails the query
    (``raise_error``), so source dates ``max_back_days + 1`` apart pass and one
    more day fails.  Nothing is extrapolated past the last source date.  Of rows
    with the same keys and date the one latest in ``order`` counts (without it the
    greatest rate, as in :func:`latest_per_date`); rows without a date don't.
    """
    keys = list(keys)
    one = F.max_by(rate, order) if order else F.max(rate)
    w = Window.partitionBy(*keys).orderBy(date)
    nxt = F.lead(date).over(w)
    r = (rates.where(F.col(date).isNotNull()).groupBy(*keys, date).agg(one.alias(rate))
         .withColumn("_next", nxt))
    last_day = F.coalesce(F.date_sub(F.col("_next"), 1), F.col(date))
    if max_back_days is not None:
        too_long = F.datediff(F.col("_next"), F.col(date)) > max_back_days + 1
        msg = F.concat(F.lit("rate gap: no value for "),
                       (F.datediff(F.col("_next"), F.col(date)) - 1).cast("string"),
                       F.lit(f" days after "), F.col(date).cast("string"),
                       F.lit(f" exceeds max_back_days={max_back_days}"))
        last_day = F.when(too_long, F.raise_error(msg).cast("date")).otherwise(last_day)
    r = r.select(*keys, F.col(date).alias("source_date"), rate,
                 F.explode(F.sequence(F.col(date), last_day)).alias("date"))
    return r.select(*keys, "date", rate, (F.col("date") != F.col("source_date")).alias("is_ffilled"),
                    F.datediff("date", "source_date").alias("age_days"), "source_date")


def bounded_broadcast(dim: DataFrame, max_rows: int = MAX_BROADCAST_ROWS,
                      max_bytes: int = MAX_BROADCAST_BYTES) -> DataFrame:
    """Broadcast ``dim`` only after counting its rows and the bytes of their
    values as text; above either bound it is left to a shuffle join (AQE may
    still pick broadcast from runtime sizes)."""
    size = F.octet_length(F.to_json(F.struct(F.array(*[F.col(c).cast("string") for c in dim.columns]).alias("v"))))
    r = dim.agg(F.count(F.lit(1)).alias("n"), F.sum(size).alias("bytes")).first()
    return F.broadcast(dim) if r["n"] <= max_rows and (r["bytes"] or 0) <= max_bytes else dim


def with_local_date(facts: DataFrame, ts: str, zone: str = LOCAL_ZONE,
                    out: str = "local_date") -> DataFrame:
    return facts.withColumn(out, local_date(ts, zone))


def zone_calendar(daily: DataFrame, zone: str = LOCAL_ZONE, rate: str = "rate",
                  carry: Sequence[str] = (), step: str = ZONE_STEP) -> DataFrame:
    """The daily table re-keyed by UTC time: one row per ``step`` bucket of
    every local day it holds, ``(_q, _ld, _rate, _s, _e, carry...)``.

    A local day is ``[convert(zone->UTC, d 00:00), convert(zone->UTC, d+1
    00:00))`` in UTC, 23, 24 or 25 hours long across DST changes (a skipped
    local midnight starts the day at the first existing instant).  Zone offsets
    need not be multiples of ``step``: a bucket cut by a local midnight is listed
    for both days, and a fact belongs to the row whose ``[_s, _e)`` holds it.
    About 97 rows per day: bounded by the calendar, not by the facts."""
    one = interval_of(step)
    d = daily.select(F.col("date").alias("_ld"), F.col(rate).alias("_rate"), *carry)
    d = d.withColumn("_s", F.convert_timezone(F.lit(zone), F.lit("UTC"), F.col("_ld").cast("timestamp_ntz"))) \
        .withColumn("_e", F.convert_timezone(F.lit(zone), F.lit("UTC"), F.date_add("_ld", 1).cast("timestamp_ntz")))
    d = d.where(F.col("_s") < F.col("_e"))  # a zone may skip a whole day
    last = floor_to(F.col("_e") - F.expr("INTERVAL '0.000001' SECOND"), step)
    return d.select("_ld", "_rate", "_s", "_e", *carry, F.explode(F.sequence(floor_to("_s", step), last, one)).alias("_q"))


def _attach_calendar(facts: DataFrame, daily: DataFrame, ts: str, zone: str, rate: str,
                     carry: Sequence[str], how: str, keys: Sequence[str] = ()) -> tuple[DataFrame, str, str]:
    """Facts + the local date, rate and ``carry`` by one broadcast hash probe on the
    UTC bucket of ``ts``: the time-zone rules are evaluated per calendar bucket,
    not per fact row.  Returns the names of the date and rate columns too; no
    helper shares a name with a column of the facts.

    The daily series is stored once, so counting it doesn't run its plan again.
    A series with two rows a date (and ``keys``) would repeat facts and is refused."""
    keys, carry = list(keys), list(carry)
    if clash := set(carry) & set(facts.columns):
        raise ValueError(f"facts already have {sorted(clash)}; rename them")
    d = materialize(daily.select(*keys, "date", F.col(rate).alias("_rate"), *carry), "daily_rates")
    twice = d.groupBy(*keys, "date").agg(F.count(F.lit(1)).alias("n")).where("n > 1").limit(1).collect()
    if twice:
        raise ValueError(f"more than one rate for {twice[0].asDict()}; resolve repeated dates (latest_per_date) or name the series' key")
    cal = zone_calendar(d, zone, "_rate", [*keys, *carry])
    taken = {*facts.columns, *carry}
    name = {c: _free(c, taken) for c in ["_ld", "_rate", "_s", "_e", "_q", *[f"_key_{k}" for k in keys]]}
    bucket = _free("_bucket", taken)
    cal = bounded_broadcast(cal.select(*[F.col(c).alias(name[c]) for c in ("_ld", "_rate", "_s", "_e", "_q")],
                                       *[F.col(k).alias(name[f"_key_{k}"]) for k in keys], *carry))
    f = facts.withColumn(bucket, bucket_start(ts, ZONE_STEP))
    on = (F.col(bucket) == F.col(name["_q"])) & (F.col(ts) >= F.col(name["_s"])) & (F.col(ts) < F.col(name["_e"]))
    for k in keys:
        on &= F.col(k) == F.col(name[f"_key_{k}"])
    j = f.join(cal, on, how).drop(bucket, name["_q"], name["_s"], name["_e"], *[name[f"_key_{k}"] for k in keys])
    return j, name["_ld"], name["_rate"]


def _free(name: str, taken: set[str]) -> str:
    low = {t.lower() for t in taken}
    while name.lower() in low:
        name = "_" + name
    return name


def convert_by_local_date(facts: DataFrame, daily: DataFrame, ts: str,
                          price_cols: Sequence[str], zone: str = LOCAL_ZONE,
                          missing: str = "raise", rate: str = "rate",
                          suffix: str = "", carry: Sequence[str] = (), keys: Sequence[str] = (),
                          rate_as: str = "rate", date_as: str = "local_date") -> DataFrame:
    """Multiply ``price_cols`` by the rate of each row's calendar date in
    ``zone`` (not its UTC date).  One rate per row keeps low <= open,close <=
    high.  A row whose local date has no rate fails the query naming that
    date (``missing="raise"``), keeps NULL prices (``"null"``) or is left out
    (``"drop"``, an inner join).

    ``keys`` are columns of both sides for several series at once (a currency,
    say).  The rate and the date come back as ``rate_as`` and ``date_as``; facts
    that have such columns already are refused.

    The rate table is re-keyed by UTC 15-minute bucket (:func:`zone_calendar`)
    and broadcast behind a check of its size, so the fact side is neither
    shuffled nor converted row by row; only rows outside the calendar compute
    their local date directly (for the error / NULL case)."""
    if clash := {rate_as, date_as} & set(facts.columns):
        raise ValueError(f"facts already have {sorted(clash)}; give rate_as and date_as other names")
    j, ld, r_ = _attach_calendar(facts, daily, ts, zone, rate, carry, "inner" if missing == "drop" else "left", keys)
    j = j.withColumn(date_as, F.coalesce(F.col(ld), local_date(ts, zone))).drop(ld)
    r: Column = F.col(r_)
    if missing == "raise":
        r = F.when(r.isNull(), F.raise_error(F.concat(
            F.lit("rate coverage gap: no rate for local date "), F.col(date_as).cast("string")))
            .cast("double")).otherwise(r)
    j = j.withColumn(r_, r)
    for c in price_cols:
        j = j.withColumn(c + suffix, F.col(c) * F.col(r_))
    return j.withColumnRenamed(r_, rate_as)


def attach_local_date(facts: DataFrame, ts: str, days: DataFrame, zone: str = LOCAL_ZONE,
                      out: str = "local_date") -> DataFrame:
    """``facts`` plus the calendar date of ``ts`` in ``zone``, resolved through
    the UTC-bucket calendar of ``days`` (a ``date`` column: the local days that
    matter, e.g. a rate table's range) by one broadcast hash probe; rows
    outside those days fall back to per-row conversion."""
    d = days.select("date", F.lit(1.0).alias("rate")).distinct()
    j, ld, r_ = _attach_calendar(facts, d, ts, zone, "rate", (), "left")
    return j.withColumn(out, F.coalesce(F.col(ld), local_date(ts, zone))).drop(ld, r_)


def missing_rate_dates(facts: DataFrame, daily: DataFrame, ts: str,
                       zone: str = LOCAL_ZONE, limit: int | None = 10) -> DataFrame:
    """Local dates of facts with no rate, with how many facts each, earliest
    first (the first ``limit`` are what an error message shows).  Only the
    unmatched rows evaluate time-zone rules."""
    j, ld, _ = _attach_calendar(facts.select(ts), daily.select("date", F.lit(1.0).alias("rate")).distinct(), ts, zone,
                                "rate", (), "left")
    m = (j.where(F.col(ld).isNull()).select(local_date(ts, zone).alias("local_date"))
         .groupBy("local_date").agg(F.count(F.lit(1)).alias("rows")))
    m = m.orderBy("local_date")
    return m.limit(limit) if limit is not None else m


def assert_rate_coverage(facts: DataFrame, daily: DataFrame, ts: str,
                         zone: str = LOCAL_ZONE) -> None:
    """Eager pre-write check: raise naming up to 10 uncovered local dates."""
    rows = missing_rate_dates(facts, daily, ts, zone, 10).collect()  # at most 10 rows
    if rows:
        raise ValueError("rate coverage gap; missing local dates (up to 10 shown): "
                         + ", ".join(str(r["local_date"]) for r in rows))


def asof_backward(left: DataFrame, right: DataFrame, left_on: str, right_on: str,
                  values: Sequence[str], keys: Sequence[str] = (),
                  tolerance_days: int | None = None, order: str | None = None) -> DataFrame:
    """Backward as-of join on a DATE key: each left row gets the right row with
    the greatest ``right_on <= left_on`` (same keys), or NULLs when there is
    none or it is more than ``tolerance_days`` older.

    The right side is a daily series (bounded by the calendar), so the as-of
    is re-expressed as fill + equality: every right row is expanded to the
    days it serves -- up to the day before the next right date, and at most
    ``tolerance_days`` past its own date -- and the left side is equi-joined on
    ``(keys, day)`` against that table, broadcast behind a row-count check.
    The fact side is never windowed, sorted or shuffled, so a hot key or hot
    day costs nothing extra.  Without a tolerance the last right row serves
    every later left day (bounded by the left side's last date).

    Of right rows with equal keys and date the one greatest in ``order``, then in
    its values, serves.  For times of day see :func:`tickwave.operators.asof.asof_join`."""
    keys = list(keys)
    w = Window.partitionBy(*keys).orderBy(right_on)
    tie = F.struct(*[F.col(c).alias(f"o{i}") for i, c in enumerate(([order] if order else []) + list(values))])
    one = right.where(F.col(right_on).isNotNull()).groupBy(*keys, right_on).agg(F.max_by(F.struct(*values), tie).alias("_one"))
    r = materialize(one.select(*keys, right_on, *[F.col("_one")[v].alias(v) for v in values]), "asof_days") \
        .withColumn("_next", F.lead(right_on).over(w))
    last = F.date_sub(F.col("_next"), 1)
    if tolerance_days is not None:
        cap = F.date_add(F.col(right_on), tolerance_days)
        last = F.least(F.coalesce(last, cap), cap)
    else:
        # open end: serve up to the last left date of the key
        if keys:
            lmax = left.groupBy(*keys).agg(F.max(left_on).alias("_lmax"))
            r = r.join(lmax, keys, "left")
        else:  # one scalar from an aggregate
            r = r.withColumn("_lmax", F.lit(left.agg(F.max(left_on)).first()[0]).cast("date"))
        last = F.coalesce(last, F.greatest(F.col("_lmax"), F.col(right_on)))
    cal = r.select(*keys, F.col(right_on).alias(right_on + "_matched"), *values,
                   F.explode(F.sequence(F.col(right_on), last)).alias("_day"))
    cal = bounded_broadcast(cal).alias("_r")
    lft = left.alias("_l")
    cond = [F.col(f"_l.{k}") == F.col(f"_r.{k}") for k in keys] + [F.col(f"_l.{left_on}") == F.col("_r._day")]
    j = lft.join(cal, cond, "left")
    return j.select(*[F.col(f"_l.{c}") for c in left.columns], F.col(f"_r.{right_on}_matched"),
                    *[F.col(f"_r.{v}") for v in values])


def apply_policy(filled: DataFrame, policy: str = "keep") -> DataFrame:
    """Consumer policy for forward-filled days: ``drop`` them, ``keep`` them
    (default), or ``weight`` each day by ``1 / (1 + age_days)``."""
    if policy == "drop":
        return filled.where(~F.col("is_ffilled"))
    if policy == "keep":
        return filled
    if policy == "weight":
        return filled.withColumn("weight", F.lit(1.0) / (F.col("age_days") + 1))
    raise ValueError(f"unknown policy {policy!r}")
