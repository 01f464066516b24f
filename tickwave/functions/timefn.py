"""Time expressions.

Market time is carried as ``TIMESTAMP_NTZ`` holding the UTC wall clock.  All
arithmetic below is interval arithmetic on NTZ values, which Spark evaluates
without looking at ``spark.sql.session.timeZone``: the same query gives the
same answer whatever zone the calling session is pinned to.  Local calendar
dates use zone ids (never fixed offsets) so daylight-saving edges are right.
"""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

# The local market calendar that daily reference rates are
# published in, and the epoch origin.
LOCAL_ZONE = "America/Santiago"


def EPOCH() -> Column:  # noqa: N802 - reads as the constant it stands for
    """The epoch origin as a TIMESTAMP_NTZ literal (built lazily: a Column
    needs an active session)."""
    return F.expr("TIMESTAMP_NTZ'1970-01-01 00:00:00'")


def _c(c) -> Column:
    return F.col(c) if isinstance(c, str) else c


def ms_to_ts(ms) -> Column:
    """Epoch milliseconds (BIGINT) -> UTC wall clock as TIMESTAMP_NTZ."""
    return EPOCH() + _c(ms) * F.expr("INTERVAL '0.001' SECOND")


def epoch_seconds(ts) -> Column:
    """TIMESTAMP_NTZ (UTC wall clock) -> seconds since epoch, DECIMAL(20,6)."""
    return (_c(ts) - EPOCH()).cast("interval second").cast("decimal(20,6)")


def epoch_ms(ts) -> Column:
    """TIMESTAMP_NTZ (UTC wall clock) -> epoch milliseconds (BIGINT, floor)."""
    return F.floor(epoch_seconds(ts) * 1000).cast("bigint")


def seconds_between(earlier, later) -> Column:
    """Elapsed seconds ``later - earlier`` (DECIMAL), not boundary counts."""
    return (_c(later) - _c(earlier)).cast("interval second").cast("decimal(20,6)")


def interval_of(width: str) -> Column:
    """``'15 minutes'`` -> ``INTERVAL '15' MINUTE``."""
    n, unit = width.split()
    return F.expr(f"INTERVAL '{n}' {unit.upper().rstrip('S')}")


def bucket_start(ts, width: str) -> Column:
    """Start of the fixed-width bucket holding ``ts`` (e.g. ``'1 minute'``).

    A tumbling ``window`` is a plain projection, so it stays in codegen."""
    return F.window(_c(ts), width).start


_UNIT_SECONDS = {"second": 1, "minute": 60, "hour": 3600, "day": 86400, "week": 604800}


def width_seconds(width: str) -> int:
    """``'15 minutes'`` -> 900."""
    n, unit = width.split()
    return int(n) * _UNIT_SECONDS[unit.lower().rstrip("s")]


def floor_to(ts, width: str) -> Column:
    """Start of the epoch-aligned ``width`` bucket holding ``ts``.

    Same value as :func:`bucket_start` (a tumbling ``window``: long arithmetic
    inside codegen) -- use that, once per projection.  This form is plain
    decimal/interval arithmetic, several times slower per row, and only for
    places that need two buckets in one expression."""
    w = width_seconds(width)
    secs = F.floor(epoch_seconds(ts) / F.lit(w)) * F.lit(w)
    return EPOCH() + secs * F.expr("INTERVAL '1' SECOND")


def longer_than(earlier, later, seconds: float) -> Column:
    """``later - earlier > seconds`` compared as day-time intervals (exact
    microseconds, no decimal conversion per row)."""
    micros = int(round(seconds * 1_000_000))
    return (_c(later) - _c(earlier)) > F.expr(f"INTERVAL '{micros / 1_000_000:.6f}' SECOND")


def local_wallclock(ts, zone: str = LOCAL_ZONE) -> Column:
    """UTC wall clock -> wall clock in ``zone`` (TIMESTAMP_NTZ)."""
    return F.convert_timezone(F.lit("UTC"), F.lit(zone), _c(ts))


def local_date(ts, zone: str = LOCAL_ZONE) -> Column:
    """Calendar date in ``zone`` of a UTC instant given as TIMESTAMP_NTZ."""
    return F.to_date(local_wallclock(ts, zone))


def days_in_month(d) -> Column:
    return F.dayofmonth(F.last_day(_c(d)))
