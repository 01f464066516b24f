"""Presentation strings built from built-in functions."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F


def _c(c) -> Column:
    return F.col(c) if isinstance(c, str) else c


def duration_text(minutes) -> Column:
    """Minutes -> ``'42 min'`` under an hour, ``'5h 03m'``, or ``'2h'`` on a
    whole hour."""
    m = _c(minutes).cast("bigint")
    h = F.floor(m / 60).cast("bigint")
    r = m % 60
    return (F.when(m < 60, F.concat(m.cast("string"), F.lit(" min")))
            .when(r == 0, F.concat(h.cast("string"), F.lit("h")))
            .otherwise(F.format_string("%dh %02dm", h, r)))


def pct_text(x, decimals: int = 2) -> Column:
    """Number already in percent -> ``'12.34%'`` (no grouping separator)."""
    return F.format_string(f"%.{decimals}f%%", _c(x).cast("double"))


def grouped_number(x, decimals: int = 1) -> Column:
    """``1234.5`` -> ``'1,234.5'``."""
    return F.format_number(_c(x).cast("double"), decimals)


def reformat_timestamp(text, in_fmt: str, out_fmt: str) -> Column:
    """Reformat a timestamp string; text that does not parse is kept as is."""
    parsed = F.try_to_timestamp(_c(text), F.lit(in_fmt))
    return F.coalesce(F.date_format(parsed, out_fmt), _c(text))
