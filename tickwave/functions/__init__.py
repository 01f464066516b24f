"""Column-level helpers (built-in Spark expressions only, no UDFs)."""

from tickwave.functions.timefn import (  # noqa: F401
    EPOCH,
    LOCAL_ZONE,
    bucket_start,
    days_in_month,
    epoch_ms,
    epoch_seconds,
    floor_to,
    interval_of,
    width_seconds,
    local_date,
    local_wallclock,
    longer_than,
    ms_to_ts,
    seconds_between,
)
from tickwave.functions.text import (  # noqa: F401
    duration_text,
    grouped_number,
    pct_text,
    reformat_timestamp,
)
