from __future__ import annotations

import datetime as dt

from pyspark.sql import Column
from pyspark.sql import functions as F


def _c(col) -> Column:
    return F.col(col) if isinstance(col, str) else col


def safe_divide(x, y) -> Column:
    """x / y, NULL when y is 0 or either side is NULL (ANSI-safe)."""
    return F.try_divide(_c(x), _c(y))


def guarded_log_ratio(x, y) -> Column:
    """ln(x / y) only where both are strictly positive, else NULL."""
    x, y = _c(x), _c(y)
    return F.when((x > 0) & (y > 0), F.ln(F.try_divide(x, y)))


def hours_between(later, earlier) -> Column:
    """Whole elapsed hours from ``earlier`` to ``later``, truncated toward 0."""
    return F.timestamp_diff("HOUR", _c(earlier), _c(later))


def from_epoch_ms(col) -> Column:
    return F.timestamp_millis(_c(col))


def epoch_ms(col) -> Column:
    return F.unix_millis(_c(col))


def lit_ts(value) -> Column:
    """A timestamp literal (UTC session) from a datetime/date/string."""
    if isinstance(value, dt.datetime):
        value = value.strftime("%Y-%m-%d %H:%M:%S.%f")
    elif isinstance(value, dt.date):
        value = value.isoformat()
    return F.lit(value).cast("timestamp")


def day_start_ms(day: dt.date) -> int:
    """Epoch milliseconds of UTC midnight of ``day`` (driver-side constant)."""
    start = dt.datetime.combine(day, dt.time.min, tzinfo=dt.timezone.utc)
    return int(start.timestamp()) * 1000
