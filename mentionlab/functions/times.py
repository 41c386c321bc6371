"""Time keys, segment names and interval boundaries (all UTC, all JVM-side)."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

# Segment length in minutes, segment file suffix and name format, record key
# time format, the seed key of an empty topic and the seed segment of the pick-up.
SEGMENT_MINUTES = 15
SEGMENT_SUFFIX = ".gkg.csv"
SEGMENT_NAME_FORMAT = "yyyyMMddHHmm00"
RECORD_KEY_FORMAT = "yyyyMMddHHmmss"
DEFAULT_LAST_KEY = "20150218230000-0"
DEFAULT_LAST_SEGMENT = "20150218230000"


def as_instant(ts: Column) -> Column:
    """TIMESTAMP (with zone) from a TIMESTAMP_NTZ or TIMESTAMP column; session zone is UTC."""
    return ts.cast("timestamp")


def micros(ts: Column) -> Column:
    return F.unix_micros(as_instant(ts))


def millis(ts: Column) -> Column:
    return F.unix_millis(as_instant(ts))


def admitted(ts: Column, now: Column, window_seconds: int = 3600) -> Column:
    """A mention counts only while younger than the window (whole seconds, as the reference)."""
    return F.floor((millis(now) - millis(ts)) / 1000) < F.lit(window_seconds)


def day_of(ts: Column) -> Column:
    """Day of a timestamp as DATE (no zone offset in the result)."""
    return F.to_date(ts)


def record_key(ts: Column, seq: Column) -> Column:
    """``yyyyMMddHHmmss-N``, the shape of a record key on the article topic."""
    return F.concat(F.date_format(ts, RECORD_KEY_FORMAT), F.lit("-"), seq.cast("string"))


def day_key(key: Column) -> Column:
    return F.substring(key, 1, 8)


def minute_key(key: Column) -> Column:
    return F.substring(key, 1, 12)


def parse_record_key(key: Column) -> Column:
    """``"a-b"`` to ``struct(a BIGINT, b BIGINT)``; ``(0, 0)`` unless exactly two numeric parts."""
    parts = F.split(key, "-")
    pa, pb = parts.getItem(0), F.get(parts, 1)
    a, b = pa.try_cast("bigint"), pb.try_cast("bigint")
    # whole-number text only (no spaces), as a strict long parser accepts; overflow gives null
    number = r"^\+?[0-9]+$"
    ok = (F.size(parts) == 2) & pa.rlike(number) & pb.rlike(number) & a.isNotNull() & b.isNotNull()
    zero = F.lit(0).cast("bigint")
    return F.struct(F.when(ok, a).otherwise(zero).alias("a"), F.when(ok, b).otherwise(zero).alias("b"))


def _check_divides_hour(minutes: int) -> None:
    if minutes <= 0 or 60 % minutes:
        raise ValueError("interval must divide 60 minutes")


def next_boundary(ts: Column, minutes: int = SEGMENT_MINUTES) -> Column:
    """First interval boundary strictly after the minute of ``ts`` (TIMESTAMP)."""
    _check_divides_hour(minutes)
    return as_instant(F.window(as_instant(ts), f"{minutes} minutes").end)


def interval_start(ts: Column, minutes: int = SEGMENT_MINUTES) -> Column:
    _check_divides_hour(minutes)
    return as_instant(F.window(as_instant(ts), f"{minutes} minutes").start)


def seconds_to_boundary(ts: Column, minutes: int = SEGMENT_MINUTES) -> Column:
    """Whole seconds left to the next boundary, at least 1 (millisecond arithmetic)."""
    left_ms = millis(next_boundary(ts, minutes)) - millis(ts)
    return F.greatest(F.floor(left_ms / 1000).cast("bigint"), F.lit(1).cast("bigint"))


def segment_name(ts: Column) -> Column:
    """File name of the segment starting at ``ts``."""
    return F.concat(F.date_format(ts, SEGMENT_NAME_FORMAT), F.lit(SEGMENT_SUFFIX))


def segment_time(name: Column) -> Column:
    """Inverse of :func:`segment_name`."""
    return F.to_timestamp(F.substring(name, 1, 14), RECORD_KEY_FORMAT)


def lookback_segments(now: Column, window_minutes: int = 60,
                      minutes: int = SEGMENT_MINUTES) -> Column:
    """Array of segment start times in the look-back window for a poll at ``now``.

    The newest entry is the last *full* interval before the current one; the window
    holds ``window_minutes / minutes`` names.
    """
    _check_divides_hour(minutes)
    current = interval_start(now, minutes)
    last = current - F.expr(f"INTERVAL {minutes} MINUTES")
    first = current - F.expr(f"INTERVAL {window_minutes} MINUTES")
    return F.sequence(first, last, F.expr(f"INTERVAL {minutes} MINUTES"))
