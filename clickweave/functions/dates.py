"""Date parts and zone-free epoch values."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

_EPOCH_NTZ = "TIMESTAMP_NTZ'1970-01-01 00:00:00'"


def _col(c: str | Column) -> Column:
    return F.col(c) if isinstance(c, str) else c


def epoch_micros(ts: str | Column) -> Column:
    """Microseconds since 1970-01-01 00:00:00 without any time zone.

    The input is read as a wall-clock time (``TIMESTAMP_NTZ``); a zoned
    ``TIMESTAMP`` is first turned into the session's wall-clock time.  Kept as
    ``BIGINT`` so gaps are exact integers until the last step.
    """
    ntz = _col(ts).cast("timestamp_ntz")
    return F.timestamp_diff("MICROSECOND", F.expr(_EPOCH_NTZ), ntz)


def epoch_seconds(ts: str | Column) -> Column:
    """Whole seconds since 1970 (the wall-clock second, no zone): ``us div 10^6``."""
    us = epoch_micros(ts)
    million = F.lit(1_000_000).cast("bigint")
    return F.call_function("div", us - F.pmod(us, million), million)


def micros_to_seconds(us: str | Column) -> Column:
    """Exact seconds as ``DOUBLE`` from integer microseconds."""
    return _col(us) / F.lit(1e6)


def parse_timestamp(text: str | Column, formats: tuple[str, ...] = ("yyyy-MM-dd HH:mm:ss", "yyyy-MM-dd")) -> Column:
    """Text to ``TIMESTAMP_NTZ`` trying the stated formats in turn (D2);
    text that matches none of them gives NULL instead of an error."""
    c = _col(text)
    return F.coalesce(*[F.try_to_timestamp(c, F.lit(f)).cast("timestamp_ntz") for f in formats])


def date_part_columns(ts: str | Column, prefix: str, time: bool = True) -> dict[str, Column]:
    """Date (and time) parts as named columns.

    Week is the ISO week; Dayofweek counts Monday as 0; the month flags are
    0/1 integers; Minute is the minute of the hour.
    """
    c = _col(ts)
    day = F.to_date(c)
    parts = {
        f"{prefix}Day": F.dayofmonth(c),
        f"{prefix}Week": F.weekofyear(c),
        f"{prefix}Dayofweek": F.weekday(c),
        f"{prefix}Is_month_end": (F.last_day(day) == day).cast("int"),
        f"{prefix}Is_month_start": (F.dayofmonth(c) == F.lit(1)).cast("int"),
    }
    if time:
        parts[f"{prefix}Hour"] = F.hour(c)
        parts[f"{prefix}Minute"] = F.minute(c)
    return parts
