"""Epoch-millisecond helpers that do not depend on the session zone."""

from collections.abc import Sequence
from datetime import datetime, timedelta, timezone

from pyspark.sql import Column, functions as F

# Years 0001 to 9999, the range of TIMESTAMP. Outside it the conversion would raise and one bad
# message would stop a stream, so such a time is NULL and the row joins no window.
_FIRST_MS = -62135596800000
_LAST_MS = 253402300799999
_SECONDS_PER_DAY = 86400

# Unit of a window text: label in column names, length in seconds.
_UNITS = {"second": ("s", 1), "minute": ("min", 60), "hour": ("h", 3600), "day": ("day", _SECONDS_PER_DAY)}


def event_time(epoch_ms: Column) -> Column:
    return F.when(epoch_ms.between(_FIRST_MS, _LAST_MS), F.timestamp_millis(epoch_ms))


def utc_date(instant: Column) -> Column:
    days = F.floor(F.unix_seconds(instant) / F.lit(_SECONDS_PER_DAY))
    return F.date_from_unix_date(days.cast("int"))


def day_path(epoch_ms: Column) -> Column:
    """UTC day as yyyy/MM/dd."""
    return F.date_format(utc_date(event_time(epoch_ms)), "yyyy/MM/dd")


def day_ranges(days: Sequence[str]) -> list[tuple[int, int]]:
    """UTC days ('yyyy/MM/dd') as ranges of epoch milliseconds, end exclusive; days in a row are one range."""
    found = sorted({datetime.strptime(day, "%Y/%m/%d").replace(tzinfo=timezone.utc) for day in days})
    firsts = [day for day in found if day - timedelta(days=1) not in found]
    lasts = [day for day in found if day + timedelta(days=1) not in found]
    return [
        (int(first.timestamp()) * 1000, (int(last.timestamp()) + _SECONDS_PER_DAY) * 1000)
        for first, last in zip(firsts, lasts, strict=True)
    ]


def window_label(window: str) -> str:
    """'5 minutes' -> '5min', for column names."""
    count, unit = window.split()
    return count + _UNITS[unit.rstrip("s")][0]


def window_seconds(window: str) -> int:
    count, unit = window.split()
    return int(count) * _UNITS[unit.rstrip("s")][1]
