"""Load stamps and time arithmetic."""

from __future__ import annotations

from datetime import timedelta

from pyspark.sql import Column
from pyspark.sql import functions as F

# Load stamp of a run (fixed value): also its directory below the landing zone.
LOADDATE_FORMAT = "yyyy/MM/dd/HH/mm"


def run_time(loaddate: Column | str) -> Column:
    """Load stamp -> TIMESTAMP, null if it is not one."""
    return F.try_to_timestamp(_column(loaddate), F.lit(LOADDATE_FORMAT))


def loaddate_of(ts: Column | str) -> Column:
    return F.date_format(_column(ts), LOADDATE_FORMAT)


def load_day(loaddate: Column | str) -> Column:
    """The `yyyy/MM/dd` part of a load stamp."""
    return F.substring(_column(loaddate), 1, 10)


def to_us(interval: timedelta) -> int:
    return interval // timedelta(microseconds=1)


def distance_us(later: Column, earlier: Column) -> Column:
    return F.unix_micros(later) - F.unix_micros(earlier)


def slot_of(ts: Column | str, width: timedelta) -> Column:
    """Number of the half-open slot [k*width, (k+1)*width) holding `ts`; exact also before 1970."""
    micros = F.unix_micros(_column(ts))
    size = F.lit(to_us(width)).cast("long")
    return F.call_function("div", micros - F.pmod(micros, size), size)


def _column(value: Column | str) -> Column:
    return F.col(value) if isinstance(value, str) else value
