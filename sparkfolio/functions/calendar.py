"""Calendar helpers."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

# Weekday names and their report order (Monday first).
WEEKDAYS = ["Monday", "Tuesday", "Wednesday", "Thursday", "Friday", "Saturday", "Sunday"]


def _col(c) -> Column:
    return F.col(c) if isinstance(c, str) else c


def hour_of_day(c) -> Column:
    return F.hour(_col(c))


def weekday_name(c) -> Column:
    """Full English day name (``dayname`` would give ``Mon``)."""
    return F.date_format(_col(c), "EEEE")


def weekday_ord(c, sunday_first: bool = False) -> Column:
    """Explicit ordering key, Monday=1..Sunday=7 (or Sunday=1..)."""
    d = F.dayofweek(_col(c))  # Sunday=1 .. Saturday=7
    return d if sunday_first else ((d + F.lit(5)) % F.lit(7)) + F.lit(1)
