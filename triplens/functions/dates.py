"""Date labels and dated paths."""

from __future__ import annotations

from datetime import date

from pyspark.sql import Column
from pyspark.sql import functions as F


def weekday_label(day: Column) -> Column:
    """``2016-03-18 (Friday)``."""
    return F.date_format(day, "yyyy-MM-dd (EEEE)")


def date_key(day: Column) -> Column:
    """``2016_3_18``: month and day without leading zeros."""
    return F.date_format(day, "y_M_d")


def dated_path(prefix: str, day: date) -> str:
    """``prefix`` followed by the date key of ``day``."""
    return f"{prefix}_{day.year}_{day.month}_{day.day}"
