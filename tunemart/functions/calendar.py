"""Calendar parts of a timestamp."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F


def calendar_parts(ts: Column) -> list[Column]:
    """hour, day, week, month, year, weekday.

    week is the ISO week while year is the calendar year, so the last days of December may
    carry week 1 of the year they still belong to. weekday counts from Sunday = 0.
    """
    return [
        F.hour(ts).alias("hour"),
        F.dayofmonth(ts).alias("day"),
        F.weekofyear(ts).alias("week"),
        F.month(ts).alias("month"),
        F.year(ts).alias("year"),
        (F.dayofweek(ts) - 1).alias("weekday"),
    ]
