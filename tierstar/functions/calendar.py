"""Calendar attributes of a date column."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F


def date_key(c: Column) -> Column:
    """yyyymmdd as an integer; NULL stays NULL."""
    d = c.cast("date")
    return F.year(d) * 10000 + F.month(d) * 100 + F.day(d)


def month_name(c: Column) -> Column:
    """Full English month name."""
    return F.date_format(c, "MMMM")


def day_name(c: Column) -> Column:
    """Full English weekday name."""
    return F.date_format(c, "EEEE")


def is_weekend(c: Column) -> Column:
    """1 on Saturday and Sunday, else 0; does not depend on the session language."""
    return F.when(F.weekday(c) >= 5, 1).otherwise(0)
