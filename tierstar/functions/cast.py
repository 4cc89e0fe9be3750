"""Safe casts of cleaned text: what does not parse becomes NULL and never fails the job.

Each pattern below names the accepted spelling, because Spark's own parsers also take forms
such as ``1e3`` for a decimal, ``NaN`` for a double or ``2017`` for a timestamp. Asking first is
also the fast way: a failed cast raises and catches an exception inside Spark, row by row.
"""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

INTEGER = r"^ *[+-]?[0-9]+ *$"
DECIMAL = r"^ *[+-]?([0-9]+[.]?[0-9]*|[.][0-9]+) *$"
FLOAT = r"^ *[+-]?([0-9]+[.]?[0-9]*|[.][0-9]+)([eE][+-]?[0-9]+)? *$"
DATE_TIME = r"^(?!0000)[0-9]{4}-[0-9]{1,2}-[0-9]{1,2}([ T][0-9]{1,2}:[0-9]{2}(:[0-9]{2}([.][0-9]+)?)?)?$"


def _if_spelled(c: Column, pattern: str, value: Column) -> Column:
    return F.when(c.rlike(pattern), value)


def try_int(c: Column) -> Column:
    return _if_spelled(c, INTEGER, F.trim(c).try_cast("int"))


def try_unsigned_byte(c: Column) -> Column:
    """0..255 held in a smallint, because Spark's own byte type ends at 127."""
    n = try_int(c)
    return F.when(n.between(0, 255), n.cast("smallint"))


def try_money(c: Column) -> Column:
    """decimal(10,2), rounded half up; too large a value is NULL."""
    return _if_spelled(c, DECIMAL, F.trim(c).try_cast("decimal(10,2)"))


def try_float(c: Column) -> Column:
    value = F.trim(c).try_cast("double")
    return F.when(c.rlike(FLOAT) & (F.abs(value) < float("inf")), value)


def _dashed(t: Column) -> Column:
    """``yyyymmdd`` at the head of a text as ``yyyy-mm-dd``."""
    return F.regexp_replace(t, "^([0-9]{4})([0-9]{2})([0-9]{2})(?=$|[ T])", "$1-$2-$3")


def try_seconds(c: Column) -> Column:
    """Zone-free timestamp rounded to the nearest second.

    The fraction is cut off as text: Spark's ``date_trunc`` would take the value through the session
    zone and move times that do not exist there.
    """
    t = _dashed(F.trim(c))
    exact = t.try_cast("timestamp_ntz")
    nudged = exact + F.expr("interval 500 milliseconds")
    rounded = F.left(nudged.cast("string"), F.lit(19)).try_cast("timestamp_ntz")
    return _if_spelled(t, DATE_TIME, F.when(F.contains(t, F.lit(".")), rounded).otherwise(exact))


def try_date(c: Column) -> Column:
    t = _dashed(F.trim(c))
    return _if_spelled(t, DATE_TIME, t.try_cast("date"))
