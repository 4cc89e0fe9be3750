from tierstar.functions.calendar import date_key, day_name, is_weekend, month_name
from tierstar.functions.cast import (
    try_date,
    try_float,
    try_int,
    try_money,
    try_seconds,
    try_unsigned_byte,
)
from tierstar.functions.text import clean_text, filled, fixed, fixed_upper, limited, present, unquoted

__all__ = [
    "clean_text",
    "date_key",
    "day_name",
    "filled",
    "fixed",
    "fixed_upper",
    "is_weekend",
    "limited",
    "month_name",
    "present",
    "try_date",
    "try_float",
    "try_int",
    "try_money",
    "try_seconds",
    "try_unsigned_byte",
    "unquoted",
]
