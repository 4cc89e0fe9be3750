from decimal import Decimal as D

import pytest
from hypothesis import given, settings
from hypothesis import strategies as st
from pyspark.sql import functions as F

from helpers import at, on, table
from tierstar import functions as fn


def apply(spark, expression, *texts):
    df = table(spark, i=list(range(len(texts))), x=list(texts))
    return [r.y for r in df.select("i", expression(F.col("x")).alias("y")).orderBy("i").collect()]


def test_clean_text(spark):
    texts = ['  "ab c" ', '""', '"   "', "", "   ", None, 'a"b"c', '" x"', "\tx"]
    assert apply(spark, fn.clean_text, *texts) == ["ab c", None, None, None, None, None, "abc", " x", "\tx"]


def test_sizes(spark):
    assert apply(spark, lambda c: fn.limited(c, 3), "abcdef", "ab", "ab c") == ["abc", "ab", "ab "]
    assert apply(spark, lambda c: fn.fixed(c, 3), "abcdef", "ab ", "ab c") == ["abc", "ab", "ab"]
    assert apply(spark, lambda c: fn.fixed_upper(c, 2), "spx", "s") == ["SP", "S"]


def test_integers(spark):
    texts = ["12", "+5", "-7", " 8 ", "12.0", "1e3", "x", "99999999999", None]
    assert apply(spark, fn.try_int, *texts) == [12, 5, -7, 8, None, None, None, None, None]


def test_unsigned_byte(spark):
    assert apply(spark, fn.try_unsigned_byte, "0", "200", "255", "256", "-1", "300") == [0, 200, 255, None, None, None]


def test_money(spark):
    texts = ["58.905", "-58.905", "12", ".5", "5.", "1e3", "abc", "123456789.00", "12345678.994"]
    expected = [D("58.91"), D("-58.91"), D("12.00"), D("0.50"), D("5.00"), None, None, None, D("12345678.99")]
    assert apply(spark, fn.try_money, *texts) == expected


def test_float(spark):
    assert apply(spark, fn.try_float, "-23.5", "1e3", "NaN", "1.5d", "Infinity", "1e999") == [-23.5, 1000.0, None, None, None, None]


def test_seconds(spark):
    texts = ["2017-10-02 10:56:33", "2017-10-02", "2017-10-02 23:59:59.6", "2017-10-02 23:59:59.4", "10-02", "2017", "2017-13-01", "12:30", "2017-10-02T08:30"]
    expected = [
        at("2017-10-02 10:56:33"),
        at("2017-10-02 00:00:00"),
        at("2017-10-03 00:00:00"),
        at("2017-10-02 23:59:59"),
        None,
        None,
        None,
        None,
        at("2017-10-02 08:30:00"),
    ]
    assert apply(spark, fn.try_seconds, *texts) == expected


def test_seconds_ignore_the_session_zone(spark):
    zone = spark.conf.get("spark.sql.session.timeZone")
    try:
        spark.conf.set("spark.sql.session.timeZone", "America/Sao_Paulo")
        # 00:00:00.7 does not exist there on this day, when clocks went forward at midnight.
        assert apply(spark, fn.try_seconds, "2017-10-15 00:00:00.7", "2017-10-15 00:30:00") == [
            at("2017-10-15 00:00:01"),
            at("2017-10-15 00:30:00"),
        ]
    finally:
        spark.conf.set("spark.sql.session.timeZone", zone)


def test_dates(spark):
    assert apply(spark, fn.try_date, "2017-10-18 00:00:00", "2017-10-18", "soon", None) == [on("2017-10-18")] * 2 + [None] * 2


@pytest.mark.parametrize(
    "day, key, month, name, weekend",
    [
        ("2017-10-14", 20171014, "October", "Saturday", 1),
        ("2017-10-15", 20171015, "October", "Sunday", 1),
        ("2018-01-01", 20180101, "January", "Monday", 0),
    ],
)
def test_calendar(spark, day, key, month, name, weekend):
    d = F.to_date(F.lit(day))
    row = spark.range(1).select(fn.date_key(d), fn.month_name(d), fn.day_name(d), fn.is_weekend(d)).first()
    assert tuple(row) == (key, month, name, weekend)


def reference_clean(x):
    y = x.strip(" ").replace('"', "")
    return y if y.rstrip(" ") else None


@settings(max_examples=5, deadline=None)
@given(st.lists(st.text(alphabet=' "ab\té,', max_size=8), min_size=20, max_size=200))
def test_clean_text_against_plain_python(spark, texts):
    assert apply(spark, fn.clean_text, *texts) == [reference_clean(x) for x in texts]
