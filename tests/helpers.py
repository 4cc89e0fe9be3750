"""Small clean and raw tables shared by the tests."""

from datetime import date, datetime

import pyarrow as pa

from tierstar.schemas import TABLES


def rows(df, *order):
    return [tuple(r) for r in (df.orderBy(*order) if order else df).collect()]


def raw_table(spark, name, *lines):
    """Raw rows from tuples of text; short tuples are filled with NULL."""
    names = [c.raw for c in TABLES[name].columns]
    filled = [tuple(line) + (None,) * (len(names) - len(line)) for line in lines]
    columns = {n: pa.array([line[i] for line in filled], pa.string()) for i, n in enumerate(names)}
    return spark.createDataFrame(pa.table(columns))


def table(spark, **columns):
    """A small table from lists of values."""
    return spark.createDataFrame(pa.table(columns))


def shop(spark, **replace):
    """Raw rows of a tiny shop: order o1 with three lines, two payments and two reviews; o2 with one line only."""
    data = {
        "customers": [('"c1"', '"u1"', '"01000"', " sao paulo ", '"sp"'), ("c2", "u2", "02000", "rio", "rj")],
        "geolocation": [("01000", "-23.5", "-46.6", "sao paulo", "sp")],
        "orders": [
            ("o1", "c1", "delivered", "2017-10-02 10:56:33", "2017-10-02 11:07:15", "2017-10-04 19:55:00", "2017-10-10 21:25:13", "2017-10-18 00:00:00"),
            ("o2", "c2", "shipped", "2018-07-24 20:41:37", "", "", "", "2018-08-13 00:00:00"),
        ],
        "order_items": [
            ("o1", "1", "p1", "s1", "2017-10-06 11:07:15", "10.00", "1.00"),
            ("o1", "2", "p2", "s1", "2017-10-06 11:07:15", "20.00", "2.00"),
            ("o1", "3", "p1", "s2", "2017-10-06 11:07:15", "30.00", ""),
            ("o2", "1", "p2", "s2", "2018-07-30 03:24:27", "5.00", "0.50"),
        ],
        "payments": [("o1", "1", "credit_card", "1", "60.00"), ("o1", "2", "voucher", "1", "40.00")],
        "reviews": [
            ("r1", "o1", "5", "", "good", "2017-10-11 00:00:00", "2017-10-12 03:43:48"),
            ("r2", "o1", "4", "", "", "2017-10-11 00:00:00", "2017-10-13 03:43:48"),
        ],
        "products": [("p1", "perfumaria", "40", "287", "1", "225", "16", "10", "14"), ("p2", "artes", "44", "276", "1", "1000", "30", "18", "20")],
        "sellers": [("s1", "13023", "campinas", "sp"), ("s2", "13844", "mogi guacu", "SP")],
        "category_translation": [("perfumaria", "perfumery")],
    }
    data.update(replace)
    return {name: raw_table(spark, name, *lines) for name, lines in data.items()}


def at(text):
    return datetime.strptime(text, "%Y-%m-%d %H:%M:%S")


def on(text):
    return date.fromisoformat(text)
