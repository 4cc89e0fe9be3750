from decimal import Decimal as D

from pyspark.sql import functions as F

from helpers import at, raw_table, rows
from tierstar.operators.clean import clean, left_out
from tierstar.schemas import TABLES


def cleaned(spark, name, *lines):
    return clean(raw_table(spark, name, *lines), TABLES[name])


def test_schemas_are_as_declared(spark):
    for name, spec in TABLES.items():
        produced = clean(raw_table(spark, name, ()), spec).schema
        assert [(f.name, f.dataType) for f in produced] == [(f.name, f.dataType) for f in spec.clean_schema()], name


def test_customers(spark):
    got = cleaned(
        spark,
        "customers",
        ('"c1"', '"u1"', '"014091"', '  sao paulo ', '  "sp" '),
        ("c2", '"  "', "1", "x", "rj"),
        ('""', "u3", "1", "x", "rj"),
    )
    assert rows(got) == [("c1", "u1", "01409", "sao paulo", "SP")]


def test_misspelt_lengths_are_renamed(spark):
    got = cleaned(spark, "products", ("p1", "", "40", "287.0", "300", "225", "16", "x", None))
    assert got.columns[2:4] == ["product_name_length", "product_description_length"]
    assert rows(got) == [("p1", None, 40, None, None, 225, 16, None, None)]


def test_items_need_a_whole_line_number(spark):
    got = cleaned(
        spark,
        "order_items",
        ("o1", "x", "p1", "s1", "2017-10-06", "1", "1"),
        ("o1", "1.0", "p1", "s1", "2017-10-06", "1", "1"),
        ("o1", "2", "p1", "s1", "bad", "abc", "1.005"),
        ("o1", "3", "", "s1", "2017-10-06", "1", "1"),
    )
    assert rows(got) == [("o1", 2, "p1", "s1", None, None, D("1.01"))]


def test_place_with_both_coordinates_wins_then_city(spark):
    got = cleaned(
        spark,
        "geolocation",
        ("01000", None, "-46", "a city", "sp"),
        ('"01000"', "nonsense", "-46", "c city", "sp"),
        ("01000", "-23", "-46", "d city", "sp"),
        ("02000", None, None, "only", "rj"),
        ("", "-1", "-1", "none", "rj"),
    )
    # An unparseable latitude is still there, so that row competes and wins by city.
    assert rows(got, "geolocation_zip_code_prefix") == [
        ("01000", None, -46.0, "c city", "SP"),
        ("02000", None, None, "only", "RJ"),
    ]


def test_copies_are_found_by_whole_key_text(spark):
    got = cleaned(spark, "geolocation", ("01000-1", "1", "1", "a", "sp"), ("01000-2", "1", "1", "b", "sp"))
    assert [r[0] for r in rows(got)] == ["01000", "01000"]


def test_latest_answered_review_wins(spark):
    def review(score, created, answered):
        return ("r1", "o1", score, "", "", created, answered)

    two_answers = cleaned(
        spark,
        "reviews",
        review("1", "2018-01-09", "2018-01-10 00:00:00"),
        review("2", "2018-01-01", "2018-02-10 00:00:00"),
        review("3", "2019-01-01", ""),
        review("4", "2019-01-01", None),
    )
    assert [r.review_score for r in two_answers.collect()] == [2]
    # Quotes are text, so this row counts as answered, but it loses to a real answer time.
    quoted = cleaned(spark, "reviews", review("1", "2019-01-01", '""'), review("2", "2018-01-01", "2018-01-02"))
    assert [r.review_score for r in quoted.collect()] == [2]
    quoted = cleaned(spark, "reviews", review("1", "2018-01-01", '""'), review("2", "2019-01-01", " "))
    assert [r.review_score for r in quoted.collect()] == [1]
    creation = cleaned(spark, "reviews", review("1", "2018-01-01", "x"), review("2", "2018-01-02", "x"))
    assert [(r.review_score, r.review_creation_date) for r in creation.collect()] == [(2, at("2018-01-02 00:00:00"))]


def test_ties_do_not_depend_on_row_order(spark):
    lines = [("r1", f"o{i % 7}", "5", f"title {i % 3}", "", "2018-01-01", "2018-01-02") for i in range(21)]
    df = raw_table(spark, "reviews", *lines)
    expected = rows(clean(df, TABLES["reviews"]))
    for parts in (3, 7):
        assert rows(clean(df.repartition(parts), TABLES["reviews"])) == expected


def test_hot_key_is_limited_before_the_shuffle(spark):
    text = [F.col("id").cast("string").alias(c.raw) for c in TABLES["reviews"].columns]
    plan = clean(spark.range(1000).select(*text), TABLES["reviews"])._jdf.queryExecution().executedPlan().toString()
    partial, final = plan.index("Partial"), plan.index("Final")
    exchange = plan.index("Exchange hashpartitioning")
    # Printed from the last step to the first: the partial limit runs below the exchange.
    assert "WindowGroupLimit" in plan and final < exchange < partial


def test_rows_left_out_are_accounted_for(spark):
    for name, lines in {
        "reviews": [("r1", "o1", "5"), (' "r1" ', "o1", "4"), ("r1 ", "o2", "3"), ("", "o1", "1"), ("r2", None, "x"), ("r3", "o1", "x")],
        "order_items": [("o1", "1", "p1", "s1"), ("o1", "x", "p1", "s1"), ("  ", "1", "p1", "s1"), ("o1", "1", "p1", "s1")],
    }.items():
        raw, spec = raw_table(spark, name, *lines), TABLES[name]
        out = {r.reason: r.row_count for r in left_out(raw, spec).collect()}
        assert raw.count() == clean(raw, spec).count() + sum(out.values()), name
        assert out["required column missing"] >= 1 and (out["copy"] >= 1) == (spec.best_first is not None)
        assert sum(r.row_count for r in left_out(raw.limit(0), spec).collect()) == 0
