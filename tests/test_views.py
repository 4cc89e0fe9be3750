from decimal import Decimal as D

from pyspark.sql import functions as F

from helpers import rows, table
from tierstar.operators.aggregates import (
    allocate,
    items_per_order,
    order_review_score,
    payments_per_order,
    row_counts,
    union_all,
    union_distinct,
)
from tierstar.plans import analyses, views


def test_kpis_of_the_shop(star):
    customers = views.customer_metrics(star)
    assert customers.columns == [
        "customer_id",
        "customer_unique_id",
        "customer_city",
        "customer_state",
        "order_count",
        "order_line_count",
        "gross_sales_amount",
        "avg_order_line_amount",
        "avg_review_score",
    ]
    assert rows(customers, "customer_id") == [
        ("c1", "u1", "sao paulo", "SP", 1, 3, D("63.00"), D("21.000000"), D("4.500000")),
        ("c2", "u2", "rio", "RJ", 1, 1, D("5.50"), D("5.500000"), None),
    ]
    products = views.product_metrics(star)
    assert rows(products, "product_id") == [
        ("p1", "perfumaria", "perfumery", 2, 2, D("41.00"), D("20.500000"), D("4.500000")),
        ("p2", "artes", None, 2, 2, D("27.50"), D("13.750000"), D("4.500000")),
    ]
    assert len(views.order_line_metrics(star).columns) == 23


def test_kpis_do_not_depend_on_where_names_are_joined(star):
    """Aggregating lines with their names gives the same as aggregating keys first."""
    lines = views.order_line_metrics(star)
    direct = lines.groupBy("customer_id", "customer_unique_id", "customer_city", "customer_state").agg(
        F.count_distinct("order_id"), F.count("*"), F.sum("total_amount"), F.avg("total_amount"), F.avg("review_score")
    )
    assert rows(direct, "customer_id") == rows(views.customer_metrics(star), "customer_id")
    assert lines.agg(F.sum("total_amount")).first()[0] == star["fact_orders"].agg(F.sum("total_amount")).first()[0]


def test_analyses_of_the_shop(star):
    assert rows(analyses.revenue_by_month(star), "order_year") == [(2017, 10, D("63.00"), 1, 3), (2018, 7, D("5.50"), 1, 1)]
    by_category = rows(analyses.sales_by_category(star), "product_category_name_english")
    assert by_category == [(None, D("27.50"), 2, 1), ("perfumery", D("41.00"), 2, 1)]
    assert rows(analyses.delivery_trend(star), "order_year") == [(2017, 10, 3, 3, 0, 24, 8.0), (2018, 7, 1, 0, 0, None, None)]


def test_per_order_aggregates(spark):
    payments = table(spark, order_id=["a", "a", "b"], payment_value=[D("60.00"), D("40.00"), None])
    payments = payments.withColumn("payment_value", F.col("payment_value").cast("decimal(10,2)"))
    assert rows(payments_per_order(payments), "order_id") == [("a", D("100.00")), ("b", D("0.00"))]
    assert rows(items_per_order(payments), "order_id") == [("a", 2), ("b", 1)]
    reviews = table(spark, order_id=["a", "a", "a", "b"], review_score=[5, 4, 4, None])
    assert rows(order_review_score(reviews)) == [("a", D("4.333333"))]


def test_allocation(spark):
    df = table(spark, amount=["100.00", "0.05", None, "1.00"], n=[3, 2, 2, 0])
    got = df.select(allocate(F.col("amount").cast("decimal(20,2)"), F.col("n")).alias("a"))
    assert [r.a for r in got.collect()] == [D("33.33"), D("0.03"), None, None]


def test_unions_and_counts(spark):
    a, b = table(spark, x=[1, 2, 2]), table(spark, x=[2, 3])
    assert union_all([a, b]).count() == 5
    assert rows(union_distinct([a, b]), "x") == [(1,), (2,), (3,)]
    assert rows(row_counts({"a": a, "b": b}), "table_name") == [("a", 3), ("b", 2)]


def test_line_view_keeps_orders_together_and_joins_the_calendar_last(star):
    from tierstar.plans import views

    plan = views.order_line_metrics(star)._jdf.queryExecution().optimizedPlan().toString()
    keys = [next(k for k in ("order_date_key", "customer_key", "product_key", "seller_key") if k in line) for line in plan.splitlines() if "Join Inner" in line]
    # From the last join down.
    assert keys == ["order_date_key", "seller_key", "product_key", "customer_key"]
