"""Business views over the star."""

from __future__ import annotations

from collections.abc import Mapping

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tierstar.operators.aggregates import amount_or_zero


def order_line_metrics(star: Mapping[str, DataFrame]) -> DataFrame:
    """Every order line with the names its keys stand for.

    Each shuffle carries what was joined before it, so the calendar, which is small enough to be sent to every task, comes last.
    Customers come first: the lines of an order have one customer, so they stay together in that shuffle and their bytes compress.
    """
    dates = star["dim_date"].select(
        F.col("date_key").alias("order_date_key"),
        F.col("full_date").alias("order_date"),
        F.col("year").alias("order_year"),
        F.col("month").alias("order_month"),
        "month_name",
    )
    return (
        star["fact_orders"]
        .join(star["dim_customers"], "customer_key")
        .join(star["dim_products"], "product_key")
        .join(star["dim_sellers"], "seller_key")
        .join(dates, "order_date_key")
        .select(
            "order_id",
            "order_item_id",
            "order_date",
            "order_year",
            "order_month",
            "month_name",
            "order_status",
            "customer_id",
            "customer_unique_id",
            "customer_city",
            "customer_state",
            "product_id",
            "product_category_name",
            "product_category_name_english",
            "seller_id",
            "seller_city",
            "seller_state",
            "quantity",
            "item_amount",
            "freight_amount",
            "total_amount",
            "allocated_payment_amount",
            "review_score",
        )
    )


def _sales() -> list[Column]:
    """Measures per group of lines. Scores are averaged over lines, so an order counts once per line."""
    return [
        F.sum(amount_or_zero("total_amount")).alias("gross_sales_amount"),
        F.avg(F.col("total_amount").cast("decimal(12,2)")).alias("avg_order_line_amount"),
        F.avg(F.col("review_score").cast("decimal(5,2)")).alias("avg_review_score"),
    ]


def customer_metrics(star: Mapping[str, DataFrame]) -> DataFrame:
    """Orders, lines, sales and score per customer id.

    A dimension row is unique on its key, so the fact is aggregated by key first and the names are
    joined to one row per customer instead of to every line.
    """
    per_customer = star["fact_orders"].groupBy("customer_key").agg(
        F.count_distinct("order_id").alias("order_count"),
        F.count(F.lit(1)).alias("order_line_count"),
        *_sales(),
    )
    names = ["customer_id", "customer_unique_id", "customer_city", "customer_state"]
    joined = per_customer.join(star["dim_customers"].select("customer_key", *names), "customer_key")
    return joined.select(*names, *[c for c in per_customer.columns if c != "customer_key"])


def product_metrics(star: Mapping[str, DataFrame]) -> DataFrame:
    """Lines, units, sales and score per product, aggregated by key before names are joined."""
    per_product = star["fact_orders"].groupBy("product_key").agg(
        F.count(F.lit(1)).alias("order_line_count"),
        F.sum(F.coalesce("quantity", F.lit(0))).alias("units_sold"),
        *_sales(),
    )
    names = ["product_id", "product_category_name", "product_category_name_english"]
    joined = per_product.join(star["dim_products"].select("product_key", *names), "product_key")
    return joined.select(*names, *[c for c in per_product.columns if c != "product_key"])


def all_views(star: Mapping[str, DataFrame]) -> dict[str, DataFrame]:
    return {
        "vw_order_line_metrics": order_line_metrics(star),
        "vw_customer_metrics": customer_metrics(star),
        "vw_product_metrics": product_metrics(star),
    }
