"""Analyses the star is made for. Each aggregates the fact by key before it joins names."""

from __future__ import annotations

from collections.abc import Mapping

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F


def _day(key: str) -> Column:
    k = F.col(key)
    return F.make_date(F.floor(k / 10000).cast("int"), (F.floor(k / 100) % 100).cast("int"), (k % 100).cast("int"))


def revenue_by_month(star: Mapping[str, DataFrame]) -> DataFrame:
    """Revenue, orders and lines per month of purchase."""
    per_order = star["fact_orders"].groupBy("order_date_key", "order_id").agg(
        F.sum("total_amount").alias("revenue"), F.count(F.lit(1)).alias("line_count")
    )
    per_day = per_order.groupBy("order_date_key").agg(
        F.sum("revenue").alias("revenue"),
        F.count(F.lit(1)).alias("order_count"),
        F.sum("line_count").alias("line_count"),
    )
    months = star["dim_date"].select(F.col("date_key").alias("order_date_key"), "year", "month")
    return per_day.join(months, "order_date_key").groupBy(
        F.col("year").alias("order_year"), F.col("month").alias("order_month")
    ).agg(
        F.sum("revenue").cast("decimal(38,2)").alias("revenue"),
        F.sum("order_count").alias("order_count"),
        F.sum("line_count").alias("order_line_count"),
    )


def sales_by_category(star: Mapping[str, DataFrame]) -> DataFrame:
    """Sales per English category name; untranslated categories form one NULL group."""
    per_product = star["fact_orders"].groupBy("product_key").agg(
        F.sum("total_amount").alias("revenue"), F.sum("quantity").alias("units")
    )
    names = star["dim_products"].select("product_key", "product_category_name_english")
    return per_product.join(names, "product_key").groupBy("product_category_name_english").agg(
        F.sum("revenue").cast("decimal(38,2)").alias("revenue"),
        F.sum("units").alias("units_sold"),
        F.count(F.lit(1)).alias("product_count"),
    )


def delivery_trend(star: Mapping[str, DataFrame]) -> DataFrame:
    """Delivered and late lines and the days from purchase to delivery, per month of purchase."""
    keys = ["order_date_key", "delivered_date_key", "estimated_delivery_date_key"]
    per_days = star["fact_orders"].groupBy(*keys).agg(F.count(F.lit(1)).alias("lines"))
    timed = per_days.select(
        F.floor(F.col("order_date_key") / 10000).cast("int").alias("order_year"),
        (F.floor(F.col("order_date_key") / 100) % 100).cast("int").alias("order_month"),
        "lines",
        F.when(F.col("delivered_date_key").isNotNull(), F.col("lines")).alias("delivered"),
        F.when(F.col("delivered_date_key") > F.col("estimated_delivery_date_key"), F.col("lines")).alias("late"),
        (F.datediff(_day("delivered_date_key"), _day("order_date_key")) * F.col("lines")).alias("days"),
    )
    return timed.groupBy("order_year", "order_month").agg(
        F.sum("lines").alias("order_line_count"),
        F.coalesce(F.sum("delivered"), F.lit(0)).alias("delivered_line_count"),
        F.coalesce(F.sum("late"), F.lit(0)).alias("late_line_count"),
        F.sum("days").alias("delivery_days"),
        F.try_divide(F.sum("days").cast("double"), F.sum("delivered").cast("double")).alias("avg_delivery_days"),
    )
