"""Per-order aggregates, allocation, counts and unions."""

from __future__ import annotations

from collections.abc import Iterable, Mapping
from functools import reduce

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F


def amount_or_zero(c: Column | str) -> Column:
    c = F.col(c) if isinstance(c, str) else c
    return F.coalesce(c, F.lit(0).cast("decimal(3,2)"))


def union_all(frames: Iterable[DataFrame]) -> DataFrame:
    return reduce(DataFrame.unionByName, frames)


def union_distinct(frames: Iterable[DataFrame]) -> DataFrame:
    return union_all(frames).distinct()


def row_counts(tables: Mapping[str, DataFrame]) -> DataFrame:
    """One line per table: its name and its number of rows."""
    return union_all(
        df.agg(F.count(F.lit(1)).alias("row_count")).select(F.lit(name).alias("table_name"), "row_count")
        for name, df in tables.items()
    )


def items_per_order(items: DataFrame) -> DataFrame:
    return items.groupBy("order_id").agg(F.count(F.lit(1)).alias("order_item_count"))


def payments_per_order(payments: DataFrame) -> DataFrame:
    """Payment total per order; a missing value counts as zero."""
    return payments.groupBy("order_id").agg(F.sum(amount_or_zero("payment_value")).alias("order_payment_amount"))


def order_review_score(reviews: DataFrame) -> DataFrame:
    """Mean score per order over the reviews that have one."""
    scored = reviews.filter(F.col("review_score").isNotNull())
    return scored.groupBy("order_id").agg(F.avg(F.col("review_score").cast("decimal(5,2)")).alias("avg_review_score"))


def allocate(amount: Column, parts: Column) -> Column:
    """An even share in cents; NULL without an amount or without parts. Shares may not add up to the cent."""
    return F.when(parts > 0, (amount / parts).cast("decimal(12,2)"))
