"""The star: four dimensions, one fact per order line, and its gate."""

from __future__ import annotations

from collections.abc import Mapping

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from tierstar import functions as fn
from tierstar.operators.aggregates import (
    allocate,
    amount_or_zero,
    items_per_order,
    order_review_score,
    payments_per_order,
    union_distinct,
)
from tierstar.operators.clean import require
from tierstar.operators.joins import enrich, heavy_keys, split_join
from tierstar.operators.keys import dense_key, derive_date, resolve_date, resolve_key
from tierstar.operators.quality import WARNING, Reference, Rule, Unique, any_null, key_checks, negative, row_checks, run_checks
from tierstar.schemas import STAR, conform

# Check codes of the star.
GOLD_NOT_NULL, GOLD_UNIQUE, GOLD_ORPHAN, GOLD_SIGN = 54100, 54200, 54300, 54400

DATE_ROLES = (
    "order_date_key",
    "shipping_limit_date_key",
    "approved_date_key",
    "delivered_date_key",
    "estimated_delivery_date_key",
)
# The calendar covers these order dates and the items' shipping limit; the carrier hand-over is not in use.
ORDER_DATES = (
    "order_purchase_timestamp",
    "order_approved_at",
    "order_delivered_customer_date",
    "order_estimated_delivery_date",
)
DIMENSION_KEYS = {
    "dim_customers": ("customer_key", "customer_id"),
    "dim_products": ("product_key", "product_id"),
    "dim_sellers": ("seller_key", "seller_id"),
}


def dates_in_use(orders: DataFrame, items: DataFrame) -> DataFrame:
    """Every distinct day that an order or item mentions; each table is scanned once."""
    days = F.explode(F.array(*[F.col(c).cast("date") for c in ORDER_DATES]))
    of_orders = orders.select(days.alias("full_date"))
    of_items = items.select(F.col("shipping_limit_date").cast("date").alias("full_date"))
    return union_distinct([of_orders, of_items]).filter(F.col("full_date").isNotNull())


def build_dim_date(orders: DataFrame, items: DataFrame) -> DataFrame:
    day = F.col("full_date")
    calendar = dates_in_use(orders, items).select(
        fn.date_key(day).alias("date_key"),
        "full_date",
        F.year(day).alias("year"),
        F.month(day).alias("month"),
        F.day(day).alias("day"),
        fn.month_name(day).alias("month_name"),
        fn.day_name(day).alias("day_name"),
        F.quarter(day).alias("quarter_number"),
        fn.is_weekend(day).alias("is_weekend"),
    )
    return conform(calendar, STAR["dim_date"])


def build_dimension(name: str, rows: DataFrame) -> DataFrame:
    """Current attribute values under a dense surrogate key."""
    surrogate, business = DIMENSION_KEYS[name]
    return conform(dense_key(rows, [business], surrogate), STAR[name])


def build_dim_customers(customers: DataFrame) -> DataFrame:
    return build_dimension("dim_customers", customers)


def build_dim_sellers(sellers: DataFrame) -> DataFrame:
    return build_dimension("dim_sellers", sellers)


def build_dim_products(products: DataFrame, translation: DataFrame) -> DataFrame:
    """Products with the English category name; untranslated categories keep a NULL.

    The name is looked up after numbering, so counting rows for the keys does not need the join.
    """
    numbered = dense_key(products, ["product_id"], "product_key")
    return conform(enrich(numbered, translation, "product_category_name"), STAR["dim_products"])


def build_dimensions(clean: Mapping[str, DataFrame]) -> dict[str, DataFrame]:
    return {
        "dim_date": build_dim_date(clean["orders"], clean["order_items"]),
        "dim_customers": build_dim_customers(clean["customers"]),
        "dim_products": build_dim_products(clean["products"], clean["category_translation"]),
        "dim_sellers": build_dim_sellers(clean["sellers"]),
    }


def _date_role(rows: DataFrame, dates: DataFrame | None, time: str, role: str, how: str = "left") -> DataFrame:
    if dates is None:
        return derive_date(rows, time, role, how)
    return resolve_date(rows, dates, time, role, how)


def order_header(
    orders: DataFrame, counts: DataFrame, payments: DataFrame, reviews: DataFrame, dim_customers: DataFrame | None, dates: DataFrame | None = None
) -> DataFrame:
    """One row per order with everything a line takes over from it.

    All joined sides hold one row per order and share one partitioning on ``order_id``. Orders
    without a purchase time or without a known customer leave here, before the large join. Without
    ``dim_customers`` the customer id is kept instead and nothing but ``order_id`` is joined on.
    """
    header = _date_role(orders, dates, "order_purchase_timestamp", "order_date_key", "inner")
    header = _date_role(header, dates, "order_approved_at", "approved_date_key")
    header = _date_role(header, dates, "order_delivered_customer_date", "delivered_date_key")
    header = _date_role(header, dates, "order_estimated_delivery_date", "estimated_delivery_date_key")
    if dim_customers is not None:
        header = resolve_key(header, dim_customers, "customer_id", "customer_key")
    header = (
        header.join(counts, "order_id")
        .join(payments_per_order(payments), "order_id", "left")
        .join(order_review_score(reviews), "order_id", "left")
    )
    return header.select(
        "order_id",
        "customer_id" if dim_customers is None else "customer_key",
        "order_date_key",
        "approved_date_key",
        "delivered_date_key",
        "estimated_delivery_date_key",
        "order_status",
        allocate(F.col("order_payment_amount"), F.col("order_item_count")).alias("allocated_payment_amount"),
        F.col("avg_review_score").alias("review_score"),
    )


def build_fact(
    items: DataFrame,
    orders: DataFrame,
    payments: DataFrame,
    reviews: DataFrame,
    dim_customers: DataFrame,
    dim_products: DataFrame,
    dim_sellers: DataFrame,
    dim_date: DataFrame | None = None,
    rows_per_split: int | None = 1_000_000,
) -> DataFrame:
    """One row per order line whose order, customer, product, seller and purchase day are all known.

    Lines are counted per order before any line leaves, so a dropped line still takes its share of
    the payment. Without ``dim_date`` the calendar keys are computed from the days, which gives
    what joining the calendar would. Orders with very many lines are split over several tasks. With
    ``rows_per_split=None``, for tables in buckets of ``order_id`` that hold no such orders, lines meet
    their order first, where they lie, and the dimensions after.
    """
    # A line without an order id cannot join; saying so once gives every use of the counts the same
    # plan, so Spark shuffles them once and reuses the exchange.
    items = require(items, "order_id")
    counts = items_per_order(items)
    in_place = rows_per_split is None
    header = order_header(orders, counts, payments, reviews, None if in_place else dim_customers, dim_date)
    lines = _date_role(items, dim_date, "shipping_limit_date", "shipping_limit_date_key")
    if in_place:
        lines = resolve_key(lines.join(header, "order_id"), dim_customers, "customer_id", "customer_key")
    lines = resolve_key(lines, dim_products, "product_id", "product_key")
    joined = lines = resolve_key(lines, dim_sellers, "seller_id", "seller_key")
    if not in_place:
        heavy = heavy_keys(counts, "order_id", "order_item_count", rows_per_split)
        joined = split_join(lines, header, "order_id", heavy, spread=["order_item_id"])
    fact = joined.select(
        "*",
        F.lit(1).alias("quantity"),
        F.col("price").alias("item_amount"),
        F.col("freight_value").alias("freight_amount"),
        (amount_or_zero("price") + amount_or_zero("freight_value")).alias("total_amount"),
    )
    return conform(fact, fact_rows_schema())


def fact_rows_schema() -> T.StructType:
    """The fact without its own surrogate key, which is given when the rows are stored."""
    return T.StructType([f for f in STAR["fact_orders"] if f.name != "fact_order_key"])


def order_month_key(c: Column | str = "order_date_key") -> Column:
    """yyyymm, the storage partition of the fact."""
    return F.floor((F.col(c) if isinstance(c, str) else c) / 100).cast("int")


def gate(star: Mapping[str, DataFrame]) -> DataFrame:
    """Unique keys, required columns, valid references and non-negative amounts of the star.

    Every table is read twice: once for what shows in single rows, once for its keys.
    """
    results = []
    for i, (name, df) in enumerate(star.items()):
        required = [f.name for f in STAR[name] if not f.nullable and f.name in df.columns]
        rules = [Rule(GOLD_NOT_NULL + i, f"NULL in required columns of {name}", any_null(*required))]
        if name == "fact_orders":
            rules.append(Rule(GOLD_SIGN, "negative total_amount in fact_orders", negative("total_amount"), WARNING))
        results.append(row_checks(df, rules))

    unique = [("fact_orders", ("order_id", "order_item_id")), ("dim_date", ("date_key",)), ("dim_date", ("full_date",))]
    for name, keys in DIMENSION_KEYS.items():
        unique += [(name, (k,)) for k in keys]
    uniques = [Unique(GOLD_UNIQUE + i, f"duplicate {', '.join(keys)} in {name}", name, keys) for i, (name, keys) in enumerate(unique)]

    roles = [("dim_customers", "customer_key", "customer_key")]
    roles += [("dim_products", "product_key", "product_key"), ("dim_sellers", "seller_key", "seller_key")]
    roles += [("dim_date", role, "date_key") for role in DATE_ROLES]
    references = [
        Reference(GOLD_ORPHAN + i, f"fact_orders.{role} not in {name}", "fact_orders", role, name, key, role in DATE_ROLES[1:]) for i, (name, role, key) in enumerate(roles)
    ]
    return run_checks([*results, key_checks(star, uniques, references)])
