"""Declared schemas of the nine source tables and of the star they are turned into.

Every clean table is described by one ``TableSpec``: which raw column becomes which typed
column, what a row needs to be kept, what makes it unique, and (for two tables) which of several
rows with the same key survives. Schemas are never inferred from data.
"""

from __future__ import annotations

from collections.abc import Callable
from dataclasses import dataclass

from pyspark.sql import Column
from pyspark.sql import functions as F
from pyspark.sql import types as T

from tierstar import functions as fn

CORRUPT = "_corrupt_record"

# kind -> (column expression on unquoted text, Spark type); blank text fits no other type by itself
KINDS: dict[str, tuple[Callable[[Column, int], Column], T.DataType]] = {
    "fixed": (lambda c, n: fn.fixed(fn.filled(c), n), T.StringType()),
    "fixed_upper": (lambda c, n: fn.fixed_upper(fn.filled(c), n), T.StringType()),
    "limited": (lambda c, n: fn.limited(fn.filled(c), n), T.StringType()),
    # Limited text that tables are joined on: blanks at its end do not tell two values apart.
    "limited_key": (lambda c, n: fn.fixed(fn.filled(c), n), T.StringType()),
    "text": (lambda c, _: fn.filled(c), T.StringType()),
    "int": (lambda c, _: fn.try_int(c), T.IntegerType()),
    "unsigned_byte": (lambda c, _: fn.try_unsigned_byte(c), T.ShortType()),
    "money": (lambda c, _: fn.try_money(c), T.DecimalType(10, 2)),
    "float": (lambda c, _: fn.try_float(c), T.DoubleType()),
    "seconds": (lambda c, _: fn.try_seconds(c), T.TimestampNTZType()),
    "date": (lambda c, _: fn.try_date(c), T.DateType()),
}


@dataclass(frozen=True)
class ColumnSpec:
    name: str
    kind: str
    size: int = 0
    raw_name: str | None = None

    @property
    def raw(self) -> str:
        return self.raw_name or self.name

    def typed(self, text: Column) -> Column:
        return KINDS[self.kind][0](text, self.size)

    @property
    def spark_type(self) -> T.DataType:
        return KINDS[self.kind][1]


@dataclass(frozen=True)
class TableSpec:
    """One source table. ``best_first`` orders rows of equal key; it may use typed and raw columns."""

    name: str
    columns: tuple[ColumnSpec, ...]
    required: tuple[str, ...]
    key: tuple[str, ...]
    separator: str = ","
    best_first: Callable[[], list[Column]] | None = None

    def raw_schema(self) -> T.StructType:
        return T.StructType([T.StructField(c.raw, T.StringType()) for c in self.columns])

    def clean_schema(self) -> T.StructType:
        return T.StructType(
            [T.StructField(c.name, c.spark_type, c.name not in self.required) for c in self.columns]
        )

    def column(self, name: str) -> ColumnSpec:
        return next(c for c in self.columns if c.name == name)


def raw(column: str) -> Column:
    """A raw column beside the typed ones, while rows of equal key are being ranked."""
    return F.col(f"_raw_{column}")


def _identifier(name: str) -> ColumnSpec:
    return ColumnSpec(name, "fixed", 32)


def _best_place() -> list[Column]:
    """Rows that carry both raw coordinates (parseable or not) come first, then by raw city."""
    both = raw("geolocation_lat").isNotNull() & raw("geolocation_lng").isNotNull()
    return [F.when(both, 0).otherwise(1), raw("geolocation_city").asc_nulls_first()]


def _latest_answer() -> list[Column]:
    """Rows with a non-blank raw answer time first (quotes count as text), then latest answer, then latest creation."""
    return [
        F.when(F.trim(raw("review_answer_timestamp")) != "", 0).otherwise(1),
        F.col("review_answer_timestamp").desc_nulls_last(),
        F.col("review_creation_date").desc_nulls_last(),
    ]


# Column names and sizes of the source files and of the clean tables.
CUSTOMERS = TableSpec(
    "customers",
    (
        _identifier("customer_id"),
        _identifier("customer_unique_id"),
        ColumnSpec("customer_zip_code_prefix", "fixed", 5),
        ColumnSpec("customer_city", "limited", 100),
        ColumnSpec("customer_state", "fixed_upper", 2),
    ),
    required=("customer_id", "customer_unique_id"),
    key=("customer_id",),
)

GEOLOCATION = TableSpec(
    "geolocation",
    (
        ColumnSpec("geolocation_zip_code_prefix", "fixed", 5),
        ColumnSpec("geolocation_lat", "float"),
        ColumnSpec("geolocation_lng", "float"),
        ColumnSpec("geolocation_city", "limited", 50),
        ColumnSpec("geolocation_state", "fixed_upper", 2),
    ),
    required=("geolocation_zip_code_prefix",),
    key=("geolocation_zip_code_prefix",),
    best_first=_best_place,
)

ORDER_ITEMS = TableSpec(
    "order_items",
    (
        _identifier("order_id"),
        ColumnSpec("order_item_id", "int"),
        _identifier("product_id"),
        _identifier("seller_id"),
        ColumnSpec("shipping_limit_date", "seconds"),
        ColumnSpec("price", "money"),
        ColumnSpec("freight_value", "money"),
    ),
    required=("order_id", "order_item_id", "product_id", "seller_id"),
    key=("order_id", "order_item_id"),
)

PAYMENTS = TableSpec(
    "payments",
    (
        _identifier("order_id"),
        ColumnSpec("payment_sequential", "int"),
        ColumnSpec("payment_type", "limited", 30),
        ColumnSpec("payment_installments", "int"),
        ColumnSpec("payment_value", "money"),
    ),
    required=("order_id", "payment_sequential"),
    key=("order_id", "payment_sequential"),
)

REVIEWS = TableSpec(
    "reviews",
    (
        _identifier("review_id"),
        _identifier("order_id"),
        ColumnSpec("review_score", "unsigned_byte"),
        ColumnSpec("review_comment_title", "limited", 255),
        ColumnSpec("review_comment_message", "text"),
        ColumnSpec("review_creation_date", "seconds"),
        ColumnSpec("review_answer_timestamp", "seconds"),
    ),
    required=("review_id", "order_id"),
    key=("review_id",),
    separator="|",
    best_first=_latest_answer,
)

ORDERS = TableSpec(
    "orders",
    (
        _identifier("order_id"),
        _identifier("customer_id"),
        ColumnSpec("order_status", "limited", 20),
        ColumnSpec("order_purchase_timestamp", "seconds"),
        ColumnSpec("order_approved_at", "seconds"),
        ColumnSpec("order_delivered_carrier_date", "seconds"),
        ColumnSpec("order_delivered_customer_date", "seconds"),
        ColumnSpec("order_estimated_delivery_date", "date"),
    ),
    required=("order_id", "customer_id"),
    key=("order_id",),
)

PRODUCTS = TableSpec(
    "products",
    (
        _identifier("product_id"),
        ColumnSpec("product_category_name", "limited_key", 50),
        ColumnSpec("product_name_length", "int", raw_name="product_name_lenght"),
        ColumnSpec("product_description_length", "int", raw_name="product_description_lenght"),
        ColumnSpec("product_photos_qty", "unsigned_byte"),
        ColumnSpec("product_weight_g", "int"),
        ColumnSpec("product_length_cm", "int"),
        ColumnSpec("product_height_cm", "int"),
        ColumnSpec("product_width_cm", "int"),
    ),
    required=("product_id",),
    key=("product_id",),
)

SELLERS = TableSpec(
    "sellers",
    (
        _identifier("seller_id"),
        ColumnSpec("seller_zip_code_prefix", "fixed", 5),
        ColumnSpec("seller_city", "limited", 50),
        ColumnSpec("seller_state", "fixed_upper", 2),
    ),
    required=("seller_id", "seller_zip_code_prefix"),
    key=("seller_id",),
)

CATEGORY_TRANSLATION = TableSpec(
    "category_translation",
    (
        ColumnSpec("product_category_name", "limited_key", 50),
        ColumnSpec("product_category_name_english", "limited", 50),
    ),
    required=("product_category_name", "product_category_name_english"),
    key=("product_category_name",),
)

TABLES: dict[str, TableSpec] = {
    t.name: t
    for t in (
        CUSTOMERS,
        GEOLOCATION,
        ORDER_ITEMS,
        PAYMENTS,
        REVIEWS,
        ORDERS,
        PRODUCTS,
        SELLERS,
        CATEGORY_TRANSLATION,
    )
}

# Surrogate keys are bigint throughout: at warehouse scale a dimension can outgrow 2^31 rows.
STAR: dict[str, T.StructType] = {
    "dim_date": T.StructType(
        [
            T.StructField("date_key", T.IntegerType(), False),
            T.StructField("full_date", T.DateType(), False),
            T.StructField("year", T.ShortType(), False),
            T.StructField("month", T.ShortType(), False),
            T.StructField("day", T.ShortType(), False),
            T.StructField("month_name", T.StringType(), False),
            T.StructField("day_name", T.StringType(), False),
            T.StructField("quarter_number", T.ShortType(), False),
            T.StructField("is_weekend", T.IntegerType(), False),
        ]
    ),
    "dim_customers": T.StructType(
        [
            T.StructField("customer_key", T.LongType(), False),
            T.StructField("customer_id", T.StringType(), False),
            T.StructField("customer_unique_id", T.StringType(), False),
            T.StructField("customer_zip_code_prefix", T.StringType()),
            T.StructField("customer_city", T.StringType()),
            T.StructField("customer_state", T.StringType()),
        ]
    ),
    "dim_products": T.StructType(
        [
            T.StructField("product_key", T.LongType(), False),
            T.StructField("product_id", T.StringType(), False),
            T.StructField("product_category_name", T.StringType()),
            T.StructField("product_category_name_english", T.StringType()),
            T.StructField("product_name_length", T.IntegerType()),
            T.StructField("product_description_length", T.IntegerType()),
            T.StructField("product_photos_qty", T.ShortType()),
            T.StructField("product_weight_g", T.IntegerType()),
            T.StructField("product_length_cm", T.IntegerType()),
            T.StructField("product_height_cm", T.IntegerType()),
            T.StructField("product_width_cm", T.IntegerType()),
        ]
    ),
    "dim_sellers": T.StructType(
        [
            T.StructField("seller_key", T.LongType(), False),
            T.StructField("seller_id", T.StringType(), False),
            T.StructField("seller_zip_code_prefix", T.StringType()),
            T.StructField("seller_city", T.StringType()),
            T.StructField("seller_state", T.StringType()),
        ]
    ),
    "fact_orders": T.StructType(
        [
            T.StructField("fact_order_key", T.LongType(), False),
            T.StructField("order_id", T.StringType(), False),
            T.StructField("order_item_id", T.IntegerType(), False),
            T.StructField("customer_key", T.LongType(), False),
            T.StructField("product_key", T.LongType(), False),
            T.StructField("seller_key", T.LongType(), False),
            T.StructField("order_date_key", T.IntegerType(), False),
            T.StructField("shipping_limit_date_key", T.IntegerType()),
            T.StructField("approved_date_key", T.IntegerType()),
            T.StructField("delivered_date_key", T.IntegerType()),
            T.StructField("estimated_delivery_date_key", T.IntegerType()),
            T.StructField("order_status", T.StringType()),
            T.StructField("quantity", T.IntegerType(), False),
            T.StructField("item_amount", T.DecimalType(12, 2)),
            T.StructField("freight_amount", T.DecimalType(12, 2)),
            T.StructField("total_amount", T.DecimalType(12, 2)),
            T.StructField("allocated_payment_amount", T.DecimalType(12, 2)),
            T.StructField("review_score", T.DecimalType(5, 2)),
        ]
    ),
}


def conform(df, schema: T.StructType):
    """Project onto a declared schema: its columns, its order, its types."""
    return df.select(*[F.col(f.name).cast(f.dataType).alias(f.name) for f in schema])
