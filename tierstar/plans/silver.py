"""The clean layer: nine typed tables and the gate in front of the star."""

from __future__ import annotations

from collections.abc import Mapping

from pyspark.sql import DataFrame, SparkSession

from tierstar.operators.clean import clean
from tierstar.operators.quality import (
    WARNING,
    Reference,
    Rule,
    Unique,
    any_null,
    count_check,
    earlier,
    existence_checks,
    key_checks,
    negative,
    outside,
    row_checks,
    run_checks,
)
from tierstar.schemas import TABLES

# Check codes. Tables are counted in this order within each hundred.
EXISTS_CODE, NOT_NULL_CODE, UNIQUE_CODE, ORPHAN_CODE = 53000, 53100, 53200, 53300
CHECK_ORDER = (
    "customers",
    "geolocation",
    "order_items",
    "payments",
    "reviews",
    "orders",
    "products",
    "sellers",
    "category_translation",
)
# (child, parent, key), in code order
RELATIONS = (
    ("orders", "customers", "customer_id"),
    ("order_items", "orders", "order_id"),
    ("order_items", "products", "product_id"),
    ("order_items", "sellers", "seller_id"),
    ("payments", "orders", "order_id"),
    ("reviews", "orders", "order_id"),
)
# Codes of the reported-only checks of row counts, signs, ranges and date order.
COUNT_CODE, SIGN_CODE, RANGE_CODE, DATE_ORDER_CODE = 53400, 53500, 53600, 53700


def clean_name(table: str) -> str:
    return f"{table}_clean"


def raw_name(table: str) -> str:
    return f"{table}_raw"


def clean_all(raw: Mapping[str, DataFrame]) -> dict[str, DataFrame]:
    """Every raw table given, cleaned by its own spec."""
    return {name: clean(df, TABLES[name]) for name, df in raw.items()}


def existence_gate(spark: SparkSession, present: set[str]) -> DataFrame:
    """Are all nine clean tables there?"""
    expected = [(EXISTS_CODE + i, clean_name(t)) for i, t in enumerate(CHECK_ORDER)]
    return existence_checks(spark, expected, {clean_name(t) for t in present})


def domain_rules() -> dict[str, list[Rule]]:
    """Reported, never blocking: signs, score range and order of dates."""
    signs = {
        "order_items": ("price", "freight_value"),
        "payments": ("payment_value", "payment_installments"),
        "products": (
            "product_name_length",
            "product_description_length",
            "product_weight_g",
            "product_length_cm",
            "product_height_cm",
            "product_width_cm",
        ),
    }
    rules: dict[str, list[Rule]] = {}
    code = SIGN_CODE
    for table, columns in signs.items():
        for column in columns:
            rules.setdefault(table, []).append(
                Rule(code, f"negative {column} in {clean_name(table)}", negative(column), WARNING)
            )
            code += 1
    rules["reviews"] = [
        Rule(RANGE_CODE, "review_score outside 1..5 in reviews_clean", outside("review_score", 1, 5), WARNING)
    ]
    date_order = (
        ("order_approved_at", "order_purchase_timestamp"),
        ("order_delivered_carrier_date", "order_purchase_timestamp"),
        ("order_delivered_customer_date", "order_purchase_timestamp"),
        ("order_delivered_customer_date", "order_delivered_carrier_date"),
    )
    rules["orders"] = [
        Rule(DATE_ORDER_CODE + i, f"{later} before {first} in orders_clean", earlier(later, first), WARNING)
        for i, (later, first) in enumerate(date_order)
    ]
    return rules


def gate(
    clean_tables: Mapping[str, DataFrame], raw: Mapping[str, DataFrame] | None = None, dropped: Mapping[str, DataFrame] | None = None
) -> DataFrame:
    """All checks of the clean layer, one line each.

    Required columns and domain rules of a table share one pass, the keys of all tables another.
    With ``raw`` the row counts of both layers are compared too, less the rows in ``dropped``.
    """
    domain = domain_rules()
    results, uniques = [], []
    for i, name in enumerate(CHECK_ORDER):
        if name not in clean_tables:
            continue
        spec, df = TABLES[name], clean_tables[name]
        not_null = Rule(
            NOT_NULL_CODE + i, f"NULL in required columns of {clean_name(name)}", any_null(*spec.required)
        )
        results.append(row_checks(df, [not_null, *domain.get(name, [])]))
        uniques.append(Unique(UNIQUE_CODE + i, f"duplicate key ({', '.join(spec.key)}) in {clean_name(name)}", name, tuple(spec.key)))
        if raw and name in raw:
            message = f"rows of {raw_name(name)} missing from {clean_name(name)}"
            results.append(count_check(COUNT_CODE + i, message, raw[name], df, (dropped or {}).get(name)))
    references = [
        Reference(ORPHAN_CODE + i, f"{clean_name(child)} rows without {clean_name(parent)} ({key})", child, key, parent, key)
        for i, (child, parent, key) in enumerate(RELATIONS)
        if child in clean_tables and parent in clean_tables
    ]
    return run_checks([*results, key_checks(clean_tables, uniques, references)])
