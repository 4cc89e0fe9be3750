"""Facts with the attributes that held when they happened."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame

from tierstar.operators.asof import as_of
from tierstar.operators.clean import require


def lines_with_customer_version(items: DataFrame, orders: DataFrame, history: DataFrame, columns: Sequence[str]) -> DataFrame:
    """Every line of a known order with ``columns`` of the customer version valid at purchase, NULL before the first one.

    The version is looked up once per order; lines take it over with their order.
    """
    header = orders.select("order_id", "customer_id", "order_purchase_timestamp")
    dated = as_of(header, history, "customer_id", "order_purchase_timestamp", columns)
    return require(items, "order_id").select("order_id", "order_item_id").join(dated, "order_id")
