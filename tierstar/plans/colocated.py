"""Order tables stored in buckets of the order, and the fact built from them without a shuffle on the order."""

from __future__ import annotations

from collections.abc import Mapping

from pyspark.sql import DataFrame

from tierstar.plans import gold, silver
from tierstar.sources.buckets import Bucketed, read_buckets, stage_buckets
from tierstar.sources.store import LayerStore, RunInfo

LAYER = "silver_by_order"
ORDER_TABLES = ("order_items", "orders", "payments", "reviews")


def load_by_order(store: LayerStore, run: RunInfo, clean: Mapping[str, DataFrame], buckets: int, rows_per_order: int = 1_000_000) -> dict[str, Bucketed]:
    """Store and publish the clean order tables in buckets of ``order_id``."""
    tables = {silver.clean_name(name): clean[name] for name in ORDER_TABLES}
    store.publish(run, LAYER, stage_buckets(store, run, LAYER, tables, "order_id", buckets, rows_per_order))
    return read_by_order(store)


def read_by_order(store: LayerStore) -> dict[str, Bucketed]:
    tables = read_buckets(store, LAYER, "order_id")
    return {name: tables[silver.clean_name(name)] for name in ORDER_TABLES}


def build_fact(by_order: Mapping[str, Bucketed], star: Mapping[str, DataFrame], rows_per_split: int = 1_000_000) -> DataFrame:
    """What ``gold.build_fact`` gives, from bucketed order tables.

    Lines, orders, payments and reviews meet inside their bucket; only the dimensions are joined by a shuffle, if they are too large
    to be broadcast. Orders kept beside the buckets go the usual way, where lines of one order are split over tasks.
    """
    dimensions = [star[d] for d in ("dim_customers", "dim_products", "dim_sellers")]
    light = gold.build_fact(*[by_order[name].light for name in ORDER_TABLES], *dimensions, rows_per_split=None)
    beside = gold.build_fact(*[by_order[name].beside for name in ORDER_TABLES], *dimensions, rows_per_split=rows_per_split)
    return light.unionByName(beside)
