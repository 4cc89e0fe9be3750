"""Names that a run leaves in the catalog: its tables and the views over its star, for sessions that know no store."""

from __future__ import annotations

from pyspark.sql import SparkSession

from tierstar.plans import kpis, views
from tierstar.sources import catalog
from tierstar.sources.store import LayerStore


def star_views(store: LayerStore, prefix: str = "") -> dict[str, str]:
    """The queries of the persistent views. They read catalog names only, so a later run changes what they show by moving these."""
    gold = f"{prefix}gold"
    columns = ", ".join(views.order_line_metrics(store.read("gold")).columns)
    dates = f"SELECT date_key AS order_date_key, full_date AS order_date, year AS order_year, month AS order_month, month_name FROM {gold}.dim_date"
    keyed = " ".join(f"JOIN {gold}.{table} USING ({key})" for table, key in (("dim_customers", "customer_key"), ("dim_products", "product_key"), ("dim_sellers", "seller_key")))
    found = {f"{gold}.vw_order_line_metrics": f"SELECT {columns} FROM {gold}.fact_orders JOIN ({dates}) USING (order_date_key) {keyed}"}
    # KPIs are stored; their views give them the names that reports use.
    return found | {f"{gold}.{name.replace('kpi_', 'vw_')}": f"SELECT * FROM {gold}.{name}" for name in kpis.KPIS}


def register_run(spark: SparkSession, store: LayerStore, prefix: str = "") -> list[str]:
    """Point all names of the catalog at what ``store`` has published, views included; returns the views' names.

    A catalog changes one name at a time: a session that reads while names move may join tables of two runs. Jobs that must not, read the store.
    """
    catalog.ensure_layers(spark, prefix, store.root)
    for layer in catalog.LAYERS:
        catalog.register_layer(spark, store, layer, prefix)
    found = star_views(store, prefix)
    catalog.register_sql_views(spark, found)
    return list(found)
