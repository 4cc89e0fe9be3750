"""Stored KPIs kept up to date from the lines that changed, without a scan of the fact."""

from __future__ import annotations

from collections.abc import Mapping, Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tierstar.operators import partials
from tierstar.operators.partials import SUM, Measures, State
from tierstar.sources.store import LayerStore, RunInfo, Staged

CUSTOMER = Measures("customer_key", ("total_amount", "review_score"), "order_id")
PRODUCT = Measures("product_key", ("quantity", "total_amount", "review_score"))
#: The layer that holds the states, beside the KPI tables that the star shows.
LAYER = "kpis"
KPIS = {"kpi_customer_metrics": CUSTOMER, "kpi_product_metrics": PRODUCT}


def _sales() -> list[Column]:
    return [
        F.col(SUM + "total_amount").cast("decimal(20,2)").alias("gross_sales_amount"),
        partials.average("total_amount", "decimal(16,6)").alias("avg_order_line_amount"),
        partials.average("review_score", "decimal(9,6)").alias("avg_review_score"),
    ]


def customer_kpis(totals: DataFrame, dim_customers: DataFrame) -> DataFrame:
    """What ``views.customer_metrics`` gives, from the state."""
    names = ["customer_id", "customer_unique_id", "customer_city", "customer_state"]
    joined = totals.join(dim_customers.select("customer_key", *names), "customer_key")
    return joined.select(*names, F.col("members").alias("order_count"), F.col("lines").alias("order_line_count"), *_sales())


def product_kpis(totals: DataFrame, dim_products: DataFrame) -> DataFrame:
    """What ``views.product_metrics`` gives, from the state."""
    names = ["product_id", "product_category_name", "product_category_name_english"]
    joined = totals.join(dim_products.select("product_key", *names), "product_key")
    units = F.col(SUM + "quantity").cast("long").alias("units_sold")
    return joined.select(*names, F.col("lines").alias("order_line_count"), units, *_sales())


def kpi_table(name: str, totals: DataFrame, star: Mapping[str, DataFrame]) -> DataFrame:
    if name == "kpi_customer_metrics":
        return customer_kpis(totals, star["dim_customers"])
    return product_kpis(totals, star["dim_products"])


def lines_of(fact: DataFrame, orders: DataFrame) -> DataFrame:
    """The lines of some orders (a table of order_id)."""
    return fact.join(orders.select("order_id").distinct(), "order_id", "left_semi")


def _stage(store: LayerStore, run: RunInfo, name: str, state: State, star: Mapping[str, DataFrame]) -> list[Staged]:
    """The state's tables and the KPI table made of them, each written once."""
    totals = store.stage(run, LAYER, f"{name}_totals", state.totals)
    staged = [totals, store.stage(run, LAYER, name, kpi_table(name, totals.df, star))]
    if state.members is not None:
        staged.append(store.stage(run, LAYER, f"{name}_members", state.members))
    return staged


def stage_kpis(store: LayerStore, run: RunInfo, star: Mapping[str, DataFrame]) -> list[Staged]:
    """States and KPIs of a whole fact, for a first or a full run."""
    return [t for name, kept in KPIS.items() for t in _stage(store, run, name, partials.start(star["fact_orders"], kept), star)]


def refresh_kpis(store: LayerStore, run: RunInfo, gone: DataFrame, came: DataFrame, replaced: Sequence[Staged] = ()) -> None:
    """Publish the KPIs after some lines of the fact went and some came, together with the tables of the star that the run ``replaced``.

    The states of the last run are advanced by the changed lines; the fact is not read. All other tables of the star are carried over, and states,
    KPIs and star appear together, so a run that fails changes nothing.
    """
    seen = store.head()
    star, states = store.read("gold") | {t.name: t.df for t in replaced}, store.read(LAYER)
    staged = []
    for name, kept in KPIS.items():
        keep = lambda part, df, name=name: store.stage(run, "scratch", f"{name}_{part}", df).df
        state = partials.advance(State(states[f"{name}_totals"], states.get(f"{name}_members")), gone, came, kept, keep)
        staged += _stage(store, run, name, state, star)
    fresh = [*replaced, *[t for t in staged if t.name in KPIS]]
    store.publish_layers(run, {LAYER: staged, "gold": [*fresh, *store.carried("gold", [t.name for t in fresh])]}, after=seen)
