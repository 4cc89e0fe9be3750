"""The whole run: files to raw tables, clean tables, gate, star, gate, views."""

from __future__ import annotations

from collections.abc import Mapping

from pyspark.sql import DataFrame, SparkSession

from tierstar.operators.aggregates import row_counts
from tierstar.operators.clean import left_out
from tierstar.operators.keys import position_key
from tierstar.operators.quality import enforce
from tierstar.plans import gold, kpis, published, silver
from tierstar.schemas import STAR, TABLES, conform
from tierstar.sources.delimited import accepted, read_raw
from tierstar.sources.store import LayerStore, RunInfo


def load_bronze(store: LayerStore, run: RunInfo, sources: Mapping[str, DataFrame]) -> dict[str, DataFrame]:
    """Store the raw tables as read, rejected lines included and marked, in one pass over each file."""
    staged = [store.stage(run, "bronze", silver.raw_name(name), df) for name, df in sources.items()]
    store.publish(run, "bronze", staged)
    return {name: t.df for name, t in zip(sources, staged)}


def bronze_counts(raw: Mapping[str, DataFrame]) -> DataFrame:
    """Rows per raw table, for reading by eye."""
    return row_counts(raw)


def load_silver(store: LayerStore, run: RunInfo, raw: Mapping[str, DataFrame]) -> dict[str, DataFrame]:
    """Clean every raw table, check the result as stored, and publish only if no critical check failed.

    Whether all raw tables are there is asked of what the store has published, before any is cleaned.
    """
    loaded = set(store.current("bronze"))
    there = {name for name in TABLES if silver.raw_name(name) in loaded}
    enforce(store.append_audit(run, "silver", silver.existence_gate(store.spark, there)))
    usable = {name: accepted(df) if "_corrupt_record" in df.columns else df for name, df in raw.items()}
    cleaned = silver.clean_all(usable)
    staged = {name: store.stage(run, "silver", silver.clean_name(name), df) for name, df in cleaned.items()}
    tables = {name: t.df for name, t in staged.items()}
    enforce(store.append_audit(run, "silver", silver.gate(tables, usable, {name: left_out(df, TABLES[name]) for name, df in usable.items()})))
    store.publish(run, "silver", list(staged.values()))
    return tables


def load_gold(store: LayerStore, run: RunInfo, clean: Mapping[str, DataFrame]) -> dict[str, DataFrame]:
    """Build the star from stored clean tables, check it as stored, publish it, and store the KPI tables."""
    dimensions = gold.build_dimensions(clean)
    staged = {name: store.stage(run, "gold", name, df) for name, df in dimensions.items()}
    star = {name: t.df for name, t in staged.items()}

    fact_rows = gold.build_fact(
        clean["order_items"],
        clean["orders"],
        clean["payments"],
        clean["reviews"],
        star["dim_customers"],
        star["dim_products"],
        star["dim_sellers"],
    )
    # The fact's own key numbers stored rows, so rows are stored once without it; no shuffle follows.
    rows = store.stage(
        run, "gold", "fact_order_rows", fact_rows.withColumn("order_month_key", gold.order_month_key()), ["order_month_key"]
    )
    keyed = position_key(rows.df, "fact_order_key")
    staged["fact_orders"] = store.stage(run, "gold", "fact_orders", keyed, ["order_month_key"], rebalance=False)
    star["fact_orders"] = conform(staged["fact_orders"].df, STAR["fact_orders"])

    enforce(store.append_audit(run, "gold", gold.gate(star)))
    # The KPIs come from states that the next run can advance by the lines that change.
    states = kpis.stage_kpis(store, run, star)
    store.publish_layers(run, {"gold": [*staged.values(), *[t for t in states if t.name in kpis.KPIS]], kpis.LAYER: states})
    return star


def read_sources(spark: SparkSession, paths: Mapping[str, str], **options) -> dict[str, DataFrame]:
    """One raw table per given file or folder of files."""
    return {name: read_raw(spark, path, TABLES[name], **options) for name, path in paths.items()}


def run_all(spark: SparkSession, root: str, sources: Mapping[str, DataFrame], run: RunInfo | None = None, names: str | None = "") -> dict[str, DataFrame]:
    """From raw tables to the published star. Any failure leaves what was published before in force.

    At the end the catalog's names point at the new tables and views (``published.register_run``), with ``names`` before each schema's name; None leaves the catalog alone.
    """
    run, store = run or RunInfo(), LayerStore(spark, root)
    raw = load_bronze(store, run, sources)
    clean = load_silver(store, run, raw)
    star = load_gold(store, run, clean)
    if names is not None:
        published.register_run(spark, store, names)
    return star
