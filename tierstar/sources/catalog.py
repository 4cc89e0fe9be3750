"""Names in the Spark catalog for layers, tables and views."""

from __future__ import annotations

from collections.abc import Mapping

from pyspark.sql import DataFrame, SparkSession

from tierstar.sources.store import LayerStore

LAYERS = ("bronze", "silver", "gold")


def ensure_layers(spark: SparkSession, prefix: str = "", root: str | None = None) -> None:
    """One schema per layer; may be run again at any time. With ``root``, new schemas lie beside the store there."""
    for layer in LAYERS:
        place = f" LOCATION '{root}/catalog/{prefix}{layer}'" if root else ""
        spark.sql(f"CREATE SCHEMA IF NOT EXISTS {prefix}{layer}{place}")


def table_exists(spark: SparkSession, name: str) -> bool:
    return spark.catalog.tableExists(name)


def register_layer(spark: SparkSession, store: LayerStore, layer: str, prefix: str = "") -> None:
    """Point the catalog names of a layer at the files of its latest published run.

    Columns and types are those of the manifest, whatever Spark would infer from partition folders; a table without rows may have no files.
    """
    tables = store.read(layer)
    counts = store.row_counts(layer)
    for name, path in store.current(layer).items():
        kind = {f.name: f.dataType.simpleString() for f in tables[name].schema}
        if counts[name]:
            rows = ", ".join(f"CAST(`{c}` AS {t}) AS `{c}`" for c, t in kind.items()) + f" FROM parquet.`{path}`"
        else:
            rows = ", ".join(f"CAST(NULL AS {t}) AS `{c}`" for c, t in kind.items()) + " WHERE FALSE"
        spark.sql(f"CREATE OR REPLACE VIEW {prefix}{layer}.`{name}` AS SELECT {rows}")


def register_sql_views(spark: SparkSession, views: Mapping[str, str]) -> None:
    """Views of the catalog, by name and query: every session that shares the catalog finds them."""
    for name, query in views.items():
        spark.sql(f"CREATE OR REPLACE VIEW {name} AS {query}")


def register_views(views: Mapping[str, DataFrame]) -> None:
    """Create or replace session views; they hold the query, not its rows."""
    for name, df in views.items():
        df.createOrReplaceTempView(name)
