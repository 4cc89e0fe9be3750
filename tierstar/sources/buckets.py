"""Tables stored in buckets of one key, so that joins and aggregates by that key need no shuffle.

A bucket is read by one task. Rows whose key is very frequent in any of the tables that are stored together, or NULL,
would make one bucket large; they are kept beside the buckets, evenly spread, for all of these tables alike. A job
over such tables runs once on the buckets, without a shuffle on the key, and once on the few keys beside them.

The manifest's schema of a table says how many buckets it has, so any session can open it.
"""

from __future__ import annotations

import hashlib
from collections.abc import Mapping
from dataclasses import dataclass

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tierstar.operators.aggregates import union_all
from tierstar.sources.store import LayerStore, RunInfo, Staged

#: Up to so many frequent keys a table is read once more for the rows beside its buckets instead of being stored marked.
FEW_FREQUENT = 100_000
#: Ending of the name of the table that holds the rows kept beside the buckets.
BESIDE = "_beside"
BUCKETS = "buckets"


@dataclass(frozen=True)
class Bucketed:
    """One table: the rows in buckets and the rows beside them."""

    light: DataFrame
    beside: DataFrame


def _catalog_name(path: str) -> str:
    return f"bucketed_{hashlib.md5(path.encode()).hexdigest()}"


def frequent_keys(tables: Mapping[str, DataFrame], key: str, rows_per_key: int) -> DataFrame:
    """Keys with more than ``rows_per_key`` rows in any of the tables; counted before rows are shuffled."""
    counts = [df.groupBy(key).agg(F.count(F.lit(1)).alias("n")).filter(F.col("n") > rows_per_key).select(key) for df in tables.values()]
    return union_all(counts).filter(F.col(key).isNotNull()).distinct()


def stage_buckets(
    store: LayerStore, run: RunInfo, layer: str, tables: Mapping[str, DataFrame], key: str, buckets: int, rows_per_key: int = 1_000_000
) -> list[Staged]:
    """Write tables of one key that are to be joined on it: each in ``buckets`` files, and its frequent keys beside them.

    Choose ``buckets`` so that a bucket of the largest table fits a task (some 128 MB); all tables must have the same number.
    Beyond a few frequent keys, which are joined by a shuffle, rows are marked by one join, stored, and parted from there.
    """
    frequent = store.stage(run, "scratch", f"{layer}_frequent_{key}", frequent_keys(tables, key, rows_per_key))
    marks = frequent.df.withColumn("_frequent", F.lit(True))
    staged = []
    for name, df in tables.items():
        marked = df.filter(F.col(key).isNotNull()).join(marks, key, "left")
        if frequent.row_count > FEW_FREQUENT:
            marked = store.stage(run, "scratch", f"{layer}_{name}_marked", marked).df
        light = marked.filter(F.col("_frequent").isNull())
        columns = [F.col(c).alias(c, metadata={BUCKETS: buckets}) if c == key else F.col(c) for c in df.columns]
        path = f"{store.root}/{layer}/runs/{run.run_id}/{name}"
        # Dealt as the buckets are, so that every bucket is one file.
        writer = light.select(*columns).repartition(buckets, key).write.format("parquet").bucketBy(buckets, key)
        writer.option("path", path).saveAsTable(_catalog_name(path))
        written = store.spark.table(_catalog_name(path))
        staged.append(Staged(name, path, written.count(), written))
        beside = marked.filter("_frequent").select(*df.columns).unionByName(df.filter(F.col(key).isNull()))
        staged.append(store.stage(run, layer, name + BESIDE, beside))
    return staged


def read_buckets(store: LayerStore, layer: str, key: str) -> dict[str, Bucketed]:
    """The published bucketed tables of a layer, opened so that Spark knows their buckets."""
    tables, paths, found = store.read(layer), store.current(layer), {}
    for name, df in tables.items():
        if name.endswith(BESIDE) or key not in df.columns or BUCKETS not in df.schema[key].metadata:
            continue
        known, spark = _catalog_name(paths[name]), store.spark
        if not spark.catalog.tableExists(known):
            columns = ", ".join(f"`{f.name}` {f.dataType.simpleString()}" for f in df.schema)
            spark.sql(f"CREATE TABLE {known} ({columns}) USING parquet CLUSTERED BY (`{key}`) INTO {df.schema[key].metadata[BUCKETS]} BUCKETS LOCATION '{paths[name]}'")
        found[name] = Bucketed(spark.table(known), tables[name + BESIDE])
    return found
