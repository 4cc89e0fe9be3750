"""Joins that stay whole and balanced when one key holds a large share of the rows."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame
from pyspark.sql import functions as F


def enrich(rows: DataFrame, lookup: DataFrame, on: str) -> DataFrame:
    """Left join: every row stays, columns of a missing match are NULL."""
    return rows.join(lookup, on, "left")


def heavy_keys(counts: DataFrame, key: str, rows: str, rows_per_split: int = 1_000_000) -> DataFrame:
    """Keys that one task should not hold alone, each with the number of parts to split it into.

    Every key above ``rows_per_split`` is listed, whatever its share of the table.
    """
    return counts.filter(F.col(rows) > rows_per_split).select(key, F.ceil(F.col(rows) / rows_per_split).cast("int").alias("_parts"))


def split_join(
    rows: DataFrame,
    lookup: DataFrame,
    key: str,
    heavy: DataFrame,
    spread: Sequence[str],
    how: str = "inner",
) -> DataFrame:
    """Join many rows to a lookup that is unique on ``key``, splitting the keys listed in ``heavy``.

    Rows of a heavy key are spread over its parts by a hash of ``spread``; the single lookup row of
    that key is repeated once per part. All other keys have one part and are joined as usual. The
    list is not broadcast by force: it grows with the data, and Spark knows its size when it runs.
    """
    parts = F.coalesce(F.col("_parts"), F.lit(1))
    spread_rows = (
        rows.join(heavy, key, "left")
        .withColumn("_part", F.when(parts == 1, 0).otherwise(F.pmod(F.xxhash64(*spread), parts)).cast("int"))
        .drop("_parts")
    )
    repeated = (
        lookup.join(heavy, key, "left")
        .withColumn("_part", F.explode(F.sequence(F.lit(0), parts - 1)))
        .drop("_parts")
    )
    return spread_rows.join(repeated, [key, "_part"], how).drop("_part")


def orphans(child: DataFrame, parent: DataFrame, child_key: str, parent_key: str | None = None) -> DataFrame:
    """Child keys without a parent, with the number of child rows that carry them.

    A NULL child key has no parent. Children are counted per key before the join, so the join never
    moves more than one row per key and map task.
    """
    parent_key = parent_key or child_key
    used = child.groupBy(F.col(child_key).alias("key")).agg(F.count(F.lit(1)).alias("row_count"))
    known = parent.select(F.col(parent_key).alias("key"))
    return used.join(known, "key", "left_anti")
