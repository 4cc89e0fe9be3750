"""Keep one row per key."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F


def first_per_key(
    df: DataFrame,
    keys: Sequence[str],
    order: Sequence[Column],
    ties: Sequence[Column] | None = None,
) -> DataFrame:
    """The first row of every key under ``order``; ``ties`` make the choice reproducible.

    ``rank = 1`` straight above the window lets Spark limit each map task to one row per key
    before the shuffle, so the reducer of a hot key receives as many rows as there are map tasks.
    """
    if ties is None:
        ties = [F.col(c) for c in df.columns if c not in keys]
    ranking = Window.partitionBy(*keys).orderBy(*order, *ties)
    return df.withColumn("_rank", F.row_number().over(ranking)).filter(F.col("_rank") == 1).drop("_rank")


def latest_per_key(df: DataFrame, keys: Sequence[str], *times: str) -> DataFrame:
    """The row with the latest ``times`` of every key; missing times lose."""
    return first_per_key(df, keys, [F.col(t).desc_nulls_last() for t in times])
