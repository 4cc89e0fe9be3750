"""Incremental loads: only what arrived since the last run is read."""

from __future__ import annotations

from collections.abc import Sequence
from datetime import datetime

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from tierstar.operators.aggregates import union_all
from tierstar.operators.dedup import first_per_key
from tierstar.schemas import CORRUPT, TableSpec
from tierstar.sources.delimited import _options


def append_new_files(spark: SparkSession, folder: str, spec: TableSpec, target: str, checkpoint: str) -> None:
    """Add the files that are new in ``folder`` to the raw table at ``target`` and return.

    The stream's checkpoint remembers which files were taken in, so a file is loaded exactly once,
    also when a run fails half-way and is started again.
    """
    schema = T.StructType([*spec.raw_schema().fields, T.StructField(CORRUPT, T.StringType())])
    options = _options(spec.separator, False, False) | {"enforceSchema": "false"}  # a file with another header fails
    arriving = spark.readStream.schema(schema).options(**options).csv(folder)
    (
        arriving.writeStream.format("parquet")
        .option("path", target)
        .option("checkpointLocation", checkpoint)
        .trigger(availableNow=True)
        .start()
        .awaitTermination()
    )


def newer_than(df: DataFrame, time: str, watermark: datetime | None) -> DataFrame:
    """Rows at or after the high-water mark of the previous load; all rows on the first load.

    A row may still arrive with the very time of the mark; those there already do no harm to ``upsert``.
    """
    return df if watermark is None else df.filter(F.col(time) >= F.lit(watermark).cast("timestamp_ntz"))


def high_water_mark(df: DataFrame, time: str) -> datetime | None:
    return df.agg(F.max(time).alias("mark")).first().mark


def upsert(
    existing: DataFrame, arrived: DataFrame, keys: Sequence[str], order: Sequence[Column], existing_unique: bool = False
) -> DataFrame:
    """Existing and new rows with one row per key: the first under ``order``; on a tie the new one.

    Where ``existing`` is known to hold one row per key and no NULL key, say so: then only its rows
    whose key arrives again are ranked, and all others pass through, without a shuffle as long as
    the arrived keys are few enough for Spark to broadcast them.
    """
    columns = existing.columns
    untouched = []
    if existing_unique:
        touched = arrived.select(*keys).distinct()
        untouched = [existing.join(touched, list(keys), "left_anti").select(*columns)]
        existing = existing.join(touched, list(keys), "left_semi").select(*columns)
    rivals = union_all([existing.withColumn("_age", F.lit(1)), arrived.withColumn("_age", F.lit(0))])
    ties = [F.col("_age"), *[F.col(c) for c in columns if c not in keys]]
    return union_all([*untouched, first_per_key(rivals, keys, order, ties).drop("_age")])
