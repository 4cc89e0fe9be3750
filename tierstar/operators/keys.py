"""Surrogate keys and their resolution."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from tierstar.functions import date_key


def key_bucket(by: Sequence[str], digits: int = 3) -> Column:
    """First hex digits of a digest of the business key: evenly filled, and the same on every run."""
    return F.left(F.md5(F.concat_ws("|", *[F.col(c).cast("string") for c in by])), F.lit(digits))


def dense_key(df: DataFrame, by: Sequence[str], name: str, digits: int = 3) -> DataFrame:
    """Number the rows 1..n without gaps; ``by`` must be unique.

    Rows are numbered inside ``16 ** digits`` buckets in parallel, each bucket starting after the
    rows of the buckets before it. The start travels as one extra row at the head of its bucket, so
    a running sum yields the number and nothing is broadcast. The bucket comes from the key alone:
    nothing is sampled or checkpointed, and a lost executor recomputes the very same numbers. Only
    the bucket sizes, at most ``16 ** digits`` rows whatever the data size, meet in one task.
    """
    bucketed = df.withColumns({"_bucket": key_bucket(by, digits), "_step": F.lit(1).cast("long")})
    before = Window.orderBy("_bucket").rowsBetween(Window.unboundedPreceding, -1)
    starts = (
        bucketed.groupBy("_bucket")
        .agg(F.sum("_step").alias("_rows"))
        .select("_bucket", F.coalesce(F.sum("_rows").over(before), F.lit(0)).alias("_step"), F.lit(1).alias("_head"))
    )
    numbering = Window.partitionBy("_bucket").orderBy(F.col("_head").desc_nulls_last(), *by)
    return (
        bucketed.unionByName(starts, allowMissingColumns=True)
        .withColumn(name, F.sum("_step").over(numbering.rowsBetween(Window.unboundedPreceding, 0)))
        .filter(F.col("_head").isNull())
        .select(name, *df.columns)
    )


def position_key(written: DataFrame, name: str) -> DataFrame:
    """Number the rows of a written Parquet table 1..n by file and position in it.

    Use it on a table that will not be rewritten. File names come from the rows themselves. The table of where
    each file starts has one row per file, a few hundred bytes, and is sent to every task: joined by a shuffle, the rows of a
    file would meet in one task, which would sort them all.
    """
    placed = written.select("*", F.col("_metadata.file_path").alias("_file"), F.col("_metadata.row_index").alias("_row"))
    before = Window.orderBy("_file").rowsBetween(Window.unboundedPreceding, -1)
    starts = (
        placed.groupBy("_file")
        .agg(F.count(F.lit(1)).alias("_rows"))
        .select("_file", F.coalesce(F.sum("_rows").over(before), F.lit(0)).alias("_start"))
    )
    return placed.join(F.broadcast(starts), "_file").select((F.col("_start") + F.col("_row") + 1).cast("long").alias(name), *written.columns)


def key_range(keyed: DataFrame, name: str) -> DataFrame:
    """One row: row_count, first_key, last_key and key_count, the number of different keys, of whole-number keys.

    Different keys are counted as bits of 64-bit words, one group per word: of dense keys a task holds a group for 64 rows, not for each.
    """
    key = F.col(name).cast("long")
    bit = F.expr(f"shiftleft(1L, cast(pmod(`{name}`, 64) as int))")
    words = keyed.groupBy(F.shiftright(key, 6).alias("_word")).agg(F.count(F.lit(1)).alias("n"), F.min(name).alias("low"), F.max(name).alias("high"), F.bit_or(bit).alias("bits"))
    count = lambda c: F.coalesce(F.sum(c), F.lit(0)).cast("long")
    return words.agg(count("n").alias("row_count"), F.min("low").alias("first_key"), F.max("high").alias("last_key"), count(F.bit_count("bits")).alias("key_count"))


def resolve_key(rows: DataFrame, dimension: DataFrame, business_key: str, surrogate_key: str, how: str = "inner") -> DataFrame:
    """Add the dimension's surrogate key; with ``inner``, rows of an unknown business key leave.

    No broadcast hint: dimensions grow with the data. Spark broadcasts the two-column side when its
    size is under the session's limit, and otherwise runs a shuffled join whose hot keys adaptive
    execution splits (both inputs come straight from a shuffle).
    """
    return rows.join(dimension.select(business_key, surrogate_key), business_key, how)


def resolve_date(rows: DataFrame, dates: DataFrame, time: str, role: str, how: str = "left") -> DataFrame:
    """Add ``role``, the calendar key of the day of ``time``, by joining the calendar table."""
    calendar = dates.select(F.col("full_date").alias(f"_{role}_day"), F.col("date_key").alias(role))
    return rows.join(calendar, F.col(time).cast("date") == F.col(f"_{role}_day"), how).drop(f"_{role}_day")


def derive_date(rows: DataFrame, time: str, role: str, how: str = "left") -> DataFrame:
    """Same result as ``resolve_date`` on a calendar that holds every day in use, without a join."""
    keyed = rows.withColumn(role, date_key(F.col(time)))
    return keyed.filter(F.col(role).isNotNull()) if how == "inner" else keyed
