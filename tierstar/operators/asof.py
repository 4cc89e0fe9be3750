"""Point-in-time lookup: each row gets the version of its key that was valid at the row's time."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from tierstar.operators.aggregates import union_all


def as_of(rows: DataFrame, versions: DataFrame, key: str, time: str, columns: Sequence[str], start: str = "valid_from", end: str = "valid_to", slice: str = "month") -> DataFrame:
    """``rows`` with ``columns`` of the version of ``key`` valid at ``time`` (from ``start`` on, before ``end``); NULL where there is none.

    ``versions`` is unique on (key, start). Rows and versions are one sorted stream per key, and the last version
    seen is carried on by a window, so there is no range join and a row never meets more than one version. A key is cut into
    time slices that are sorted apart from each other, so that a key with very many rows is spread over tasks: the version
    that holds when a slice begins is looked up among one row per key and slice. Rows without a key or time get NULL.
    """
    def part(t: str):
        return F.date_trunc(slice, F.col(t)).cast("timestamp_ntz")

    kept = F.struct(F.col(start).alias("_start"), F.col(end).alias("_end"), *columns)
    offered = versions.filter(F.col(key).isNotNull() & F.col(start).isNotNull())
    offered = offered.select(F.col(key).alias("_key"), F.col(start).cast("timestamp_ntz").alias("_time"), part(start).alias("_part"), kept.alias("_version"))
    asked = rows.select(F.col(key).alias("_key"), F.col(time).cast("timestamp_ntz").alias("_time"), part(time).alias("_part"), F.struct(*rows.columns).alias("_row"))
    known = F.col("_key").isNotNull() & F.col("_time").isNotNull()

    # The last version of each slice, and from these the one that each slice with rows begins with.
    ends = offered.groupBy("_key", "_part").agg(F.max_by("_version", "_time").alias("_version"))
    used = asked.filter(known).select("_key", "_part").distinct()
    places = union_all([ends.withColumn("_asks", F.lit(0)), used.withColumns({"_version": F.lit(None).cast(ends.schema["_version"].dataType), "_asks": F.lit(1)}).select(*ends.columns, "_asks")])
    # Slices as numbers, so that the frame can end before the slice itself.
    numbered = places.withColumn("_at", F.unix_date(F.col("_part").cast("date")).cast("long") * 24 + F.hour("_part"))
    before = Window.partitionBy("_key").orderBy("_at").rangeBetween(Window.unboundedPreceding, -1)
    carried = numbered.withColumn("_held", F.last("_version", ignorenulls=True).over(before)).filter((F.col("_asks") == 1) & F.col("_held").isNotNull())
    seeds = carried.select("_key", F.col("_part").alias("_time"), "_part", F.col("_held").alias("_version"), F.lit(0).alias("_order"))

    no_row, no_version = F.lit(None).cast(asked.schema["_row"].dataType), F.lit(None).cast(offered.schema["_version"].dataType)
    stream = union_all(
        [
            seeds.withColumn("_row", no_row),
            offered.withColumns({"_order": F.lit(1), "_row": no_row}).select("_key", "_time", "_part", "_version", "_order", "_row"),
            asked.filter(known).withColumns({"_version": no_version, "_order": F.lit(2)}).select("_key", "_time", "_part", "_version", "_order", "_row"),
        ]
    )
    so_far = Window.partitionBy("_key", "_part").orderBy("_time", "_order").rowsBetween(Window.unboundedPreceding, Window.currentRow)
    met = stream.withColumn("_last", F.last("_version", ignorenulls=True).over(so_far)).filter(F.col("_row").isNotNull())
    holds = F.col("_last._end").isNull() | (F.col("_time") < F.col("_last._end"))
    found = met.select("_row.*", *[F.when(holds, F.col(f"_last.{c}")).alias(c) for c in columns])
    lost = asked.filter(~F.coalesce(known, F.lit(False))).select("_row.*", *[F.lit(None).cast(versions.schema[c].dataType).alias(c) for c in columns])
    return union_all([found, lost])
