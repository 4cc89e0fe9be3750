"""Dimension history: keep old attribute values with the time span in which they held."""

from __future__ import annotations

from collections.abc import Sequence
from datetime import datetime

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from tierstar.operators.aggregates import union_all
from tierstar.operators.dedup import first_per_key


def start_history(snapshot: DataFrame, at: datetime) -> DataFrame:
    """Every row of a first snapshot, valid from ``at`` on."""
    return snapshot.select(
        "*",
        F.lit(at).cast("timestamp_ntz").alias("valid_from"),
        F.lit(None).cast("timestamp_ntz").alias("valid_to"),
        F.lit(1).alias("is_current"),
    )


def merge_history(history: DataFrame, snapshot: DataFrame, key: str, attributes: Sequence[str], at: datetime) -> DataFrame:
    """Bring a history up to a new full snapshot, unique on ``key``.

    Rows whose attributes changed, or whose key vanished, are closed at ``at``; changed and new
    keys open a row. Only current rows take part in the one join; closed rows pass through unmoved.
    """
    closed = history.filter(F.col("is_current") == 0)
    current = history.filter(F.col("is_current") == 1)
    now = F.lit(at).cast("timestamp_ntz")

    # Both sides carry their attributes as one struct, which compares field by field, NULL like any value.
    fresh = snapshot.select(F.col(key).alias("_key"), F.struct(*attributes).alias("_new"))
    known = current.select(F.col(key).alias("_id"), F.struct(*attributes).alias("_old"), "valid_from", "valid_to")
    paired = known.join(fresh, F.col("_id") == F.col("_key"), "full_outer")
    same = F.col("_old").isNotNull() & F.col("_new").isNotNull() & F.col("_old").eqNullSafe(F.col("_new"))

    def row(values: str, start: Column, end: Column, is_current: Column) -> Column:
        fields = [F.col(values)[a].alias(a) for a in attributes]
        return F.struct(F.coalesce("_id", "_key").alias(key), *fields, start.alias("valid_from"), end.alias("valid_to"), is_current.alias("is_current"))

    carried = row("_old", F.col("valid_from"), F.when(same, F.col("valid_to")).otherwise(now), F.when(same, 1).otherwise(0))
    opened = row("_new", now, F.lit(None).cast("timestamp_ntz"), F.lit(1))
    each = F.array_compact(F.array(F.when(F.col("_old").isNotNull(), carried), F.when(F.col("_new").isNotNull() & ~same, opened)))
    return union_all([closed.select(key, *attributes, "valid_from", "valid_to", "is_current"), paired.select(F.inline(each))])


def merge_points(points: DataFrame | None, changes: DataFrame, key: str, recorded: str = "recorded") -> DataFrame:
    """Change points, one per key and ``valid_from``: of several for one moment the one recorded last holds, in whatever order they arrive.

    A point has the key, ``valid_from``, the attributes, ``is_present`` (0 where the key vanished then) and ``recorded``. Points are kept although
    the history merges equal neighbours: a change that comes in between later needs them.
    """
    both = changes if points is None else union_all([points, changes.select(*points.columns)])
    return first_per_key(both, [key, "valid_from"], [F.col(recorded).desc_nulls_last(), F.col("is_present")])


def timeline(points: DataFrame, key: str, attributes: Sequence[str]) -> DataFrame:
    """The history that change points give: equal neighbours are one row, and each row ends where the next point begins."""
    along = Window.partitionBy(key).orderBy("valid_from")
    values = F.struct("is_present", *[F.when(F.col("is_present") == 1, F.col(a)).alias(a) for a in attributes])
    marked = points.withColumn("_value", values).withColumn("_before", F.lag("_value").over(along))
    steps = marked.filter(F.col("_before").isNull() | ~F.col("_value").eqNullSafe(F.col("_before")))
    ended = steps.withColumn("valid_to", F.lead("valid_from").over(along)).filter(F.col("is_present") == 1)
    return ended.select(key, *attributes, "valid_from", "valid_to", F.col("valid_to").isNull().cast("int").alias("is_current"))


def apply_changes(history: DataFrame | None, points: DataFrame | None, changes: DataFrame, key: str, attributes: Sequence[str]) -> tuple[DataFrame, DataFrame]:
    """History and points after changes that may lie before changes known already.

    Only the points of keys that change are merged and laid out anew; all other rows of both tables pass through. The result is
    that of all changes at once, whatever their order of arrival and however often one arrives.
    """
    if history is None or points is None:
        first = merge_points(None, changes, key)
        return timeline(first, key, attributes), first
    touched = changes.select(key).distinct()
    moved = merge_points(points.join(touched, key, "left_semi").select(*points.columns), changes, key)
    still = points.join(touched, key, "left_anti").select(*points.columns)
    rest = history.join(touched, key, "left_anti").select(*history.columns)
    return union_all([rest, timeline(moved, key, attributes).select(*history.columns)]), union_all([still, moved])
