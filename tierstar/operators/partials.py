"""Partial aggregates that can be kept up to date: sums and counts per key, merged by adding what came and taking off what went.

A state has two tables. ``totals`` holds for every key its rows (``lines``) and for every measure the sum and the
number of values. ``members`` holds for every key the different members (say, orders) it has rows of, with their
number, so that a distinct count can go down as well as up. Both are keyed by values, not by positions, so a
state may be stored, read back and advanced by any later run.
"""

from __future__ import annotations

from collections.abc import Callable, Sequence
from dataclasses import dataclass

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tierstar.operators.aggregates import union_all

SUM, NUMBER = "sum_", "n_"


@dataclass(frozen=True)
class Measures:
    """What is kept per key: sums of ``sums`` (decimals or whole numbers) and the number of different ``member``."""

    key: str
    sums: tuple[str, ...]
    member: str | None = None


@dataclass(frozen=True)
class State:
    totals: DataFrame
    members: DataFrame | None


def signed(gone: DataFrame, came: DataFrame) -> DataFrame:
    """Rows that left count -1, rows that arrived +1; a replaced row is in both."""
    return union_all([gone.withColumn("_sign", F.lit(-1)), came.withColumn("_sign", F.lit(1))])


def _totals(rows: DataFrame, kept: Measures) -> DataFrame:
    measures = []
    for c in kept.sums:
        value = F.col(c).cast("decimal(20,2)")
        measures.append(F.sum(F.coalesce(value * F.col("_sign").cast("decimal(1,0)"), F.lit(0))).cast("decimal(38,2)").alias(SUM + c))
        measures.append(F.sum(F.when(F.col(c).isNotNull(), F.col("_sign")).otherwise(0)).alias(NUMBER + c))
    return rows.groupBy(kept.key).agg(F.sum("_sign").alias("lines"), *measures)


def _members(rows: DataFrame, kept: Measures) -> DataFrame:
    return rows.filter(F.col(kept.member).isNotNull()).groupBy(kept.key, kept.member).agg(F.sum("_sign").alias("lines"))


def start(rows: DataFrame, kept: Measures) -> State:
    """The state of a whole table; members are counted first, and the totals of a key take their number over."""
    one = rows.withColumn("_sign", F.lit(1))
    if kept.member is None:
        return State(_totals(one, kept), None)
    members = _members(one, kept)
    number = members.groupBy(F.col(kept.key).alias("_k")).agg(F.count(F.lit(1)).alias("members"))
    totals = _totals(one, kept).join(number, F.col(kept.key).eqNullSafe(F.col("_k")), "left").drop("_k").withColumn("members", F.coalesce("members", F.lit(0).cast("long")))
    return State(totals, members)


def _split(state: DataFrame, touched: DataFrame, keys: Sequence[str]) -> tuple[DataFrame, DataFrame]:
    """Rows of untouched keys, which pass through, and rows of touched ones. Keys compare as values; a null key is one as well."""
    names = [f"_{k}" for k in keys]
    marks = touched.select(*[F.col(k).alias(n) for k, n in zip(keys, names)])
    same = F.lit(True)
    for k, n in zip(keys, names):
        same = same & F.col(k).eqNullSafe(F.col(n))
    return state.join(marks, same, "left_anti"), state.join(marks, same, "left_semi")


def _counted(lines: Column, what: str) -> Column:
    """Fails the run where more rows left than there were: the state and the changes do not belong together."""
    return F.when(lines < 0, F.raise_error(F.lit(f"more rows of a {what} left than its state holds")).cast("long")).otherwise(lines)


def advance(state: State, gone: DataFrame, came: DataFrame, kept: Measures, keep: Callable[[str, DataFrame], DataFrame] = lambda name, df: df) -> State:
    """The state after some rows went and some came, from these rows and the states of their keys alone.

    Give every row that changed in both tables, as it was and as it is. Keys without rows leave the state.
    ``keep`` stores what several results are made of (by name), aggregated already; without it each computes it anew.
    """
    rows = signed(gone, came)
    delta = _totals(rows, kept)
    if kept.member is not None:
        changed = keep("changed", _members(rows, kept).withColumnRenamed("lines", "_change"))
        still, touched = _split(state.members, changed, [kept.key, kept.member])
        was = touched.withColumnsRenamed({kept.key: "_k", kept.member: "_m", "lines": "_was"})
        paired = changed.join(was, F.col(kept.key).eqNullSafe(F.col("_k")) & (F.col(kept.member) == F.col("_m")), "left")
        before = F.coalesce("_was", F.lit(0))
        after = _counted(before + F.col("_change"), f"{kept.member} of a {kept.key}")
        paired = keep("paired", paired.select(kept.key, kept.member, after.alias("lines"), ((before + F.col("_change") > 0).cast("long") - (before > 0).cast("long")).alias("members")))
        members = union_all([still.select(kept.key, kept.member, "lines"), paired.filter(F.col("lines") > 0).select(kept.key, kept.member, "lines")])
        step = paired.groupBy(F.col(kept.key).alias("_k")).agg(F.sum("members").alias("members"))
        delta = delta.join(step, F.col(kept.key).eqNullSafe(F.col("_k")), "left").drop("_k").withColumn("members", F.coalesce("members", F.lit(0).cast("long")))
    else:
        members = None
    delta = keep("delta", delta)
    columns = state.totals.columns
    still, touched = _split(state.totals, delta, [kept.key])
    added = union_all([touched.select(*columns), delta.select(*columns)]).groupBy(kept.key)
    sums = added.agg(*[F.sum(c).cast(state.totals.schema[c].dataType).alias(c) for c in columns if c != kept.key])
    sums = sums.withColumn("lines", _counted(F.col("lines"), kept.key)).filter(F.col("lines") > 0)
    return State(union_all([still.select(*columns), sums.select(*columns)]), members)


def average(c: str, kind: str) -> Column:
    """The mean of a measure's values as ``avg`` gives it on a decimal of two digits; NULL if there is none."""
    return F.when(F.col(NUMBER + c) > 0, F.col(SUM + c).cast("decimal(22,2)") / F.col(NUMBER + c).cast("decimal(15,0)")).cast(kind)
