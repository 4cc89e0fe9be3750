"""Quality checks as small result tables, and the gate that stops a run.

Every builder returns one result line per check: ``code, severity, message, failing_rows,
checked_rows, passed``. Checks that look at single rows share one pass over their table.
"""

from __future__ import annotations

from collections.abc import Mapping, Sequence
from dataclasses import dataclass

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from tierstar.operators.aggregates import union_all
from tierstar.operators.joins import orphans

CRITICAL, WARNING = "critical", "warning"

RESULT = T.StructType(
    [
        T.StructField("code", T.IntegerType(), False),
        T.StructField("severity", T.StringType(), False),
        T.StructField("message", T.StringType(), False),
        T.StructField("failing_rows", T.LongType()),
        T.StructField("checked_rows", T.LongType()),
        T.StructField("passed", T.BooleanType()),
    ]
)


class QualityError(Exception):
    """Raised by ``enforce``; carries the first failed critical check and the whole list of them."""

    def __init__(self, failures: Sequence[tuple[int, str, int]]):
        self.failures = list(failures)
        self.code, self.message, self.failing_rows = self.failures[0]
        super().__init__("; ".join(f"{code} {text} ({rows} rows)" for code, text, rows in self.failures))


@dataclass(frozen=True)
class Rule:
    """A row is bad where ``bad`` is true. Up to ``max_bad_ratio`` of the rows may be bad."""

    code: int
    message: str
    bad: Column
    severity: str = CRITICAL
    max_bad_ratio: float = 0.0


def any_null(*columns: str) -> Column:
    bad = F.col(columns[0]).isNull()
    for c in columns[1:]:
        bad = bad | F.col(c).isNull()
    return bad


def negative(column: str) -> Column:
    return F.col(column) < 0


def outside(column: str, low, high) -> Column:
    return ~F.col(column).between(low, high)


def earlier(later: str, first: str) -> Column:
    """``later`` lies before ``first``, which it should not."""
    return F.col(later) < F.col(first)


def _line(code: int, severity: str, message: str, failing: Column, checked: Column, ratio: float) -> Column:
    return F.struct(
        F.lit(code).alias("code"),
        F.lit(severity).alias("severity"),
        F.lit(message).alias("message"),
        failing.cast("long").alias("failing_rows"),
        checked.cast("long").alias("checked_rows"),
        (failing <= F.coalesce(checked, F.lit(0)) * F.lit(ratio)).alias("passed"),
    )


def row_checks(df: DataFrame, rules: Sequence[Rule]) -> DataFrame:
    """All row rules of one table in a single aggregate."""
    counted = df.agg(
        F.count(F.lit(1)).alias("checked"),
        *[F.count_if(r.bad).alias(f"bad_{i}") for i, r in enumerate(rules)],
    )
    lines = [
        _line(r.code, r.severity, r.message, F.col(f"bad_{i}"), F.col("checked"), r.max_bad_ratio)
        for i, r in enumerate(rules)
    ]
    return counted.select(F.inline(F.array(*lines)))


def duplicate_keys(df: DataFrame, keys: Sequence[str]) -> DataFrame:
    """Keys that occur more than once, with their number of rows. NULL is a key like any other."""
    return df.groupBy(*keys).agg(F.count(F.lit(1)).alias("row_count")).filter(F.col("row_count") > 1)


@dataclass(frozen=True)
class Unique:
    """``keys`` occur once in ``table``."""

    code: int
    message: str
    table: str
    keys: tuple[str, ...]
    severity: str = CRITICAL


@dataclass(frozen=True)
class Reference:
    """``key`` of ``table`` is found among the ``parent_key`` of ``parent``, which has a ``Unique`` check; a NULL may be let pass."""

    code: int
    message: str
    table: str
    key: str
    parent: str
    parent_key: str
    null_passes: bool = False
    severity: str = CRITICAL


def key_checks(tables: Mapping[str, DataFrame], uniques: Sequence[Unique], references: Sequence[Reference]) -> DataFrame:
    """All unique and reference checks of several tables: every table is scanned once, and there is one shuffle.

    Each row is turned into the keys it holds. A key of a parent and the children's keys that refer
    to it share a domain; counting by domain and key (combined before the shuffle) shows both which keys occur twice
    and which are used without being there, so nothing is joined. Failing rows are rows, not keys.
    """
    domain = {(u.table, u.keys): i for i, u in enumerate(uniques)}
    held: dict[str, list[Column]] = {}
    for i, u in enumerate(uniques):
        # One column stands for itself; several are rendered with their names, so no two tuples look alike.
        key = F.col(u.keys[0]).cast("string") if len(u.keys) == 1 else F.to_json(F.struct(*u.keys), {"ignoreNullFields": "false"})
        held.setdefault(u.table, []).append(F.struct(F.lit(i).alias("domain"), F.lit(-1).alias("role"), key.alias("key")))
    for i, r in enumerate(references):
        place = F.struct(F.lit(domain[(r.parent, (r.parent_key,))]).alias("domain"), F.lit(i).alias("role"), F.col(r.key).cast("string").alias("key"))
        held.setdefault(r.table, []).append(F.when(F.col(r.key).isNotNull(), place) if r.null_passes else place)
    events = union_all([tables[t].select(F.inline(F.array_compact(F.array(*keys)))) for t, keys in held.items()])
    own = F.count_if(F.col("role") == -1)
    counts = events.groupBy("domain", "key").agg(own.alias("own"), *[F.count_if(F.col("role") == i).alias(f"used_{i}") for i in range(len(references))])
    lost = (F.col("own") == 0) | F.col("key").isNull()
    totals = counts.agg(
        *[F.coalesce(F.sum(F.when((F.col("domain") == i) & (F.col("own") > 1), F.col("own"))), F.lit(0)).alias(f"double_{i}") for i in range(len(uniques))],
        *[F.coalesce(F.sum(F.when(F.col("domain") == i, F.col("own"))), F.lit(0)).alias(f"rows_{i}") for i in range(len(uniques))],
        *[F.coalesce(F.sum(F.when(lost, F.col(f"used_{i}"))), F.lit(0)).alias(f"lost_{i}") for i in range(len(references))],
    )
    lines = [_line(u.code, u.severity, u.message, F.col(f"double_{i}"), F.col(f"rows_{i}"), 0.0) for i, u in enumerate(uniques)]
    lines += [_line(r.code, r.severity, r.message, F.col(f"lost_{i}"), F.lit(None), 0.0) for i, r in enumerate(references)]
    return totals.select(F.inline(F.array(*lines)))


def unique_check(code: int, message: str, df: DataFrame, keys: Sequence[str], severity: str = CRITICAL) -> DataFrame:
    """Fails on every row of a key that occurs more than once."""
    per_key = df.groupBy(*keys).agg(F.count(F.lit(1)).alias("n"))
    repeated = F.coalesce(F.sum(F.when(F.col("n") > 1, F.col("n"))), F.lit(0))
    counted = per_key.agg(repeated.alias("bad"), F.coalesce(F.sum("n"), F.lit(0)).alias("checked"))
    return counted.select(F.inline(F.array(_line(code, severity, message, F.col("bad"), F.col("checked"), 0.0))))


def orphan_check(
    code: int,
    message: str,
    child: DataFrame,
    parent: DataFrame,
    child_key: str,
    parent_key: str | None = None,
    severity: str = CRITICAL,
    max_bad_ratio: float = 0.0,
) -> DataFrame:
    """Fails on child rows without a parent; all children are counted only where a ratio needs it."""
    lost = orphans(child, parent, child_key, parent_key).agg(F.coalesce(F.sum("row_count"), F.lit(0)).alias("bad"))
    checked = child.agg(F.count(F.lit(1)).alias("n")).scalar() if max_bad_ratio else F.lit(None).cast("long")
    lost = lost.withColumn("checked", checked)
    return lost.select(F.inline(F.array(_line(code, severity, message, F.col("bad"), F.col("checked"), max_bad_ratio))))


def count_check(code: int, message: str, before: DataFrame, after: DataFrame, dropped: DataFrame | None = None, severity: str = WARNING) -> DataFrame:
    """Rows before = rows after + rows known to be dropped (those of ``dropped``, or the sum of its ``row_count``); ``failing_rows`` is the absolute gap."""
    def size(df: DataFrame) -> Column:
        return df.agg(F.count(F.lit(1)).alias("n")).scalar()

    counted = before.agg(F.count(F.lit(1)).alias("checked")).withColumn("kept", size(after))
    if dropped is not None and "row_count" in dropped.columns:
        counted = counted.withColumn("lost", dropped.agg(F.coalesce(F.sum("row_count"), F.lit(0))).scalar())
    else:
        counted = counted.withColumn("lost", size(dropped) if dropped is not None else F.lit(0))
    gap = F.abs(F.col("checked") - F.col("kept") - F.col("lost"))
    return counted.select(F.inline(F.array(_line(code, severity, message, gap, F.col("checked"), 0.0))))


def existence_checks(spark: SparkSession, expected: Sequence[tuple[int, str]], present: set[str]) -> DataFrame:
    """One line per expected table name; fails where it is not among ``present``."""
    rows = [
        (code, CRITICAL, f"missing table {name}", int(name not in present), 1, name in present)
        for code, name in expected
    ]
    return spark.createDataFrame(rows, RESULT)


def run_checks(results: Sequence[DataFrame]) -> DataFrame:
    """Every result line of a gate in one table, hence one Spark job."""
    return union_all(results)


def any_row(df: DataFrame) -> bool:
    """Whether ``df`` has a row at all; stops at the first one found."""
    return not df.isEmpty()


def enforce(results: DataFrame) -> None:
    """Raise when a critical check failed. Reads one line per check, however large the tables are."""
    failed = results.filter(~F.col("passed") & (F.col("severity") == CRITICAL)).orderBy("code").collect()
    if failed:
        raise QualityError([(r.code, r.message, r.failing_rows) for r in failed])
