"""Raw text rows to typed, keyed rows, driven by a ``TableSpec``."""

from __future__ import annotations

from functools import reduce
from operator import and_

from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from tierstar.functions import filled, present, unquoted
from tierstar.operators.dedup import first_per_key
from tierstar.schemas import TableSpec


def require(df: DataFrame, *columns: str) -> DataFrame:
    """Drop every row in which one of ``columns`` is NULL.

    Spelled as plain not-null tests, which reach the Parquet scan and match the tests that joins add.
    """
    return df.filter(reduce(and_, [F.col(c).isNotNull() for c in columns])) if columns else df


def clean(raw: DataFrame, spec: TableSpec) -> DataFrame:
    """Clean, type and filter one raw table; keep one row per key where the spec asks for it.

    A required text column is tested as it stands, below the projections: a test of the cleaned column
    would be pushed through them and clean the text a second time. Only required numbers are tested once typed. Without deduplication this is a single map-only stage. With it there
    is one shuffle, and the rank limit runs before that shuffle, so a key with very many copies
    sends one row per map task.
    """
    names = [c.name for c in spec.columns]
    needed = [spec.column(c) for c in spec.required]
    for c in needed:
        if isinstance(c.spark_type, T.StringType):
            raw = raw.filter(present(F.col(c.raw)))
    numbers = [c.name for c in needed if not isinstance(c.spark_type, T.StringType)]
    texts = [unquoted(F.col(c.raw)).alias(f"_text_{c.name}") for c in spec.columns]
    typed = [c.typed(F.col(f"_text_{c.name}")).alias(c.name) for c in spec.columns]
    if spec.best_first is None:
        return require(raw.select(*texts).select(*typed), *numbers)

    raws = [F.col(c.raw).alias(f"_raw_{c.raw}") for c in spec.columns]
    # Copies are recognised by the whole cleaned key text, before it is cut to its column size; blanks at its end do not count.
    keys = {f"_key_{k}": F.rtrim(filled(F.col(f"_text_{k}"))) for k in spec.key}
    candidates = raw.select(*raws, *texts).select("*", *typed).withColumns(keys)
    candidates = require(candidates, *numbers)
    return first_per_key(candidates, list(keys), spec.best_first(), [F.col(c) for c in names]).select(*names)


def left_out(raw: DataFrame, spec: TableSpec) -> DataFrame:
    """How many raw rows ``clean`` leaves out and why: reason ('required column missing', 'copy'), row_count.

    Counted on the raw rows by a way of its own, so that it can explain the difference of the row counts of both layers. Copies are
    counted per key before the shuffle; no row moves.
    """
    needed = [spec.column(c) for c in spec.required]
    texts = [unquoted(F.col(c.raw)).alias(f"_text_{c.name}") for c in spec.columns]
    tests = [
        F.coalesce(present(F.col(c.raw)), F.lit(False)) if isinstance(c.spark_type, T.StringType) else c.typed(unquoted(F.col(c.raw))).isNotNull()
        for c in needed
    ]
    whole = reduce(and_, tests) if tests else F.lit(True)
    keys = [F.rtrim(filled(F.col(f"_text_{k}"))).alias(f"_key_{k}") for k in spec.key] if spec.best_first else []
    per_key = raw.select(*texts, whole.alias("_whole")).groupBy("_whole", *keys).agg(F.count(F.lit(1)).alias("n"))
    copies = F.coalesce(F.sum(F.when(F.col("_whole"), F.col("n") - 1)), F.lit(0)) if keys else F.lit(0).cast("long")
    totals = per_key.agg(F.coalesce(F.sum(F.when(~F.col("_whole"), F.col("n"))), F.lit(0)).alias("missing"), copies.alias("copies"))
    line = lambda reason, n: F.struct(F.lit(reason).alias("reason"), F.col(n).cast("long").alias("row_count"))
    return totals.select(F.inline(F.array(line("required column missing", "missing"), line("copy", "copies"))))
