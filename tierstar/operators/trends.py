"""Pass and fail trends of checks over runs."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F


def audit_trend(audit: DataFrame) -> DataFrame:
    """One row per check and run: its streak (runs in a row with the same outcome, and where it began), the
    first failure so far, and the change in failing rows against the run before.

    Takes what ``LayerStore.audit`` gives. Islands of equal outcomes are numbered by a running sum of changes; all windows share
    one partitioning by check and one order by run.
    """
    check = ["layer", "code"]
    along = Window.partitionBy(*check).orderBy("load_dts", "run_id")
    so_far = along.rowsBetween(Window.unboundedPreceding, Window.currentRow)
    before = F.lag("passed").over(along)
    islands = audit.withColumns(
        {
            "_turn": F.when(before.isNull() | (before != F.col("passed")), 1).otherwise(0),
            "failing_change": F.col("failing_rows") - F.lag("failing_rows").over(along),
            "first_failure": F.min(F.when(~F.col("passed"), F.col("load_dts"))).over(so_far),
        }
    ).withColumn("_island", F.sum("_turn").over(so_far))
    streak = Window.partitionBy(*check, "_island").orderBy("load_dts", "run_id").rowsBetween(Window.unboundedPreceding, Window.currentRow)
    return islands.withColumns({"streak": F.count(F.lit(1)).over(streak), "streak_since": F.min("load_dts").over(streak)}).select(
        *check, "run_id", "load_dts", "passed", "failing_rows", "failing_change", "streak", "streak_since", "first_failure"
    )


def contract_limits(audit: DataFrame, width: float = 3.0, at_least: int = 5) -> DataFrame:
    """Limits that past runs set for the share of failing rows of each check, and the runs outside them.

    One row per check and run: the median share, the median deviation from it, the limit (median plus ``width`` times 1.4826 deviations), and
    whether the run is outside. Both medians are over all runs of the check, so a single bad run moves neither. A check with fewer than ``at_least`` runs has no limit.
    """
    check = ["layer", "code"]
    share: Column = F.when(F.col("checked_rows") > 0, F.col("failing_rows") / F.col("checked_rows"))
    runs = audit.select(*check, "run_id", "load_dts", share.alias("share"))
    middle = runs.groupBy(*check).agg(F.median("share").alias("median_share"), F.count("share").alias("runs"))
    apart = runs.join(middle, check).withColumn("_apart", F.abs(F.col("share") - F.col("median_share")))
    spread = apart.groupBy(*check).agg(F.median("_apart").alias("deviation"))
    limit = F.when(F.col("runs") >= at_least, F.col("median_share") + F.lit(width * 1.4826) * F.col("deviation"))
    out = apart.join(spread, check).withColumn("limit_share", limit)
    return out.select(*check, "run_id", "share", "median_share", "deviation", "limit_share", F.coalesce(F.col("share") > F.col("limit_share"), F.lit(False)).alias("outside"))
