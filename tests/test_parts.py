from datetime import datetime, timedelta

import pyarrow as pa

from helpers import rows, table
from pyspark.sql import functions as F

from tierstar.operators import quality, quarantine, trends
from tierstar.sources.parts import PartedTable
from tierstar.sources.store import LayerStore, RunInfo


def fact(spark, *items):
    order, month, n = zip(*items, strict=True)
    return table(spark, order_id=pa.array(order, pa.string()), month=pa.array(month, pa.int32()), n=pa.array(n, pa.int64()))


def test_only_touched_parts_are_written(spark, tmp_path):
    store = LayerStore(spark, str(tmp_path))
    parts = PartedTable(store, "gold", "fact", "month")
    start = fact(spark, ("a", 1, 1), ("a", 1, 2), ("b", 2, 3), ("c", 3, 4), ("d", None, 5), ("e", 4, 6))
    first, second = RunInfo(), RunInfo()
    store.publish(first, "gold", [parts.stage(first, start)])
    assert rows(parts.read(start.schema), "n") == rows(start, "n")
    # b moves to the third month, and its month is left empty; e goes; f is new in a new month.
    came = fact(spark, ("b", 3, 30), ("f", 5, 7))
    gone = table(spark, order_id=["b", "e", "f"])
    store.publish(second, "gold", [parts.replace(second, start.schema, gone, came, "order_id")])
    assert rows(parts.read(start.schema), "n") == [("a", 1, 1), ("a", 1, 2), ("c", 3, 4), ("d", None, 5), ("f", 5, 7), ("b", 3, 30)]
    listing = {r.part: (second.run_id in r.path, r.row_count) for r in parts.listing().collect()}
    assert listing == {"1": (False, 2), "none": (False, 1), "3": (True, 2), "5": (True, 1)}


UNIQUES = [quality.Unique(2, "key", "t", ("k", "line")), quality.Unique(4, "v", "t", ("v",))]
REFERENCES = [quality.Reference(3, "parent", "t", "p", "parents", "id"), quality.Reference(5, "other", "t", "o", "parents", "id", True)]


def test_rows_carry_all_rules_they_break(spark):
    given = [("a", 1, -1, "x", "x"), ("a", 1, 2, "x", None), ("b", 1, 3, "q", "q"), (None, None, 4, None, "x"), (None, None, 5, "x", "x"), ("c", 1, None, "x", "x")]
    k, line, v, p, o = zip(*given, strict=True)
    df = table(spark, k=pa.array(k, pa.string()), line=pa.array(line, pa.int32()), v=pa.array(v, pa.int32()), p=pa.array(p, pa.string()), o=pa.array(o, pa.string()))
    rules = [quality.Rule(1, "negative", F.col("v") < 0)]
    parents = {"parents": table(spark, id=["x", "y"])}
    tagged = quarantine.tag(df, rules, UNIQUES, REFERENCES, parents).cache()
    assert [(r.v, r.broken) for r in tagged.orderBy("v").collect()] == [(None, []), (-1, [1, 2]), (2, [2]), (3, [3, 5]), (4, [2, 3]), (5, [2])]
    good, bad = quarantine.part(tagged)
    assert good.columns == df.columns and good.count() == 1 and bad.count() == 5
    offered = quarantine.offer(df.limit(0).unionByName(df.filter("k = 'b'").withColumn("p", F.lit("y"))), bad, ["k", "line"])
    assert offered.count() == 5 and offered.filter("k = 'b'").first().p == "y"
    assert rows(quarantine.tag(df.limit(0), rules, UNIQUES, REFERENCES, parents)) == []
    assert quarantine.tag(df, rules).filter("size(broken) > 0").count() == 1


def test_trend_of_a_check(spark):
    at = [datetime(2024, 1, 1) + timedelta(i) for i in range(5)]
    audit = table(spark, layer=["s"] * 5, code=[1] * 5, run_id=list("abcde"), load_dts=at, passed=[True, True, False, False, True], failing_rows=[0, 0, 4, 7, 0])
    got = rows(trends.audit_trend(audit).select("failing_change", "streak", "streak_since", "first_failure"), "run_id")
    assert got == [(None, 1, at[0], None), (0, 2, at[0], None), (4, 1, at[2], at[2]), (3, 2, at[2], at[2]), (-7, 1, at[4], at[2])]


def test_limits_from_history(spark):
    n = [1, 2, 1, 2, 1, 50]
    audit = table(spark, layer=["s"] * 8, code=[1] * 6 + [2] * 2, run_id=list("abcdefgh"), load_dts=[datetime(2024, 1, 1 + i) for i in range(8)], failing_rows=[*n, 0, 9], checked_rows=[100] * 7 + [0])
    got = rows(trends.contract_limits(audit).select("run_id", "median_share", "deviation", "outside"), "run_id")
    assert [(r[0], r[3]) for r in got] == [*[(x, False) for x in "abcde"], ("f", True), ("g", False), ("h", False)]
    assert abs(got[0][1] - 0.015) < 1e-12 and abs(got[0][2] - 0.005) < 1e-12


def test_rows_are_observed_in_the_write(spark, tmp_path):
    store = LayerStore(spark, str(tmp_path))
    rules = [quality.Rule(1, "low", F.col("v") < 2), quality.Rule(2, "few nulls", F.col("v").isNull(), quality.WARNING, 0.5)]
    df = table(spark, v=pa.array([3, 1, None, 5], pa.int32())).repartition(3)
    staged, lines, least = store.stage_observed(RunInfo(), "silver", "t", df, rules, ["v"])
    assert staged.row_count == 4 and least == {"v": 1}
    assert rows(lines, "code") == rows(quality.row_checks(staged.df, rules), "code")
    empty, lines, least = store.stage_observed(RunInfo(), "silver", "e", df.limit(0), rules, ["v"])
    assert empty.row_count == 0 and least == {"v": None} and rows(lines.select("passed")) == [(True,), (True,)]
    assert empty.df.count() == 0


def test_whole_rows_move_once_for_a_unique_rule_and_its_references(spark):
    df = table(spark, k=pa.array([1, 1, 2, 3, None, 4], pa.int64()), line=pa.array([1, 1, 1, 1, 1, None], pa.int32()), v=["wide"] * 6)
    parents = {"parents": table(spark, id=pa.array([1, 2, 4], pa.int64())), "texts": table(spark, id=["1", "3", "4"])}
    unique = [quality.Unique(2, "key", "t", ("k", "line"))]
    references = [quality.Reference(3, "parent", "t", "k", "parents", "id"), quality.Reference(5, "text", "t", "k", "texts", "id", True)]
    tagged = quarantine.tag(df, [], unique, references, parents)
    assert rows(tagged.select("k", "broken"), "k", "line") == [(None, [3]), (1, [2]), (1, [2]), (2, [5]), (3, [3]), (4, [])]
    limit = spark.conf.get("spark.sql.autoBroadcastJoinThreshold")
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", -1)
    try:
        plan = quarantine.tag(df, [], unique, references, parents)._jdf.queryExecution().optimizedPlan().toString()
    finally:
        spark.conf.set("spark.sql.autoBroadcastJoinThreshold", limit)
    joins = [line for line in plan.splitlines() if "Join " in line]
    # One join of whole rows, by the unique key; the references are asked for keys.
    assert sum("LeftOuter" in line for line in joins) == 1 and all("LeftOuter" in line or "LeftAnti" in line or "LeftSemi" in line for line in joins)
