import re

import pytest
from pyspark.sql import functions as F

from helpers import rows, shop
from tierstar.plans import colocated, gold, silver
from tierstar.sources.buckets import frequent_keys, read_buckets, stage_buckets
from tierstar.sources.store import LayerStore, RunInfo


def built(spark, tmp_path, rows_per_order):
    clean = silver.clean_all(shop(spark))
    star = gold.build_dimensions(clean)
    dimensions = [star[d] for d in ("dim_customers", "dim_products", "dim_sellers")]
    expected = gold.build_fact(*[clean[n] for n in colocated.ORDER_TABLES], *dimensions)
    by_order = colocated.load_by_order(LayerStore(spark, str(tmp_path)), RunInfo(), clean, 3, rows_per_order)
    return expected, by_order, colocated.build_fact(by_order, star, 2), star


# Order o1 has three lines, o2 has one.
@pytest.mark.parametrize("rows_per_order, beside", [(1_000_000, 0), (2, 3), (0, 4)])
def test_fact_from_buckets(spark, tmp_path, rows_per_order, beside):
    expected, by_order, fact, _ = built(spark, tmp_path, rows_per_order)
    assert by_order["order_items"].beside.count() == beside and by_order["order_items"].light.count() == 4 - beside
    assert fact.schema == expected.schema
    assert rows(fact, "order_id", "order_item_id") == rows(expected, "order_id", "order_item_id")


def test_orders_meet_without_a_shuffle(spark, tmp_path):
    _, by_order, _, star = built(spark, tmp_path, 1_000_000)
    dimensions = [star[d] for d in ("dim_customers", "dim_products", "dim_sellers")]
    light = gold.build_fact(*[by_order[n].light for n in colocated.ORDER_TABLES], *dimensions, rows_per_split=None)
    limit = spark.conf.get("spark.sql.autoBroadcastJoinThreshold")
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", -1)
    try:
        plan = light._jdf.queryExecution().executedPlan().toString()
    finally:
        spark.conf.set("spark.sql.autoBroadcastJoinThreshold", limit)
    assert "hashpartitioning(product_id" in plan and not re.search(r"hashpartitioning\(order_id", plan)
    assert light._jdf.queryExecution().executedPlan().toString().count("Bucketed: true") >= 4


def test_another_session_opens_the_buckets(spark, tmp_path):
    store, run = LayerStore(spark, str(tmp_path)), RunInfo()
    df = spark.range(100).select((F.col("id") % 7).cast("string").alias("k"), "id")
    store.publish(run, "silver", stage_buckets(store, run, "silver", {"t": df}, "k", 4))
    first = read_buckets(store, "silver", "k")["t"].light
    assert len(first.inputFiles()) <= 4
    # The name is gone, the files are not: what a session with a catalog of its own sees.
    (name,) = [t.name for t in spark.catalog.listTables() if t.name.startswith("bucketed_") and spark.table(t.name).columns == ["k", "id"]]
    spark.sql(f"DROP TABLE {name}")
    light = read_buckets(store, "silver", "k")["t"].light
    assert rows(light, "id") == rows(df, "id")
    counts = light.groupBy("k").agg(F.count("*").alias("n"))
    assert "Exchange" not in counts._jdf.queryExecution().executedPlan().toString()
    assert {r.k: r.n for r in counts.collect()} == {str(k): 15 if k < 2 else 14 for k in range(7)}


def test_null_and_frequent_keys_stay_beside(spark, tmp_path):
    store, run = LayerStore(spark, str(tmp_path)), RunInfo()
    a = spark.createDataFrame([("x", 1), ("x", 2), ("x", 3), ("y", 4), (None, 5), (None, 6)], "k string, v int")
    b = spark.createDataFrame([("x", 1), ("y", 2), ("z", 3)], "k string, v int")
    assert rows(frequent_keys({"a": a, "b": b}, "k", 2)) == [("x",)]
    store.publish(run, "silver", stage_buckets(store, run, "silver", {"a": a, "b": b, "none": b.limit(0)}, "k", 2, 2))
    got = read_buckets(store, "silver", "k")
    assert rows(got["a"].light) == [("y", 4)] and rows(got["a"].beside, "v") == [("x", 1), ("x", 2), ("x", 3), (None, 5), (None, 6)]
    # A key that is frequent in one table lies beside the buckets of all.
    assert rows(got["b"].light, "v") == [("y", 2), ("z", 3)] and rows(got["b"].beside) == [("x", 1)]
    assert got["none"].light.count() == got["none"].beside.count() == 0
    log = {r.table_name: r.row_count for r in store.manifest().collect()}
    assert (log["a"], log["a_beside"], log["b"], log["b_beside"]) == (1, 5, 2, 1)


def test_marked_rows_are_stored_once_beyond_few_frequent_keys(spark, tmp_path, monkeypatch):
    a = spark.createDataFrame([("x", 1), ("x", 2), ("x", 3), ("y", 4), (None, 5)], "k string, v int")
    found = {}
    for limit in (0, 1):
        monkeypatch.setattr("tierstar.sources.buckets.FEW_FREQUENT", limit)
        store, run = LayerStore(spark, str(tmp_path / str(limit))), RunInfo()
        store.publish(run, "silver", stage_buckets(store, run, "silver", {"a": a}, "k", 2, 2))
        got = read_buckets(store, "silver", "k")["a"]
        assert got.light.columns == got.beside.columns == ["k", "v"]
        marked = tmp_path / str(limit) / "scratch" / "runs" / run.run_id / "silver_a_marked"
        found[limit] = (rows(got.light), rows(got.beside, "v"), marked.exists())
    assert found[0] == ([("y", 4)], [("x", 1), ("x", 2), ("x", 3), (None, 5)], True)
    assert found[1] == (*found[0][:2], False)
