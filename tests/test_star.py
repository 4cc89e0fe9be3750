from decimal import Decimal as D

from pyspark.sql import Window
from pyspark.sql import functions as F

from helpers import rows, shop
from tierstar.operators.keys import dense_key
from tierstar.plans import gold, silver


def star_of(spark, raw, with_calendar=False, **options):
    clean = silver.clean_all(raw)
    star = gold.build_dimensions(clean)
    star["fact_orders"] = gold.build_fact(
        clean["order_items"],
        clean["orders"],
        clean["payments"],
        clean["reviews"],
        star["dim_customers"],
        star["dim_products"],
        star["dim_sellers"],
        star["dim_date"] if with_calendar else None,
        **options,
    )
    return star


MEASURES = ["order_id", "order_item_id", "total_amount", "allocated_payment_amount", "review_score"]
EXPECTED = [
    ("o1", 1, D("11.00"), D("33.33"), D("4.50")),
    ("o1", 2, D("22.00"), D("33.33"), D("4.50")),
    ("o1", 3, D("30.00"), D("33.33"), D("4.50")),
    ("o2", 1, D("5.50"), None, None),
]


def test_worked_example(star):
    fact = star["fact_orders"]
    assert rows(fact.select(*MEASURES), "order_id", "order_item_id") == EXPECTED
    first = fact.filter("order_id = 'o1' and order_item_id = 3").first()
    assert (first.order_date_key, first.shipping_limit_date_key, first.approved_date_key) == (20171002, 20171006, 20171002)
    assert (first.delivered_date_key, first.estimated_delivery_date_key) == (20171010, 20171018)
    assert first.freight_amount is None and first.quantity == 1


def test_joined_calendar_gives_the_same_fact(spark, star):
    plain = star["fact_orders"]
    joined = star_of(spark, shop(spark), with_calendar=True)["fact_orders"]
    assert plain.schema == joined.schema
    assert rows(plain, "order_id", "order_item_id") == rows(joined, "order_id", "order_item_id")


def test_split_orders_give_the_same_fact(spark, star):
    whole = star["fact_orders"]
    split = star_of(spark, shop(spark), rows_per_split=1)["fact_orders"]
    assert rows(whole, "order_id", "order_item_id") == rows(split, "order_id", "order_item_id")


def test_dropped_line_still_takes_its_share(spark):
    data = shop(spark)
    items = data["order_items"].withColumn("product_id", F.when(F.col("price") == "30.00", "unknown").otherwise(F.col("product_id")))
    fact = star_of(spark, data | {"order_items": items})["fact_orders"]
    assert rows(fact.select(*MEASURES), "order_id", "order_item_id") == [r for r in EXPECTED if r[:2] != ("o1", 3)]


def test_lines_leave_without_customer_seller_order_or_purchase_time(spark):
    def fact_with(**tables):
        got = star_of(spark, shop(spark) | tables)["fact_orders"]
        return {(r.order_id, r.order_item_id) for r in got.collect()}

    data = shop(spark)
    every = {("o1", 1), ("o1", 2), ("o1", 3), ("o2", 1)}
    assert fact_with() == every
    assert fact_with(customers=data["customers"].filter("customer_id <> 'c2'")) == every - {("o2", 1)}
    assert fact_with(sellers=data["sellers"].filter("seller_id <> 's2'")) == {("o1", 1), ("o1", 2)}
    assert fact_with(orders=data["orders"].filter("order_id <> 'o2'")) == every - {("o2", 1)}
    untimed = data["orders"].withColumn("order_purchase_timestamp", F.lit("10-02"))
    assert fact_with(orders=untimed) == set()


def test_untranslated_category_keeps_its_product(star):
    products = star["dim_products"]
    names = ["product_id", "product_category_name", "product_category_name_english"]
    assert rows(products.select(*names), "product_id") == [("p1", "perfumaria", "perfumery"), ("p2", "artes", None)]


def test_calendar_holds_each_used_day_once(star):
    days = star["dim_date"]
    keys = [r.date_key for r in days.orderBy("date_key").collect()]
    # The carrier hand-over on 2017-10-04 is not in use.
    assert keys == [20171002, 20171006, 20171010, 20171018, 20180724, 20180730, 20180813]


def test_dense_key_is_dense_unique_and_reproducible(spark):
    ids = spark.range(5000).select(F.concat(F.lit("id"), "id").alias("bk"), F.col("id").alias("v"))
    first = dense_key(ids, ["bk"], "sk")
    facts = first.agg(F.count("*"), F.min("sk"), F.max("sk"), F.count_distinct("sk")).first()
    assert tuple(facts) == (5000, 1, 5000, 5000)
    again = dense_key(ids.repartition(13), ["bk"], "sk")
    assert first.exceptAll(again).isEmpty()
    ranked = ids.withColumn("sk", F.row_number().over(Window.orderBy(F.left(F.md5("bk"), F.lit(3)), "bk")).cast("long"))
    assert first.select("sk", "bk").exceptAll(ranked.select("sk", "bk")).isEmpty()


def test_one_order_with_a_third_of_all_lines(spark):
    """A hot order is counted, joined and allocated whole."""
    data = shop(spark)
    many = spark.range(1, 3001).select(
        F.when(F.col("id") <= 1000, "o1").otherwise("o2").alias("order_id"),
        F.col("id").cast("string").alias("order_item_id"),
        F.lit("p1").alias("product_id"),
        F.lit("s1").alias("seller_id"),
        F.lit("2017-10-06").alias("shipping_limit_date"),
        F.lit("1.00").alias("price"),
        F.lit("0.10").alias("freight_value"),
    )
    fact = star_of(spark, data | {"order_items": many}, rows_per_split=100)["fact_orders"]
    got = fact.groupBy("order_id").agg(F.count("*"), F.sum("total_amount"), F.max("allocated_payment_amount"))
    assert rows(got, "order_id") == [("o1", 1000, D("1100.00"), D("0.10")), ("o2", 2000, D("2200.00"), None)]


def test_result_does_not_depend_on_partitioning(spark):
    data = shop(spark)
    shuffled = {name: df.repartition(5) for name, df in data.items()}
    first, second = star_of(spark, data), star_of(spark, shuffled)
    for name in first:
        assert first[name].exceptAll(second[name]).isEmpty(), name
        assert second[name].exceptAll(first[name]).isEmpty(), name


def test_gate_of_the_query_reads_stored_tables(spark):
    """The fact is built once, not for each of the two times that the gate reads it."""
    import __spark_entry__ as entry
    from standins import Given

    from tierstar.plans import gold

    gate = entry.QUERIES["gold_gate"](Given(spark, "/root/testdata/sf0.001"))
    assert "Join" not in gate._jdf.queryExecution().optimizedPlan().toString()
    assert sorted(gate.collect()) == sorted(gold.gate(entry._star(Given(spark, "/root/testdata/sf0.001"))).collect())
