import pytest
from pyspark.sql import functions as F

from helpers import raw_table, rows, shop, table
from tierstar.operators.keys import dense_key, resolve_key
from tierstar.operators.joins import heavy_keys, orphans, split_join
from tierstar.operators.quality import (
    WARNING,
    QualityError,
    Reference,
    Rule,
    Unique,
    any_null,
    any_row,
    count_check,
    duplicate_keys,
    earlier,
    enforce,
    key_checks,
    negative,
    orphan_check,
    outside,
    row_checks,
    run_checks,
    unique_check,
)
from tierstar.plans import silver
from tierstar.schemas import TABLES
from tierstar.operators.clean import clean


def failed_codes(results):
    return sorted(r.code for r in results.filter(~F.col("passed")).collect())


def test_clean_shop_passes(spark):
    results = silver.gate(silver.clean_all(shop(spark)))
    assert failed_codes(results) == []
    # 9 required-column checks, 9 key checks, 6 relations, 15 domain rules
    assert results.count() == 39
    enforce(results)


def test_missing_tables(spark):
    results = silver.existence_gate(spark, {"customers", "orders"})
    assert results.count() == 9
    assert failed_codes(results) == [53001, 53002, 53003, 53004, 53006, 53007, 53008]
    with pytest.raises(QualityError) as raised:
        enforce(results)
    assert raised.value.code == 53001


PLANTED_NULL = {
    "customers": "customer_unique_id",
    "geolocation": "geolocation_zip_code_prefix",
    "order_items": "seller_id",
    "payments": "payment_sequential",
    "reviews": "review_id",
    "orders": "customer_id",
    "products": "product_id",
    "sellers": "seller_zip_code_prefix",
    "category_translation": "product_category_name_english",
}


def test_each_planted_null_is_found(spark):
    tables = silver.clean_all(shop(spark))
    for i, name in enumerate(silver.CHECK_ORDER):
        broken = tables[name].withColumn(PLANTED_NULL[name], F.lit(None).cast(tables[name].schema[PLANTED_NULL[name]].dataType))
        results = silver.gate({name: broken})
        assert 53100 + i in failed_codes(results), name


def test_each_planted_duplicate_is_found(spark):
    tables = silver.clean_all(shop(spark))
    for i, name in enumerate(silver.CHECK_ORDER):
        results = silver.gate({name: tables[name].unionAll(tables[name])})
        assert failed_codes(results) == [53200 + i], name


def test_each_planted_orphan_is_found(spark):
    tables = silver.clean_all(shop(spark))
    for i, (child, parent, _) in enumerate(silver.RELATIONS):
        results = silver.gate({child: tables[child], parent: tables[parent].limit(0)})
        assert failed_codes(results) == [53300 + i], (child, parent)
        with pytest.raises(QualityError) as raised:
            enforce(results)
        assert raised.value.code == 53300 + i
        assert raised.value.failing_rows == tables[child].count()


def test_domain_findings_are_reported_but_do_not_stop(spark):
    data = shop(spark)
    data["reviews"] = raw_table(spark, "reviews", ("r1", "o1", "9"))
    data["order_items"] = data["order_items"].withColumn("price", F.lit("-1.00"))
    data["orders"] = data["orders"].withColumn("order_delivered_customer_date", F.lit("2001-01-01"))
    results = silver.gate(silver.clean_all(data))
    assert failed_codes(results) == [53500, 53600, 53702, 53703]
    enforce(results)


def test_row_counts_of_both_layers(spark):
    raw = {"reviews": raw_table(spark, "reviews", ("r1", "o1"), ("r1", "o1"), ("", "o1"))}
    results = silver.gate({"reviews": clean(raw["reviews"], TABLES["reviews"])}, raw)
    line = results.filter("code = 53404").first()
    assert (line.failing_rows, line.checked_rows, line.passed, line.severity) == (2, 3, False, WARNING)
    explained = count_check(1, "explained", raw["reviews"], raw["reviews"].limit(1), raw["reviews"].limit(2)).first()
    assert explained.passed


def test_rules_share_one_pass_and_allow_a_ratio(spark):
    df = table(spark, a=[1, None, -3, 4], b=[5, 4, 3, 2])
    rules = [
        Rule(1, "null", any_null("a", "b")),
        Rule(2, "null, one in four is fine", any_null("a"), max_bad_ratio=0.25),
        Rule(3, "sign", negative("a"), WARNING),
        Rule(4, "range", outside("b", 2, 4)),
        Rule(5, "order", earlier("b", "a")),
    ]
    results = row_checks(df, rules)
    assert [(r.code, r.failing_rows, r.checked_rows, r.passed) for r in results.orderBy("code").collect()] == [
        (1, 1, 4, False),
        (2, 1, 4, True),
        (3, 1, 4, False),
        (4, 1, 4, False),
        (5, 1, 4, False),
    ]
    plan = results._jdf.queryExecution().optimizedPlan().toString()
    assert plan.count("Aggregate") == 1
    with pytest.raises(QualityError) as raised:
        enforce(run_checks([results]))
    assert [f[0] for f in raised.value.failures] == [1, 4, 5]


def test_empty_tables_pass(spark):
    empty = table(spark, a=[1]).limit(0)
    results = run_checks([row_checks(empty, [Rule(1, "n", any_null("a"))]), unique_check(2, "u", empty, ["a"]), orphan_check(3, "o", empty, empty, "a")])
    assert failed_codes(results) == []


def test_null_keys(spark):
    child = table(spark, k=["a", None, "b", None])
    parent = table(spark, k=["a", None])
    assert rows(orphans(child, parent, "k"), "key") == [(None, 2), ("b", 1)]
    assert rows(duplicate_keys(child, ["k"])) == [(None, 2)]
    ratio = orphan_check(1, "o", child, parent, "k", max_bad_ratio=0.75).first()
    assert (ratio.failing_rows, ratio.checked_rows, ratio.passed) == (3, 4, True)


def test_unique_checks_count_rows(spark):
    df = table(spark, k=["a", "a", "a", "b", None, None], j=[1, 1, 2, 3, 4, 5])
    assert unique_check(1, "u", df, ["k"]).first().failing_rows == 5
    lines = key_checks({"t": df, "p": df.filter("k = 'a'").limit(1)}, [Unique(1, "k", "t", ("k",)), Unique(2, "kj", "t", ("k", "j")), Unique(3, "pk", "p", ("k",))],
                       [Reference(4, "r", "t", "k", "p", "k"), Reference(5, "r0", "t", "k", "p", "k", True)])
    assert [(r.code, r.failing_rows, r.checked_rows) for r in lines.collect()] == [(1, 5, 6), (2, 2, 6), (3, 0, 1), (4, 3, None), (5, 1, None)]


def test_gates_read_each_table_twice(spark, star):
    from tierstar.plans import gold

    plan = gold.gate({n: spark.createDataFrame(df.collect(), df.schema) for n, df in star.items()})._jdf.queryExecution().optimizedPlan().toString()
    assert plan.count("LogicalRDD") + plan.count("LocalRelation") <= 2 * len(star)


def test_dense_key_digits(spark):
    df = spark.range(3000).select(F.col("id").cast("string").alias("k"))
    for digits in (2, 3, 4):
        keyed = dense_key(df, ["k"], "n", digits)
        assert tuple(keyed.agg(F.min("n"), F.max("n"), F.count_distinct("n")).first()) == (1, 3000, 3000)


def test_any_row(spark):
    assert any_row(spark.range(1)) and not any_row(spark.range(0))


def test_heavy_keys_are_split_evenly(spark):
    lines = spark.range(10_000).select(
        F.when(F.col("id") % 3 == 0, "hot").otherwise(F.concat(F.lit("k"), F.col("id"))).alias("k"), "id"
    )
    counts = lines.groupBy("k").agg(F.count("*").alias("n"))
    heavy = heavy_keys(counts, "k", "n", rows_per_split=100)
    assert rows(heavy) == [("hot", 34)]
    lookup = counts.select("k", F.length("k").alias("v"))
    for how in ("inner", "left"):
        split = split_join(lines, lookup, "k", heavy, ["id"], how)
        plain = lines.join(lookup, "k", how)
        assert split.select("k", "id", "v").exceptAll(plain.select("k", "id", "v")).isEmpty()
        assert split.count() == 10_000


def test_hot_product_is_split_at_run_time(spark):
    """A third of the rows on one key: adaptive execution divides it between tasks, rows stay whole."""
    settings = {
        "spark.sql.autoBroadcastJoinThreshold": "-1",
        "spark.sql.adaptive.autoBroadcastJoinThreshold": "-1",
        "spark.sql.adaptive.skewJoin.skewedPartitionThresholdInBytes": "50KB",
        "spark.sql.adaptive.skewJoin.skewedPartitionFactor": "2",
        "spark.sql.adaptive.advisoryPartitionSizeInBytes": "50KB",
    }
    before = {k: spark.conf.get(k, None) for k in settings}
    try:
        for k, v in settings.items():
            spark.conf.set(k, v)
        lines = spark.range(0, 90_000, 1, 8).select(
            F.when(F.col("id") % 3 == 0, "hot").otherwise(F.concat(F.lit("k"), F.col("id") % 5000)).alias("product_id"),
            F.sha2(F.col("id").cast("string"), 256).alias("payload"),
        )
        dimension = dense_key(lines.select("product_id").distinct(), ["product_id"], "product_key")
        joined = resolve_key(lines, dimension, "product_id", "product_key")
        joined._jdf.collectToPython()
        assert "skew" in joined._jdf.queryExecution().executedPlan().toString().lower()
        assert joined.count() == 90_000
    finally:
        for k, v in before.items():
            spark.conf.unset(k) if v is None else spark.conf.set(k, v)
