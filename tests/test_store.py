import os

import pytest
from pyspark.sql import functions as F

from helpers import at, rows, shop, table
from tierstar.operators.keys import position_key
from tierstar.operators.quality import QualityError
from tierstar.plans import gold, pipeline, views
from tierstar.schemas import CORRUPT, STAR, TABLES
from tierstar.sources import catalog
from tierstar.sources.delimited import accepted, header_drift, read_raw, rejected
from tierstar.sources.store import ConcurrentPublish, LayerStore, RunInfo


def write(folder, name, text):
    path = os.path.join(folder, name)
    with open(path, "w", encoding="utf-8", newline="") as f:
        f.write(text)
    return path


SELLERS = TABLES["sellers"]
HEADER = "seller_id,seller_zip_code_prefix,seller_city,seller_state\n"


def test_quotes_commas_and_accents(spark, tmp_path):
    path = write(tmp_path, "s.csv", HEADER + '"s1","01000","são paulo, centro","SP"\ns2,,"",RJ\n')
    raw = accepted(read_raw(spark, path, SELLERS))
    assert rows(raw, "seller_id") == [("s1", "01000", "são paulo, centro", "SP"), ("s2", None, '""', "RJ")]


def test_quotes_can_be_kept(spark, tmp_path):
    path = write(tmp_path, "s.csv", HEADER + '"s1","01000","campinas","SP"\n')
    assert rows(accepted(read_raw(spark, path, SELLERS, raw_quotes=True))) == [('"s1"', '"01000"', '"campinas"', '"SP"')]


def test_wrong_field_counts_are_set_aside(spark, tmp_path):
    path = write(tmp_path, "s.csv", HEADER + "s1,1,a,SP\ns2,2\ns3,3,a,SP,extra\r\ns4,4,a,SP\r\n")
    raw = read_raw(spark, path, SELLERS)
    assert [r.seller_id for r in accepted(raw).select("seller_id").orderBy("seller_id").collect()] == ["s1", "s4"]
    assert sorted(r[CORRUPT].strip() for r in rejected(raw).select("seller_id", CORRUPT).collect()) == ["s2,2", "s3,3,a,SP,extra"]
    # no carriage return is left on the last column
    assert {r.seller_state for r in accepted(raw).collect()} == {"SP"}


def test_pipe_file_and_line_breaks(spark, tmp_path):
    spec = TABLES["reviews"]
    header = "|".join(c.raw for c in spec.columns) + "\n"
    path = write(tmp_path, "r.csv", header + "r1|o1|5||good, very good|2018-01-01|2018-01-02\n")
    assert accepted(read_raw(spark, path, spec)).first().review_comment_message == "good, very good"
    path = write(tmp_path, "m.csv", header + 'r1|o1|5||"two\nlines"|2018-01-01|2018-01-02\n')
    assert accepted(read_raw(spark, path, spec, multiline=True)).first().review_comment_message == "two\nlines"


def test_header_drift(spark, tmp_path):
    path = write(tmp_path, "s.csv", "seller_id,zip,seller_city,seller_state\ns1,1,a,SP\n")
    write(tmp_path, "t.csv", HEADER + "s2,1,a,SP\n")
    (drift,) = header_drift(spark, str(tmp_path), SELLERS).collect()
    assert drift.file.endswith("s.csv") and (drift.missing, drift.unexpected) == (["seller_zip_code_prefix"], ["zip"])
    with pytest.raises(Exception):
        read_raw(spark, path, SELLERS).collect()
    assert read_raw(spark, path, SELLERS, check_header=False).count() == 1


def csv_files(spark, folder, data):
    paths = {}
    for name, df in data.items():
        paths[name] = os.path.join(folder, f"{name}.in")
        df.coalesce(1).write.option("header", True).option("sep", TABLES[name].separator).option("escape", '"').csv(paths[name])
    return paths


def test_run_from_files_to_views(spark, tmp_path):
    sources = pipeline.read_sources(spark, csv_files(spark, str(tmp_path), shop(spark)))
    root = str(tmp_path / "lake")
    run = RunInfo(load_dts=at("2020-01-01 10:00:00"))
    star = pipeline.run_all(spark, root, sources, run)
    store = LayerStore(spark, root)

    assert set(store.current("bronze")) == {f"{t}_raw" for t in TABLES}
    assert set(store.current("silver")) == {f"{t}_clean" for t in TABLES}
    assert set(store.current("gold")) == {*STAR, "kpi_customer_metrics", "kpi_product_metrics"}
    assert store.exists("gold", "fact_orders") and not store.exists("gold", "other")
    log = {r.table_name: r.row_count for r in store.manifest().collect()}
    assert (log["order_items_raw"], log["orders_clean"], log["fact_orders"]) == (4, 2, 4)
    assert run.text() == f"run_id={run.run_id} load_dts=2020-01-01 10:00:00"

    fact = star["fact_orders"]
    assert [(f.name, f.dataType) for f in fact.schema] == [(f.name, f.dataType) for f in STAR["fact_orders"]]
    assert sorted(r.fact_order_key for r in fact.collect()) == [1, 2, 3, 4]
    stored = store.read("gold")["fact_orders"]
    assert {r.order_month_key for r in stored.collect()} == {201710, 201807}

    audit = store.audit()
    assert audit.filter("layer = 'silver'").count() == 9 + 39 + 9 and audit.filter("layer = 'gold'").count() == 23
    assert audit.filter(~F.col("passed") & (F.col("severity") == "critical")).isEmpty()

    catalog.register_views(views.all_views(star))
    total = spark.sql("select sum(total_amount) t, count(*) n from vw_order_line_metrics").first()
    assert (float(total.t), total.n) == (68.5, 4)
    assert len(spark.table("vw_order_line_metrics").columns) == 23
    customers = spark.sql("select * from vw_customer_metrics order by customer_id").collect()
    assert [(c.customer_id, c.order_count, c.order_line_count, float(c.gross_sales_amount)) for c in customers] == [("c1", 1, 3, 63.0), ("c2", 1, 1, 5.5)]

    catalog.ensure_layers(spark)
    catalog.ensure_layers(spark)
    for layer in catalog.LAYERS:
        catalog.register_layer(spark, store, layer)
    assert catalog.table_exists(spark, "gold.dim_date") and not catalog.table_exists(spark, "gold.dim_nothing")
    assert spark.table("silver.customers_clean").count() == 2


def test_loading_twice_gives_the_same_star(spark, tmp_path):
    root, keep = str(tmp_path), ["fact_order_key"]
    first = pipeline.run_all(spark, root, shop(spark))
    second = pipeline.run_all(spark, root, shop(spark))
    for name in first:
        a, b = first[name].drop(*keep), second[name].drop(*keep)
        assert a.exceptAll(b).isEmpty() and b.exceptAll(a).isEmpty(), name
    runs = {r.run_id for r in LayerStore(spark, root).manifest().collect()}
    assert len(runs) == 2


def test_failed_gate_leaves_the_published_layers(spark, tmp_path):
    root = str(tmp_path)
    pipeline.run_all(spark, root, shop(spark))
    store = LayerStore(spark, root)
    before = {layer: store.current(layer) for layer in ("silver", "gold")}

    data = shop(spark)
    data["customers"] = data["customers"].unionAll(data["customers"])
    data["payments"] = data["payments"].withColumn("order_id", F.lit("o9"))
    with pytest.raises(QualityError) as raised:
        pipeline.run_all(spark, root, data)
    assert [f[0] for f in raised.value.failures] == [53200, 53304]
    assert {layer: store.current(layer) for layer in ("silver", "gold")} == before
    failed = store.audit().filter(~F.col("passed") & (F.col("severity") == "critical"))
    assert sorted(r.code for r in failed.collect()) == [53200, 53304]


def test_gold_gate_finds_planted_faults(spark, tmp_path):
    star = pipeline.run_all(spark, str(tmp_path), shop(spark))

    def failed(**tables):
        return sorted(r.code for r in gold.gate(star | tables).filter(~F.col("passed")).collect())

    assert failed() == []
    fact = star["fact_orders"]
    assert failed(fact_orders=fact.unionAll(fact)) == [54200]
    assert failed(fact_orders=fact.withColumn("total_amount", F.lit(-1).cast("decimal(12,2)"))) == [54400]
    assert failed(dim_sellers=star["dim_sellers"].limit(1)) == [54302]
    assert failed(dim_date=star["dim_date"].filter("date_key <> 20171010")) == [54306]
    assert failed(dim_customers=star["dim_customers"].withColumn("customer_unique_id", F.lit(None).cast("string"))) == [54101]
    assert failed(dim_products=star["dim_products"].withColumn("product_id", F.lit("p1"))) == [54206]


def test_position_key_is_dense(spark, tmp_path):
    path = str(tmp_path / "t")
    spark.range(0, 1000, 1, 7).select("id", (F.col("id") % 3).alias("p")).write.partitionBy("p").parquet(path)
    stored = spark.read.parquet(path)
    keyed = position_key(stored, "k")
    facts = keyed.agg(F.count("*"), F.min("k"), F.max("k"), F.count_distinct("k"), F.count_distinct("id")).first()
    assert tuple(facts) == (1000, 1, 1000, 1000, 1000)


def test_empty_tables_and_text_partitions_keep_their_schema(spark, tmp_path):
    store, run = LayerStore(spark, str(tmp_path)), RunInfo()
    df = spark.createDataFrame([("007", 1)], "code string, n int")
    staged = [store.stage(run, "gold", "kept", df, ["code"]), store.stage(run, "gold", "empty", df.limit(0), ["code"])]
    store.publish(run, "gold", staged)
    read = store.read("gold")
    assert [r.code for r in read["kept"].collect()] == ["007"] and read["empty"].count() == 0
    assert {f.name: f.dataType for f in read["empty"].schema} == {f.name: f.dataType for f in df.schema}
    catalog.ensure_layers(spark)
    catalog.register_layer(spark, store, "gold")
    # Names are the same for every session of the application.
    named = spark.newSession().table("gold.empty")
    assert named.count() == 0 and {f.name: f.dataType for f in named.schema} == {f.name: f.dataType for f in df.schema}


@pytest.mark.parametrize("broken", ["no items", "no purchase time"])
def test_run_with_an_empty_fact(spark, tmp_path, broken):
    data = shop(spark)
    if broken == "no items":
        data["order_items"] = data["order_items"].limit(0)
    else:
        data["orders"] = data["orders"].withColumn("order_purchase_timestamp", F.lit("never"))
    pipeline.run_all(spark, str(tmp_path), data)
    assert LayerStore(spark, str(tmp_path)).read("gold")["fact_orders"].count() == 0


def test_empty_store(spark, tmp_path):
    store = LayerStore(spark, str(tmp_path / "none"))
    assert store.current("gold") == {} and store.manifest().isEmpty()


def test_publications_are_numbered_whatever_the_clock_says(spark, tmp_path, monkeypatch):
    from tierstar.sources import store as module

    store, df = LayerStore(spark, str(tmp_path)), spark.range(1)
    assert store.head() == 0
    first, second = RunInfo(), RunInfo()
    store.publish(first, "gold", [store.stage(first, "gold", "t", df)])
    monkeypatch.setattr(module, "utc_now", lambda: at("1999-01-01 00:00:00"))
    store.publish(second, "gold", [store.stage(second, "gold", "t", df.limit(0))])
    assert store.head() == 2 and second.run_id in store.current("gold")["t"] and store.row_counts("gold") == {"t": 0}


def test_of_runs_that_build_on_the_same_state_one_publishes(spark, tmp_path):
    from concurrent.futures import ThreadPoolExecutor

    store, df = LayerStore(spark, str(tmp_path)), spark.range(1)
    seen = store.head()
    staged = [(run, store.stage(run, "gold", "t", df)) for run in (RunInfo() for _ in range(4))]

    def publish(one, after):
        try:
            store.publish(one[0], "gold", [one[1]], after)
            return one[0].run_id
        except ConcurrentPublish:
            return None

    with ThreadPoolExecutor(4) as pool:
        published = [r for r in pool.map(lambda one: publish(one, seen), staged) if r]
        assert len(published) == 1 and published[0] in store.current("gold")["t"]
        # Those that build on nothing each get a number of their own.
        assert None not in list(pool.map(lambda one: publish(one, None), staged))
    log = store.manifest().filter("layer = 'gold'").collect()
    assert sorted(r.number for r in log) == [1, 2, 3, 4, 5] and store.head() == 5


def test_a_claim_without_a_publication_changes_nothing(spark, tmp_path):
    store, run = LayerStore(spark, str(tmp_path)), RunInfo()
    store.publish(run, "gold", [store.stage(run, "gold", "t", spark.range(1))])
    store._claim(None)  # The run that claimed it ended there.
    assert store.head() == 2 and run.run_id in store.current("gold")["t"]
    later = RunInfo()
    store.publish(later, "gold", [store.stage(later, "gold", "t", spark.range(2))], after=store.head())
    assert later.run_id in store.current("gold")["t"]


def test_a_run_leaves_views_that_other_sessions_find(spark, star, tmp_path):
    pipeline.run_all(spark, str(tmp_path), shop(spark), names="left_")
    other = spark.newSession()
    lines = other.table("left_gold.vw_order_line_metrics")
    expected = views.order_line_metrics(star)
    assert lines.columns == expected.columns and [f.dataType for f in lines.schema] == [f.dataType for f in expected.schema]
    assert lines.exceptAll(expected).isEmpty() and expected.exceptAll(lines).isEmpty()
    assert other.table("left_gold.vw_customer_metrics").count() == views.customer_metrics(star).count()
    # The names follow a later run; partition values keep the type they were stored with.
    pipeline.run_all(spark, str(tmp_path), shop(spark, order_items=[("o2", "1", "p2", "s2", "2018-07-30 03:24:27", "5.00", "0.50")]), names="left_")
    assert [r.order_id for r in other.table("left_gold.vw_order_line_metrics").collect()] == ["o2"]
    stored = LayerStore(spark, str(tmp_path)).read("gold")["fact_orders"].schema
    assert [(f.name, f.dataType) for f in other.table("left_gold.fact_orders").schema] == [(f.name, f.dataType) for f in stored]


def test_a_run_may_leave_the_catalog_alone(spark, tmp_path):
    before = {d.name for d in spark.catalog.listDatabases()}
    pipeline.run_all(spark, str(tmp_path), shop(spark), names=None)
    assert {d.name for d in spark.catalog.listDatabases()} == before
