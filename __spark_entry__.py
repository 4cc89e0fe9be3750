
from __future__ import annotations

import importlib.util
import os
import sys
import uuid
from collections.abc import Callable
from datetime import datetime

sys.path.insert(0, os.path.dirname(os.path.abspath(__file__)))

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

import oracles
import standins
from standins import Given
from tierstar import functions as fn
from tierstar.operators import aggregates, dedup, history, joins, keys, quality, quarantine, trends
from tierstar.operators.clean import clean, left_out, require
from tierstar.plans import analyses, colocated, gold, kpis, pipeline, silver, timecorrect, views
from tierstar.schemas import TABLES, ColumnSpec, TableSpec, conform
from tierstar.sources.delimited import accepted, header_drift, read_evolved, read_raw, rejected
from tierstar.sources.parts import PartedTable
from tierstar.sources.store import LayerStore, RunInfo, shared_folder
from tierstar.streaming.feed import Feed, live
from tierstar.streaming.incremental import newer_than, upsert

# The operators for training corpora may be taken out; everything else must then still work.
if importlib.util.find_spec("tierstar.llm") and importlib.util.find_spec("corpus_pipeline"):
    import corpus_pipeline
    from tierstar.llm import queries as corpus
else:
    corpus_pipeline = corpus = None

SMOKE = "/root/testdata/sf0.001"


def _doubles(df: DataFrame) -> DataFrame:
    """Decimals as doubles, so that values compare alike whatever client reads them."""
    return df.select(
        *[F.col(f.name).cast("double").alias(f.name) if isinstance(f.dataType, T.DecimalType) else F.col(f.name) for f in df.schema]
    )


def _scratch(spark: SparkSession) -> str:
    """A new folder in the shared folder the cluster names."""
    return f"{shared_folder(spark)}/{uuid.uuid4()}"


def _fact(clean: dict[str, DataFrame], star: dict[str, DataFrame], dates: DataFrame | None = None, **options) -> DataFrame:
    dimensions = [star[d] for d in ("dim_customers", "dim_products", "dim_sellers")]
    return gold.build_fact(
        clean["order_items"], clean["orders"], clean["payments"], clean["reviews"], *dimensions, dates, **options
    )


def _star(given: Given) -> dict[str, DataFrame]:
    clean_tables = standins.star_tables(given)
    star = gold.build_dimensions(clean_tables)
    star["fact_orders"] = _fact(clean_tables, star)
    return star


def _kept(given: Given, layer: str, tables: dict[str, DataFrame]) -> dict[str, DataFrame]:
    """Tables as a run stores them before its gate, which reads every table more than once."""
    store, run = LayerStore(given.spark, _scratch(given.spark)), RunInfo()
    return {name: store.stage(run, layer, name, df).df for name, df in tables.items()}


def _kept_star(given: Given) -> dict[str, DataFrame]:
    """The star stored, the fact resolved against the stored dimensions."""
    clean_tables = standins.star_tables(given)
    star = _kept(given, "gold", gold.build_dimensions(clean_tables))
    return star | _kept(given, "gold", {"fact_orders": _fact(clean_tables, star)})


def _star_of_kept(given: Given) -> dict[str, DataFrame]:
    """The star as views read it: lines, which three of its tables are made of, and dimensions stored, the fact built when it is read."""
    clean_tables = standins.star_tables(given)
    clean_tables |= _kept(given, "silver", {"order_items": clean_tables["order_items"]})
    star = _kept(given, "gold", gold.build_dimensions(clean_tables))
    return star | {"fact_orders": _fact(clean_tables, star)}


def _raw(given: Given, name: str) -> DataFrame:
    return standins.RAW[name](given)


def _cleaned(name: str) -> Callable[[Given], DataFrame]:
    return lambda given: clean(_raw(given, name), TABLES[name])


def _baseline_clean(given: Given) -> DataFrame:
    raw = _raw(given, "customers")
    return raw.select(*[fn.clean_text(F.col(c)).alias(c) for c in raw.columns])


def _safe_cast(given: Given) -> DataFrame:
    raw = _raw(given, "order_items")
    texts = raw.select(*[fn.clean_text(F.col(c)).alias(c) for c in raw.columns])
    return texts.select(
        "order_id",
        fn.try_int(F.col("order_item_id")).alias("as_int"),
        fn.try_unsigned_byte(F.col("freight_value")).alias("as_byte"),
        fn.try_money(F.col("price")).alias("as_money"),
        fn.try_float(F.col("price")).alias("as_float"),
        fn.try_seconds(F.col("shipping_limit_date")).alias("as_seconds"),
        fn.try_date(F.col("shipping_limit_date")).alias("as_date"),
    )


def _require_keys(given: Given) -> DataFrame:
    item = fn.try_int(fn.clean_text(F.col("order_item_id"))).alias("order_item_id")
    kept = require(_raw(given, "order_items").select(item), "order_item_id")
    return kept.groupBy(F.col("order_item_id").isNull().alias("was_null")).agg(F.count(F.lit(1)).alias("row_count"))


def _dedup_line_items(given: Given) -> DataFrame:
    key = ["l_orderkey", "l_linenumber"]
    ties = ["l_partkey", "l_suppkey", "l_quantity", "l_extendedprice", "l_discount", "l_tax", "l_returnflag", "l_linestatus"]
    return dedup.first_per_key(given["lineitem"], key, [F.col("l_shipdate").desc_nulls_last()], [F.col(c) for c in ties])


def _order_line_keys(given: Given) -> DataFrame:
    lines = standins.order_items(given).select("order_id", "order_item_id")
    return keys.dense_key(lines, ["order_id", "order_item_id"], "line_key", digits=4)


def _fact_line_keys(given: Given) -> DataFrame:
    """The keys by position in stored lines are dense and unique."""
    return keys.key_range(keys.position_key(given["lineitem"], "line_key"), "line_key")


def _published(given: Given) -> LayerStore:
    """A store with two clean tables and an empty one, partitioned, in its silver layer."""
    store, run = LayerStore(given.spark, _scratch(given.spark)), RunInfo()
    tables = {"customers_clean": standins.customers(given), "orders_clean": standins.orders(given)}
    staged = [store.stage(run, "silver", name, df) for name, df in tables.items()]
    staged.append(store.stage(run, "silver", "empty_clean", standins.orders(given).filter("order_id IS NULL"), ["order_status"]))
    store.publish(run, "silver", staged)
    return store


def _existence_gate(given: Given) -> DataFrame:
    """Asked of what the store has published."""
    store = _published(given)
    return silver.existence_gate(given.spark, {t for t in TABLES if store.exists("silver", silver.clean_name(t))})


def _resolve_product_key(given: Given) -> DataFrame:
    """Lines of unknown products leave: the dimension is restricted so that there are some."""
    products = gold.build_dim_products(standins.products(given), standins.category_translation(given))
    known = products.filter(F.col("product_category_name") != "economy")
    lines = keys.resolve_key(standins.order_items(given), known, "product_id", "product_key")
    return lines.select("order_id", "order_item_id", "product_key")


def _allocate_payment(given: Given) -> DataFrame:
    counts = aggregates.items_per_order(standins.order_items(given))
    paid = aggregates.payments_per_order(standins.payments(given))
    share = aggregates.allocate(F.col("order_payment_amount"), F.col("order_item_count"))
    return counts.join(paid, "order_id", "left").select(
        "order_id", "order_item_count", share.alias("allocated_payment_amount")
    )


def _fact_orders_calendar(given: Given) -> DataFrame:
    clean_tables = standins.star_tables(given)
    star = gold.build_dimensions(clean_tables)
    return _fact(clean_tables, star, star["dim_date"])


def _fact_orders_split(given: Given) -> DataFrame:
    """Every order of more than three lines counts as heavy and is split."""
    clean_tables = standins.star_tables(given)
    return _fact(clean_tables, gold.build_dimensions(clean_tables), rows_per_split=3)


def _fact_bucketed(given: Given) -> DataFrame:
    """Order tables stored in buckets of the order; orders of six lines or more lie beside them and are split."""
    clean_tables = standins.star_tables(given)
    store = LayerStore(given.spark, _scratch(given.spark))
    by_order = colocated.load_by_order(store, RunInfo(), clean_tables, buckets=16, rows_per_order=5)
    return colocated.build_fact(by_order, gold.build_dimensions(clean_tables), rows_per_split=3)


def _not_null_check(given: Given) -> DataFrame:
    texts = _baseline_clean(given)
    rules = [
        quality.Rule(1, "customers without unique id", quality.any_null("customer_unique_id")),
        quality.Rule(2, "customers without city", quality.any_null("customer_city"), quality.WARNING, 0.5),
    ]
    return quality.row_checks(texts, rules)


def _range_check(given: Given) -> DataFrame:
    rules = [
        quality.Rule(1, "negative balance", quality.negative("c_acctbal"), quality.WARNING),
        quality.Rule(2, "balance outside -1000..10000", quality.outside("c_acctbal", -1000, 10000)),
    ]
    return quality.row_checks(given["customer"], rules)


def _orphans(given: Given) -> DataFrame:
    """Pending orders are left out of the parents, so that their lines are orphans."""
    parents = given["orders"].filter(F.col("o_orderstatus") != "P")
    return joins.orphans(given["lineitem"], parents, "l_orderkey", "o_orderkey")


def _row_count_compare(given: Given) -> DataFrame:
    raw = _raw(given, "reviews")
    message = "rows of reviews_raw missing from reviews_clean"
    return quality.count_check(53400, message, raw, clean(raw, TABLES["reviews"]))


def _row_count_explained(given: Given) -> DataFrame:
    """The same comparison, with the rows that cleaning leaves out accounted for."""
    raw = _raw(given, "reviews")
    message = "rows of reviews_raw missing from reviews_clean"
    return quality.count_check(53400, message, raw, clean(raw, TABLES["reviews"]), left_out(raw, TABLES["reviews"]))


def _customer_history(given: Given, first_at: datetime = datetime(2020, 1, 1), second_at: datetime = datetime(2021, 1, 1)) -> DataFrame:
    """Between two snapshots customers appear, vanish and move."""
    balance, city = F.col("c_acctbal"), F.col("c_mktsegment").alias("customer_city")
    key = F.col("c_custkey").cast("string").alias("customer_id")
    before = given["customer"].filter(F.col("c_mktsegment") != "BUILDING").select(key, city)
    moved = F.when(balance < 0, "moved").otherwise(F.col("c_mktsegment")).alias("customer_city")
    after = given["customer"].filter(balance <= 9000).select(key, moved)
    first = history.start_history(before, first_at)
    return history.merge_history(first, after, "customer_id", ["customer_city"], second_at)


def _upsert_latest(given: Given) -> DataFrame:
    """Events up to mid-January are there already, later ones arrive; one row per user and type stays."""
    events, mark, key = given["events"], datetime(2024, 1, 15), ["user_id", "event_type"]
    order = [F.col("ts").desc_nulls_last(), F.col("event_id")]
    existing = dedup.first_per_key(events.filter(F.col("ts") <= F.lit(mark).cast("timestamp_ntz")), key, order)
    return upsert(existing, newer_than(events, "ts", mark), key, order, existing_unique=True)


def _changed_star(given: Given) -> LayerStore:
    """A star published as it was before some lines came, changed and went, and its KPIs refreshed by just these lines."""
    store = LayerStore(given.spark, _scratch(given.spark))
    clean_tables, first = standins.star_tables(given), RunInfo()
    staged = {name: store.stage(first, "gold", name, df) for name, df in gold.build_dimensions(clean_tables).items()}
    after = store.stage(first, "scratch", "fact_orders", _fact(clean_tables, {name: t.df for name, t in staged.items()})).df
    lot = F.pmod(F.xxhash64("order_id", "order_item_id"), F.lit(7))
    old = after.filter(lot == 1).withColumns({"order_id": F.concat("order_id", F.lit("x")), "total_amount": F.col("total_amount") + 1, "review_score": F.lit(None).cast(after.schema["review_score"].dataType)})
    extra = after.filter(lot == 2).withColumn("order_item_id", F.col("order_item_id") + 1000)
    gone = old.unionByName(extra.select(old.columns))
    before = after.filter(lot > 1).unionByName(gone)
    staged["fact_orders"] = store.stage(first, "gold", "fact_orders", before)
    states = kpis.stage_kpis(store, first, {name: t.df for name, t in staged.items()})
    store.publish_layers(first, {"gold": [*staged.values(), *[t for t in states if t.name in kpis.KPIS]], kpis.LAYER: states})
    kpis.refresh_kpis(store, RunInfo(), gone, after.filter(lot < 2))
    return store


def _change_feed(given: Given) -> DataFrame:
    """Events as changes of their user: errors delete. They arrive in three lots, the last lot twice and one after later ones."""
    changes = given["events"].withColumn("operation", F.when(F.col("event_type") == "error", "delete").otherwise("update"))
    root = _scratch(given.spark)
    feed = Feed(LayerStore(given.spark, root), "users", ["user_id"], "event_id", "operation")
    for lot in (2, 0, 2, 1):
        changes.filter(F.col("event_id") % 3 == lot).write.mode("append").parquet(f"{root}/inbox")
        feed.run(given.spark, f"{root}/inbox", changes.schema, f"{root}/checkpoint")
    return live(feed.table())


def _fact_asof_customer(given: Given) -> DataFrame:
    """Customers of the history of two snapshots, looked up at the time of purchase."""
    start = datetime(1995, 6, 1)
    versions = _customer_history(given, start, datetime(1998, 1, 1)).withColumn("version_from", F.col("valid_from"))
    return timecorrect.lines_with_customer_version(standins.order_items(given), standins.orders(given), versions, ["customer_city", "version_from"])


def _history_backdated(given: Given) -> DataFrame:
    """The event type as an attribute of the user, absent after an error; events are reported in three lots that interleave in time."""
    present = (F.col("event_type") != "error").cast("int")
    changes = given["events"].select("user_id", F.col("ts").cast("timestamp_ntz").alias("valid_from"), "event_type", present.alias("is_present"), F.col("event_id").alias("recorded"))
    store, found, points = LayerStore(given.spark, _scratch(given.spark)), None, None
    for lot in (2, 0, 1):
        run = RunInfo()
        found, points = history.apply_changes(found, points, changes.filter(F.col("recorded") % 3 == lot), "user_id", ["event_type"])
        found, points = store.stage(run, "gold", "history", found).df, store.stage(run, "gold", "points", points).df
    return found


def _fact_month_refresh(given: Given) -> DataFrame:
    """A fact stored by month before some orders of two months changed, of which only these months and the one that orders leave are written again."""
    store, first = LayerStore(given.spark, _scratch(given.spark)), RunInfo()
    after = store.stage(first, "scratch", "fact_orders", _star(given)["fact_orders"]).df.withColumn("order_month_key", gold.order_month_key())
    lot = F.pmod(F.xxhash64("order_id"), F.lit(3))
    some = F.col("order_month_key").isin(199703, 199707) & (lot < 2)
    came = after.filter(some)
    # Before, a third of these orders was not there, and a third had another month and other amounts.
    moved = came.filter(lot == 1).withColumns({"order_month_key": F.lit(199709), "total_amount": (F.col("total_amount") + 1).cast(after.schema["total_amount"].dataType)})
    table = PartedTable(store, "gold", "fact_orders", "order_month_key")
    store.publish(first, "gold", [table.stage(first, after.filter(~some).unionByName(moved.select(after.columns)))])
    run = RunInfo()
    store.publish(run, "gold", [table.replace(run, after.schema, came, came, "order_id")])
    return table.read(after.schema).drop("order_month_key")


def _quarantined_rows(given: Given) -> DataFrame:
    """Lines set apart by a first run that lacks pending orders, and offered again to a second one that has them."""
    store, lines = LayerStore(given.spark, _scratch(given.spark)), given["lineitem"]
    rules = [quality.Rule(1, "large quantity", F.col("l_quantity") > 45, quality.WARNING)]
    uniques = [quality.Unique(2, "line numbers occur once", "lineitem", ("l_orderkey", "l_linenumber"))]
    references = [quality.Reference(3, "order known", "lineitem", "l_orderkey", "orders", "o_orderkey")]

    def run(offered: DataFrame, orders: DataFrame) -> DataFrame:
        now = RunInfo()
        keep = lambda keys: store.stage(now, "quarantine", "broken_keys", keys).df
        return store.stage(now, "quarantine", "tagged", quarantine.tag(offered, rules, uniques, references, {"orders": orders}, keep)).df

    _, failing = quarantine.part(run(lines, given["orders"].filter(F.col("o_orderstatus") != "P")))
    again = run(quarantine.offer(lines.limit(0), failing, ["l_orderkey", "l_linenumber"]), given["orders"])
    broken = F.array_join(F.transform(quarantine.BROKEN, lambda x: x.cast("string")), ",")
    return again.select("l_orderkey", "l_linenumber", "l_partkey", "l_quantity", broken.alias("broken"))


def _audited(given: Given) -> LayerStore:
    """Each day of events is a run; its checks, one per event type, fail if more than five values are below 10."""
    store = LayerStore(given.spark, _scratch(given.spark))
    day = F.date_trunc("day", "ts").cast("timestamp_ntz")
    bad = F.count_if(F.col("value") < 10)
    lines = given["events"].groupBy(day.alias("load_dts"), "event_type").agg(bad.alias("failing_rows"), F.count(F.lit(1)).alias("checked_rows"))
    code = F.pmod(F.crc32("event_type"), F.lit(1000)).cast("int").alias("code")
    results = lines.select(code, F.lit("warning").alias("severity"), F.col("event_type").alias("message"), "failing_rows", "checked_rows", (F.col("failing_rows") <= 5).alias("passed"), "load_dts", F.date_format("load_dts", "yyyyMMdd").alias("run_id"))
    # As a run writes them: one folder per layer and run.
    results.withColumn("layer", F.lit("bronze")).write.partitionBy("layer", "run_id").json(f"{store.root}/audit")
    return store


def _contract_limits(given: Given) -> DataFrame:
    """Numbers rounded: quotients of whole numbers are not the same to the last digit everywhere."""
    found = trends.contract_limits(_audited(given).audit())
    shares = {c: F.round(c, 9).alias(c) for c in ("share", "median_share", "deviation", "limit_share")}
    return found.select(*[shares.get(c, F.col(c)) for c in found.columns])


def _observed_rows(given: Given) -> DataFrame:
    """The range checks, observed while the customers are written."""
    rules = [
        quality.Rule(1, "negative balance", quality.negative("c_acctbal"), quality.WARNING),
        quality.Rule(2, "balance outside -1000..10000", quality.outside("c_acctbal", -1000, 10000)),
    ]
    store = LayerStore(given.spark, _scratch(given.spark))
    return store.stage_observed(RunInfo(), "silver", "customer", given["customer"], rules)[1]


PARTS = TableSpec(
    "parts",
    (ColumnSpec("part_id", "int"), ColumnSpec("part_name", "text"), ColumnSpec("part_brand", "text"), ColumnSpec("part_type", "text")),
    required=("part_id",),
    key=("part_id",),
    separator="|",
)


def _raw_scan(given: Given) -> DataFrame:
    """The parts written as delimited text, read back under a declared schema and typed."""
    names = [c.name for c in PARTS.columns]
    folder = _scratch(given.spark)
    parts = given["part"].select("p_partkey", "p_name", "p_brand", "p_type").toDF(*names)
    parts.write.option("header", True).option("sep", "|").option("quoteAll", True).csv(folder)
    typed = clean(accepted(read_raw(given.spark, folder, PARTS)), PARTS)
    return typed.withColumn("part_id", F.col("part_id").cast("long"))


def _verbatim(lines: DataFrame, header: str, folder: str) -> None:
    """Lines of text as files that begin with a header line."""
    lines.toDF(header).write.mode("append").option("header", True).option("sep", "\u0001").option("quote", "").option("escapeQuotes", False).csv(folder)


COMMA = TableSpec("parts", PARTS.columns, PARTS.required, PARTS.key)


def _raw_scan_comma(given: Given) -> DataFrame:
    """Parts as comma files: names hold commas in quotes, some lines are a field short, some a field long."""
    folder, tenth = _scratch(given.spark), F.pmod("p_partkey", F.lit(10))
    name = F.concat(F.lit('"'), "p_name", F.lit(', new"'))
    short, long = F.concat_ws(",", "p_partkey", name, "p_brand"), F.concat_ws(",", "p_partkey", name, "p_brand", "p_type", F.lit("more"))
    line = F.when(tenth == 0, short).when(tenth == 1, long).otherwise(F.concat_ws(",", "p_partkey", name, "p_brand", "p_type"))
    _verbatim(given["part"].select(line), "part_id,part_name,part_brand,part_type", folder)
    raw = read_raw(given.spark, folder, COMMA)
    good = clean(accepted(raw), COMMA).withColumns({"part_id": F.col("part_id").cast("long"), "line": F.lit(None).cast("string")})
    bad = rejected(raw).select(F.col("part_id").cast("long").alias("part_id"), F.col("_corrupt_record").alias("line"))
    return good.unionByName(bad, allowMissingColumns=True)


def _versions(given: Given) -> str:
    """Parts as pipe files of three years: as declared; in another order under an earlier name; with a column less and one more."""
    folder, third, part = _scratch(given.spark), F.pmod("p_partkey", F.lit(3)), given["part"]
    _verbatim(part.filter(third == 0).select(F.concat_ws("|", "p_partkey", "p_name", "p_brand", "p_type")), "part_id|part_name|part_brand|part_type", folder)
    _verbatim(part.filter(third == 1).select(F.concat_ws("|", "p_type", "p_brand", "p_partkey", "p_name")), "part_type|part_brand|part_id|title", folder)
    _verbatim(part.filter(third == 2).select(F.concat_ws("|", "p_partkey", "p_size", "p_name", "p_type")), "part_id|part_size|part_name|part_type", folder)
    return folder


def _evolved_scan(given: Given) -> DataFrame:
    raw = read_evolved(given.spark, _versions(given), PARTS, {"title": "part_name"})
    return clean(accepted(raw), PARTS).withColumn("part_id", F.col("part_id").cast("long"))


def _header_drift(given: Given) -> DataFrame:
    """Files by what their headers lack and have in excess; how many files there are of a kind is up to the writer."""
    found = header_drift(given.spark, _versions(given), PARTS)
    return found.select(F.array_join("missing", ",").alias("missing"), F.array_join("unexpected", ",").alias("unexpected")).distinct()


def _texts(given: Given) -> dict[str, DataFrame]:
    """The given tables as raw text, blanks and quotes around every value."""
    return {
        name: df.select(*[F.concat(F.lit(' "'), F.col(c).cast("string"), F.lit('"')).alias(TABLES[name].column(c).raw) for c in df.columns])
        for name, df in standins.clean_tables(given).items()
    }


def _star_pipeline(given: Given) -> DataFrame:
    """The whole run on the given tables rendered as text: raw, clean, gate, star, gate, published KPIs."""
    root = _scratch(given.spark)
    pipeline.run_all(given.spark, root, _texts(given))
    return LayerStore(given.spark, root).read("gold")["kpi_product_metrics"]


def _catalog_view(name: str) -> Callable[[Given], DataFrame]:
    """A view that a run leaves in the catalog, read by its name alone."""

    def read(given: Given) -> DataFrame:
        prefix = f"run_{uuid.uuid4().hex}_"
        pipeline.run_all(given.spark, _scratch(given.spark), _texts(given), names=prefix)
        return given.spark.table(f"{prefix}gold.{name}")

    return read


def _audit_of_failed_run(given: Given) -> DataFrame:
    """Orders whose number 7 divides arrive twice: the run stops, its findings stay, nothing is published."""
    store, run = LayerStore(given.spark, _scratch(given.spark)), RunInfo()
    texts = _texts(given)
    orders = texts["orders"]
    number = F.regexp_extract("order_id", "[0-9]+", 0).cast("long")
    texts["orders"] = orders.unionAll(orders.filter(number % 7 == 0))
    raw = pipeline.load_bronze(store, run, texts)
    try:
        pipeline.load_silver(store, run, raw)
    except quality.QualityError:
        found = store.audit().filter((F.col("run_id") == run.run_id) & (F.col("severity") == quality.CRITICAL) & ~F.col("passed"))
        return found.select("layer", "code", "failing_rows", "checked_rows", F.lit(len(store.current("silver"))).alias("published"))
    raise AssertionError("a run with repeated orders was published")


QUERIES: dict[str, Callable[[Given], DataFrame]] = {
    "raw_row_counts": lambda g: aggregates.row_counts(standins.raw_tables(g)),
    "baseline_clean": _baseline_clean,
    "safe_cast": _safe_cast,
    "require_keys": _require_keys,
    **{f"clean_{name}": _cleaned(name) for name in TABLES},
    "dedup_latest": lambda g: dedup.latest_per_key(g["events"], ["user_id"], "ts"),
    "dedup_line_items": _dedup_line_items,
    "dim_date": lambda g: gold.build_dim_date(standins.orders(g), standins.order_items(g)),
    "dim_customers": lambda g: gold.build_dim_customers(standins.customers(g)),
    "dim_sellers": lambda g: gold.build_dim_sellers(standins.sellers(g)),
    "dim_products": lambda g: gold.build_dim_products(standins.products(g), standins.category_translation(g)),
    "order_line_keys": _order_line_keys,
    "resolve_product_key": _resolve_product_key,
    "items_per_order": lambda g: aggregates.items_per_order(standins.order_items(g)),
    "payments_per_order": lambda g: aggregates.payments_per_order(standins.payments(g)),
    "order_review_score": lambda g: aggregates.order_review_score(standins.reviews(g)),
    "allocate_payment": _allocate_payment,
    "fact_orders": lambda g: _star(g)["fact_orders"],
    "fact_orders_calendar": _fact_orders_calendar,
    "fact_orders_split": _fact_orders_split,
    "fact_bucketed": _fact_bucketed,
    "order_line_metrics": lambda g: views.order_line_metrics(_star_of_kept(g)),
    "customer_metrics": lambda g: views.customer_metrics(_star(g)),
    "product_metrics": lambda g: views.product_metrics(_star(g)),
    "revenue_by_month": lambda g: analyses.revenue_by_month(_star(g)),
    "sales_by_category": lambda g: analyses.sales_by_category(_star(g)),
    "delivery_trend": lambda g: analyses.delivery_trend(_star(g)),
    "not_null_check": _not_null_check,
    "duplicate_keys": lambda g: quality.duplicate_keys(g["lineitem"], ["l_orderkey", "l_linenumber"]),
    "orphans": _orphans,
    "range_check": _range_check,
    "row_count_compare": _row_count_compare,
    "row_count_explained": _row_count_explained,
    "rows_left_out": lambda g: left_out(_raw(g, "reviews"), TABLES["reviews"]).agg(F.sum("row_count").alias("row_count")),
    "fact_line_keys": _fact_line_keys,
    "manifest_rows": lambda g: _published(g).manifest().select("layer", "table_name", "row_count"),
    "existence_gate": _existence_gate,
    "silver_gate": lambda g: silver.gate(silver.clean_all(standins.raw_tables(g))),
    "gold_gate": lambda g: gold.gate(_kept_star(g)),
    "customer_history": _customer_history,
    "upsert_latest": _upsert_latest,
    "kpi_increment": lambda g: _changed_star(g).read("gold")["kpi_customer_metrics"],
    "kpi_increment_products": lambda g: _changed_star(g).read("gold")["kpi_product_metrics"],
    "change_feed": _change_feed,
    "fact_asof_customer": _fact_asof_customer,
    "history_backdated": _history_backdated,
    "fact_month_refresh": _fact_month_refresh,
    "quarantined_rows": _quarantined_rows,
    "audit_trend": lambda g: trends.audit_trend(_audited(g).audit()),
    "contract_limits": _contract_limits,
    "observed_rows": _observed_rows,
    "raw_scan": _raw_scan,
    "raw_scan_comma": _raw_scan_comma,
    "evolved_scan": _evolved_scan,
    "header_drift": _header_drift,
    "star_pipeline": _star_pipeline,
    "catalog_line_view": _catalog_view("vw_order_line_metrics"),
    "audit_of_failed_run": _audit_of_failed_run,
}


def entry(spark: SparkSession) -> DataFrame:
    """Product KPIs of the star built from the given tables."""
    return _doubles(views.product_metrics(_star(Given(spark, SMOKE))))


def queries() -> dict[str, Callable[[SparkSession, str], DataFrame]]:
    def bind(build: Callable[[Given], DataFrame]) -> Callable[[SparkSession, str], DataFrame]:
        return lambda spark, folder: _doubles(build(Given(spark, folder)))

    found = {name: bind(build) for name, build in QUERIES.items()}
    return found if corpus is None else found | corpus.QUERIES | {"pipeline": corpus_pipeline.run}


def oracle_sql() -> dict[str, str]:
    found = dict(oracles.ORACLES)
    if corpus is not None:
        found |= corpus.ORACLES
        if corpus_pipeline.ORACLE_SQL:
            found["pipeline"] = corpus_pipeline.ORACLE_SQL
    return found
