"""The given tables in the roles of the shop tables: as clean typed tables, and as raw text.

Nothing here is fixed data: every row derives from a row of the given tables, so all work grows
with them. ``clean_tables`` feeds the star; ``raw_tables`` renders the same rows as untidy text
(blanks, quotes, unparseable values) so that cleaning has something to do.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from tierstar.operators.clean import clean
from tierstar.schemas import GEOLOCATION

MONEY = "decimal(10,2)"


def from_cents(c: str) -> Column:
    return (F.col(c).cast("decimal(10,0)") * F.lit("0.01").cast("decimal(2,2)")).cast(MONEY)


class Given:
    """The given tables of one folder; each is opened once however many roles it plays."""

    def __init__(self, spark: SparkSession, folder: str):
        self.spark, self.folder, self._opened = spark, folder, {}

    def __getitem__(self, name: str) -> DataFrame:
        if name not in self._opened:
            self._opened[name] = self.spark.read.parquet(f"{self.folder}/{name}.parquet")
        return self._opened[name]


def text(c: str) -> Column:
    return F.col(c).cast("string")


def order_lines(given: Given) -> DataFrame:
    """One line per order and line number. The given lines repeat these keys; their amounts are added up, in cents."""
    return given["lineitem"].groupBy("l_orderkey", "l_linenumber").agg(
        F.max("l_partkey").alias("l_partkey"),
        F.max("l_suppkey").alias("l_suppkey"),
        F.max("l_shipdate").alias("l_shipdate"),
        F.sum(F.round(F.col("l_extendedprice") * 100).cast("long")).alias("amount"),
        F.sum(F.round(F.col("l_quantity") * 100).cast("long")).alias("freight"),
    )


def customers(given):
    people = given["customer"].join(
        given["nation"], F.col("c_nationkey") == F.col("n_nationkey")
    )
    return people.select(
        text("c_custkey").alias("customer_id"),
        F.col("c_name").alias("customer_unique_id"),
        F.lpad(text("c_nationkey"), 5, "0").alias("customer_zip_code_prefix"),
        F.lower("c_mktsegment").alias("customer_city"),
        F.right("n_name", F.lit(2)).alias("customer_state"),
    )


def sellers(given):
    sellers = given["supplier"].join(
        given["nation"], F.col("s_nationkey") == F.col("n_nationkey")
    )
    return sellers.select(
        text("s_suppkey").alias("seller_id"),
        F.lpad(text("s_nationkey"), 5, "0").alias("seller_zip_code_prefix"),
        F.col("s_name").alias("seller_city"),
        F.right("n_name", F.lit(2)).alias("seller_state"),
    )


def products(given):
    size = F.col("p_size")
    return given["part"].select(
        text("p_partkey").alias("product_id"),
        F.lower("p_type").alias("product_category_name"),
        F.length("p_name").alias("product_name_length"),
        (size * 10).alias("product_description_length"),
        size.cast("smallint").alias("product_photos_qty"),
        (size * 100).alias("product_weight_g"),
        (size + 10).alias("product_length_cm"),
        (size + 5).alias("product_height_cm"),
        (size + 1).alias("product_width_cm"),
    )


def category_translation(given):
    """Every product type but one has an English name, so one category stays untranslated."""
    types = given["part"].select("p_type").distinct().filter(F.col("p_type") != "ECONOMY")
    return types.select(
        F.lower("p_type").alias("product_category_name"),
        F.concat(F.initcap("p_type"), F.lit(" goods")).alias("product_category_name_english"),
    )


def orders(given):
    day = F.col("o_orderdate")

    def at(days_and_hours: str) -> Column:
        return F.expr(f"o_orderdate + make_dt_interval({days_and_hours})")

    return given["orders"].select(
        text("o_orderkey").alias("order_id"),
        text("o_custkey").alias("customer_id"),
        F.col("o_orderstatus").alias("order_status"),
        day.alias("order_purchase_timestamp"),
        F.when(F.col("o_orderstatus") != "P", at("1, 6")).alias("order_approved_at"),
        F.when(F.col("o_orderstatus") == "F", at("3, 12")).alias("order_delivered_carrier_date"),
        F.when(F.col("o_orderstatus") == "F", at("10 + dayofmonth(o_orderdate), 18")).alias(
            "order_delivered_customer_date"
        ),
        F.date_add(day.cast("date"), 30).alias("order_estimated_delivery_date"),
    )


def order_items(given):
    return order_lines(given).select(
        text("l_orderkey").alias("order_id"),
        F.col("l_linenumber").alias("order_item_id"),
        text("l_partkey").alias("product_id"),
        text("l_suppkey").alias("seller_id"),
        F.col("l_shipdate").alias("shipping_limit_date"),
        from_cents("amount").alias("price"),
        from_cents("freight").alias("freight_value"),
    )


def payments(given):
    """Orders with status P are unpaid; urgent ones are paid in two parts, the second a voucher."""
    paid = given["orders"].filter(F.col("o_orderstatus") != "P")
    urgent = F.col("o_orderpriority") == "1-URGENT"
    parts = F.when(urgent, F.array(F.lit(1), F.lit(2))).otherwise(F.array(F.lit(1)))
    part = F.col("part")
    return paid.withColumn("part", F.explode(parts)).select(
        text("o_orderkey").alias("order_id"),
        part.alias("payment_sequential"),
        F.when(part == 1, "credit_card").otherwise("voucher").alias("payment_type"),
        F.when(part == 1, F.left("o_orderpriority", F.lit(1)).cast("int")).otherwise(1).alias("payment_installments"),
        F.when(part == 1, F.col("o_totalprice").cast(MONEY)).otherwise(F.lit(25).cast(MONEY)).alias("payment_value"),
    )


def reviews(given):
    """One review per delivered order, a second one for urgent orders; low-priority orders give no score."""
    reviewed = given["orders"].filter(F.col("o_orderstatus") != "O")
    urgent = F.col("o_orderpriority") == "1-URGENT"
    parts = F.when(urgent, F.array(F.lit("a"), F.lit("b"))).otherwise(F.array(F.lit("a")))
    score = F.left("o_orderpriority", F.lit(1)).cast("smallint")
    return reviewed.withColumn("part", F.explode(parts)).select(
        F.concat(text("o_orderkey"), F.col("part")).alias("review_id"),
        text("o_orderkey").alias("order_id"),
        F.when(F.col("part") == "b", F.lit(4).cast("smallint"))
        .when(F.col("o_orderpriority") != "5-LOW", score)
        .alias("review_score"),
        F.lit(None).cast("string").alias("review_comment_title"),
        F.col("o_orderpriority").alias("review_comment_message"),
        F.expr("o_orderdate + make_dt_interval(20)").alias("review_creation_date"),
        F.expr("o_orderdate + make_dt_interval(21)").alias("review_answer_timestamp"),
    )


def star_tables(given: Given) -> dict[str, DataFrame]:
    """The clean tables the star is built from."""
    builders = (customers, sellers, products, category_translation, orders, order_items, payments, reviews)
    return {f.__name__: f(given) for f in builders}


def clean_tables(given: Given) -> dict[str, DataFrame]:
    """All nine clean tables."""
    return star_tables(given) | {"geolocation": geolocation(given)}


def geolocation(given):
    """One place per zip code: the clean form of ``raw_geolocation``."""
    return clean(raw_geolocation(given), GEOLOCATION)


def _untidy(c: Column) -> Column:
    """Text as a careless export leaves it: quoted, with blanks around the quotes."""
    return F.concat(F.lit('  "'), c, F.lit('" '))


def _stamp(c: str) -> Column:
    return F.date_format(c, "yyyy-MM-dd HH:mm:ss")


def raw_customers(given):
    """Customers with a negative balance come without a city, those in debt by more than 500 without a unique id."""
    people = given["customer"].join(
        given["nation"], F.col("c_nationkey") == F.col("n_nationkey")
    )
    return people.select(
        _untidy(text("c_custkey")).alias("customer_id"),
        F.when(F.col("c_acctbal") < -500, '""').otherwise(_untidy(F.col("c_name"))).alias("customer_unique_id"),
        _untidy(F.lpad(text("c_nationkey"), 7, "0")).alias("customer_zip_code_prefix"),
        F.when(F.col("c_acctbal") < 0, '"   "').otherwise(_untidy(F.lower("c_mktsegment"))).alias("customer_city"),
        F.concat(F.lit(' "'), F.lower("n_name"), F.lit('"')).alias("customer_state"),
    )


def raw_sellers(given):
    return given["supplier"].select(
        _untidy(text("s_suppkey")).alias("seller_id"),
        F.when(F.col("s_acctbal") < 0, "  ").otherwise(text("s_nationkey")).alias("seller_zip_code_prefix"),
        F.concat(F.lit(" "), F.col("s_name")).alias("seller_city"),
        F.lower(F.right("s_name", F.lit(3))).alias("seller_state"),
    )


def raw_products(given):
    """Sizes above 40 are exported as decimals, which are no integers; photo counts run past one byte."""
    size = text("p_size")
    return given["part"].select(
        _untidy(text("p_partkey")).alias("product_id"),
        F.concat(F.lit('"'), F.lower("p_type"), F.lit('"')).alias("product_category_name"),
        F.length("p_name").cast("string").alias("product_name_lenght"),
        F.concat(F.lit(" "), size, F.lit(" ")).alias("product_description_lenght"),
        (F.col("p_size") * 8 - 20).cast("string").alias("product_photos_qty"),
        F.when(F.col("p_size") > 40, F.concat(size, F.lit(".0"))).otherwise(size).alias("product_weight_g"),
        F.concat(F.lit("+"), size).alias("product_length_cm"),
        F.concat(F.lit("-"), size).alias("product_height_cm"),
        F.concat(size, F.lit("cm")).alias("product_width_cm"),
    )


def _untidy_key(c: Column) -> Column:
    """As ``_untidy``; in every other event another copy of the key has a blank inside its quotes."""
    return F.when(F.col("event_id") % 2 == 0, F.concat(F.lit('"'), c, F.lit(' "'))).otherwise(_untidy(c))


def raw_geolocation(given):
    """Places of the events' users: many per zip code, some without one of the coordinates."""
    return given["events"].select(
        _untidy_key(F.lpad(text("user_id"), 5, "0")).alias("geolocation_zip_code_prefix"),
        F.when(F.col("event_type") != "error", F.concat(F.lit("-"), text("event_id"), F.lit(".25"))).alias("geolocation_lat"),
        F.when(F.col("event_type") == "click", "unknown").otherwise(F.concat(text("event_id"), F.lit(".5"))).alias("geolocation_lng"),
        F.concat(F.col("event_type"), F.lit(" "), text("event_id")).alias("geolocation_city"),
        F.lower("event_type").alias("geolocation_state"),
    )


def raw_category_translation(given):
    types = given["part"].select("p_type").distinct()
    return types.select(
        F.concat(F.lit('"'), F.lower("p_type"), F.lit('  "')).alias("product_category_name"),
        F.when(F.col("p_type") == "ECONOMY", '""').otherwise(F.initcap("p_type")).alias("product_category_name_english"),
    )


def raw_orders(given):
    """Times in several spellings: seconds, fractions that round up to the next day, dates, and text that is none."""
    status, day = F.col("o_orderstatus"), F.date_format("o_orderdate", "yyyy-MM-dd")
    return given["orders"].select(
        _untidy(text("o_orderkey")).alias("order_id"),
        F.when(F.col("o_totalprice") < 2000, '" "').otherwise(_untidy(text("o_custkey"))).alias("customer_id"),
        _untidy(F.col("o_orderpriority")).alias("order_status"),
        F.when(F.col("o_orderpriority") == "5-LOW", "10-02").otherwise(_stamp("o_orderdate")).alias("order_purchase_timestamp"),
        F.when(status == "F", F.concat(F.lit('"'), day, F.lit(' 23:59:59.6"'))).otherwise(day).alias("order_approved_at"),
        F.when(status != "P", F.concat(day, F.lit("T08:30"))).alias("order_delivered_carrier_date"),
        F.when(status == "F", F.concat(F.lit(" "), _stamp("o_orderdate"), F.lit(" "))).alias("order_delivered_customer_date"),
        F.when(status == "O", "soon").otherwise(_stamp("o_orderdate")).alias("order_estimated_delivery_date"),
    )


def raw_order_items(given):
    """Line numbers above 6 are not integers; prices carry a third decimal; some freight is text."""
    price = text("l_extendedprice")
    return given["lineitem"].select(
        _untidy(text("l_orderkey")).alias("order_id"),
        F.when(F.col("l_linenumber") > 6, "x").otherwise(_untidy(text("l_linenumber"))).alias("order_item_id"),
        _untidy(text("l_partkey")).alias("product_id"),
        F.concat(F.lit(" "), text("l_suppkey")).alias("seller_id"),
        _stamp("l_shipdate").alias("shipping_limit_date"),
        F.format_string("%.2f5", "l_extendedprice").alias("price"),
        F.when(F.col("l_returnflag") == "R", "abc")
        .when(F.col("l_returnflag") == "A", "1e3")
        .otherwise(F.col("l_quantity").cast("int").cast("string"))
        .alias("freight_value"),
    )


def raw_payments(given):
    return given["orders"].select(
        _untidy(text("o_orderkey")).alias("order_id"),
        F.when(F.col("o_orderpriority") == "5-LOW", "").otherwise("1").alias("payment_sequential"),
        F.concat(F.lit("a payment type with a rather long name "), F.col("o_orderpriority")).alias("payment_type"),
        F.left("o_orderpriority", F.lit(1)).alias("payment_installments"),
        F.when(F.col("o_orderstatus") == "P", "99999999999.00")
        .otherwise(F.format_string("%.2f", "o_totalprice"))
        .alias("payment_value"),
    )


def raw_reviews(given):
    """Events as reviews: many per user, some with an empty or a quoted empty answer time."""
    kind = F.col("event_type")
    return given["events"].select(
        _untidy_key(text("user_id")).alias("review_id"),
        F.when(kind == "signup", '"  "').otherwise(text("event_id")).alias("order_id"),
        F.concat(F.lit('"'), F.floor(F.col("value")).cast("string"), F.lit('"')).alias("review_score"),
        F.concat(F.lit(" "), kind).alias("review_comment_title"),
        F.col("props").alias("review_comment_message"),
        _stamp("ts").alias("review_creation_date"),
        F.when(kind == "error", "  ").when(kind == "click", '""').otherwise(_stamp("ts")).alias("review_answer_timestamp"),
    )


RAW = {
    "customers": raw_customers,
    "geolocation": raw_geolocation,
    "order_items": raw_order_items,
    "payments": raw_payments,
    "reviews": raw_reviews,
    "orders": raw_orders,
    "products": raw_products,
    "sellers": raw_sellers,
    "category_translation": raw_category_translation,
}


def raw_tables(given: Given) -> dict[str, DataFrame]:
    return {name: build(given) for name, build in RAW.items()}
