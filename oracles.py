"""The expected result of every registered query as plain SQL over the given tables.

Written independently of the library: text is cleaned, typed, ranked and summed in SQL here, cents
are handled as whole numbers, and each surrogate key is one global ``row_number``.
"""

from __future__ import annotations

import zlib

# ---------------------------------------------------------------- the given tables in clean form
CENT = "CAST(0.01 AS DECIMAL(3,2))"


def cents(x: str, type_: str = "DECIMAL(12,2)") -> str:
    return f"CAST(CAST({x} AS DECIMAL(18,0)) * {CENT} AS {type_})"


def micro(x: str) -> str:
    """A whole number of millionths as a decimal."""
    return f"CAST(CAST({x} AS DECIMAL(22,0)) * CAST(0.000001 AS DECIMAL(7,6)) AS DECIMAL(16,6))"


def mean(total_cents: str, n: str) -> str:
    """Mean of amounts in cents, rounded half up at six decimals, for non-negative totals."""
    return micro(f"(2 * CAST({total_cents} AS HUGEINT) * 10000 + {n}) // (2 * {n})")


CLEAN = {
    "g_customers": """
        SELECT CAST(c_custkey AS VARCHAR) AS customer_id, c_name AS customer_unique_id,
               lpad(CAST(c_nationkey AS VARCHAR), 5, '0') AS customer_zip_code_prefix,
               lower(c_mktsegment) AS customer_city, right(n_name, 2) AS customer_state
        FROM customer JOIN nation ON c_nationkey = n_nationkey""",
    "g_sellers": """
        SELECT CAST(s_suppkey AS VARCHAR) AS seller_id,
               lpad(CAST(s_nationkey AS VARCHAR), 5, '0') AS seller_zip_code_prefix,
               s_name AS seller_city, right(n_name, 2) AS seller_state
        FROM supplier JOIN nation ON s_nationkey = n_nationkey""",
    "g_products": """
        SELECT CAST(p_partkey AS VARCHAR) AS product_id, lower(p_type) AS product_category_name,
               CAST(length(p_name) AS INTEGER) AS product_name_length,
               p_size * 10 AS product_description_length, CAST(p_size AS SMALLINT) AS product_photos_qty,
               p_size * 100 AS product_weight_g, p_size + 10 AS product_length_cm,
               p_size + 5 AS product_height_cm, p_size + 1 AS product_width_cm
        FROM part""",
    "g_translation": """
        SELECT DISTINCT lower(p_type) AS product_category_name,
               upper(left(p_type, 1)) || lower(substr(p_type, 2)) || ' goods' AS product_category_name_english
        FROM part WHERE p_type <> 'ECONOMY'""",
    "g_orders": """
        SELECT CAST(o_orderkey AS VARCHAR) AS order_id, CAST(o_custkey AS VARCHAR) AS customer_id,
               o_orderstatus AS order_status, o_orderdate AS order_purchase_timestamp,
               CASE WHEN o_orderstatus <> 'P' THEN o_orderdate + INTERVAL 30 HOUR END AS order_approved_at,
               CASE WHEN o_orderstatus = 'F' THEN o_orderdate + INTERVAL 84 HOUR END AS order_delivered_carrier_date,
               CASE WHEN o_orderstatus = 'F' THEN o_orderdate + to_days(CAST(10 + day(o_orderdate) AS INTEGER)) + INTERVAL 18 HOUR
               END AS order_delivered_customer_date,
               CAST(o_orderdate AS DATE) + 30 AS order_estimated_delivery_date
        FROM orders""",
    "g_items": f"""
        SELECT CAST(l_orderkey AS VARCHAR) AS order_id, l_linenumber AS order_item_id,
               CAST(max(l_partkey) AS VARCHAR) AS product_id, CAST(max(l_suppkey) AS VARCHAR) AS seller_id,
               max(l_shipdate) AS shipping_limit_date,
               CAST(sum(CAST(round(l_extendedprice * 100) AS BIGINT)) AS BIGINT) AS price_cents,
               CAST(sum(CAST(round(l_quantity * 100) AS BIGINT)) AS BIGINT) AS freight_cents
        FROM lineitem GROUP BY l_orderkey, l_linenumber""",
    "g_payments": """
        SELECT CAST(o_orderkey AS VARCHAR) AS order_id, part AS payment_sequential,
               CASE WHEN part = 1 THEN CAST(round(o_totalprice * 100) AS BIGINT) ELSE 2500 END AS payment_cents
        FROM orders JOIN (VALUES (1), (2)) AS parts(part) ON part = 1 OR o_orderpriority = '1-URGENT'
        WHERE o_orderstatus <> 'P'""",
    "g_reviews": """
        SELECT CAST(o_orderkey AS VARCHAR) || part AS review_id, CAST(o_orderkey AS VARCHAR) AS order_id,
               CASE WHEN part = 'b' THEN 4 WHEN o_orderpriority <> '5-LOW' THEN CAST(left(o_orderpriority, 1) AS INTEGER)
               END AS review_score
        FROM orders JOIN (VALUES ('a'), ('b')) AS parts(part) ON part = 'a' OR o_orderpriority = '1-URGENT'
        WHERE o_orderstatus <> 'O'""",
}


def numbered(source: str, business: str, surrogate: str) -> str:
    return f"SELECT CAST(row_number() OVER (ORDER BY left(md5({business}), 3), {business}) AS BIGINT) AS {surrogate}, * FROM {source}"


def day_key(x: str) -> str:
    return f"CAST(strftime({x}, '%Y%m%d') AS INTEGER)"


STAR = {
    "counts": "SELECT order_id, count(*) AS order_item_count FROM g_items GROUP BY order_id",
    "paid": "SELECT order_id, sum(coalesce(payment_cents, 0)) AS cents FROM g_payments GROUP BY order_id",
    "scores": """
        SELECT order_id, sum(review_score) AS points, count(*) AS n
        FROM g_reviews WHERE review_score IS NOT NULL GROUP BY order_id""",
    "days": """
        SELECT CAST(order_purchase_timestamp AS DATE) AS full_date FROM g_orders
        UNION SELECT CAST(order_approved_at AS DATE) FROM g_orders
        UNION SELECT CAST(order_delivered_customer_date AS DATE) FROM g_orders
        UNION SELECT order_estimated_delivery_date FROM g_orders
        UNION SELECT CAST(shipping_limit_date AS DATE) FROM g_items""",
    "d_date": f"""
        SELECT {day_key('full_date')} AS date_key, full_date, CAST(year(full_date) AS SMALLINT) AS "year",
               CAST(month(full_date) AS SMALLINT) AS "month", CAST(day(full_date) AS SMALLINT) AS "day",
               monthname(full_date) AS month_name, dayname(full_date) AS day_name,
               CAST(quarter(full_date) AS SMALLINT) AS quarter_number,
               CASE WHEN isodow(full_date) >= 6 THEN 1 ELSE 0 END AS is_weekend
        FROM days WHERE full_date IS NOT NULL""",
    "d_customers": numbered("g_customers", "customer_id", "customer_key"),
    "d_products": """
        SELECT product_key, product_id, p.product_category_name, product_category_name_english, product_name_length,
               product_description_length, product_photos_qty, product_weight_g, product_length_cm,
               product_height_cm, product_width_cm
        FROM (""" + numbered("g_products", "product_id", "product_key") + """) AS p
        LEFT JOIN g_translation AS t ON t.product_category_name = p.product_category_name""",
    "d_sellers": numbered("g_sellers", "seller_id", "seller_key"),
    "fact": f"""
        SELECT i.order_id, i.order_item_id, customer_key, product_key, seller_key, d.date_key AS order_date_key,
               ship.date_key AS shipping_limit_date_key, appr.date_key AS approved_date_key,
               deli.date_key AS delivered_date_key, esti.date_key AS estimated_delivery_date_key,
               o.order_status, 1 AS quantity, price_cents AS item_cents, freight_cents,
               price_cents + freight_cents AS total_cents,
               (2 * paid.cents + order_item_count) // (2 * order_item_count) AS allocated_cents,
               (2 * 100 * points + scores.n) // (2 * scores.n) AS score_cents
        FROM g_items AS i
        JOIN g_orders AS o ON o.order_id = i.order_id
        JOIN d_customers AS c ON c.customer_id = o.customer_id
        JOIN d_products AS p ON p.product_id = i.product_id
        JOIN d_sellers AS s ON s.seller_id = i.seller_id
        JOIN d_date AS d ON d.full_date = CAST(o.order_purchase_timestamp AS DATE)
        LEFT JOIN d_date AS ship ON ship.full_date = CAST(i.shipping_limit_date AS DATE)
        LEFT JOIN d_date AS appr ON appr.full_date = CAST(o.order_approved_at AS DATE)
        LEFT JOIN d_date AS deli ON deli.full_date = CAST(o.order_delivered_customer_date AS DATE)
        LEFT JOIN d_date AS esti ON esti.full_date = o.order_estimated_delivery_date
        LEFT JOIN counts ON counts.order_id = i.order_id
        LEFT JOIN paid ON paid.order_id = i.order_id
        LEFT JOIN scores ON scores.order_id = i.order_id""",
}


def ctes(parts: dict[str, str]) -> str:
    return "WITH " + ",\n".join(f"{name} AS ({body})" for name, body in parts.items())


GOLD = ctes(CLEAN | STAR)
GIVEN = ctes(CLEAN)


def as_double(*columns: str) -> str:
    return ", ".join(f"CAST({cents(c + '_cents')} AS DOUBLE) AS {name}" for c, name in (x.split(":") for x in columns))


FACT_AMOUNTS = as_double(
    "item:item_amount",
    "freight:freight_amount",
    "total:total_amount",
    "allocated:allocated_payment_amount",
    "score:review_score",
)
FACT = f"""{GOLD}
SELECT order_id, order_item_id, customer_key, product_key, seller_key, order_date_key, shipping_limit_date_key,
       approved_date_key, delivered_date_key, estimated_delivery_date_key, order_status, quantity, {FACT_AMOUNTS}
FROM fact"""

SALES = f"""CAST({cents('sum(total_cents)', 'DECIMAL(20,2)')} AS DOUBLE) AS gross_sales_amount,
       CAST({mean('sum(total_cents)', 'count(*)')} AS DOUBLE) AS avg_order_line_amount,
       CASE WHEN count(score_cents) > 0 THEN CAST({mean('sum(score_cents)', 'count(score_cents)')} AS DOUBLE) END AS avg_review_score"""

# ---------------------------------------------------------------- cleaning of text, in SQL


def tidy(x: str) -> str:
    stripped = f"replace(trim({x}, ' '), '\"', '')"
    return f"(CASE WHEN rtrim({stripped}, ' ') <> '' THEN {stripped} END)"


def fixed(x: str, n: int) -> str:
    return f"rtrim(left({tidy(x)}, {n}), ' ')"


def limited(x: str, n: int) -> str:
    return f"left({tidy(x)}, {n})"


def integer(x: str) -> str:
    t = f"trim({tidy(x)}, ' ')"
    return f"(CASE WHEN regexp_full_match({t}, '[+-]?[0-9]+') THEN TRY_CAST(ltrim({t}, '+') AS INTEGER) END)"


def byte(x: str) -> str:
    return f"(CASE WHEN {integer(x)} BETWEEN 0 AND 255 THEN CAST({integer(x)} AS SMALLINT) END)"


def money(x: str) -> str:
    t = f"trim({tidy(x)}, ' ')"
    return f"CAST((CASE WHEN regexp_full_match({t}, '[+-]?[0-9]+([.][0-9]*)?') THEN TRY_CAST({t} AS DECIMAL(10,2)) END) AS DOUBLE)"


def floating(x: str) -> str:
    t = f"trim({tidy(x)}, ' ')"
    return f"(CASE WHEN regexp_full_match({t}, '[+-]?[0-9]+([.][0-9]*)?') THEN TRY_CAST({t} AS DOUBLE) END)"


TIME = "[0-9]{4}-[0-9]{2}-[0-9]{2}([ T][0-9]{2}:[0-9]{2}(:[0-9]{2}([.][0-9]+)?)?)?"


def seconds(x: str) -> str:
    t = f"trim({tidy(x)}, ' ')"
    full = f"CASE WHEN length({t}) = 16 THEN {t} || ':00' ELSE {t} END"
    return (
        f"(CASE WHEN regexp_full_match({t}, '{TIME}') THEN "
        f"CAST(date_trunc('second', TRY_CAST({full} AS TIMESTAMP) + INTERVAL 500 MILLISECOND) AS TIMESTAMP) END)"
    )


def day(x: str) -> str:
    t = f"trim({tidy(x)}, ' ')"
    return f"(CASE WHEN regexp_full_match({t}, '{TIME}') THEN TRY_CAST(left({t}, 10) AS DATE) END)"


def quoted(x: str) -> str:
    return f"'  \"' || {x} || '\" '"


def stamp(x: str) -> str:
    return f"strftime({x}, '%Y-%m-%d %H:%M:%S')"


def s(x: str) -> str:
    return f"CAST({x} AS VARCHAR)"


def quoted_key(x: str) -> str:
    return f"CASE WHEN event_id % 2 = 0 THEN '\"' || {x} || ' \"' ELSE {quoted(x)} END"


RAW = {
    "customers": f"""
        SELECT {quoted(s('c_custkey'))} AS customer_id,
               CASE WHEN c_acctbal < -500 THEN '""' ELSE {quoted('c_name')} END AS customer_unique_id,
               {quoted("lpad(" + s('c_nationkey') + ", 7, '0')")} AS customer_zip_code_prefix,
               CASE WHEN c_acctbal < 0 THEN '"   "' ELSE {quoted('lower(c_mktsegment)')} END AS customer_city,
               ' "' || lower(n_name) || '"' AS customer_state
        FROM customer JOIN nation ON c_nationkey = n_nationkey""",
    "sellers": f"""
        SELECT {quoted(s('s_suppkey'))} AS seller_id,
               CASE WHEN s_acctbal < 0 THEN '  ' ELSE {s('s_nationkey')} END AS seller_zip_code_prefix,
               ' ' || s_name AS seller_city, lower(right(s_name, 3)) AS seller_state
        FROM supplier""",
    "products": f"""
        SELECT {quoted(s('p_partkey'))} AS product_id, '"' || lower(p_type) || '"' AS product_category_name,
               {s('length(p_name)')} AS product_name_lenght, ' ' || {s('p_size')} || ' ' AS product_description_lenght,
               {s('p_size * 8 - 20')} AS product_photos_qty,
               CASE WHEN p_size > 40 THEN {s('p_size')} || '.0' ELSE {s('p_size')} END AS product_weight_g,
               '+' || {s('p_size')} AS product_length_cm, '-' || {s('p_size')} AS product_height_cm,
               {s('p_size')} || 'cm' AS product_width_cm
        FROM part""",
    "geolocation": f"""
        SELECT {quoted_key("lpad(" + s('user_id') + ", 5, '0')")} AS geolocation_zip_code_prefix,
               CASE WHEN event_type <> 'error' THEN '-' || {s('event_id')} || '.25' END AS geolocation_lat,
               CASE WHEN event_type = 'click' THEN 'unknown' ELSE {s('event_id')} || '.5' END AS geolocation_lng,
               event_type || ' ' || {s('event_id')} AS geolocation_city, lower(event_type) AS geolocation_state
        FROM events""",
    "category_translation": f"""
        SELECT '"' || lower(p_type) || '  "' AS product_category_name,
               CASE WHEN p_type = 'ECONOMY' THEN '""' ELSE upper(left(p_type, 1)) || lower(substr(p_type, 2)) END
               AS product_category_name_english
        FROM (SELECT DISTINCT p_type FROM part)""",
    "orders": f"""
        SELECT {quoted(s('o_orderkey'))} AS order_id,
               CASE WHEN o_totalprice < 2000 THEN '" "' ELSE {quoted(s('o_custkey'))} END AS customer_id,
               {quoted('o_orderpriority')} AS order_status,
               CASE WHEN o_orderpriority = '5-LOW' THEN '10-02' ELSE {stamp('o_orderdate')} END AS order_purchase_timestamp,
               CASE WHEN o_orderstatus = 'F' THEN '"' || strftime(o_orderdate, '%Y-%m-%d') || ' 23:59:59.6"'
                    ELSE strftime(o_orderdate, '%Y-%m-%d') END AS order_approved_at,
               CASE WHEN o_orderstatus <> 'P' THEN strftime(o_orderdate, '%Y-%m-%d') || 'T08:30' END AS order_delivered_carrier_date,
               CASE WHEN o_orderstatus = 'F' THEN ' ' || {stamp('o_orderdate')} || ' ' END AS order_delivered_customer_date,
               CASE WHEN o_orderstatus = 'O' THEN 'soon' ELSE {stamp('o_orderdate')} END AS order_estimated_delivery_date
        FROM orders""",
    "order_items": f"""
        SELECT {quoted(s('l_orderkey'))} AS order_id,
               CASE WHEN l_linenumber > 6 THEN 'x' ELSE {quoted(s('l_linenumber'))} END AS order_item_id,
               {quoted(s('l_partkey'))} AS product_id, ' ' || {s('l_suppkey')} AS seller_id,
               {stamp('l_shipdate')} AS shipping_limit_date, printf('%.2f', l_extendedprice) || '5' AS price,
               CASE l_returnflag WHEN 'R' THEN 'abc' WHEN 'A' THEN '1e3' ELSE {s('CAST(l_quantity AS INTEGER)')} END AS freight_value
        FROM lineitem""",
    "payments": f"""
        SELECT {quoted(s('o_orderkey'))} AS order_id,
               CASE WHEN o_orderpriority = '5-LOW' THEN '' ELSE '1' END AS payment_sequential,
               'a payment type with a rather long name ' || o_orderpriority AS payment_type,
               left(o_orderpriority, 1) AS payment_installments,
               CASE WHEN o_orderstatus = 'P' THEN '99999999999.00' ELSE printf('%.2f', o_totalprice) END AS payment_value
        FROM orders""",
    "reviews": f"""
        SELECT {quoted_key(s('user_id'))} AS review_id,
               CASE WHEN event_type = 'signup' THEN '"  "' ELSE {s('event_id')} END AS order_id,
               '"' || {s('CAST(floor(value) AS BIGINT)')} || '"' AS review_score, ' ' || event_type AS review_comment_title,
               props AS review_comment_message, {stamp('ts')} AS review_creation_date,
               CASE event_type WHEN 'error' THEN '  ' WHEN 'click' THEN '""' ELSE {stamp('ts')} END AS review_answer_timestamp
        FROM events""",
}

# table -> (typed columns, required)
CLEANED = {
    "customers": (
        {
            "customer_id": fixed("customer_id", 32),
            "customer_unique_id": fixed("customer_unique_id", 32),
            "customer_zip_code_prefix": fixed("customer_zip_code_prefix", 5),
            "customer_city": limited("customer_city", 100),
            "customer_state": f"upper({fixed('customer_state', 2)})",
        },
        ("customer_id", "customer_unique_id"),
    ),
    "sellers": (
        {
            "seller_id": fixed("seller_id", 32),
            "seller_zip_code_prefix": fixed("seller_zip_code_prefix", 5),
            "seller_city": limited("seller_city", 50),
            "seller_state": f"upper({fixed('seller_state', 2)})",
        },
        ("seller_id", "seller_zip_code_prefix"),
    ),
    "products": (
        {
            "product_id": fixed("product_id", 32),
            "product_category_name": fixed("product_category_name", 50),
            "product_name_length": integer("product_name_lenght"),
            "product_description_length": integer("product_description_lenght"),
            "product_photos_qty": byte("product_photos_qty"),
            "product_weight_g": integer("product_weight_g"),
            "product_length_cm": integer("product_length_cm"),
            "product_height_cm": integer("product_height_cm"),
            "product_width_cm": integer("product_width_cm"),
        },
        ("product_id",),
    ),
    "geolocation": (
        {
            "geolocation_zip_code_prefix": fixed("geolocation_zip_code_prefix", 5),
            "geolocation_lat": floating("geolocation_lat"),
            "geolocation_lng": floating("geolocation_lng"),
            "geolocation_city": limited("geolocation_city", 50),
            "geolocation_state": f"upper({fixed('geolocation_state', 2)})",
        },
        ("geolocation_zip_code_prefix",),
    ),
    "category_translation": (
        {
            "product_category_name": fixed("product_category_name", 50),
            "product_category_name_english": limited("product_category_name_english", 50),
        },
        ("product_category_name", "product_category_name_english"),
    ),
    "orders": (
        {
            "order_id": fixed("order_id", 32),
            "customer_id": fixed("customer_id", 32),
            "order_status": limited("order_status", 20),
            "order_purchase_timestamp": seconds("order_purchase_timestamp"),
            "order_approved_at": seconds("order_approved_at"),
            "order_delivered_carrier_date": seconds("order_delivered_carrier_date"),
            "order_delivered_customer_date": seconds("order_delivered_customer_date"),
            "order_estimated_delivery_date": day("order_estimated_delivery_date"),
        },
        ("order_id", "customer_id"),
    ),
    "order_items": (
        {
            "order_id": fixed("order_id", 32),
            "order_item_id": integer("order_item_id"),
            "product_id": fixed("product_id", 32),
            "seller_id": fixed("seller_id", 32),
            "shipping_limit_date": seconds("shipping_limit_date"),
            "price": money("price"),
            "freight_value": money("freight_value"),
        },
        ("order_id", "order_item_id", "product_id", "seller_id"),
    ),
    "payments": (
        {
            "order_id": fixed("order_id", 32),
            "payment_sequential": integer("payment_sequential"),
            "payment_type": limited("payment_type", 30),
            "payment_installments": integer("payment_installments"),
            "payment_value": money("payment_value"),
        },
        ("order_id", "payment_sequential"),
    ),
    "reviews": (
        {
            "review_id": fixed("review_id", 32),
            "order_id": fixed("order_id", 32),
            "review_score": byte("review_score"),
            "review_comment_title": limited("review_comment_title", 255),
            "review_comment_message": tidy("review_comment_message"),
            "review_creation_date": seconds("review_creation_date"),
            "review_answer_timestamp": seconds("review_answer_timestamp"),
        },
        ("review_id", "order_id"),
    ),
}
BEST_FIRST = {
    "geolocation": (
        "geolocation_zip_code_prefix",
        "CASE WHEN geolocation_lat IS NOT NULL AND geolocation_lng IS NOT NULL THEN 0 ELSE 1 END, "
        "geolocation_city ASC NULLS FIRST",
    ),
    "reviews": (
        "review_id",
        "CASE WHEN trim(review_answer_timestamp, ' ') <> '' THEN 0 ELSE 1 END, "
        f"{seconds('review_answer_timestamp')} DESC NULLS LAST, {seconds('review_creation_date')} DESC NULLS LAST",
    ),
}


def cleaned(table: str) -> str:
    columns, required = CLEANED[table]
    names = ", ".join(columns)
    typed = ", ".join(f"{expr} AS t_{name}" for name, expr in columns.items())
    kept = " AND ".join(f"t_{c} IS NOT NULL" for c in required)
    out = ", ".join(f"t_{name} AS {name}" for name in columns)
    if table not in BEST_FIRST:
        return f"SELECT {out} FROM (SELECT {typed} FROM ({RAW[table]}) AS r) AS t WHERE {kept}"
    key, order = BEST_FIRST[table]
    ties = ", ".join(f"t_{name} ASC NULLS FIRST" for name in columns)
    rank = f"row_number() OVER (PARTITION BY rtrim({tidy(key)}, ' ') ORDER BY {order}, {ties})"
    return f"""SELECT {out} FROM (SELECT *, {rank} AS rn FROM (SELECT *, {typed} FROM ({RAW[table]}) AS r) AS t WHERE {kept}) AS k
        WHERE rn = 1"""


CLEANED_NAMES = {
    "g_customers": "customers", "g_sellers": "sellers", "g_products": "products",
    "g_translation": "category_translation", "g_orders": "orders", "g_items": "order_items",
    "g_payments": "payments", "g_reviews": "reviews",
}


def gate_line(code: int, severity: str, message: str, failing: str, checked: str | None = None) -> str:
    seen = f"({checked})" if checked else "NULL"
    return f"""SELECT {code} AS code, '{severity}' AS severity, '{message}' AS message,
        CAST(({failing}) AS BIGINT) AS failing_rows, CAST({seen} AS BIGINT) AS checked_rows, ({failing}) = 0 AS passed"""


def _untidy_gate() -> str:
    """Gate over the cleaned untidy text: it has duplicates, orphans and values out of range."""
    order = ["customers", "geolocation", "order_items", "payments", "reviews", "orders", "products", "sellers", "category_translation"]
    keys = {
        "customers": "customer_id", "geolocation": "geolocation_zip_code_prefix", "order_items": "order_id, order_item_id",
        "payments": "order_id, payment_sequential", "reviews": "review_id", "orders": "order_id", "products": "product_id",
        "sellers": "seller_id", "category_translation": "product_category_name",
    }
    lines = []
    for i, t in enumerate(order):
        null = " OR ".join(f"{c} IS NULL" for c in CLEANED[t][1])
        count = f"SELECT count(*) FROM c_{t}"
        lines.append(gate_line(53100 + i, "critical", f"NULL in required columns of {t}_clean", f"{count} WHERE {null}", count))
        dup = f"SELECT coalesce(sum(n), 0) FROM (SELECT count(*) AS n FROM c_{t} GROUP BY {keys[t]} HAVING count(*) > 1)"
        lines.append(gate_line(53200 + i, "critical", f"duplicate key ({keys[t]}) in {t}_clean", dup, count))
    links = [("orders", "customers", "customer_id"), ("order_items", "orders", "order_id"), ("order_items", "products", "product_id"),
             ("order_items", "sellers", "seller_id"), ("payments", "orders", "order_id"), ("reviews", "orders", "order_id")]
    for i, (child, parent, key) in enumerate(links):
        lost = f"SELECT count(*) FROM c_{child} AS c WHERE NOT EXISTS (SELECT 1 FROM c_{parent} AS p WHERE p.{key} = c.{key})"
        lines.append(gate_line(53300 + i, "critical", f"{child}_clean rows without {parent}_clean ({key})", lost))
    negative = [("order_items", "price"), ("order_items", "freight_value"), ("payments", "payment_value"), ("payments", "payment_installments")]
    negative += [("products", f"product_{c}") for c in ("name_length", "description_length", "weight_g", "length_cm", "height_cm", "width_cm")]
    for i, (t, c) in enumerate(negative):
        lines.append(gate_line(53500 + i, "warning", f"negative {c} in {t}_clean", f"SELECT count(*) FROM c_{t} WHERE {c} < 0", f"SELECT count(*) FROM c_{t}"))
    lines.append(gate_line(53600, "warning", "review_score outside 1..5 in reviews_clean", "SELECT count(*) FROM c_reviews WHERE review_score NOT BETWEEN 1 AND 5", "SELECT count(*) FROM c_reviews"))
    pairs = [("order_approved_at", "order_purchase_timestamp"), ("order_delivered_carrier_date", "order_purchase_timestamp"),
             ("order_delivered_customer_date", "order_purchase_timestamp"), ("order_delivered_customer_date", "order_delivered_carrier_date")]
    for i, (later, first) in enumerate(pairs):
        lines.append(gate_line(53700 + i, "warning", f"{later} before {first} in orders_clean", f"SELECT count(*) FROM c_orders WHERE {later} < {first}", "SELECT count(*) FROM c_orders"))
    head = "WITH " + ",\n".join(f"c_{t} AS MATERIALIZED ({cleaned(t)})" for t in order)
    return head + "\n" + "\nUNION ALL ".join(lines)


def _gold_gate() -> str:
    required = {
        "d_date": ("dim_date", ["date_key", "full_date", "year", "month", "day", "month_name", "day_name", "quarter_number", "is_weekend"]),
        "d_customers": ("dim_customers", ["customer_key", "customer_id", "customer_unique_id"]),
        "d_products": ("dim_products", ["product_key", "product_id"]),
        "d_sellers": ("dim_sellers", ["seller_key", "seller_id"]),
        "fact": ("fact_orders", ["order_id", "order_item_id", "customer_key", "product_key", "seller_key", "order_date_key", "quantity"]),
    }
    lines = []
    for i, (t, (name, columns)) in enumerate(required.items()):
        null = " OR ".join(f'"{c}" IS NULL' for c in columns)
        lines.append(gate_line(54100 + i, "critical", f"NULL in required columns of {name}", f"SELECT count(*) FROM {t} WHERE {null}", f"SELECT count(*) FROM {t}"))
    lines.append(gate_line(54400, "warning", "negative total_amount in fact_orders", "SELECT count(*) FROM fact WHERE total_cents < 0", "SELECT count(*) FROM fact"))
    unique = [("fact", "fact_orders", "order_id, order_item_id"), ("d_date", "dim_date", "date_key"), ("d_date", "dim_date", "full_date")]
    for t, name, pair in (("d_customers", "dim_customers", "customer"), ("d_products", "dim_products", "product"), ("d_sellers", "dim_sellers", "seller")):
        unique += [(t, name, f"{pair}_key"), (t, name, f"{pair}_id")]
    for i, (t, name, keys) in enumerate(unique):
        dup = f"SELECT coalesce(sum(n), 0) FROM (SELECT count(*) AS n FROM {t} GROUP BY {keys} HAVING count(*) > 1)"
        lines.append(gate_line(54200 + i, "critical", f"duplicate {keys} in {name}", dup, f"SELECT count(*) FROM {t}"))
    links = [("customer_key", "d_customers", "dim_customers", "customer_key"), ("product_key", "d_products", "dim_products", "product_key"),
             ("seller_key", "d_sellers", "dim_sellers", "seller_key")]
    links += [(f"{r}_date_key", "d_date", "dim_date", "date_key") for r in ("order", "shipping_limit", "approved", "delivered", "estimated_delivery")]
    for i, (role, t, name, key) in enumerate(links):
        lost = f"SELECT count(*) FROM fact AS f WHERE f.{role} IS NOT NULL AND NOT EXISTS (SELECT 1 FROM {t} AS d WHERE d.{key} = f.{role})"
        lines.append(gate_line(54300 + i, "critical", f"fact_orders.{role} not in {name}", lost))
    return GOLD + "\n" + "\nUNION ALL ".join(lines)


SHIPPED = "'shipped lines ' || "

ORACLES: dict[str, str] = {
    "raw_row_counts": "\nUNION ALL ".join(
        f"SELECT '{t}' AS table_name, count(*) AS row_count FROM ({RAW[t]}) AS r" for t in RAW
    ),
    "baseline_clean": "SELECT " + ", ".join(f"{tidy(c)} AS {c}" for c in CLEANED["customers"][0]) + f" FROM ({RAW['customers']}) AS r",
    "safe_cast": f"""SELECT {tidy('order_id')} AS order_id, {integer('order_item_id')} AS as_int, {byte('freight_value')} AS as_byte,
        {money('price')} AS as_money, {floating('price')} AS as_float, {seconds('shipping_limit_date')} AS as_seconds,
        {day('shipping_limit_date')} AS as_date FROM ({RAW['order_items']}) AS r""",
    "require_keys": f"""SELECT order_item_id IS NULL AS was_null, count(*) AS row_count FROM
        (SELECT {integer('order_item_id')} AS order_item_id FROM ({RAW['order_items']}) AS r) AS t
        WHERE order_item_id IS NOT NULL GROUP BY 1""",
    **{f"clean_{t}": cleaned(t) for t in CLEANED},
    "dedup_latest": """SELECT event_id, ts, user_id, event_type, value, props FROM (
        SELECT *, row_number() OVER (PARTITION BY user_id ORDER BY ts DESC NULLS LAST, event_id, event_type, value, props) AS rn
        FROM events) AS e WHERE rn = 1""",
    "dedup_line_items": """SELECT * EXCLUDE (rn) FROM (
        SELECT *, row_number() OVER (PARTITION BY l_orderkey, l_linenumber
            ORDER BY l_shipdate DESC NULLS LAST, l_partkey, l_suppkey, l_quantity, l_extendedprice, l_discount, l_tax,
                     l_returnflag, l_linestatus) AS rn FROM lineitem) AS e WHERE rn = 1""",
    "dim_date": f"{GOLD} SELECT * FROM d_date",
    "dim_customers": f"{GOLD} SELECT * FROM d_customers",
    "dim_sellers": f"{GOLD} SELECT * FROM d_sellers",
    "dim_products": f"{GOLD} SELECT * FROM d_products",
    "order_line_keys": f"""{GIVEN} SELECT CAST(row_number() OVER (
        ORDER BY left(md5(order_id || '|' || order_item_id), 4), order_id, order_item_id) AS BIGINT) AS line_key,
        order_id, order_item_id FROM g_items""",
    "resolve_product_key": f"""{GOLD} SELECT i.order_id, i.order_item_id, p.product_key FROM g_items AS i
        JOIN d_products AS p ON p.product_id = i.product_id WHERE p.product_category_name <> 'economy'""",
    "items_per_order": f"{GOLD} SELECT * FROM counts",
    "payments_per_order": f"{GOLD} SELECT order_id, CAST({cents('cents', 'DECIMAL(20,2)')} AS DOUBLE) AS order_payment_amount FROM paid",
    "order_review_score": f"""{GOLD} SELECT order_id, CAST({mean('points * 100', 'n')} AS DOUBLE) AS avg_review_score FROM scores""",
    "allocate_payment": f"""{GOLD} SELECT counts.order_id, order_item_count,
        CAST({cents('(2 * paid.cents + order_item_count) // (2 * order_item_count)')} AS DOUBLE) AS allocated_payment_amount
        FROM counts LEFT JOIN paid ON paid.order_id = counts.order_id""",
    "fact_orders": FACT,
    "fact_orders_calendar": FACT,
    "fact_orders_split": FACT,
    "fact_bucketed": FACT,
    "order_line_metrics": f"""{GOLD} SELECT f.order_id, f.order_item_id, d.full_date AS order_date, d."year" AS order_year,
        d."month" AS order_month, d.month_name, f.order_status, customer_id, customer_unique_id, customer_city, customer_state,
        product_id, product_category_name, product_category_name_english, seller_id, seller_city, seller_state, quantity, {FACT_AMOUNTS}
        FROM fact AS f JOIN d_date AS d ON d.date_key = f.order_date_key JOIN d_customers AS c ON c.customer_key = f.customer_key
        JOIN d_products AS p ON p.product_key = f.product_key JOIN d_sellers AS s ON s.seller_key = f.seller_key""",
    "customer_metrics": f"""{GOLD} SELECT customer_id, customer_unique_id, customer_city, customer_state,
        count(DISTINCT order_id) AS order_count, count(*) AS order_line_count, {SALES}
        FROM fact AS f JOIN d_customers AS c ON c.customer_key = f.customer_key GROUP BY 1, 2, 3, 4""",
    "product_metrics": f"""{GOLD} SELECT product_id, product_category_name, product_category_name_english,
        count(*) AS order_line_count, CAST(sum(quantity) AS BIGINT) AS units_sold, {SALES}
        FROM fact AS f JOIN d_products AS p ON p.product_key = f.product_key GROUP BY 1, 2, 3""",
    "revenue_by_month": f"""{GOLD} SELECT d."year" AS order_year, d."month" AS order_month,
        CAST({cents('sum(total_cents)', 'DECIMAL(20,2)')} AS DOUBLE) AS revenue, count(DISTINCT order_id) AS order_count,
        count(*) AS order_line_count FROM fact AS f JOIN d_date AS d ON d.date_key = f.order_date_key GROUP BY 1, 2""",
    "sales_by_category": f"""{GOLD} SELECT product_category_name_english,
        CAST({cents('sum(total_cents)', 'DECIMAL(20,2)')} AS DOUBLE) AS revenue, CAST(sum(quantity) AS BIGINT) AS units_sold,
        count(DISTINCT product_id) AS product_count
        FROM fact AS f JOIN d_products AS p ON p.product_key = f.product_key GROUP BY 1""",
    "delivery_trend": f"""{GOLD} SELECT CAST(d."year" AS INTEGER) AS order_year, CAST(d."month" AS INTEGER) AS order_month,
        count(*) AS order_line_count, count(delivered_date_key) AS delivered_line_count,
        count(*) FILTER (WHERE delivered_date_key > estimated_delivery_date_key) AS late_line_count,
        CAST(sum(deli.full_date - d.full_date) AS BIGINT) AS delivery_days,
        CAST(sum(deli.full_date - d.full_date) AS DOUBLE) / CAST(count(delivered_date_key) AS DOUBLE) AS avg_delivery_days
        FROM fact AS f JOIN d_date AS d ON d.date_key = f.order_date_key
        LEFT JOIN d_date AS deli ON deli.date_key = f.delivered_date_key GROUP BY 1, 2""",
    "not_null_check": f"""SELECT 1 AS code, 'critical' AS severity, 'customers without unique id' AS message,
        count(*) FILTER (WHERE u IS NULL) AS failing_rows, count(*) AS checked_rows, count(*) FILTER (WHERE u IS NULL) = 0 AS passed
        FROM (SELECT {tidy('customer_unique_id')} AS u FROM ({RAW['customers']}) AS r) AS t
        UNION ALL SELECT 2, 'warning', 'customers without city', count(*) FILTER (WHERE u IS NULL), count(*),
        count(*) FILTER (WHERE u IS NULL) <= count(*) * 0.5
        FROM (SELECT {tidy('customer_city')} AS u FROM ({RAW['customers']}) AS r) AS t""",
    "duplicate_keys": "SELECT l_orderkey, l_linenumber, count(*) AS row_count FROM lineitem GROUP BY 1, 2 HAVING count(*) > 1",
    "orphans": """SELECT l_orderkey AS key, count(*) AS row_count FROM lineitem WHERE NOT EXISTS (
        SELECT 1 FROM orders WHERE o_orderkey = l_orderkey AND o_orderstatus <> 'P') GROUP BY 1""",
    "range_check": """SELECT 1 AS code, 'warning' AS severity, 'negative balance' AS message,
        count(*) FILTER (WHERE c_acctbal < 0) AS failing_rows, count(*) AS checked_rows, count(*) FILTER (WHERE c_acctbal < 0) = 0 AS passed FROM customer
        UNION ALL SELECT 2, 'critical', 'balance outside -1000..10000', count(*) FILTER (WHERE c_acctbal NOT BETWEEN -1000 AND 10000),
        count(*), count(*) FILTER (WHERE c_acctbal NOT BETWEEN -1000 AND 10000) = 0 FROM customer""",
    "row_count_compare": f"""SELECT 53400 AS code, 'warning' AS severity, 'rows of reviews_raw missing from reviews_clean' AS message,
        CAST((SELECT count(*) FROM events) - (SELECT count(*) FROM ({cleaned('reviews')})) AS BIGINT) AS failing_rows,
        (SELECT count(*) FROM events) AS checked_rows, FALSE AS passed""",
    "row_count_explained": """SELECT 53400 AS code, 'warning' AS severity, 'rows of reviews_raw missing from reviews_clean' AS message,
        CAST(0 AS BIGINT) AS failing_rows, (SELECT count(*) FROM events) AS checked_rows, TRUE AS passed""",
    "rows_left_out": f"SELECT CAST((SELECT count(*) FROM events) - (SELECT count(*) FROM ({cleaned('reviews')})) AS BIGINT) AS row_count",
    "silver_gate": _untidy_gate(),
    "gold_gate": _gold_gate(),
    "customer_history": """
        SELECT CAST(c_custkey AS VARCHAR) AS customer_id, c_mktsegment AS customer_city, TIMESTAMP '2020-01-01' AS valid_from,
               CASE WHEN c_acctbal < 0 OR c_acctbal > 9000 THEN TIMESTAMP '2021-01-01' END AS valid_to,
               CASE WHEN c_acctbal < 0 OR c_acctbal > 9000 THEN 0 ELSE 1 END AS is_current FROM customer WHERE c_mktsegment <> 'BUILDING'
        UNION ALL
        SELECT CAST(c_custkey AS VARCHAR), CASE WHEN c_acctbal < 0 THEN 'moved' ELSE c_mktsegment END, TIMESTAMP '2021-01-01', NULL, 1
        FROM customer WHERE c_acctbal <= 9000 AND (c_acctbal < 0 OR c_mktsegment = 'BUILDING')""",
    "fact_line_keys": """SELECT count(*) AS row_count, 1 AS first_key, count(*) AS last_key, count(*) AS key_count FROM lineitem""",
    "manifest_rows": """SELECT 'silver' AS layer, 'customers_clean' AS table_name, count(*) AS row_count FROM customer
        UNION ALL SELECT 'silver', 'orders_clean', count(*) FROM orders UNION ALL SELECT 'silver', 'empty_clean', 0""",
    "existence_gate": "SELECT * FROM (VALUES " + ", ".join(
        f"({53000 + i}, 'critical', 'missing table {t}_clean', {int(t not in ('customers', 'orders'))}::BIGINT, 1::BIGINT, {t in ('customers', 'orders')})"
        for i, t in enumerate(("customers", "geolocation", "order_items", "payments", "reviews", "orders", "products", "sellers", "category_translation"))
    ) + ") AS v(code, severity, message, failing_rows, checked_rows, passed)",
    "upsert_latest": """SELECT event_id, ts, user_id, event_type, value, props FROM (
        SELECT *, row_number() OVER (PARTITION BY user_id, event_type ORDER BY ts DESC NULLS LAST, event_id) AS rn
        FROM events) AS e WHERE rn = 1""",
    "raw_scan": f"SELECT p_partkey AS part_id, p_name AS part_name, p_brand AS part_brand, p_type AS part_type FROM part",
}
ORACLES["star_pipeline"] = ORACLES["product_metrics"]
ORACLES["kpi_increment"] = ORACLES["customer_metrics"]
ORACLES["kpi_increment_products"] = ORACLES["product_metrics"]
ORACLES["change_feed"] = """SELECT user_id, ts, event_type, value, props FROM (
    SELECT *, row_number() OVER (PARTITION BY user_id ORDER BY event_id DESC) AS rn FROM events) AS e
    WHERE rn = 1 AND event_type <> 'error'"""
ORACLES["fact_asof_customer"] = f"""WITH h AS ({ORACLES["customer_history"].replace("2020-01-01", "1995-06-01").replace("2021-01-01", "1998-01-01")})
    SELECT CAST(l_orderkey AS VARCHAR) AS order_id, l_linenumber AS order_item_id, CAST(o_custkey AS VARCHAR) AS customer_id,
           o_orderdate AS order_purchase_timestamp, h.customer_city, h.valid_from AS version_from
    FROM (SELECT DISTINCT l_orderkey, l_linenumber FROM lineitem) AS l JOIN orders ON o_orderkey = l_orderkey
    LEFT JOIN h ON h.customer_id = CAST(o_custkey AS VARCHAR) AND o_orderdate >= h.valid_from AND (h.valid_to IS NULL OR o_orderdate < h.valid_to)"""
ORACLES["history_backdated"] = """WITH p AS (SELECT user_id, ts, CASE WHEN event_type <> 'error' THEN event_type END AS v FROM (
        SELECT *, row_number() OVER (PARTITION BY user_id, ts ORDER BY event_id DESC) AS rn FROM events) AS e WHERE rn = 1),
    step AS (SELECT * FROM (SELECT *, lag(v) OVER w AS was, row_number() OVER w AS n FROM p WINDOW w AS (PARTITION BY user_id ORDER BY ts)) AS s
             WHERE n = 1 OR v IS DISTINCT FROM was),
    row AS (SELECT user_id, v, ts, lead(ts) OVER (PARTITION BY user_id ORDER BY ts) AS until FROM step)
    SELECT user_id, v AS event_type, ts AS valid_from, until AS valid_to, CAST(until IS NULL AS INTEGER) AS is_current FROM row WHERE v IS NOT NULL"""
ORACLES["quarantined_rows"] = """WITH l AS (SELECT *, count(*) OVER (PARTITION BY l_orderkey, l_linenumber) AS n,
        NOT EXISTS (SELECT 1 FROM orders WHERE o_orderkey = l_orderkey AND o_orderstatus <> 'P') AS lost_first,
        NOT EXISTS (SELECT 1 FROM orders WHERE o_orderkey = l_orderkey) AS lost FROM lineitem)
    SELECT l_orderkey, l_linenumber, l_partkey, l_quantity,
        concat_ws(',', CASE WHEN l_quantity > 45 THEN '1' END, CASE WHEN n > 1 THEN '2' END, CASE WHEN lost THEN '3' END) AS broken
    FROM l WHERE l_quantity > 45 OR n > 1 OR lost_first"""
_CODES = ", ".join(f"('{t}', {zlib.crc32(t.encode()) % 1000})" for t in ("click", "error", "purchase", "signup", "view"))
ORACLES["audit_trend"] = f"""WITH r AS (SELECT 'bronze' AS layer, CAST(v.code AS INTEGER) AS code, date_trunc('day', ts)::TIMESTAMP AS load_dts,
        count(*) FILTER (WHERE value < 10) AS failing_rows FROM events JOIN (VALUES {_CODES}) AS v(t, code) ON t = event_type GROUP BY ALL),
    s AS (SELECT *, strftime(load_dts, '%Y%m%d') AS run_id, failing_rows <= 5 AS passed FROM r),
    i AS (SELECT *, row_number() OVER w - row_number() OVER (PARTITION BY code, passed ORDER BY load_dts) AS island,
        failing_rows - lag(failing_rows) OVER w AS failing_change, min(CASE WHEN NOT passed THEN load_dts END) OVER w AS first_failure
        FROM s WINDOW w AS (PARTITION BY code ORDER BY load_dts))
    SELECT layer, code, run_id, load_dts, passed, failing_rows, failing_change, count(*) OVER k AS streak, min(load_dts) OVER k AS streak_since, first_failure
    FROM i WINDOW k AS (PARTITION BY code, passed, island ORDER BY load_dts)"""
ORACLES["fact_month_refresh"] = ORACLES["fact_orders"]
ORACLES["observed_rows"] = ORACLES["range_check"]
ORACLES["contract_limits"] = f"""WITH r AS (SELECT 'bronze' AS layer, CAST(v.code AS INTEGER) AS code, strftime(date_trunc('day', ts), '%Y%m%d') AS run_id,
        count(*) FILTER (WHERE value < 10) / CAST(count(*) AS DOUBLE) AS share FROM events JOIN (VALUES {_CODES}) AS v(t, code) ON t = event_type GROUP BY ALL),
    m AS (SELECT layer, code, median(share) AS median_share, count(*) AS runs FROM r GROUP BY ALL),
    d AS (SELECT layer, code, median(abs(share - median_share)) AS deviation FROM r JOIN m USING (layer, code) GROUP BY ALL),
    l AS (SELECT *, CASE WHEN runs >= 5 THEN median_share + 3.0 * 1.4826 * deviation END AS limit_share FROM r JOIN m USING (layer, code) JOIN d USING (layer, code))
    SELECT layer, code, run_id, round(share, 9) AS share, round(median_share, 9) AS median_share, round(deviation, 9) AS deviation,
           round(CAST(limit_share AS DOUBLE), 9) AS limit_share, coalesce(share > limit_share, false) AS outside FROM l"""
ORACLES["raw_scan_comma"] = """SELECT p_partkey AS part_id, p_name || ', new' AS part_name, p_brand AS part_brand, p_type AS part_type, NULL AS line
    FROM part WHERE p_partkey % 10 > 1
    UNION ALL SELECT p_partkey, NULL, NULL, NULL, CAST(p_partkey AS VARCHAR) || ',"' || p_name || ', new",' || p_brand || CASE WHEN p_partkey % 10 = 1 THEN ',' || p_type || ',more' ELSE '' END
    FROM part WHERE p_partkey % 10 <= 1"""
ORACLES["evolved_scan"] = """SELECT p_partkey AS part_id, p_name AS part_name, CASE WHEN p_partkey % 3 < 2 THEN p_brand END AS part_brand, p_type AS part_type FROM part"""
ORACLES["header_drift"] = """SELECT missing, unexpected FROM (VALUES ('part_name', 'title', 1), ('part_brand', 'part_size', 2)) AS v(missing, unexpected, k)
    WHERE k IN (SELECT p_partkey % 3 FROM part)"""
ORACLES["catalog_line_view"] = ORACLES["order_line_metrics"]
ORACLES["audit_of_failed_run"] = """SELECT 'silver' AS layer, 53205 AS code, 2 * count(*) FILTER (WHERE o_orderkey % 7 = 0) AS failing_rows,
    count(*) + count(*) FILTER (WHERE o_orderkey % 7 = 0) AS checked_rows, 0 AS published FROM orders"""
