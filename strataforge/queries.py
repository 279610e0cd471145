"""The registered queries: every operator on entities adapted from the driver's tables, with an independent DuckDB twin."""

from __future__ import annotations

import tempfile
from collections.abc import Callable
from datetime import date

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from .adapters import duckdb_views, view
from .contracts import FUNNEL_STAGES, NULL_LIKE
from .functions import clean as cl
from .functions import keys
from .operators import dedup, events, kimball, reports, serving, transactional
from .plans import migrate
from .plans.store import INSERT_ONLY, PRESERVE_BOUNDS, UPSERT_ALL, Merge, merge_frames
from .sources import kafka_shape
from .streaming import realtime as stream_realtime

QUERIES: dict[str, Callable[[SparkSession, str], DataFrame]] = {}
ORACLE_SQL: dict[str, str] = {}



def _run():
    return F.lit("2024-02-01 00:00:00").cast("timestamp")


def query(sql: str | None = None, views: str = ""):
    """Register a query and, if given, its twin; ``views`` names the adapted entities that the twin reads."""

    def add(f):
        def plain(spark: SparkSession, sf_dir: str) -> DataFrame:
            df = f(spark, sf_dir)
            # times without a zone look the same in both engines
            zoned = {x.name: F.col(x.name).cast("timestamp_ntz") for x in df.schema.fields if isinstance(x.dataType, T.TimestampType)}
            return df.withColumns(zoned) if zoned else df

        QUERIES[f.__name__] = plain
        if sql:
            ctes = ", ".join(x for x in (duckdb_views(*views.split()) if views else "", *(_CTE[n] for n in _needs(sql))) if x)
            ORACLE_SQL[f.__name__] = f"WITH {ctes} {sql}" if ctes else sql
        return f

    return add


def _needs(sql: str) -> list[str]:
    """Named helper tables of a twin, in order of definition."""
    wanted, text = [], sql
    for n in reversed(list(_CTE)):
        if f" {n}" in text or f"({n}" in text:
            wanted.append(n)
            text += _CTE[n]
    return wanted[::-1]


def _nl(x: str) -> str:
    listed = ", ".join(f"'{t}'" for t in NULL_LIKE)
    return f"(CASE WHEN lower(trim({x})) IN ({listed}) THEN NULL ELSE trim({x}) END)"


_DEV = f"coalesce(CASE lower({_nl('device_type')}) WHEN 'android' THEN 'mobile' WHEN 'ios' THEN 'mobile' WHEN 'iphone' THEN 'mobile' WHEN 'phone' THEN 'mobile' WHEN 'web' THEN 'desktop' WHEN 'pc' THEN 'desktop' ELSE lower({_nl('device_type')}) END, 'unknown')"
_SNAKE = r"regexp_replace(lower(trim({0})), '[\s-]+', '_', 'g')"
_CAT = """CASE WHEN event_type IN ('page_view','product_view','home_view','category_view','click') THEN 'browse' WHEN event_type IN ('search_product','search') THEN 'search'
 WHEN event_type IN ('add_to_cart','remove_from_cart','view_cart','update_cart') THEN 'cart' WHEN event_type IN ('checkout_start','checkout_attempt','payment_attempt','purchase','order_placed') THEN 'checkout'
 WHEN event_type IN ('rating','review','product_rating') THEN 'engagement' WHEN event_type IN ('wishlist_add','wishlist_remove') THEN 'wishlist' WHEN event_type IN ('error','page_error') THEN 'error' ELSE 'other' END"""
_KNOWN = "'page_view','product_view','home_view','category_view','click','search_product','search','add_to_cart','remove_from_cart','view_cart','update_cart','checkout_start','checkout_attempt','payment_attempt','purchase','order_placed','rating','review','product_rating','wishlist_add','wishlist_remove','error','page_error'"
_KEY = "sha256('kafka|' || kafka_topic || '|' || kafka_partition || '|' || kafka_offset)"

#: Steps that several twins share.
_CTE = {
    "o_fix": """o_fix AS (SELECT *, event_timestamp IS NULL OR year(event_timestamp) <= 1970 AS repaired,
 CASE WHEN event_timestamp IS NULL OR year(event_timestamp) <= 1970 THEN _kafka_timestamp ELSE event_timestamp END AS ts FROM orders_src)""",
    "o_ok": f"""o_ok AS (SELECT upper(order_id) AS order_id, upper({_nl('user_id')}) AS user_id, ts AS event_timestamp, total, lower({_nl('status')}) AS status, lower({_nl('payment_method')}) AS payment_method
 FROM o_fix WHERE trim(user_id) <> '' AND total >= 0 AND ts IS NOT NULL)""",
    "i_ok": """i_ok AS (SELECT * FROM (SELECT *, row_number() OVER (PARTITION BY order_item_id ORDER BY _kafka_timestamp DESC, _kafka_partition DESC, _kafka_offset DESC) AS rk
 FROM items_src WHERE quantity > 0 AND unit_price >= 0 AND (item_total_amount IS NULL OR item_total_amount >= 0)) WHERE rk = 1)""",
    "p_all": """p_all AS (SELECT price_history_id, product_id, price, valid_from FROM prices_src UNION ALL
 SELECT '__UNKNOWN_PRICE__::' || product_id, product_id, NULL, TIMESTAMP '1900-01-01 00:00:00' FROM products)""",
    "p_iv": "p_iv AS (SELECT *, lead(valid_from) OVER (PARTITION BY product_id ORDER BY valid_from, price_history_id) AS valid_to FROM p_all)",
    "f_item": """f_item AS (SELECT i.order_item_id, i.order_id, 'PRD_' || sha256(p.product_id) AS product_key, i.product_id, 'PPR_' || sha256(v.price_history_id) AS product_price_key,
 CAST(strftime(o.event_timestamp, '%Y%m%d') AS INT) AS order_date_key, i.quantity, CAST(i.unit_price AS DECIMAL(29,2)) AS unit_price, CAST(i.quantity * i.unit_price AS DECIMAL(29,2)) AS gross_item_amount,
 CAST(CAST(i.quantity * i.unit_price AS DECIMAL(29,2)) - i.item_total_amount AS DECIMAL(29,2)) AS discount_amount, CAST(i.item_total_amount AS DECIMAL(29,2)) AS item_total_amount,
 CAST(v.price AS DECIMAL(29,2)) AS historical_product_price, CAST(i.unit_price - v.price AS DECIMAL(29,2)) AS price_difference, v.price_history_id, o.event_timestamp AS order_timestamp, o.user_id, o.status, o.payment_method, o.total
 FROM i_ok i JOIN o_ok o USING (order_id) LEFT JOIN products p ON p.product_id = i.product_id
 LEFT JOIN p_iv v ON v.product_id = i.product_id AND o.event_timestamp >= v.valid_from AND (v.valid_to IS NULL OR o.event_timestamp < v.valid_to))""",
    "e_all": f"""e_all AS (SELECT *, {_KEY} AS event_key, row_number() OVER (PARTITION BY {_KEY} ORDER BY copy_no) AS copy FROM ev)""",
    "e_ok": f"""e_ok AS (SELECT event_key, kafka_topic, kafka_partition, kafka_offset, event_timestamp, trim(user_id) AS user_id, trim(session_id) AS session_id, {_SNAKE.format('event_type')} AS event_type, {_DEV} AS device_type,
 {_SNAKE.format(_nl('utm_source'))} AS utm_source, {_nl('ip_address')} AS ip_address, cart_value, quantity, rating, http_status FROM e_all WHERE trim(session_id) <> '' AND trim(event_type) <> '' AND copy = 1)""",
    "e_fact": """e_fact AS (SELECT *, CAST(strftime(event_timestamp, '%Y%m%d') AS INT) AS date_key, sha256('session|' || session_id) AS session_key, sha256('device|' || lower(device_type)) AS device_key,
 sha256('event_type|' || lower(event_type)) AS event_type_key, sha256('ip|' || lower(trim(ip_address))) AS ip_address_hash FROM e_ok)""",
    "e_sess": """e_sess AS (SELECT session_key, min(event_timestamp) AS session_start_at, max(event_timestamp) AS session_end_at, count(*) AS event_count,
 CAST(floor(epoch(max(event_timestamp))) - floor(epoch(min(event_timestamp))) AS BIGINT) AS session_duration_sec, arg_min(session_id, event_timestamp) AS session_id,
 arg_min(user_id, event_timestamp) FILTER (WHERE user_id IS NOT NULL) AS user_id, arg_min(device_key, event_timestamp) AS primary_device_key FROM e_fact GROUP BY session_key)""",
    "e_obt": f"""e_obt AS (SELECT f.*, {_CAT} AS event_category, device_type AS device_name, s.session_start_at, s.session_end_at, s.session_duration_sec, s.event_count AS session_event_count, s.primary_device_key
 FROM e_fact f LEFT JOIN (SELECT session_key, session_start_at, session_end_at, session_duration_sec, event_count, primary_device_key FROM e_sess) s USING (session_key))""",
    "t_obt": """t_obt AS (SELECT f.order_item_id, f.order_id, f.product_id, coalesce(c.category_id, 'Unknown') AS category_id, f.user_id, f.price_history_id, f.order_date_key AS date_key, f.order_timestamp,
 CAST(f.order_timestamp AS DATE) AS full_date, f.status AS order_status, f.payment_method, f.quantity, f.unit_price, f.discount_amount, f.item_total_amount, coalesce(f.price_difference, 0) AS price_difference,
 CAST(f.total AS DECIMAL(29,2)) AS order_total_amount, coalesce(p.name, 'Unknown') AS product_name, coalesce(c.name, 'Unknown') AS category_name, coalesce(u.username, 'Unknown') AS username
 FROM f_item f LEFT JOIN products p ON p.product_id = f.product_id LEFT JOIN categories c ON lower(c.name) = p.category LEFT JOIN users u ON u.user_id = f.user_id)""",
    "f_step": """f_step AS (SELECT session_id, event_timestamp, CASE event_type WHEN 'page_view' THEN 1 WHEN 'product_search' THEN 2 WHEN 'add_to_cart' THEN 3 WHEN 'checkout_start' THEN 4 WHEN 'payment_attempt' THEN 5 WHEN 'order_complete' THEN 6 END AS st FROM
 (SELECT session_id, event_timestamp, regexp_replace(lower(trim(event_type)), '[\\s-]+', '_', 'g') AS event_type FROM ev WHERE trim(session_id) <> ''))""",
    "f_t1": "f_t1 AS (SELECT session_id, min(event_timestamp) AS t FROM f_step WHERE st = 1 GROUP BY session_id)",
    **{f"f_t{k}": f"f_t{k} AS (SELECT e.session_id, min(e.event_timestamp) AS t FROM f_step e JOIN f_t{k - 1} p ON e.session_id = p.session_id WHERE e.st = {k} AND e.event_timestamp > p.t GROUP BY e.session_id)" for k in range(2, 7)},
    "f_sess": """f_sess AS (SELECT f_t1.session_id, f_t1.t AS session_start_time, CASE WHEN f_t6.t IS NOT NULL THEN 6 WHEN f_t5.t IS NOT NULL THEN 5 WHEN f_t4.t IS NOT NULL THEN 4 WHEN f_t3.t IS NOT NULL THEN 3 WHEN f_t2.t IS NOT NULL THEN 2 ELSE 1 END AS depth
 FROM f_t1 LEFT JOIN f_t2 USING (session_id) LEFT JOIN f_t3 USING (session_id) LEFT JOIN f_t4 USING (session_id) LEFT JOIN f_t5 USING (session_id) LEFT JOIN f_t6 USING (session_id))""",
}


def _joined(c: str):
    return F.array_join(F.col(c), ",").alias(c)


# ---- entities -------------------------------------------------------------------------------------------------------


def _checked(spark, sf, name, table):
    return transactional.validate(view(spark, sf, name), table)


def _orders(spark, sf):
    return transactional.clean(_checked(spark, sf, "orders_src", "orders").valid, "orders")


def _items(spark, sf):
    return transactional.clean(_checked(spark, sf, "items_src", "order_items").valid, "order_items")


def _users(spark, sf):
    return transactional.clean(_checked(spark, sf, "users", "users").valid, "users")


def _dims(spark, sf):
    run = _run()
    category = kimball.dim_category(transactional.clean(_checked(spark, sf, "categories", "categories").valid, "categories"), run)
    product = kimball.dim_product(transactional.clean(_checked(spark, sf, "products", "products").valid, "products"), category, run)
    price = kimball.dim_product_price(view(spark, sf, "prices_src"), product, run)
    user = kimball.dim_user(_users(spark, sf), run)
    return user, category, product, price


def _fact_order(spark, sf, user=None):
    return kimball.fact_order(_orders(spark, sf), user if user is not None else kimball.dim_user(_users(spark, sf), _run()), _run())


def _fact_item(spark, sf):
    user, _, product, price = _dims(spark, sf)
    order = _fact_order(spark, sf, user)
    return kimball.fact_order_item(_items(spark, sf), order, product, price, _run())


def _events(spark, sf):
    raw = view(spark, sf, "ev").withColumn("bronze_ingestion_timestamp", F.col("event_timestamp") + F.make_dt_interval(secs=F.col("copy_no").cast("decimal(18,6)")))
    return events.validate_events(raw.withColumns({"processing_date": F.to_date("event_timestamp"), "pipeline_run_id": F.lit("run")}))


def _clean_events(spark, sf):
    return events.with_dimension_keys(events.clean_events(_events(spark, sf).valid))


def _fact_events(spark, sf):
    return events.fact_events(events.with_users(_clean_events(spark, sf), None), _run())


def _behavioral(spark, sf):
    cleaned, fact = _clean_events(spark, sf), _fact_events(spark, sf)
    return serving.behavioral_obt(fact, events.dim_device(cleaned, _run()), events.dim_event_type(cleaned, _run()), events.sessions(fact, _run()), _run())


def _transactional_obt(spark, sf):
    user, _, product, price = _dims(spark, sf)
    order = _fact_order(spark, sf, user)
    items = kimball.fact_order_item(_items(spark, sf), order, product, price, _run())
    return serving.transactional_obt(items, order, price, product, user, kimball.dim_date(_orders(spark, sf)))


# ---- cleaning and expressions ----------------------------------------------------------------------------------------


@query(f"SELECT upper({_nl('user_id')}) AS user_id, {_nl('username')} AS username, lower({_nl('email')}) AS email, signup_date, lower({_nl('device')}) AS device, lower({_nl('loyalty_tier')}) AS loyalty_tier, {_nl('location')} AS location FROM users", "users")
def clean_users(spark, sf):
    return _users(spark, sf).select("user_id", "username", "email", "signup_date", "device", "loyalty_tier", "location")


@query("SELECT order_id, user_id, event_timestamp, total, status, payment_method, CAST(event_timestamp AS DATE) AS order_date FROM o_ok", "orders_src")
def clean_orders(spark, sf):
    return _orders(spark, sf).select("order_id", "user_id", "event_timestamp", "total", "status", "payment_method", "order_date")


@query(f"SELECT kafka_offset, copy_no, {_nl('utm_source')} AS utm_source, {_nl('device_type')} AS device_type FROM ev", "ev")
def null_like_collapse(spark, sf):
    return view(spark, sf, "ev").select("kafka_offset", "copy_no", cl.collapse(F.col("utm_source")).alias("utm_source"), cl.collapse(F.col("device_type")).alias("device_type"))


@query(f"SELECT kafka_offset, copy_no, {_DEV} AS device_name FROM ev", "ev")
def device_alias(spark, sf):
    return view(spark, sf, "ev").select("kafka_offset", "copy_no", cl.device(F.col("device_type")).alias("device_name"))


@query(f"SELECT kafka_offset, copy_no, {_SNAKE.format('event_type')} AS event_type, {_CAT.replace('event_type', _SNAKE.format('event_type'))} AS event_category FROM ev", "ev")
def snake_case_types(spark, sf):
    kind = cl.snake(F.col("event_type"))
    return view(spark, sf, "ev").select("kafka_offset", "copy_no", kind.alias("event_type"), cl.event_category(kind).alias("event_category"))


@query("SELECT c_custkey, c_name AS username, c_mktsegment AS loyalty_tier FROM customer")
def union_flatten(spark, sf):
    union = spark.read.parquet(f"{sf}/customer.parquet").select("c_custkey", F.struct(F.col("c_name").alias("string")).alias("username"), F.col("c_mktsegment").alias("loyalty_tier"))
    return kafka_shape.flatten_unions(union, ["username", "loyalty_tier"])


@query("SELECT event_id, json_extract_string(props, '$.page') AS page FROM events")
def json_values(spark, sf):
    schema = T.StructType.fromDDL("page string")
    raw = spark.read.parquet(f"{sf}/events.parquet").select(
        F.col("props").cast("binary").alias("value"), F.lit("t").alias("topic"), F.lit(0).alias("partition"), F.col("event_id").alias("offset"), F.col("ts").alias("timestamp")
    )
    return kafka_shape.parse_json(raw, schema).select(F.col("_kafka_offset").alias("event_id"), "page")


@query(r"SELECT user_id, coalesce(regexp_matches(trim(email), '^[A-Za-z0-9._%+-]+@[A-Za-z0-9.-]+\.[A-Za-z]{2,}$'), false) AS good_email FROM users", "users")
def email_flag(spark, sf):
    return view(spark, sf, "users").select("user_id", F.coalesce(cl.good_email(F.col("email")), F.lit(False)).alias("good_email"))


@query(r"SELECT kafka_offset, copy_no, regexp_matches(ip_address, '^((25[0-5]|2[0-4][0-9]|[01]?[0-9][0-9]?)\.){3}(25[0-5]|2[0-4][0-9]|[01]?[0-9][0-9]?)$') AS good_ip FROM ev", "ev")
def ipv4_flag(spark, sf):
    return view(spark, sf, "ev").select("kafka_offset", "copy_no", cl.good_ip(F.col("ip_address")).alias("good_ip"))


@query("SELECT order_id, CASE WHEN trim(user_id) <> '' AND NOT regexp_matches(trim(user_id), '^U[0-9]$') THEN 'long' ELSE 'short' END AS kind, CASE WHEN repaired THEN 'event_timestamp:repaired' ELSE '' END AS validation_warnings FROM o_fix", "orders_src")
def id_pattern_warnings(spark, sf):
    user = F.trim("user_id")
    return _checked(spark, sf, "orders_src", "orders").rows.select("order_id", F.when((user != "") & ~user.rlike("^U[0-9]$"), "long").otherwise("short").alias("kind"), _joined("validation_warnings"))


@query(f"SELECT kafka_offset, copy_no, {_KEY} AS event_key, 'kafka_coordinate' AS event_identity_source, sha256('behavioral.events||' || kafka_partition || '||' || kafka_offset) AS bronze_event_id FROM ev", "ev")
def event_key_sha(spark, sf):
    df = events.with_identity(events.align(view(spark, sf, "ev")))
    return df.select("kafka_offset", "copy_no", "event_key", "event_identity_source", keys.bronze_event_id("kafka_topic", "kafka_partition", "kafka_offset").alias("bronze_event_id"))


@query(
    "SELECT kafka_offset, copy_no, CASE WHEN trim(session_id) <> '' THEN sha256('session|' || trim(session_id)) END AS session_key, CASE WHEN trim(event_type) <> '' THEN sha256('event_type|' || lower(trim(event_type))) END AS event_type_key, sha256('ip|' || lower(trim(ip_address))) AS ip_address_hash FROM ev",
    "ev",
)
def natural_keys(spark, sf):
    return view(spark, sf, "ev").select(
        "kafka_offset", "copy_no", keys.natural("session", F.col("session_id")).alias("session_key"), keys.natural("event_type", F.col("event_type"), case_sensitive=False).alias("event_type_key"),
        keys.ip_hash(F.col("ip_address")).alias("ip_address_hash"),
    )


@query("SELECT category_id, 'CAT_' || sha256(category_id) AS category_key, 'CAT_' || sha256('__NULL__') AS no_parent_key, 'PRD_' || sha256(category_id || '||' || '__NULL__') AS two_part_key FROM categories", "categories")
def kimball_keys(spark, sf):
    return view(spark, sf, "categories").select("category_id", keys.kimball("CAT", "category_id").alias("category_key"), keys.kimball("CAT", "parent_category_id").alias("no_parent_key"), keys.kimball("PRD", "category_id", "parent_category_id").alias("two_part_key"))


_O_ERR = "array_to_string(list_filter([CASE WHEN trim(user_id) = '' THEN 'user_id:required_value_missing' END, CASE WHEN ts IS NULL THEN 'event_timestamp:required_value_missing' END, CASE WHEN total < 0 THEN 'total:negative_value' END], lambda x: x IS NOT NULL), ',')"


@query(f"SELECT order_id, {_O_ERR} AS validation_errors FROM o_fix WHERE trim(user_id) = '' OR total < 0 OR ts IS NULL", "orders_src")
def orders_rejects(spark, sf):
    return _checked(spark, sf, "orders_src", "orders").rejected.select("order_id", _joined("validation_errors"))


@query("SELECT order_item_id, _kafka_offset, 'quantity:must_be_positive' AS validation_errors FROM items_src WHERE quantity <= 0", "items_src")
def items_rejects(spark, sf):
    return _checked(spark, sf, "items_src", "order_items").rejected.select("order_item_id", "_kafka_offset", _joined("validation_errors"))


@query(
    f"""SELECT record_id, issue_status, validation_errors, sha256('orders||' || record_id || '||' || issue_status || '||' || e || '||' || w || '||' || r || '||__NULL__||' || _kafka_partition || '||' || _kafka_offset) AS issue_key FROM (
 SELECT order_id AS record_id, _kafka_partition, _kafka_offset, {_O_ERR} AS validation_errors, CASE WHEN {_O_ERR} = '' THEN '[]' ELSE '["' || replace({_O_ERR}, ',', '","') || '"]' END AS e,
 CASE WHEN repaired THEN '["event_timestamp:repaired"]' ELSE '[]' END AS w, CASE WHEN repaired AND _kafka_timestamp IS NOT NULL THEN '{transactional.REPAIR_NOTE}' ELSE '__NULL__' END AS r,
 CASE WHEN trim(user_id) = '' OR total < 0 OR ts IS NULL THEN 'REJECTED' WHEN repaired THEN 'REPAIRED' ELSE 'WARNING' END AS issue_status FROM o_fix WHERE trim(user_id) = '' OR total < 0 OR ts IS NULL OR repaired)""",
    "orders_src",
)
def issue_keys(spark, sf):
    found = transactional.quality_issues(_checked(spark, sf, "orders_src", "orders"), "orders", _run())
    return found.select("record_id", "issue_status", _joined("validation_errors"), "issue_key")


_E_WARN = f"""list_filter([CASE WHEN user_id IS NULL OR trim(user_id) = '' THEN 'user_id:anonymous_or_missing' END, CASE WHEN utm_source IS NULL OR trim(utm_source) = '' THEN 'utm_source:missing' END,
 CASE WHEN device_type IS NULL OR trim(device_type) = '' OR {_SNAKE.format('device_type')} NOT IN ('mobile','desktop','tablet','web','android','ios','unknown') THEN 'device_type:unknown' END,
 CASE WHEN trim(event_type) <> '' AND {_SNAKE.format('event_type')} NOT IN ({_KNOWN}) THEN 'event_type:unknown' END,
 CASE WHEN kafka_offset % 300 > 255 THEN 'ip_address:invalid_format' END, 'event_id:missing_used_kafka_identity', CASE WHEN cart_value < 0 THEN 'cart_value:negative_value' END,
 CASE WHEN quantity <= 0 THEN 'quantity:must_be_positive' END, CASE WHEN rating < 1 OR rating > 5 THEN 'rating:out_of_range' END, CASE WHEN http_status < 100 OR http_status > 599 THEN 'http_status:out_of_range' END], lambda x: x IS NOT NULL)"""
_E_ERR = """list_filter([CASE WHEN trim(session_id) = '' THEN 'session_id:required_value_missing' END, CASE WHEN trim(event_type) = '' THEN 'event_type:required_value_missing' END, CASE WHEN copy > 1 THEN 'event_key:duplicate_event' END], lambda x: x IS NOT NULL)"""


@query(f"SELECT count(*) AS raw_rows, count(*) FILTER (WHERE n > 0) AS rejected_rows, count(*) FILTER (WHERE n = 0) AS processable_rows, count(*) FILTER (WHERE n = 0 AND w > 0) AS warning_rows FROM (SELECT len({_E_ERR}) AS n, len({_E_WARN}) AS w FROM e_all)", "ev")
def events_split_counts(spark, sf):
    bad, warned = F.size("validation_errors") > 0, F.size("validation_warnings") > 0
    return _events(spark, sf).rows.agg(F.count(F.lit(1)).alias("raw_rows"), F.count_if(bad).alias("rejected_rows"), F.count_if(~bad).alias("processable_rows"), F.count_if(~bad & warned).alias("warning_rows"))


@query(f"SELECT kafka_offset, issue_status, issue_code, count(*) AS n FROM (SELECT kafka_offset, 'REJECTED' AS issue_status, unnest({_E_ERR}) AS issue_code FROM e_all UNION ALL SELECT kafka_offset, 'WARNING', unnest({_E_WARN}) FROM e_all) GROUP BY ALL", "ev")
def events_issue_rows(spark, sf):
    return events.issue_rows(_events(spark, sf), _run()).groupBy("kafka_offset", "issue_status", "issue_code").agg(F.count(F.lit(1)).alias("n"))


@query(f"SELECT issue_code, count(*) AS n FROM (SELECT unnest({_E_ERR}) AS issue_code FROM e_all UNION ALL SELECT unnest({_E_WARN}) FROM e_all) GROUP BY ALL", "ev")
def issues_union_explode(spark, sf):
    return events.issue_rows(_events(spark, sf), _run()).groupBy("issue_code").agg(F.count(F.lit(1)).alias("n"))


@query("SELECT order_id, ts AS event_timestamp, CASE WHEN repaired THEN 'event_timestamp replaced with kafka timestamp' END AS repair_description FROM o_fix", "orders_src")
def order_ts_repair(spark, sf):
    return transactional.repair_timestamps(view(spark, sf, "orders_src"), "orders").select("order_id", "event_timestamp", "repair_description")


# ---- serving projections ---------------------------------------------------------------------------------------------


def _first(spark, sf, name, table, key):
    rows = serving.realtime(view(spark, sf, name), table, F.lit("2024-02-01").cast("date"))
    return rows.groupBy(*([key] if key else []), "validation_error", "is_valid").agg(F.count(F.lit(1)).alias("n"))


def _first_sql(name, cases, key=""):
    whens = " ".join(f"WHEN {c} THEN '{r}'" for r, c in cases)
    return f"SELECT {key + ', ' if key else ''}validation_error, CAST(validation_error IS NULL AS INT) AS is_valid, count(*) AS n FROM (SELECT *, CASE {whens} END AS validation_error FROM {name}) GROUP BY ALL"


_gone = lambda c: f"trim(coalesce({c}, '')) = ''"


@query(_first_sql("orders_src", [("missing_order_id", _gone("order_id")), ("missing_user_id", _gone("user_id")), ("invalid_order_timestamp", "event_timestamp IS NULL OR event_timestamp <= TIMESTAMP '1970-01-01'"), ("negative_order_total", "total < 0"), ("missing_order_status", _gone("status"))]), "orders_src")
def first_reason_orders(spark, sf):
    return _first(spark, sf, "orders_src", "orders", None)


@query(_first_sql("ev", [("missing_user_id", _gone("user_id")), ("missing_event_type", _gone("event_type")), ("missing_device", _gone("device_type")), ("missing_session_id", _gone("session_id")), ("invalid_quantity", "quantity <= 0"), ("negative_cart_value", "cart_value < 0"), ("invalid_http_status", "http_status NOT BETWEEN 100 AND 599"), ("invalid_rating", "rating NOT BETWEEN 1 AND 5")]), "ev")
def first_reason_events(spark, sf):
    return _first(spark, sf, "ev", "behavioral", None)


@query(_first_sql("items_src", [("missing_order_item_id", _gone("order_item_id")), ("missing_order_id", _gone("order_id")), ("missing_product_id", _gone("product_id")), ("invalid_quantity", "quantity <= 0"), ("negative_unit_price", "unit_price < 0"), ("negative_item_total_amount", "item_total_amount < 0")], "product_id"), "items_src")
def first_reason_items(spark, sf):
    return _first(spark, sf, "items_src", "order_items", "product_id")


@query(_first_sql("products", [("missing_product_id", _gone("product_id")), ("missing_product_name", _gone("name")), ("negative_price", "price < 0"), ("negative_inventory", "inventory < 0"), ("invalid_popularity_score", "popularity_score < 0 OR popularity_score > 100")], "product_id"), "products")
def first_reason_products(spark, sf):
    return _first(spark, sf, "products", "products", "product_id")


@query(_first_sql("users", [("missing_user_id", _gone("user_id")), ("missing_username", _gone("username")), ("missing_email", _gone("email")), ("invalid_email", "instr(trim(email), '@') <= 1"), ("invalid_signup_date", "signup_date < DATE '2000-01-01'"), ("future_signup_date", "signup_date > DATE '2024-02-01'")], "user_id"), "users")
def first_reason_users(spark, sf):
    return _first(spark, sf, "users", "users", "user_id")


@query(_first_sql("prices_src", [("missing_price_history_id", _gone("price_history_id")), ("missing_product_id", _gone("product_id")), ("negative_price", "price < 0"), ("invalid_valid_from", "valid_from IS NULL OR valid_from <= TIMESTAMP '1970-01-01'")], "price_history_id"), "prices_src")
def first_reason_prices(spark, sf):
    rows = serving.realtime(view(spark, sf, "prices_src").withColumnRenamed("valid_from", "valid_from_timestamp"), "product_price_history")
    return rows.groupBy("price_history_id", "validation_error", "is_valid").agg(F.count(F.lit(1)).alias("n"))


@query(_first_sql("categories", [("missing_category_id", _gone("category_id")), ("missing_category_name", _gone("name"))], "category_id"), "categories")
def first_reason_categories(spark, sf):
    return _first(spark, sf, "categories", "categories", "category_id")


@query("SELECT product_id, CASE WHEN inventory >= 0 THEN inventory END AS inventory, CASE WHEN popularity_score BETWEEN 0 AND 100 THEN popularity_score END AS popularity_score FROM products", "products")
def realtime_value_repair(spark, sf):
    return serving.realtime(view(spark, sf, "products"), "products").select("product_id", "inventory", "popularity_score")


# ---- deduplication and windows ---------------------------------------------------------------------------------------


@query("SELECT order_item_id, _kafka_offset, quantity, unit_price, item_total_amount FROM (SELECT *, row_number() OVER (PARTITION BY order_item_id ORDER BY _kafka_timestamp DESC, _kafka_partition DESC, _kafka_offset DESC) AS rk FROM items_src) WHERE rk = 1", "items_src")
def latest_per_key(spark, sf):
    return dedup.latest_per_key(transactional.normalize_schema(view(spark, sf, "items_src"), "order_items"), "order_items").select("order_item_id", "_kafka_offset", "quantity", "unit_price", "item_total_amount")


@query("SELECT _kafka_offset, max(_kafka_timestamp) AS _kafka_timestamp, count(DISTINCT _kafka_offset) AS n FROM items_src GROUP BY _kafka_offset", "items_src")
def coordinate_dedup(spark, sf):
    rows = transactional.normalize_schema(view(spark, sf, "items_src").withColumn("_kafka_topic", F.lit("items")), "order_items")
    return dedup.dedup_coordinates(rows, "order_items").groupBy("_kafka_offset").agg(F.max("_kafka_timestamp").alias("_kafka_timestamp"), F.count(F.lit(1)).alias("n"))


@query("SELECT kafka_offset, copy_no, copy, count(*) OVER (PARTITION BY event_key) AS copies FROM e_all", "ev")
def dup_rank_events(spark, sf):
    from pyspark.sql import Window

    rows = events.with_identity(events.align(view(spark, sf, "ev")))
    w = Window.partitionBy("event_key")
    return rows.select("kafka_offset", "copy_no", F.row_number().over(w.orderBy("copy_no")).alias("copy"), F.count(F.lit(1)).over(w).alias("copies"))


@query(f"SELECT event_key, kafka_offset, array_to_string({_E_ERR}, ',') AS validation_errors FROM (SELECT *, row_number() OVER (PARTITION BY event_key ORDER BY copy_no DESC) AS rk FROM e_all WHERE len({_E_ERR}) > 0) WHERE rk = 1", "ev")
def quarantine_representative(spark, sf):
    return events.quarantine(_events(spark, sf), _run()).select("event_key", "kafka_offset", _joined("validation_errors"))


@query("SELECT session_key, session_id, user_id, primary_device_key FROM e_sess", "ev")
def session_first_nonnull(spark, sf):
    return events.sessions(_fact_events(spark, sf), _run()).select("session_key", "session_id", "user_id", "primary_device_key")


@query("SELECT price_history_id, product_id, price, valid_from, valid_to, valid_to IS NULL AS is_current FROM p_iv", "prices_src products")
def scd2_prices(spark, sf):
    return _dims(spark, sf)[3].select("price_history_id", "product_id", "price", "valid_from", "valid_to", "is_current")


@query("SELECT product_id, price_history_id, price FROM p_iv WHERE valid_to IS NULL", "prices_src products")
def scd2_current(spark, sf):
    return _dims(spark, sf)[3].where("is_current").select("product_id", "price_history_id", "price")


@query("SELECT product_id, price_history_id, valid_from, valid_to FROM p_iv", "prices_src products")
def union_unknown_prices(spark, sf):
    return _dims(spark, sf)[3].select("product_id", "price_history_id", "valid_from", "valid_to")


# ---- joins -----------------------------------------------------------------------------------------------------------


@query("SELECT i.order_item_id, i.order_id FROM i_ok i WHERE NOT EXISTS (SELECT 1 FROM o_ok o WHERE o.order_id = i.order_id)", "orders_src items_src")
def orphans_anti(spark, sf):
    return transactional.split_by_parent(_items(spark, sf), _orders(spark, sf))[1].select("order_item_id", "order_id")


@query("SELECT i.order_item_id, i.order_id FROM i_ok i WHERE EXISTS (SELECT 1 FROM o_ok o WHERE o.order_id = i.order_id)", "orders_src items_src")
def parents_semi(spark, sf):
    return transactional.split_by_parent(_items(spark, sf), _orders(spark, sf))[0].select("order_item_id", "order_id")


@query("SELECT 'USR_' || sha256(user_id) AS user_key, user_id, username, signup_date, lower(loyalty_tier) AS loyalty_tier FROM users", "users")
def dim_user(spark, sf):
    return _dims(spark, sf)[0].select("user_key", "user_id", "username", "signup_date", "loyalty_tier")


@query("SELECT 'CAT_' || sha256(category_id) AS category_key, category_id, upper(left(name, 1)) || lower(substr(name, 2)) AS category_name FROM categories", "categories")
def dim_category(spark, sf):
    return _dims(spark, sf)[1].select("category_key", "category_id", "category_name")


@query("SELECT 'PRD_' || sha256(p.product_id) AS product_key, p.product_id, p.name AS product_name, 'CAT_' || sha256(c.category_id) AS category_key, c.category_id, c.name AS category_name, p.price, p.inventory FROM products p LEFT JOIN categories c ON lower(c.name) = p.category", "products categories")
def dim_product_join(spark, sf):
    return _dims(spark, sf)[2].select("product_key", "product_id", "product_name", "category_key", "category_id", "category_name", "price", "inventory")


@query("SELECT order_item_id, price_history_id, historical_product_price FROM f_item", "orders_src items_src products prices_src")
def price_as_of(spark, sf):
    _, _, _, price = _dims(spark, sf)
    placed = _items(spark, sf).select("order_item_id", "order_id", "product_id").join(_fact_order(spark, sf).select("order_id", "order_timestamp"), "order_id")
    found = kimball.price_as_of(placed, price)
    return found.select("order_item_id", "price_history_id", F.col("historical_product_price").cast("decimal(29,2)").alias("historical_product_price"))


@query("SELECT order_id, 'USR_' || sha256(u.user_id) AS user_key, o.user_id, CAST(strftime(event_timestamp, '%Y%m%d') AS INT) AS order_date_key, event_timestamp AS order_timestamp, status, payment_method, CAST(total AS DECIMAL(29,2)) AS total_amount, 1 AS order_count FROM o_ok o LEFT JOIN users u ON u.user_id = o.user_id", "orders_src users")
def fact_order(spark, sf):
    return _fact_order(spark, sf).drop("silver_created_at", "silver_updated_at")


@query(
    "SELECT order_item_id, order_id, product_key, product_id, product_price_key, order_date_key, quantity, unit_price, gross_item_amount, discount_amount, item_total_amount, CAST(gross_item_amount - discount_amount AS DECIMAL(29,2)) AS calculated_item_amount, historical_product_price, price_difference FROM f_item",
    "orders_src items_src products prices_src",
)
def fact_order_item(spark, sf):
    return _fact_item(spark, sf).drop("silver_created_at", "silver_updated_at")


_T_COLS = "order_item_id, order_id, product_id, category_id, user_id, price_history_id, date_key, order_timestamp, full_date, order_status, payment_method, quantity, unit_price, discount_amount, item_total_amount, price_difference, order_total_amount, product_name, category_name, username"


@query(f"SELECT {_T_COLS} FROM t_obt", "orders_src items_src products prices_src categories users")
def obt_transactional(spark, sf):
    return _transactional_obt(spark, sf).select(*_T_COLS.split(", "))


_B_COLS = "event_key, event_timestamp, date_key, user_id, session_key, session_start_at, session_end_at, session_duration_sec, session_event_count, device_key, device_name, primary_device_key, event_type_key, event_type, event_category, utm_source, ip_address_hash, http_status, quantity, cart_value, rating, kafka_partition, kafka_offset"


@query(f"SELECT {_B_COLS} FROM e_obt", "ev")
def obt_behavioral(spark, sf):
    return _behavioral(spark, sf).select(*_B_COLS.split(", "))


@query("SELECT event_key, e.user_id, 'USR_' || sha256(u.user_id) AS user_key FROM e_ok e LEFT JOIN users u ON u.user_id = e.user_id", "ev users")
def user_lookup_left(spark, sf):
    return events.with_users(_clean_events(spark, sf), _dims(spark, sf)[0]).select("event_key", "user_id", "user_key")


def _stale(spark, sf):
    """Every seventh event has the key of its old form, and every 21st lost its topic."""
    fact = _fact_events(spark, sf)
    old = F.col("kafka_offset") % 7 == 0
    return fact.withColumn("event_key", F.when(old, F.concat(F.lit("EVT-"), F.col("kafka_offset"))).otherwise(F.col("event_key"))).withColumn("kafka_topic", F.when(F.col("kafka_offset") % 21 != 0, F.col("kafka_topic")))


@query(f"SELECT 'EVT-' || kafka_offset AS old_key, {_KEY} AS new_key FROM e_ok WHERE kafka_offset % 7 = 0", "ev")
def migration_mapping(spark, sf):
    return migrate.mapping(events.align(view(spark, sf, "ev")), migrate.stale_rows(_stale(spark, sf)))


@query("SELECT kafka_partition, kafka_offset, CAST(2 AS BIGINT) AS topics FROM e_ok WHERE kafka_offset % 21 = 0 AND kafka_offset % 2 = 0", "ev")
def migration_ambiguity(spark, sf):
    bronze = events.align(view(spark, sf, "ev"))
    second = bronze.where("kafka_offset % 2 = 0").withColumn("kafka_topic", F.lit("other"))
    return migrate.ambiguous(bronze.unionByName(second), migrate.stale_rows(_stale(spark, sf)))


# ---- aggregates and reports ------------------------------------------------------------------------------------------


@query("SELECT device_key, min(device_type) AS device_name, min(event_timestamp) AS first_seen_at, max(event_timestamp) AS last_seen_at FROM e_fact GROUP BY device_key", "ev")
def dim_device(spark, sf):
    return events.dim_device(_clean_events(spark, sf), _run()).drop("silver_updated_at")


@query(f"SELECT event_type_key, event_type, min(event_timestamp) AS first_seen_at, max(event_timestamp) AS last_seen_at, {_CAT} AS event_category FROM e_fact GROUP BY event_type_key, event_type", "ev")
def dim_event_type(spark, sf):
    return events.dim_event_type(_clean_events(spark, sf), _run()).drop("silver_updated_at")


@query("SELECT session_key, session_id, user_id, session_start_at, session_end_at, session_duration_sec, primary_device_key, event_count FROM e_sess", "ev")
def dim_session(spark, sf):
    return events.sessions(_fact_events(spark, sf), _run()).drop("silver_updated_at", "user_key")


@query("SELECT order_item_id, count(*) AS copies FROM items_src GROUP BY order_item_id HAVING count(*) > 1", "items_src")
def dup_keys(spark, sf):
    return dedup.duplicate_keys(view(spark, sf, "items_src"), ["order_item_id"])


def _served_orders(spark, sf):
    return serving.realtime(view(spark, sf, "orders_src"), "orders").withColumnRenamed("event_timestamp", "order_timestamp")


_O_VALID = "trim(user_id) <> '' AND total >= 0 AND event_timestamp IS NOT NULL"


@query(f"SELECT date_trunc('minute', event_timestamp) AS minute, count(*) AS orders_per_minute FROM orders_src WHERE {_O_VALID} AND event_timestamp >= TIMESTAMP '1998-01-01 00:00:00' - INTERVAL 6 HOUR GROUP BY 1", "orders_src")
def orders_per_minute(spark, sf):
    return reports.orders_per_minute(_served_orders(spark, sf), F.lit("1998-01-01 00:00:00").cast("timestamp"))


@query(f"SELECT date_trunc('minute', event_timestamp) AS minute, avg(CAST(total AS DOUBLE)) AS avg_order_amount, min(total) AS min_amount, max(total) AS max_amount FROM orders_src WHERE {_O_VALID} GROUP BY 1", "orders_src")
def order_amount_per_minute(spark, sf):
    return reports.order_amount_per_minute(_served_orders(spark, sf)).withColumn("avg_order_amount", F.col("avg_order_amount").cast("double"))


@query("SELECT event_category, event_type, count(*) AS events, count(DISTINCT user_id) AS users, count(DISTINCT session_key) AS sessions, round(sum(cart_value), 2) AS cart_value_sum FROM e_obt GROUP BY ALL ORDER BY events DESC, event_category, event_type LIMIT 50", "ev")
def category_rollup(spark, sf):
    return reports.category_rollup(_behavioral(spark, sf)).withColumn("cart_value_sum", F.round("cart_value_sum", 2))


@query("SELECT device_name, count(*) AS events, count(DISTINCT user_id) AS users, count(DISTINCT session_key) AS sessions FROM e_obt GROUP BY device_name", "ev")
def device_rollup(spark, sf):
    return reports.device_rollup(_behavioral(spark, sf)).drop("avg_duration_sec")


@query("SELECT utm_source, count(*) FILTER (WHERE event_category = 'browse') AS browse_events, count(*) FILTER (WHERE event_category = 'cart') AS cart_events, count(*) FILTER (WHERE event_category = 'checkout') AS checkout_events, count(*) FILTER (WHERE event_type IN ('purchase','order_placed')) AS purchase_events FROM e_obt GROUP BY utm_source", "ev")
def attribution(spark, sf):
    return reports.attribution(_behavioral(spark, sf))


@query("SELECT count(*) AS total_rows, count(DISTINCT event_key) AS unique_event_keys, count(*) - count(DISTINCT event_key) AS duplicate_event_keys FROM e_obt", "ev")
def grain_check(spark, sf):
    return reports.grain_check(_behavioral(spark, sf))


@query("SELECT max(event_timestamp) AS latest_event_timestamp, TIMESTAMP '2024-02-01 00:00:00' AS latest_silver_ingestion_timestamp, TIMESTAMP '2024-02-01 00:00:00' AS latest_gold_loaded_at FROM e_obt", "ev")
def freshness(spark, sf):
    return reports.freshness(_behavioral(spark, sf))


@query("SELECT sum(order_total_amount) AS gross_sales, sum(discount_amount) AS total_discount, sum(order_total_amount - item_total_amount) AS total_shipping, CAST(0 AS DECIMAL(38,2)) AS total_refund, sum(order_total_amount - discount_amount) AS net_revenue_before_shipping, count(*) AS total_orders FROM t_obt WHERE order_status NOT IN ('cancelled') AND order_total_amount > 0", "orders_src items_src products prices_src categories users")
def financial_summary(spark, sf):
    return reports.financial_summary(_transactional_obt(spark, sf))


@query("SELECT sum(t) AS gross_sales, sum(d) AS total_discount, sum(t - i) AS total_shipping, CAST(0 AS DECIMAL(38,2)) AS total_refund, sum(t - d) AS net_revenue_before_shipping, count(*) AS total_orders FROM (SELECT order_id, max(order_total_amount) AS t, sum(discount_amount) AS d, sum(item_total_amount) AS i FROM t_obt WHERE order_status NOT IN ('cancelled') AND order_total_amount > 0 GROUP BY order_id)", "orders_src items_src products prices_src categories users")
def financial_summary_by_order(spark, sf):
    return reports.financial_summary(_transactional_obt(spark, sf), grain="order")


def _funnel(spark, sf):
    rows = view(spark, sf, "ev").withColumn("event_type", cl.snake(F.col("event_type")))
    return reports.funnel_sessions(rows, F.lit("2024-03-01 00:00:00").cast("timestamp"), tie="source_id")


@query("SELECT session_id, session_start_time, depth FROM f_sess", "ev")
def funnel_sessions(spark, sf):
    return _funnel(spark, sf)


_NAMES = ", ".join(f"({i + 1}, '{n}')" for i, (_, n) in enumerate(FUNNEL_STAGES))


@query(
    f"""SELECT stage_order, stage_name, sessions, round(CASE WHEN s1 > 0 THEN sessions * 100.0 / s1 ELSE 0 END, 2)::DOUBLE AS conversion_from_start_percent, round(CASE WHEN prev > 0 THEN sessions * 100.0 / prev ELSE 0 END, 2)::DOUBLE AS conversion_from_previous_percent,
 prev - sessions AS drop_off_sessions, round(CASE WHEN prev > 0 THEN (prev - sessions) * 100.0 / prev ELSE 0 END, 2)::DOUBLE AS drop_off_rate_percent FROM (
 SELECT *, coalesce(lag(sessions) OVER (ORDER BY stage_order), sessions) AS prev, first_value(sessions) OVER (ORDER BY stage_order) AS s1 FROM (SELECT n.k AS stage_order, n.name AS stage_name, (SELECT count(*) FROM f_sess WHERE depth >= n.k) AS sessions FROM (VALUES {_NAMES}) n(k, name)))""",
    "ev",
)
def funnel_report(spark, sf):
    return reports.funnel_report(_funnel(spark, sf))


@query("SELECT kafka_topic AS _kafka_topic, kafka_partition AS _kafka_partition, count(*) AS rows, count(DISTINCT kafka_offset) AS distinct_offsets, min(kafka_offset) AS min_offset, max(kafka_offset) AS max_offset FROM ev GROUP BY ALL", "ev")
def partition_stats(spark, sf):
    names = {f"kafka_{c}": f"_kafka_{c}" for c in ("topic", "partition", "offset")}
    return reports.partition_stats(view(spark, sf, "ev").withColumnsRenamed(names))


@query("SELECT CAST(1 AS BIGINT) AS files, count(*) AS rows, count(DISTINCT (kafka_partition, kafka_offset)) AS distinct_coordinates, count(*) - count(DISTINCT (kafka_partition, kafka_offset)) AS repeated_coordinates, CAST(0 AS BIGINT) AS without_coordinates FROM ev", "ev")
def bronze_summary(spark, sf):
    names = {f"kafka_{c}": f"_kafka_{c}" for c in ("topic", "partition", "offset")}
    return reports.bronze_summary(view(spark, sf, "ev").withColumnsRenamed(names).withColumn("_source_file", F.lit("f")))


@query(
    """SELECT CAST(strftime(d, '%Y%m%d') AS INT) AS date_key, d AS full_date, CAST(day(d) AS INT) AS day_of_month, CAST(dayofweek(d) + 1 AS INT) AS day_of_week, dayname(d) AS day_name, CAST(weekofyear(d) AS INT) AS week_of_year, CAST(month(d) AS INT) AS month_number, monthname(d) AS month_name,
 CAST(quarter(d) AS INT) AS quarter_number, CAST(year(d) AS INT) AS year_number, dayofweek(d) IN (0, 6) AS is_weekend FROM (SELECT CAST(unnest(generate_series(min(CAST(event_timestamp AS DATE)), max(CAST(event_timestamp AS DATE)), INTERVAL 1 DAY)) AS DATE) AS d FROM o_ok)""",
    "orders_src",
)
def dim_date(spark, sf):
    return kimball.dim_date(_orders(spark, sf))


@query("SELECT event_type, count(*) AS events FROM e_ok GROUP BY event_type ORDER BY events DESC, event_type LIMIT 50", "ev")
def top50_event_types(spark, sf):
    return _clean_events(spark, sf).groupBy("event_type").agg(F.count(F.lit(1)).alias("events")).orderBy(F.desc("events"), "event_type").limit(50)


@query("SELECT t.month_number, t.year_number, category_name, sum(item_total_amount) AS revenue, count(*) AS items FROM t_obt, (SELECT DISTINCT CAST(strftime(event_timestamp, '%Y%m%d') AS INT) AS dk, CAST(month(event_timestamp) AS INT) AS month_number, CAST(year(event_timestamp) AS INT) AS year_number FROM o_ok) t WHERE t.dk = date_key GROUP BY ALL", "orders_src items_src products prices_src categories users")
def revenue_by_month_and_category(spark, sf):
    return _transactional_obt(spark, sf).groupBy("month_number", "year_number", "category_name").agg(F.sum("item_total_amount").alias("revenue"), F.count(F.lit(1)).alias("items"))


# ---- merges ----------------------------------------------------------------------------------------------------------


def _halves(spark, sf):
    """A target and a source that share a third of their keys."""
    orders = spark.read.parquet(f"{sf}/orders.parquet")
    shape = lambda df, price: df.select("o_orderkey", F.col("o_custkey").alias("customer"), price.alias("price"), F.col("o_orderdate").alias("first_seen"), F.col("o_orderdate").alias("last_seen"))
    target = shape(orders.where("o_orderkey % 3 <> 0"), F.col("o_totalprice"))
    later = orders.where("o_orderkey % 3 <> 1").withColumn("o_orderdate", F.col("o_orderdate") + F.make_dt_interval(days=F.col("o_orderkey").cast("int") % 5 - 2))
    return target, shape(later, -F.col("o_totalprice"))


_HALVES = """t AS (SELECT o_orderkey, o_custkey AS customer, o_totalprice AS price, o_orderdate AS first_seen, o_orderdate AS last_seen FROM orders WHERE o_orderkey % 3 <> 0),
 s AS (SELECT o_orderkey, o_custkey AS customer, -o_totalprice AS price, o_orderdate + (o_orderkey % 5 - 2) * INTERVAL '1' DAY AS first_seen, o_orderdate + (o_orderkey % 5 - 2) * INTERVAL '1' DAY AS last_seen FROM orders WHERE o_orderkey % 3 <> 1)"""


@query(f"WITH {_HALVES} SELECT * FROM t UNION ALL SELECT * FROM s WHERE o_orderkey NOT IN (SELECT o_orderkey FROM t)")
def merge_insert_only(spark, sf):
    return merge_frames(*_halves(spark, sf), ["o_orderkey"], Merge(INSERT_ONLY))


@query(f"WITH {_HALVES} SELECT s.o_orderkey, s.customer, s.price, coalesce(t.first_seen, s.first_seen) AS first_seen, s.last_seen FROM s LEFT JOIN t USING (o_orderkey) UNION ALL SELECT * FROM t WHERE o_orderkey NOT IN (SELECT o_orderkey FROM s)")
def merge_upsert_all(spark, sf):
    return merge_frames(*_halves(spark, sf), ["o_orderkey"], Merge(UPSERT_ALL, protected=("first_seen",)))


@query(f"WITH {_HALVES} SELECT o_orderkey, coalesce(s.customer, t.customer) AS customer, coalesce(s.price, t.price) AS price, least(t.first_seen, s.first_seen) AS first_seen, greatest(t.last_seen, s.last_seen) AS last_seen FROM t FULL JOIN s USING (o_orderkey)")
def merge_preserve_bounds(spark, sf):
    return merge_frames(*_halves(spark, sf), ["o_orderkey"], Merge(PRESERVE_BOUNDS, least=("first_seen",), greatest=("last_seen",)))


@query(f"WITH {_HALVES} SELECT o_orderkey, coalesce(s.customer, t.customer) AS customer, CASE WHEN t.price IS NULL THEN s.price WHEN s.price IS NULL THEN t.price ELSE t.price + s.price END AS price, coalesce(s.first_seen, t.first_seen) AS first_seen, coalesce(s.last_seen, t.last_seen) AS last_seen FROM t FULL JOIN s USING (o_orderkey)")
def merge_custom(spark, sf):
    return merge_frames(*_halves(spark, sf), ["o_orderkey"], Merge(custom={"price": lambda old, new: old + new}))


@query(f"WITH {_HALVES} SELECT s.* FROM s UNION ALL SELECT * FROM t WHERE o_orderkey NOT IN (SELECT o_orderkey FROM s)")
def merge_idempotent(spark, sf):
    target, source = _halves(spark, sf)
    once = merge_frames(target, source, ["o_orderkey"], Merge())
    return merge_frames(once, source, ["o_orderkey"], Merge())


@query("SELECT order_item_id, quantity, _kafka_offset FROM (SELECT *, row_number() OVER (PARTITION BY order_item_id ORDER BY _kafka_offset DESC) AS rk FROM items_src) WHERE rk = 1", "items_src")
def replacing_latest(spark, sf):
    return dedup.latest_version(view(spark, sf, "items_src").select("order_item_id", "quantity", "_kafka_offset"), ["order_item_id"], "_kafka_offset")


@query("SELECT full_date, count(*) AS rows, sum(v) AS v FROM (SELECT CAST(o_orderdate AS DATE) AS full_date, CASE WHEN CAST(o_orderdate AS DATE) = DATE '1995-06-17' THEN 2 ELSE 1 END AS v FROM orders) GROUP BY full_date")
def partition_replace(spark, sf):
    from .plans.store import Store

    rows = spark.read.parquet(f"{sf}/orders.parquet").select("o_orderkey", F.to_date("o_orderdate").alias("full_date"), F.lit(1).alias("v"))
    store = Store(spark, _scratch(spark))
    store.ensure("t", rows.schema)
    store.merge("t", rows, ["o_orderkey"], Merge(INSERT_ONLY))
    day = date(1995, 6, 17)
    store.replace_partition("t", rows.where(F.col("full_date") == F.lit(day)).withColumn("v", F.lit(2)), "full_date", day)
    return store.read("t").groupBy("full_date").agg(F.count(F.lit(1)).alias("rows"), F.sum("v").alias("v"))


@query("SELECT event_id, CASE event_id % 5 WHEN 0 THEN 'error' WHEN 1 THEN 'other' WHEN 2 THEN 'search' WHEN 3 THEN 'engagement' ELSE 'error' END AS event_category FROM events")
def event_categories(spark, sf):
    """Written types: page errors in two spellings, an unknown one and others."""
    written = F.element_at(F.array(*[F.lit(x) for x in ("Page Error", "error_page", "search-product", " rating ", "error")]), (F.col("event_id") % 5 + 1).cast("int"))
    return spark.read.parquet(f"{sf}/events.parquet").select("event_id", cl.event_category(cl.snake(written)).alias("event_category"))


@query("SELECT 'U' || c_custkey AS user_id, CASE WHEN c_custkey % 4 IN (0, 2) THEN 'email:unusual_format' ELSE '' END AS validation_warnings FROM customer")
def email_warnings(spark, sf):
    """Blank and malformed addresses are flagged, absent and good ones aren't."""
    n = F.col("c_custkey")
    email = F.when(n % 4 == 0, "  ").when(n % 4 == 1, " a.b@c.org ").when(n % 4 == 2, "a.b@c")
    rows = spark.read.parquet(f"{sf}/customer.parquet").select(F.concat(F.lit("U"), n).alias("user_id"), email.alias("email"))
    return transactional.validate(transactional.normalize_schema(rows, "users"), "users").rows.select("user_id", _joined("validation_warnings"))


# ---- streams ---------------------------------------------------------------------------------------------------------


def _scratch(spark: SparkSession) -> str:
    """A new folder below the shared one."""
    import uuid

    base = spark.conf.get("spark.checkpoint.dir", None) or f"file://{tempfile.gettempdir()}/strataforge"
    return f"{base.rstrip('/')}/query-{uuid.uuid4().hex}"


@query("SELECT event_id, event_type, validation_error, is_valid FROM (SELECT event_id, lower(event_type) AS event_type, CASE WHEN value < 0 THEN 'negative_cart_value' END AS validation_error, CAST(coalesce(value >= 0, true) AS INT) AS is_valid FROM events)")
def stream_realtime_events(spark, sf):
    at = _scratch(spark)
    raw = spark.read.parquet(f"{sf}/events.parquet").select("event_id", F.col("ts").cast("timestamp").alias("event_timestamp"), F.concat(F.lit("U"), F.col("user_id")).alias("user_id"), "event_type", F.lit("web").alias("device"), F.lit("s").alias("session_id"), F.col("value").alias("cart_value"))
    raw.write.parquet(f"{at}/in")
    messages = spark.readStream.schema(raw.schema).parquet(f"{at}/in")
    stream_realtime.serve(messages, "behavioral", f"{at}/out", f"{at}/checkpoint", _run()).awaitTermination()
    return spark.read.parquet(f"{at}/out").select(F.col("event_id").cast("bigint").alias("event_id"), "event_type", "validation_error", "is_valid")


_AVRO = '{"type":"record","name":"e","fields":[{"name":"event_id","type":"long"}]}'


@query("SELECT event_id, CASE event_id % 5 WHEN 1 THEN 'invalid_magic_byte' WHEN 2 THEN 'schema_id_mismatch' WHEN 3 THEN 'message_too_short' END AS decode_error, CASE WHEN event_id % 5 IN (0, 4) THEN event_id END AS decoded FROM events")
def avro_wire_decode(spark, sf):
    """Framed values of integers of any length, with faults by modulus."""
    from .sources.avro import decode

    n = F.col("event_id").cast("bigint")
    signed = F.shiftleft(n, 1).bitwiseXOR(F.shiftright(n, 63))  # zigzag
    left = lambda k: F.shiftrightunsigned(signed, 7 * k)
    byte = lambda k: F.lpad(F.hex(left(k).bitwiseAND(F.lit(127)) + F.when((left(k + 1) != 0) if k < 9 else F.lit(False), 128).otherwise(0)), 2, "0")
    varint = F.unhex(F.concat(*[byte(k) if not k else F.when(left(k) != 0, byte(k)).otherwise("") for k in range(10)]))
    magic, schema_id = F.when(n % 5 == 1, F.lit("01")).otherwise(F.lit("00")), F.when(n % 5 == 2, F.lit("00000009")).otherwise(F.lit("00000007"))
    body = F.concat(F.unhex(F.concat(magic, schema_id)), varint)
    rows = spark.read.parquet(f"{sf}/events.parquet").select(n.alias("offset"), F.when(n % 5 == 3, F.unhex(F.lit("0000"))).otherwise(body).alias("value"))
    return decode(rows, _AVRO, 7).select(F.col("offset").alias("event_id"), "decode_error", F.col("event_id").alias("decoded"))
