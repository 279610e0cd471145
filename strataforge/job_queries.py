"""Registered queries of whole flows: raw tables from framed messages, reads of drifting partitions, daily jobs on the store."""

from __future__ import annotations

from datetime import date, datetime

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from . import queries as base
from .adapters import view
from .contracts import conform
from .functions import clean as cl
from .operators import dedup, events, kimball, reports, serving, transactional
from .plans import gold, migrate, silver
from .plans.store import INSERT_ONLY, Merge, Store
from .queries import query
from .sources import kafka_shape, partitions
from .streaming import bronze
from .streaming import realtime as stream_realtime

_MOMENT = datetime.fromisoformat("2024-02-01 00:00:00")
_DAY = date(2024, 1, 31)


def _read(spark, sf, table):
    return spark.read.parquet(f"{sf}/{table}.parquet")


# ---- framed messages -------------------------------------------------------------------------------------------------


def _text(c: Column) -> Column:
    """A short text of a message: twice its length as one byte, then the text."""
    body = F.coalesce(c, F.lit("")).cast("binary")
    return F.concat(F.unhex(F.lpad(F.hex(F.octet_length(body) * 2), 2, "0")), body)


def _record(*names: str) -> str:
    return '{"type":"record","name":"r","fields":[%s]}' % ", ".join('{"name":"%s","type":"string"}' % n for n in names)


_EVENT_FIELDS = ("user_id", "session_id", "event_type", "device", "timestamp")


def _event_records(spark, sf) -> DataFrame:
    """Messages of all events, with faults by modulus in frames and fields."""
    n = F.col("event_id")
    fields = {
        "user_id": F.when(n % 13 != 0, F.concat(F.lit(" U"), F.col("user_id"))), "session_id": F.when(n % 11 != 0, F.concat(F.lit("S"), F.col("user_id"), F.lit(" "))),
        "event_type": F.concat(F.lit(" "), F.upper("event_type")), "device": F.lit(" iOS "),
        "timestamp": F.when(n % 17 == 0, "soon").when(n % 19 != 0, F.date_format("ts", "yyyy-MM-dd HH:mm:ss")),
    }
    frame = F.unhex(F.when(n % 23 == 0, "0100000007").when(n % 29 == 0, "0000000009").otherwise("0000000007"))
    body = F.concat(frame, *[_text(fields[f]) for f in _EVENT_FIELDS])
    value = F.when(n % 31 == 0, F.unhex(F.lit("0000"))).when(n % 37 == 0, F.concat(body, F.unhex(F.lit("00")))).otherwise(body)
    return _read(spark, sf, "events").select(
        F.lit(None).cast("binary").alias("key"), value.alias("value"), F.lit("behavioral.events").alias("topic"), F.lit(0).alias("partition"), n.cast("bigint").alias("offset"),
        F.lit("2024-01-31 00:00:00").cast("timestamp").alias("timestamp"),
    )


_FAULT = "CASE WHEN event_id % 31 = 0 THEN 'message_too_short' WHEN event_id % 23 = 0 THEN 'invalid_magic_byte' WHEN event_id % 37 = 0 THEN 'avro_decode_failed' WHEN event_id % 29 = 0 THEN 'schema_id_mismatch' END"
_SEEN = f"""(SELECT *, ts::TIMESTAMP AS t, {_FAULT} AS fault FROM events)"""


@query(
    f"""SELECT event_id AS kafka_offset, sha256('behavioral.events||0||' || event_id) AS bronze_event_id, fault AS decode_error,
 CASE WHEN fault IS NULL AND event_id % 13 <> 0 THEN 'U' || user_id WHEN fault IS NULL THEN '' END AS user_id, CASE WHEN fault IS NULL THEN lower(event_type) END AS event_type, CASE WHEN fault IS NULL THEN 'ios' END AS device_type,
 CASE WHEN fault IS NULL AND event_id % 17 <> 0 AND event_id % 19 <> 0 THEN date_trunc('second', t) END AS event_timestamp,
 CASE WHEN fault IS NULL AND event_id % 17 <> 0 AND event_id % 19 <> 0 THEN CAST(t AS DATE) ELSE DATE '2024-01-31' END AS event_date,
 event_id % 31 <> 0 AND (event_id % 23 = 0 OR event_id % 29 <> 0) AS schema_id_matches,
 array_to_string(list_filter([CASE WHEN fault IS NOT NULL OR (event_id % 19 = 0 AND event_id % 17 <> 0) THEN 'missing_timestamp' END, CASE WHEN fault IS NOT NULL OR event_id % 13 = 0 THEN 'missing_user_id' END,
 CASE WHEN fault IS NOT NULL THEN 'missing_event_type' END, CASE WHEN fault IS NOT NULL THEN 'missing_device_type' END, CASE WHEN fault IS NOT NULL OR event_id % 11 = 0 THEN 'missing_session_id' END,
 CASE WHEN fault IS NOT NULL OR event_id % 17 = 0 OR event_id % 19 = 0 THEN 'invalid_event_timestamp' END, CASE WHEN fault = 'invalid_magic_byte' THEN 'invalid_magic_byte' END,
 CASE WHEN fault IN ('avro_decode_failed', 'message_too_short') THEN 'avro_decode_failed' END, CASE WHEN fault = 'schema_id_mismatch' THEN 'schema_id_mismatch' END], lambda x: x IS NOT NULL), ',') AS validation_errors FROM {_SEEN}"""
)
def bronze_event_rows(spark, sf):
    """Raw events as the ingest writes them, faulty ones flagged and kept."""
    rows = bronze.bronze_events(_event_records(spark, sf), _record(*_EVENT_FIELDS), 7, base._run())
    return rows.select("kafka_offset", F.col("event_id").alias("bronze_event_id"), "decode_error", "user_id", "event_type", "device_type", "event_timestamp", "event_date", "schema_id_matches", base._joined("validation_errors"))


_ORDER_FIELDS = ("order_id", "user_id", "event_timestamp", "total", "status")


def _order_records(spark, sf) -> DataFrame:
    n = F.col("o_orderkey")
    fields = {
        "order_id": F.concat(F.lit("O"), n), "user_id": F.when(n % 29 != 0, F.concat(F.lit("U"), F.col("o_custkey"))), "event_timestamp": F.when(n % 41 != 0, F.date_format("o_orderdate", "yyyy-MM-dd HH:mm:ss")),
        "total": F.col("o_totalprice").cast("decimal(18,2)").cast("string"), "status": F.when(F.col("o_orderstatus") == "F", " DONE").otherwise("open"),
    }
    body = F.concat(F.unhex(F.lit("0000000003")), *[_text(fields[f]) for f in _ORDER_FIELDS])
    return _read(spark, sf, "orders").select(
        F.lit(None).cast("binary").alias("key"), body.alias("value"), F.lit("orders").alias("topic"), F.lit(1).alias("partition"), n.cast("bigint").alias("offset"),
        F.lit("2024-01-31 00:00:00").cast("timestamp").alias("timestamp"),
    )


@query("SELECT 'O' || o_orderkey AS order_id, CASE WHEN o_orderkey % 29 = 0 THEN '' ELSE 'U' || o_custkey END AS user_id, CASE WHEN o_orderkey % 41 <> 0 THEN o_orderdate::TIMESTAMP END AS event_timestamp, CAST(o_totalprice AS DECIMAL(18,2)) AS total, o_orderkey AS _kafka_offset, 'orders' AS source_table, CASE WHEN o_orderkey % 41 <> 0 THEN strftime(o_orderdate, '%Y%m%d') ELSE '20240131' END AS partition_date FROM orders")
def bronze_order_rows(spark, sf):
    """Raw orders with typed columns, lineage and the date of their partition."""
    return bronze.bronze_transactional(_order_records(spark, sf), "orders", _record(*_ORDER_FIELDS), 3, base._run()).select("order_id", "user_id", "event_timestamp", "total", "_kafka_offset", "source_table", "partition_date")


@query("SELECT 'O' || o_orderkey AS order_id, CASE WHEN o_orderstatus = 'F' THEN 'done' ELSE 'open' END AS status, CASE WHEN o_orderkey % 29 = 0 THEN 'missing_user_id' WHEN o_orderkey % 41 = 0 THEN 'invalid_order_timestamp' END AS validation_error, CAST(o_orderkey % 29 <> 0 AND o_orderkey % 41 <> 0 AS INT) AS is_valid FROM orders")
def stream_orders_from_messages(spark, sf):
    """Framed messages to the serving table of orders, as one stream."""
    at = base._scratch(spark)
    _order_records(spark, sf).write.parquet(f"{at}/in")
    live = kafka_shape.read_topic(spark, "orders", directory=f"{at}/in")
    stream_realtime.serve_messages(live, "orders", _record(*_ORDER_FIELDS), 3, f"{at}/out", f"{at}/checkpoint", base._run()).awaitTermination()
    return spark.read.parquet(f"{at}/out").select("order_id", "status", "validation_error", "is_valid")


# ---- raw partitions --------------------------------------------------------------------------------------------------


@query("SELECT 'U' || c_custkey AS user_id, c_name AS username, CASE WHEN c_custkey % 3 = 1 THEN c_mktsegment END AS loyalty_tier, CASE WHEN c_custkey % 3 = 2 THEN c_nationkey::VARCHAR WHEN c_custkey % 3 = 0 THEN 'here' END AS location FROM customer")
def schema_groups(spark, sf):
    """Partitions of three schemas read as one table: a day of users needs all partitions before it."""
    at, n = base._scratch(spark), F.col("c_custkey")
    rows = _read(spark, sf, "customer").withColumns({"user_id": F.concat(F.lit("U"), n), "username": F.col("c_name"), "_kafka_topic": F.lit("users"), "_kafka_partition": F.lit(0), "_kafka_offset": n.cast("bigint")})
    own = ("user_id", "username", "_kafka_topic", "_kafka_partition", "_kafka_offset")
    drifted = {0: [F.lit("here").alias("location")], 1: [F.col("c_mktsegment").alias("loyalty_tier")], 2: [F.col("c_nationkey").alias("location")]}
    for k, more in drifted.items():
        rows.where(n % 3 == k).select(*own, *more).write.parquet(f"{at}/users/partition_date=2024010{k + 1}")
    return partitions.read_bronze(spark, at, "users", "20240105").select("user_id", "username", "loyalty_tier", "location")


@query("SELECT CAST(kafka_partition AS VARCHAR) AS _source_file, count(*) AS rows, count(DISTINCT kafka_offset) AS distinct_coordinates FROM ev GROUP BY kafka_partition", "ev")
def file_stats(spark, sf):
    names = {f"kafka_{c}": f"_kafka_{c}" for c in ("topic", "partition", "offset")}
    return reports.file_stats(view(spark, sf, "ev").withColumnsRenamed(names).withColumn("_source_file", F.col("_kafka_partition").cast("string")))


@query("SELECT order_item_id, _kafka_offset, quantity, unit_price FROM items_src WHERE _kafka_offset % 5 <> 0 UNION ALL SELECT order_item_id, NULL, quantity, unit_price FROM items_src WHERE _kafka_offset % 5 = 0 UNION ALL SELECT order_item_id, NULL, NULL, unit_price FROM items_src WHERE _kafka_offset % 5 = 0", "items_src")
def fullest_copy(spark, sf):
    """Of copies at one coordinate the fullest stays; rows without a whole coordinate all stay."""
    rows = transactional.normalize_schema(view(spark, sf, "items_src").withColumn("_kafka_topic", F.lit("items")), "order_items")
    rows = rows.withColumn("_at", F.col("_kafka_offset"))
    thin = rows.withColumn("quantity", F.lit(None).cast("int"))
    placed = rows.unionByName(thin).withColumn("_kafka_offset", F.when(F.col("_at") % 5 != 0, F.col("_at")))
    return dedup.dedup_coordinates(placed, "order_items").select("order_item_id", "_kafka_offset", "quantity", "unit_price")


@query("SELECT event_id, try_cast(w AS INT) AS quantity, try_cast(w AS TIMESTAMP) AS at FROM (SELECT event_id, CASE event_id % 4 WHEN 0 THEN '12' WHEN 1 THEN 'twelve' WHEN 2 THEN '2024-01-02 03:04:05' END AS w FROM events)")
def safe_types(spark, sf):
    """What can't be cast is null and never an error."""
    n = F.col("event_id")
    rows = _read(spark, sf, "events").select(n, F.when(n % 4 == 0, "12").when(n % 4 == 1, "twelve").when(n % 4 == 2, "2024-01-02 03:04:05").alias("quantity"))
    return conform(rows.withColumn("at", F.col("quantity")), {"event_id": "bigint", "quantity": "int", "at": "timestamp"})


@query("SELECT event_id, event_id % 3 = 0 OR event_id % 3 = 1 AS good_ip FROM events")
def ipv6_flag(spark, sf):
    h = F.lower(F.hex("event_id"))
    n = F.col("event_id") % 3
    address = F.when(n == 0, F.concat(F.lit(" 2001:db8:0:0:0:0:0:"), F.right(h, F.lit(4)))).when(n == 1, F.concat(F.lit("FE80:"), F.right(h, F.lit(4)))).otherwise(F.concat(F.lit("g:"), h))
    return _read(spark, sf, "events").select("event_id", cl.good_ip(address).alias("good_ip"))


# ---- rejects and issues ----------------------------------------------------------------------------------------------


def _reasons(checked: DataFrame, *keys: str) -> DataFrame:
    return checked.select(*keys, base._joined("validation_errors"), base._joined("validation_warnings"))


def _list(*cases: str) -> str:
    return f"array_to_string(list_filter([{', '.join(cases)}], lambda x: x IS NOT NULL), ',')"


@query(f"SELECT p_partkey, {_list('''CASE WHEN p_partkey % 5 = 0 THEN 'product_id:required_value_missing' END''', '''CASE WHEN p_partkey % 7 = 0 THEN 'name:required_value_missing' END''', '''CASE WHEN p_partkey % 11 = 0 THEN 'price:required_value_missing' END''', '''CASE WHEN p_partkey % 11 = 1 THEN 'price:negative_value' END''')} AS validation_errors, {_list('''CASE WHEN p_partkey % 5 = 1 THEN 'product_id:unusual_id_format' END''')} AS validation_warnings FROM part")
def products_checked(spark, sf):
    n = F.col("p_partkey")
    rows = _read(spark, sf, "part").select(
        n, F.when(n % 5 == 0, " ").when(n % 5 == 1, F.concat(F.lit("X"), n)).otherwise(F.concat(F.lit("P"), n)).alias("product_id"), F.when(n % 7 != 0, F.col("p_name")).alias("name"),
        F.when(n % 11 == 0, "dear").when(n % 11 == 1, "-1.50").otherwise("2.50").alias("price"), n.cast("bigint").alias("_kafka_offset"),
    )
    return _reasons(transactional.validate(rows, "products").rows.withColumnRenamed("_kafka_offset", "p_partkey"), "p_partkey").withColumn("p_partkey", F.col("p_partkey").cast(dict(rows.dtypes)["p_partkey"]))


@query(f"SELECT price_history_id, {_list('''CASE WHEN k % 5 = 0 THEN 'product_id:required_value_missing' END''', '''CASE WHEN k % 7 = 0 THEN 'valid_from_timestamp:required_value_missing' END''', '''CASE WHEN k % 11 = 1 THEN 'price:negative_value' END''')} AS validation_errors, {_list('''CASE WHEN k % 3 = 0 AND k % 7 <> 0 THEN 'valid_to:before_valid_from' END''')} AS validation_warnings FROM (SELECT 'PH' || p_partkey AS price_history_id, p_partkey AS k FROM part)")
def prices_checked(spark, sf):
    n = F.col("p_partkey")
    rows = _read(spark, sf, "part").select(
        F.concat(F.lit("PH"), n).alias("price_history_id"), F.when(n % 5 != 0, F.concat(F.lit("P"), n)).alias("product_id"), F.when(n % 11 == 1, -1).otherwise(1).alias("price"),
        F.when(n % 7 != 0, "2024-01-02 00:00:00").alias("valid_from_timestamp"), F.when(n % 3 == 0, "2024-01-01 00:00:00").alias("valid_to_timestamp"),
    )
    return _reasons(transactional.validate(rows, "product_price_history").rows, "price_history_id")


@query("""SELECT i.order_item_id AS record_id, 'MISSING_PARENT_ORDER' AS validation_errors, i.order_id AS order_id, sha256('order_items||' || i.order_item_id || '||REJECTED||["MISSING_PARENT_ORDER"]||[]||__NULL__||__NULL__||' || i._kafka_partition || '||' || i._kafka_offset) AS issue_key FROM i_ok i WHERE NOT EXISTS (SELECT 1 FROM o_ok o WHERE o.order_id = i.order_id)""", "orders_src items_src")
def orphan_issue_rows(spark, sf):
    """Issues of items without an order, with the record as JSON."""
    _, orphans = transactional.split_by_parent(base._items(spark, sf), base._orders(spark, sf))
    found = transactional.orphan_issues(orphans, base._run())
    return found.select("record_id", base._joined("validation_errors"), F.get_json_object("original_record", "$.order_id").alias("order_id"), "issue_key")


@query("SELECT kafka_offset, copy_no, copy > 1 AS later_copy FROM e_all", "ev")
def later_copies(spark, sf):
    """Later copies of an event, as the validation numbers them."""
    return base._events(spark, sf).rows.select("kafka_offset", "copy_no", F.array_contains("validation_errors", "event_key:duplicate_event").alias("later_copy"))


@query("SELECT event_id, CASE WHEN event_id % 3 = 0 THEN TIMESTAMP '1970-01-01 00:00:00' ELSE ts::TIMESTAMP END AS event_timestamp, CASE WHEN event_id % 3 = 0 THEN 'invalid_event_timestamp' END AS validation_error FROM events")
def realtime_epoch(spark, sf):
    """Serving events without a time get the epoch and are invalid."""
    n = F.col("event_id")
    rows = _read(spark, sf, "events").select(n.cast("string").alias("event_id"), F.when(n % 3 != 0, F.col("ts")).alias("event_timestamp"), F.lit("U1").alias("user_id"), F.lit("view").alias("event_type"), F.lit("web").alias("device"), F.lit("s").alias("session_id"))
    return serving.realtime(rows, "behavioral").select(F.col("event_id").cast("bigint").alias("event_id"), "event_timestamp", "validation_error")


# ---- model and reports -----------------------------------------------------------------------------------------------


@query("SELECT s.session_key, s.event_count, s.session_duration_sec FROM e_sess s WHERE s.session_key IN (SELECT session_key FROM e_fact WHERE kafka_offset % 100 = 0)", "ev")
def touched_sessions(spark, sf):
    """Whole rollups of the sessions that a batch touched."""
    fact = base._fact_events(spark, sf)
    return events.sessions(fact, base._run(), fact.where("kafka_offset % 100 = 0").select("session_key")).select("session_key", "event_count", "session_duration_sec")


@query("SELECT device_name, count(*) AS events, count(DISTINCT user_id) AS users, count(DISTINCT session_key) AS sessions, round(avg(CASE WHEN kafka_offset % 3 <> 0 THEN kafka_offset % 50 END), 6) AS avg_duration_sec FROM e_obt GROUP BY device_name", "ev")
def device_durations(spark, sf):
    obt = base._behavioral(spark, sf).withColumn("duration_sec", F.when(F.col("kafka_offset") % 3 != 0, (F.col("kafka_offset") % 50).cast("int")))
    return reports.device_rollup(obt).withColumn("avg_duration_sec", F.round("avg_duration_sec", 6))


@query("SELECT r_regionkey, 'CAT_' || sha256('C' || r_regionkey) AS category_key, CASE WHEN r_regionkey > 0 THEN 'CAT_' || sha256('C' || (r_regionkey - 1)) END AS parent_category_key FROM region")
def category_parents(spark, sf):
    n = F.col("r_regionkey")
    rows = _read(spark, sf, "region").select(n, F.concat(F.lit("C"), n).alias("category_id"), F.col("r_name").alias("name"), F.when(n > 0, F.concat(F.lit("C"), n - 1)).alias("parent_category_id"))
    made = kimball.dim_category(rows, base._run())
    return made.join(rows.select(n, "category_id"), "category_id").select("r_regionkey", "category_key", "parent_category_key")


@query("SELECT order_item_id, gross, CAST(gross - (gross - 1.25) AS DECIMAL(29,2)) AS discount_amount, CAST(gross - 1.25 AS DECIMAL(29,2)) AS item_total_amount FROM (SELECT order_item_id, gross_item_amount AS gross FROM f_item)", "orders_src items_src products prices_src")
def explicit_discounts(spark, sf):
    """Items without a total: their stated discount gives it."""
    user, _, product, price = base._dims(spark, sf)
    items = base._items(spark, sf).withColumns({"item_total_amount": F.lit(None).cast("decimal(18,2)"), "discount_amount": F.lit("1.25").cast("decimal(18,2)")})
    fact = kimball.fact_order_item(items, base._fact_order(spark, sf, user), product, price, base._run())
    return fact.select("order_item_id", F.col("gross_item_amount").alias("gross"), "discount_amount", "item_total_amount")


_T_REST = "order_item_id, year_number, month_number, quarter_number, day_of_week, is_weekend, email, signup_date, location, loyalty_tier, device, is_returned, return_reason, refund_amount, return_timestamp, silver_updated_at"


@query(
    f"""SELECT f.order_item_id, CAST(year(f.order_timestamp) AS INT) AS year_number, CAST(month(f.order_timestamp) AS INT) AS month_number, CAST(quarter(f.order_timestamp) AS INT) AS quarter_number, CAST(dayofweek(f.order_timestamp) + 1 AS INT) AS day_of_week,
 dayofweek(f.order_timestamp) IN (0, 6) AS is_weekend, coalesce(lower({base._nl('u.email')}), 'Unknown') AS email, coalesce(u.signup_date, DATE '1970-01-01') AS signup_date, coalesce({base._nl('u.location')}, 'Unknown') AS location,
 coalesce(lower({base._nl('u.loyalty_tier')}), 'Unknown') AS loyalty_tier, coalesce(lower({base._nl('u.device')}), 'Unknown') AS device, false AS is_returned, CAST(NULL AS VARCHAR) AS return_reason, CAST(NULL AS DECIMAL(29,2)) AS refund_amount,
 CAST(NULL AS TIMESTAMP) AS return_timestamp, TIMESTAMP '2024-02-01 00:00:00' AS silver_updated_at FROM f_item f LEFT JOIN users u ON u.user_id = f.user_id""",
    "orders_src items_src products prices_src users",
)
def obt_transactional_rest(spark, sf):
    """The columns of the wide table of orders that ``obt_transactional`` leaves out."""
    return base._transactional_obt(spark, sf).select(*_T_REST.split(", "))


@query(
    f"""SELECT f.event_key, CAST(NULL AS VARCHAR) AS event_id, 'kafka_coordinate' AS event_identity_source, f.session_id, CAST(f.event_timestamp AS DATE) AS processing_date, CAST(NULL AS VARCHAR) AS user_key, CAST(NULL AS VARCHAR) AS cart_items_json,
 w.flags AS dq_flags_json, f.kafka_topic, f.event_timestamp AS bronze_ingestion_timestamp, 'run' AS pipeline_run_id, TIMESTAMP '2024-02-01 00:00:00' AS silver_ingestion_timestamp, TIMESTAMP '2024-02-01 00:00:00' AS gold_loaded_at
 FROM e_fact f JOIN (SELECT event_key, CASE WHEN len({base._E_WARN}) = 0 THEN '[]' ELSE '["' || array_to_string({base._E_WARN}, '","') || '"]' END AS flags FROM e_all WHERE copy = 1) w USING (event_key)""",
    "ev",
)
def obt_behavioral_rest(spark, sf):
    """The columns of the wide table of events that ``obt_behavioral`` leaves out and the data fill."""
    names = "event_key event_id event_identity_source session_id processing_date user_key cart_items_json dq_flags_json kafka_topic bronze_ingestion_timestamp pipeline_run_id silver_ingestion_timestamp gold_loaded_at"
    return base._behavioral(spark, sf).select(*names.split())


# ---- jobs on the store -----------------------------------------------------------------------------------------------


def _raw_events(spark, sf):
    return view(spark, sf, "ev").withColumn("bronze_ingestion_timestamp", F.col("event_timestamp") + F.make_dt_interval(secs=F.col("copy_no").cast("decimal(18,6)")))


@query(f"SELECT 'SUCCEEDED' AS status, count(*) AS raw_count, count(*) FILTER (WHERE n > 0) AS rejected_count, count(*) FILTER (WHERE n = 0 AND w > 0) AS warning_count, count(*) FILTER (WHERE n = 0 AND w = 0) AS valid_count, count(*) FILTER (WHERE n = 0) AS processable_count, count(*) FILTER (WHERE n = 0) AS fact_rows_merged FROM (SELECT len({base._E_ERR}) AS n, len({base._E_WARN}) AS w FROM e_all)", "ev")
def events_job_state(spark, sf):
    """The state that a run over all events records; a rerun leaves one row."""
    store = Store(spark, base._scratch(spark))
    for _ in range(2):
        silver.run_events(store, _raw_events(spark, sf), _DAY, _MOMENT)
    return store.read("pipeline_state").select("status", "raw_count", "rejected_count", "warning_count", "valid_count", "processable_count", "fact_rows_merged")


@query("SELECT event_key, session_event_count, device_name, event_category, DATE '2024-01-31' AS processing_date FROM e_obt", "ev")
def events_job_wide(spark, sf):
    """The wide table that the daily jobs write and replace."""
    store = Store(spark, base._scratch(spark))
    silver.run_events(store, _raw_events(spark, sf), _DAY, _MOMENT)
    for _ in range(2):
        gold.run_behavioral(store, _DAY, _MOMENT)
    return store.read("behavioral_obt").select("event_key", "session_event_count", "device_name", "event_category", "processing_date")


@query("""SELECT 'dim_user' AS name, count(*) AS rows FROM users UNION ALL SELECT 'dim_category', count(*) FROM categories UNION ALL SELECT 'dim_product', count(*) FROM products UNION ALL SELECT 'dim_product_price', count(*) FROM p_all
 UNION ALL SELECT 'fact_order', count(*) FROM o_ok UNION ALL SELECT 'fact_order_item', count(*) FROM f_item UNION ALL SELECT 'dim_date', (SELECT date_diff('day', min(event_timestamp)::DATE, max(event_timestamp)::DATE) + 1 FROM o_ok)
 UNION ALL SELECT 'orphans', (SELECT count(*) FROM i_ok WHERE order_id NOT IN (SELECT order_id FROM o_ok))""", "orders_src items_src products prices_src categories users")
def orders_job_tables(spark, sf):
    """Rows of the star that the daily job of all six entities writes."""
    store = Store(spark, base._scratch(spark))
    topic = lambda n: view(spark, sf, n).withColumn("_kafka_topic", F.lit(n))
    raw = {t: topic(n) for t, n in (("categories", "categories"), ("users", "users"), ("products", "products"), ("orders", "orders_src"), ("order_items", "items_src"))}
    # their offsets come from values that rows of many items share, so that every item is a topic of its own
    raw["order_items"] = raw["order_items"].withColumn("_kafka_topic", F.concat(F.lit("items_src."), F.col("order_item_id")))
    raw["product_price_history"] = topic("prices_src").withColumnRenamed("valid_from", "valid_from_timestamp")
    silver.run_transactional(store, raw, _MOMENT)
    counts = [store.read(n).agg(F.lit(n).alias("name"), F.count(F.lit(1)).alias("rows")) for n, _ in kimball.Star.KEYS]
    counts.append(store.read("transactional_issues").where("array_contains(validation_errors, 'MISSING_PARENT_ORDER')").agg(F.lit("orphans").alias("name"), F.count(F.lit(1)).alias("rows")))
    out = counts[0]
    for c in counts[1:]:
        out = out.unionByName(c)
    return out


@query("SELECT event_key, kafka_offset FROM e_ok", "ev")
def migrated_keys(spark, sf):
    """Events after their old keys were replaced in the store, with every proof."""
    store = Store(spark, base._scratch(spark))
    fact = base._fact_events(spark, sf)
    old = F.when(F.col("kafka_offset") % 7 == 0, F.concat(F.lit("EVT-"), F.col("kafka_offset"))).otherwise(F.col("event_key"))
    fact = fact.withColumn("event_key", old).select("event_key", "kafka_topic", "kafka_partition", "kafka_offset")
    store.ensure("f", fact.schema)
    store.merge("f", fact, ["event_key"], Merge(INSERT_ONLY))
    migrate.migrate(store, "f", events.align(view(spark, sf, "ev")), dry_run=False)
    return store.read("f").select("event_key", "kafka_offset")


@query("SELECT o_orderkey, CASE WHEN o_orderkey % 2 = 0 THEN o_orderstatus ELSE 'new' END AS status, CASE WHEN o_orderkey % 2 = 1 THEN 'x' END AS note FROM orders")
def evolved_table(spark, sf):
    """A table by month and bucket that got a column between two merges; older rows have null there."""
    store = Store(spark, base._scratch(spark))
    rows = _read(spark, sf, "orders").select("o_orderkey", F.col("o_orderstatus").alias("status"), F.col("o_orderdate").cast("timestamp").alias("at"))
    store.ensure("t", rows.schema, ["months(at)", "bucket(4, o_orderkey)"])
    store.merge("t", rows, ["o_orderkey"], Merge(INSERT_ONLY))
    wider = rows.where("o_orderkey % 2 = 1").withColumns({"status": F.lit("new"), "note": F.lit("x")})
    store.ensure("t", wider.schema)
    store.merge("t", wider, ["o_orderkey"])
    return store.read("t").select("o_orderkey", "status", "note")
