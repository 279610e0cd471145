"""Wide serving tables and the per-message projections of the realtime tables."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ..contracts import BEHAVIORAL_OBT, EVENT_OPTIONAL, FACT_MONEY, TABLES, TRANSACTIONAL_OBT, conform, require_columns
from ..functions.clean import blank_to_null
from ..functions.rules import first_code, realtime_rules


_MADE = ("session_start_at", "session_end_at", "session_duration_sec", "session_event_count", "device_name", "primary_device_key", "event_category", "cart_items_json", "dq_flags_json", "gold_loaded_at")
#: What the wide table takes from the event fact.
BEHAVIORAL_FACT = (*(c for c in BEHAVIORAL_OBT if c not in _MADE), "cart_items", "dq_flags")
_ITEM_VALUES = ("quantity", "unit_price", "discount_amount", "item_total_amount", "price_difference", "silver_updated_at")


def behavioral_obt(fact: DataFrame, devices: DataFrame, event_types: DataFrame, sessions: DataFrame, run_ts: Column) -> DataFrame:
    """Events with their device, type and session; 52 columns. The optimizer broadcasts dimensions that are small."""
    require_columns(fact, BEHAVIORAL_FACT, "the event fact")
    device = devices.select("device_key", "device_name")
    kind = event_types.select("event_type_key", "event_category")
    session = sessions.select("session_key", "session_start_at", "session_end_at", "session_duration_sec", F.col("event_count").alias("session_event_count"), "primary_device_key")
    joined = fact.join(device, "device_key", "left").join(kind, "event_type_key", "left").join(session, "session_key", "left")
    made = joined.withColumns({"cart_items_json": F.to_json("cart_items"), "dq_flags_json": F.to_json("dq_flags"), "gold_loaded_at": run_ts})
    return made.select(*BEHAVIORAL_OBT)


def transactional_obt(items: DataFrame, orders: DataFrame, prices: DataFrame, products: DataFrame, users: DataFrame, dates: DataFrame) -> DataFrame:
    """Order items with order, price, product, user and day; 35 columns, with defaults where a dimension is missing."""
    require_columns(items, ("order_item_id", "order_id", "product_id", "product_price_key", "order_date_key", *_ITEM_VALUES), "the item fact")
    o = orders.select("order_id", "user_id", "order_timestamp", "status", "payment_method", F.col("total_amount").alias("order_total_amount"))
    p = prices.select("product_price_key", "price_history_id")
    d = products.select("product_id", "product_name", "category_id", "category_name")
    u = users.select("user_id", "username", "email", "signup_date", "location", "loyalty_tier", "device")
    t = dates.select(F.col("date_key").alias("order_date_key"), "full_date", "year_number", "month_number", "quarter_number", "day_of_week", "is_weekend")
    joined = items.join(o, "order_id").join(p, "product_price_key", "left").join(d, "product_id", "left").join(u, "user_id", "left").join(t, "order_date_key", "left")
    unknown = lambda c: F.coalesce(F.col(c), F.lit("Unknown")).alias(c)
    zero = lambda c: F.coalesce(F.col(c), F.lit(0).cast(FACT_MONEY)).alias(c)
    made = joined.select(
        "order_item_id", "order_id", "product_id", unknown("category_id"), unknown("user_id"), unknown("price_history_id"), F.col("order_date_key").alias("date_key"), "order_timestamp",
        F.coalesce("full_date", F.lit("1970-01-01").cast("date")).alias("full_date"), *[F.coalesce(F.col(c), F.lit(0)).alias(c) for c in ("year_number", "month_number", "quarter_number", "day_of_week")],
        F.coalesce("is_weekend", F.lit(False)).alias("is_weekend"), F.coalesce("status", F.lit("Unknown")).alias("order_status"), unknown("payment_method"), F.coalesce("quantity", F.lit(0)).alias("quantity"),
        *[zero(c) for c in ("unit_price", "discount_amount", "item_total_amount", "price_difference", "order_total_amount")], unknown("product_name"), unknown("category_name"), unknown("username"), unknown("email"),
        F.coalesce("signup_date", F.lit("1970-01-01").cast("date")).alias("signup_date"), unknown("location"), unknown("loyalty_tier"), unknown("device"), F.lit(False).alias("is_returned"),
        F.lit(None).cast("string").alias("return_reason"), F.lit(None).cast(FACT_MONEY).alias("refund_amount"), F.lit(None).cast("timestamp").alias("return_timestamp"), "silver_updated_at",
    )
    return made.select(*TRANSACTIONAL_OBT)


# fixed values: what the per-message tables put in lower case, and columns whose blanks are nulls
_EPOCH = "1970-01-01 00:00:00"
_REALTIME_LOWER = {"orders": ("status",), "users": ("email",), "behavioral": ("event_type", "device")}
_REALTIME_OPTIONAL = {
    "categories": ("parent_category_id",), "orders": ("payment_method",), "products": ("category",), "users": ("device", "loyalty_tier", "location"), "order_items": (),
    "product_price_history": (), "behavioral": ("product_id", "shipping_method", "order_id", "fulfillment_speed", "url_path", "payment_type", "error_code", "query", "wishlist_name"),
}
_OPTIONAL_LOWER = ("payment_method", "device", "loyalty_tier", "shipping_method", "fulfillment_speed", "payment_type")


def realtime(df: DataFrame, table: str, today: Column | None = None) -> DataFrame:
    """The projection of one message table: repaired values, is_valid and the first failing rule. Stateless, for streams too."""
    if table == "behavioral":
        columns = {"device": "string"} | {c: t for c, t in EVENT_OPTIONAL.items() if c not in ("device_type", "timestamp", "validation_errors", "processing_date", "pipeline_run_id", "bronze_ingestion_timestamp", "_source_file")}
        if "device" not in df.columns and "device_type" in df.columns:
            df = df.withColumnRenamed("device_type", "device")
    else:
        columns = dict(TABLES[table])
    typed = conform(df, columns, keep_others=True)
    rules = realtime_rules(table, today)
    # rules look at the values as they came
    out = {"validation_error": first_code(rules)}
    for c, t in columns.items():
        if t == "string":
            optional = c in _REALTIME_OPTIONAL[table]
            x = blank_to_null(F.col(c)) if optional else F.trim(F.col(c))
            lower = c in _REALTIME_LOWER.get(table, ()) or (optional and c in _OPTIONAL_LOWER)
            out[c] = F.lower(x) if lower else x
    if table == "products":
        out["inventory"] = F.when(F.col("inventory") >= 0, F.col("inventory"))
        out["popularity_score"] = F.when(F.col("popularity_score").between(0, 100), F.col("popularity_score"))
    if table == "behavioral":
        out["event_timestamp"] = F.coalesce("event_timestamp", F.lit(_EPOCH).cast("timestamp"))
    return typed.withColumns(out).withColumn("is_valid", F.col("validation_error").isNull().cast("int"))
