"""Schemas, code sets and patterns of the data model."""

from __future__ import annotations

import re

from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

# fixed values: tokens that mean "no value", compared lower-cased and trimmed
NULL_LIKE = ("", "null", "none", "n/a", "na", "unknown", "-")

# fixed values: device vocabulary
DEVICE_ALIASES = {"android": "mobile", "ios": "mobile", "iphone": "mobile", "phone": "mobile", "web": "desktop", "pc": "desktop"}
KNOWN_DEVICES = ("mobile", "desktop", "tablet", "web", "android", "ios", "unknown")

# fixed values: event types by category
EVENT_CATEGORIES = {
    "browse": ("page_view", "product_view", "home_view", "category_view", "click"),
    "search": ("search_product", "search"),
    "cart": ("add_to_cart", "remove_from_cart", "view_cart", "update_cart"),
    "checkout": ("checkout_start", "checkout_attempt", "payment_attempt", "purchase", "order_placed"),
    "engagement": ("rating", "review", "product_rating"),
    "wishlist": ("wishlist_add", "wishlist_remove"),
    "error": ("error", "page_error"),
}
KNOWN_EVENTS = tuple(t for types in EVENT_CATEGORIES.values() for t in types)

# fixed values: stages of the purchase funnel, (event type, shown name)
FUNNEL_STAGES = (
    ("page_view", "Page View"), ("product_search", "Product Search"), ("add_to_cart", "Add to Cart"),
    ("checkout_start", "Checkout Start"), ("payment_attempt", "Payment Attempt"), ("order_complete", "Order Complete"),
)

# fixed values: patterns of mail and network addresses
EMAIL = r"^[A-Za-z0-9._%+-]+@[A-Za-z0-9.-]+\.[A-Za-z]{2,}$"
_OCTET = r"(25[0-5]|2[0-4][0-9]|[01]?[0-9][0-9]?)"
IPV4 = rf"^{_OCTET}\.{_OCTET}\.{_OCTET}\.{_OCTET}$"
#: Doesn't know the compressed form with two colons in a row.
IPV6 = r"(?i)^(?:[0-9a-f]{1,4}:){1,7}[0-9a-f]{0,4}$"

MONEY = "decimal(18,2)"
FACT_MONEY = "decimal(29,2)"

# fixed values: business columns of the transactional entities, the key first
TABLES: dict[str, dict[str, str]] = {
    "categories": {"category_id": "string", "name": "string", "parent_category_id": "string"},
    "users": {"user_id": "string", "username": "string", "email": "string", "signup_date": "date", "device": "string", "loyalty_tier": "string", "location": "string"},
    "products": {"product_id": "string", "name": "string", "price": MONEY, "category": "string", "inventory": "int", "popularity_score": "decimal(10,2)"},
    "orders": {"order_id": "string", "user_id": "string", "event_timestamp": "timestamp", "total": MONEY, "status": "string", "payment_method": "string"},
    "order_items": {"order_item_id": "string", "order_id": "string", "product_id": "string", "quantity": "int", "unit_price": MONEY, "item_total_amount": MONEY},
    "product_price_history": {"price_history_id": "string", "product_id": "string", "price": MONEY, "valid_from_timestamp": "timestamp", "valid_to_timestamp": "timestamp", "is_current": "boolean"},
}
TECHNICAL = {
    "_kafka_topic": "string", "_kafka_partition": "int", "_kafka_offset": "bigint", "_kafka_timestamp": "timestamp", "_wire_schema_id": "int",
    "source_table": "string", "bronze_ingestion_timestamp": "timestamp", "partition_date": "string", "_source_file": "string",
}
# fixed values: patterns of ids
ID_PATTERNS = {
    "category_id": "^C[0-9]+$", "parent_category_id": "^C[0-9]+$", "user_id": "^U[0-9]+$", "product_id": "^P[0-9]+$", "order_id": "^O[0-9]+$",
    "order_item_id": "^OI[0-9]+$", "price_history_id": "^PH[0-9]+$",
}
KEY_OF = {name: next(iter(columns)) for name, columns in TABLES.items()}

# fixed values: optional columns of clickstream events
EVENT_OPTIONAL = {
    "user_id": "string", "session_id": "string", "event_type": "string", "event_id": "string", "device_type": "string", "utm_source": "string", "ip_address": "string", "product_id": "string", "order_id": "string",
    "url_path": "string", "query": "string", "wishlist_name": "string", "payment_type": "string", "shipping_method": "string", "fulfillment_speed": "string",
    "error_code": "string", "success": "boolean", "http_status": "int", "quantity": "int", "cart_total_items": "int", "cart_value": "double", "duration_sec": "int",
    "results_count": "int", "clicked_position": "int", "rating": "int", "text_length": "int", "cart_items": "array<struct<product_id:string,price:double,quantity:int>>",
    "timestamp": "string", "event_timestamp": "timestamp", "kafka_topic": "string", "kafka_partition": "int", "kafka_offset": "bigint", "kafka_timestamp": "timestamp",
    "bronze_ingestion_timestamp": "timestamp", "_source_file": "string", "validation_errors": "array<string>", "processing_date": "date", "pipeline_run_id": "string",
}
DOWNGRADED = ("missing_event_id", "missing_user_id", "missing_device_type", "missing_utm_source", "invalid_ip_address")

# fixed values: the columns of the wide serving tables, in order
BEHAVIORAL_OBT = (
    "event_key event_id event_identity_source event_timestamp date_key processing_date user_key user_id session_key session_id session_start_at session_end_at "
    "session_duration_sec session_event_count device_key device_name primary_device_key event_type_key event_type event_category utm_source ip_address_hash "
    "product_id order_id url_path query wishlist_name payment_type shipping_method fulfillment_speed error_code success http_status quantity cart_total_items "
    "cart_value duration_sec results_count clicked_position rating text_length cart_items_json dq_flags_json kafka_topic kafka_partition kafka_offset "
    "kafka_timestamp bronze_ingestion_timestamp source_file pipeline_run_id silver_ingestion_timestamp gold_loaded_at"
).split()
TRANSACTIONAL_OBT = (
    "order_item_id order_id product_id category_id user_id price_history_id date_key order_timestamp full_date year_number month_number quarter_number "
    "day_of_week is_weekend order_status payment_method quantity unit_price discount_amount item_total_amount price_difference order_total_amount product_name "
    "category_name username email signup_date location loyalty_tier device is_returned return_reason refund_amount return_timestamp silver_updated_at"
).split()

KAFKA_RECORD = T.StructType(
    [
        T.StructField(name, kind)
        for name, kind in (
            ("key", T.BinaryType()), ("value", T.BinaryType()), ("topic", T.StringType()), ("partition", T.IntegerType()), ("offset", T.LongType()), ("timestamp", T.TimestampType()),
        )
    ]
)


class ContractError(ValueError):
    """Data or names that break a contract."""


def conform(df: DataFrame, columns: dict[str, str], keep_others: bool = False) -> DataFrame:
    """``df`` with exactly ``columns``, each cast where it can be and null otherwise."""
    have = {c.lower(): c for c in df.columns}
    typed = [(F.col(f"`{have[c.lower()]}`").try_cast(t) if c.lower() in have else F.lit(None).cast(t)).alias(c) for c, t in columns.items()]
    others = [F.col(f"`{c}`") for c in df.columns if c.lower() not in {x.lower() for x in columns}] if keep_others else []
    return df.select(*typed, *others)


def require_columns(df: DataFrame, names, what: str = "input") -> None:
    missing = [c for c in names if c not in df.columns]
    if missing:
        raise ContractError(f"{what} lacks columns: {', '.join(missing)}")


def assert_schema(df: DataFrame, target: T.StructType) -> DataFrame:
    """``df`` in the target's column order; raises on missing, extra or differently typed columns."""
    have = {f.name: f.dataType for f in df.schema.fields}
    want = {f.name: f.dataType for f in target.fields}
    wrong = [f"missing {c}" for c in want if c not in have] + [f"extra {c}" for c in have if c not in want]
    wrong += [f"{c} is {have[c].simpleString()}, not {t.simpleString()}" for c, t in want.items() if c in have and have[c].simpleString() != t.simpleString()]
    if wrong:
        raise ContractError("; ".join(wrong))
    return df.select(*want)


def assert_contract(df: DataFrame, columns, keys, not_null=()) -> None:
    """One aggregate: columns in order, keys and ``not_null`` without nulls, keys unique."""
    if list(df.columns) != list(columns):
        raise ContractError("columns differ from the contract")
    keys = list(keys)
    if not keys:
        raise ContractError("a contract needs a key")
    grouped = df.groupBy(*keys).agg(F.count(F.lit(1)).alias("n"), *[F.count_if(F.col(c).isNull()).alias(f"null_{c}") for c in not_null])
    nulls = F.sum(sum((F.col(k).isNull().cast("int") for k in keys), F.lit(0)))
    found = grouped.agg(nulls.alias("k"), F.count_if(F.col("n") > 1).alias("d"), *[F.sum(f"null_{c}").alias(c) for c in not_null]).first()
    if found["k"]:
        raise ContractError("null key")
    if found["d"]:
        raise ContractError("duplicate key")
    for c in not_null:
        if found[c]:
            raise ContractError(f"null in {c}")


def valid_table(name: str) -> str:
    if name not in TABLES:
        raise ContractError(f"unknown table {name!r}")
    return name


def valid_identifier(name: str) -> str:
    if not re.fullmatch(r"[A-Za-z_][A-Za-z0-9_]*", name or ""):
        raise ContractError(f"bad identifier {name!r}")
    return name


def quote(name: str) -> str:
    return f"`{valid_identifier(name)}`"


def valid_partition(value: str) -> str:
    """A date as eight digits."""
    import datetime

    try:
        if not re.fullmatch(r"[0-9]{8}", value or ""):
            raise ValueError
        datetime.datetime.strptime(value, "%Y%m%d")
    except ValueError:
        raise ContractError(f"not a partition date: {value!r}") from None
    return value
