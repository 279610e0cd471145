"""Validation rules as data, shared by the daily path (all failures) and the serving path (the first failure)."""

from __future__ import annotations

from dataclasses import dataclass
from functools import reduce
from operator import or_

from pyspark.sql import Column
from pyspark.sql import functions as F

from ..contracts import ID_PATTERNS, KNOWN_DEVICES, KNOWN_EVENTS, TABLES
from .clean import good_email, good_ip, nonblank, snake


@dataclass(frozen=True)
class Rule:
    """``fails`` is a condition; null counts as not failing."""

    code: str
    fails: Column


def codes(rules: list[Rule]) -> Column:
    """array<string> of all failing codes, in order."""
    none = F.array().cast("array<string>")
    if not rules:
        return none
    # most rows fail in nothing, and the list takes longer than the rules
    failing = reduce(or_, [F.coalesce(r.fails, F.lit(False)) for r in rules])
    return F.when(failing, F.array_compact(F.array(*[F.when(r.fails, F.lit(r.code)) for r in rules]))).otherwise(none)


def first_code(rules: list[Rule]) -> Column:
    """The first failing code, or null."""
    return F.coalesce(*[F.when(r.fails, F.lit(r.code)) for r in rules], F.lit(None).cast("string"))


_REQUIRED = {
    "categories": ("category_id", "name"), "users": ("user_id",), "products": ("product_id", "name", "price"),
    "orders": ("order_id", "user_id", "event_timestamp", "total"), "order_items": ("order_item_id", "order_id", "product_id", "quantity", "unit_price"),
    "product_price_history": ("price_history_id", "product_id", "price", "valid_from_timestamp"),
}
_NOT_NEGATIVE = {"products": ("price",), "orders": ("total",), "order_items": ("unit_price", "item_total_amount"), "product_price_history": ("price",)}


def transactional_rejects(table: str) -> list[Rule]:
    types = TABLES[table]
    missing = lambda c: ~nonblank(F.col(c)) if types[c] == "string" else F.col(c).isNull()
    found = [Rule(f"{c}:required_value_missing", missing(c)) for c in _REQUIRED[table]]
    if table == "order_items":
        found.append(Rule("quantity:must_be_positive", F.col("quantity") <= 0))
    return found + [Rule(f"{c}:negative_value", F.col(c) < 0) for c in _NOT_NEGATIVE.get(table, ())]


def transactional_warnings(table: str) -> list[Rule]:
    found = [Rule(f"{c}:unusual_id_format", nonblank(F.col(c)) & ~F.trim(F.col(c)).rlike(ID_PATTERNS[c])) for c in TABLES[table] if c in ID_PATTERNS]
    if table == "users":
        found.append(Rule("email:unusual_format", F.col("email").isNotNull() & ~good_email(F.col("email"))))
    if table == "orders":
        found.append(Rule("event_timestamp:repaired", F.col("_timestamp_repaired")))
    if table == "product_price_history":
        found.append(Rule("valid_to:before_valid_from", F.col("valid_to_timestamp") < F.col("valid_from_timestamp")))
    return found


def event_rejects(complete: Column) -> list[Rule]:
    """Own rules of the clickstream; ``complete`` says whether broker coordinates are there."""
    return [
        Rule("event_identity:missing", ~nonblank(F.col("event_id")) & ~complete),
        Rule("session_id:required_value_missing", ~nonblank(F.col("session_id"))),
        Rule("event_type:required_value_missing", ~nonblank(F.col("event_type"))),
        Rule("event_timestamp:invalid", F.col("event_timestamp").isNull()),
        Rule("event_key:duplicate_event", F.col("_copy") > 1),
    ]


def event_warnings(complete: Column) -> list[Rule]:
    c = F.col
    outside = lambda x, low, high: (c(x) < low) | (c(x) > high)
    return [
        Rule("user_id:anonymous_or_missing", ~nonblank(c("user_id"))),
        Rule("utm_source:missing", ~nonblank(c("utm_source"))),
        Rule("device_type:unknown", ~nonblank(c("device_type")) | ~snake(c("device_type")).isin(*KNOWN_DEVICES)),
        Rule("event_type:unknown", nonblank(c("event_type")) & ~snake(c("event_type")).isin(*KNOWN_EVENTS)),
        Rule("ip_address:invalid_format", nonblank(c("ip_address")) & ~good_ip(c("ip_address"))),
        Rule("event_id:missing_used_kafka_identity", ~nonblank(c("event_id")) & complete),
        Rule("cart_value:negative_value", c("cart_value") < 0),
        Rule("quantity:must_be_positive", c("quantity") <= 0),
        Rule("duration_sec:negative_value", c("duration_sec") < 0),
        Rule("rating:out_of_range", outside("rating", 1, 5)),
        Rule("results_count:negative_value", c("results_count") < 0),
        Rule("clicked_position:negative_value", c("clicked_position") < 0),
        Rule("text_length:negative_value", c("text_length") < 0),
        Rule("http_status:out_of_range", outside("http_status", 100, 599)),
    ]


def realtime_rules(table: str, today: Column | None = None) -> list[Rule]:
    """Rules of the serving tables on their raw columns. ``today`` bounds sign-up dates."""
    c = F.col
    gone = lambda x: F.trim(F.coalesce(c(x), F.lit(""))) == ""
    epoch = F.lit("1970-01-01 00:00:00").cast("timestamp")
    if table == "behavioral":
        texts = ("user_id", "event_type", "device", "session_id")
        return [
            Rule("invalid_event_timestamp", c("event_timestamp").isNull()), *[Rule(f"missing_{x}", gone(x)) for x in texts],
            Rule("invalid_quantity", c("quantity") <= 0), Rule("negative_cart_total_items", c("cart_total_items") < 0), Rule("negative_cart_value", c("cart_value") < 0),
            Rule("negative_duration", c("duration_sec") < 0), Rule("invalid_http_status", ~c("http_status").between(100, 599)),
            Rule("negative_results_count", c("results_count") < 0), Rule("invalid_clicked_position", c("clicked_position") < 0),
            Rule("invalid_rating", ~c("rating").between(1, 5)), Rule("negative_text_length", c("text_length") < 0),
        ]
    if table == "categories":
        return [Rule("missing_category_id", gone("category_id")), Rule("missing_category_name", gone("name"))]
    if table == "order_items":
        ids = [Rule(f"missing_{x}", gone(x)) for x in ("order_item_id", "order_id", "product_id")]
        return [*ids, Rule("invalid_quantity", c("quantity") <= 0), Rule("negative_unit_price", c("unit_price") < 0), Rule("negative_item_total_amount", c("item_total_amount") < 0)]
    if table == "orders":
        return [
            Rule("missing_order_id", gone("order_id")), Rule("missing_user_id", gone("user_id")),
            Rule("invalid_order_timestamp", F.coalesce(c("event_timestamp").cast("timestamp"), epoch) <= epoch),
            Rule("negative_order_total", c("total") < 0), Rule("missing_order_status", gone("status")),
        ]
    if table == "product_price_history":
        return [
            Rule("missing_price_history_id", gone("price_history_id")), Rule("missing_product_id", gone("product_id")), Rule("negative_price", c("price") < 0),
            Rule("invalid_valid_from", F.coalesce(c("valid_from_timestamp").cast("timestamp"), epoch) <= epoch),
            Rule("valid_to_before_valid_from", c("valid_to_timestamp") < c("valid_from_timestamp")),
            Rule("current_price_has_valid_to", c("is_current") & c("valid_to_timestamp").isNotNull()),
        ]
    if table == "products":
        return [
            Rule("missing_product_id", gone("product_id")), Rule("missing_product_name", gone("name")), Rule("negative_price", c("price") < 0),
            Rule("negative_inventory", c("inventory") < 0), Rule("invalid_popularity_score", (c("popularity_score") < 0) | (c("popularity_score") > 100)),
        ]
    if table == "users":
        return [
            Rule("missing_user_id", gone("user_id")), Rule("missing_username", gone("username")), Rule("missing_email", gone("email")),
            Rule("invalid_email", F.instr(F.trim(c("email")), "@") <= 1), Rule("invalid_signup_date", c("signup_date") < F.lit("2000-01-01").cast("date")),
            Rule("future_signup_date", c("signup_date") > (today if today is not None else F.current_date())),
        ]
    raise ValueError(f"unknown table {table!r}")
