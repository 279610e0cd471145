"""Validation, cleaning and modelling of clickstream events."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from ..contracts import DOWNGRADED, EVENT_OPTIONAL
from ..functions import keys
from ..functions.clean import collapse, device, event_category, event_time, snake
from ..functions.rules import codes, event_rejects, event_warnings
from .dedup import first_by, newest_first, oldest_first
from .transactional import Validated, snapshot

# fixed values: the name of the source in issues, the order of copies and older names of columns
SOURCE = "behavioral_events"
_ORDER = ("bronze_ingestion_timestamp", "kafka_timestamp", "kafka_topic", "kafka_partition", "kafka_offset", "_source_file")
_ALIASES = {"source_topic": "kafka_topic", "source_partition": "kafka_partition", "source_offset": "kafka_offset", "device": "device_type"}


def align(df: DataFrame) -> DataFrame:
    """Older names replaced, missing columns as typed nulls, event time parsed; other columns stay."""
    for old, new in _ALIASES.items():
        if old in df.columns and new not in df.columns:
            df = df.withColumnRenamed(old, new)
    missing = {c: F.lit(None).cast(t) for c, t in EVENT_OPTIONAL.items() if c not in df.columns}
    typed = {c: F.col(c).try_cast(t) for c, t in EVENT_OPTIONAL.items() if c in df.columns and c != "event_timestamp"}
    kinds = dict(df.dtypes)
    if kinds.get("event_timestamp") == "string":
        typed["event_timestamp"] = event_time(F.col("event_timestamp"))
    elif "event_timestamp" in kinds:
        typed["event_timestamp"] = F.col("event_timestamp").cast("timestamp")
    elif "timestamp" in kinds:
        missing["event_timestamp"] = event_time(F.col("timestamp").cast("string"))
    return df.withColumns(typed | missing)


def with_identity(df: DataFrame) -> DataFrame:
    key, source = keys.event_identity(df)
    return df.withColumns({"event_key": key, "event_identity_source": source})


def validate_events(df: DataFrame) -> Validated:
    """Errors and warnings of every row. Later copies of an event are errors; some codes of the ingest become warnings."""
    original = snapshot(df)
    known = with_identity(align(df.withColumn("original_record", original)))
    copy = Window.partitionBy("event_key").orderBy(*oldest_first(*_ORDER), "original_record")
    known = known.withColumn("_copy", F.row_number().over(copy))
    complete = keys.complete_coordinates()
    ingest = F.coalesce(F.col("validation_errors"), F.array().cast("array<string>"))
    errors = F.filter(ingest, lambda e: ~e.isin(*DOWNGRADED))
    warned = F.transform(F.filter(ingest, lambda e: e.isin(*DOWNGRADED)), lambda e: F.concat(F.lit("bronze:"), e))
    # both lists are formed before validation_errors changes its meaning
    listed = known.withColumns({"_errors": F.array_distinct(F.concat(errors, codes(event_rejects(complete)))), "_warnings": F.array_distinct(F.concat(warned, codes(event_warnings(complete))))})
    return Validated(listed.drop("validation_errors", "_copy").withColumnsRenamed({"_errors": "validation_errors", "_warnings": "validation_warnings"}))


def issue_rows(checked: Validated, run_ts: Column) -> DataFrame:
    """One row per (record, issue), errors and warnings in one pass. The raw record is part of a record's key, so faulty
    rows without an identity of their own stay apart."""
    of = lambda c, status: F.transform(c, lambda x: F.struct(F.lit(status).alias("issue_status"), x.alias("issue_code")))
    issue = F.explode(F.concat(of(F.col("validation_errors"), "REJECTED"), of(F.col("validation_warnings"), "WARNING")))
    place = [F.col(c) for c in ("kafka_topic", "kafka_partition", "kafka_offset")]
    rows = checked.rows.withColumn("_issue", issue)
    named = rows.withColumn("record_key", keys.record_key("quality_record", F.col("event_key"), *place, F.col("_source_file"), F.col("original_record")))
    issue_key = keys.record_key("quality_issue", F.lit(SOURCE), F.col("record_key"), F.col("_issue.issue_status"), F.col("_issue.issue_code"))
    return named.select(
        F.lit(SOURCE).alias("source_table"), "record_key", issue_key.alias("issue_key"), "event_key", "event_id",
        "_issue.issue_status", "_issue.issue_code", "kafka_topic", "kafka_partition", "kafka_offset", "original_record", run_ts.alias("detected_at"),
    )


def quarantine(checked: Validated, run_ts: Column) -> DataFrame:
    """One representative per rejected event key, with the raw fields."""
    kept = first_by(checked.rejected, ["event_key"], [*newest_first("bronze_ingestion_timestamp", "kafka_timestamp"), *oldest_first("kafka_topic", "kafka_partition", "kafka_offset"), F.col("original_record")])
    raw = ("event_id", "user_id", "session_id", "event_type", "device_type", "event_timestamp")
    return kept.select(
        "event_key", *[F.col(c).cast("string").alias(f"raw_{c}") for c in raw], "validation_errors", "validation_warnings", "original_record",
        "kafka_topic", "kafka_partition", "kafka_offset", "kafka_timestamp", "processing_date", run_ts.alias("first_seen_at"), run_ts.alias("last_seen_at"),
    )


# fixed values: columns to be collapsed and put in snake case
_COLLAPSED = ("product_id", "order_id", "url_path", "query", "wishlist_name", "payment_type", "shipping_method", "fulfillment_speed", "error_code", "ip_address", "utm_source")
_SNAKE = ("event_type", "payment_type", "shipping_method", "fulfillment_speed", "utm_source")


def clean_events(df: DataFrame) -> DataFrame:
    """Devices, identities, descriptive strings and types; one row per event key."""
    out = {c: F.trim(F.col(c)) for c in ("event_id", "user_id", "session_id", "event_type")}
    out["device_type"] = device(F.col("device_type"))
    out |= {c: collapse(F.col(c)) for c in _COLLAPSED}
    out |= {c: snake(out[c]) for c in _SNAKE}
    return first_by(df.withColumns(out), ["event_key"], [*oldest_first(*_ORDER), F.col("original_record")] if "original_record" in df.columns else oldest_first(*_ORDER))


def with_dimension_keys(df: DataFrame) -> DataFrame:
    return df.withColumns(
        {
            "session_key": keys.natural("session", F.col("session_id")),
            "device_key": keys.natural("device", F.col("device_type"), case_sensitive=False),
            "event_type_key": keys.natural("event_type", F.col("event_type"), case_sensitive=False),
        }
    )


def with_users(df: DataFrame, users: DataFrame | None) -> DataFrame:
    """user_key of the current user row, if a user table is given; every event stays once."""
    if users is None:
        return df.withColumn("user_key", F.lit(None).cast("string"))
    if "is_current" in users.columns:
        users = users.where("is_current")
    elif "valid_to" in users.columns:
        users = users.where("valid_to is null")
    order = [F.col("silver_updated_at").desc_nulls_last()] if "silver_updated_at" in users.columns else []
    once = first_by(users.select("user_id", "user_key", *(["silver_updated_at"] if order else [])).where("user_id is not null"), ["user_id"], [*order, F.col("user_key")])
    return df.join(once.select("user_id", "user_key"), "user_id", "left")


def dim_device(df: DataFrame, run_ts: Column) -> DataFrame:
    seen = df.where("device_key is not null").groupBy("device_key").agg(F.min("device_type").alias("device_name"), F.min("event_timestamp").alias("first_seen_at"), F.max("event_timestamp").alias("last_seen_at"))
    return seen.withColumn("silver_updated_at", run_ts)


def dim_event_type(df: DataFrame, run_ts: Column) -> DataFrame:
    seen = df.where("event_type_key is not null").groupBy("event_type_key").agg(F.min("event_type").alias("event_type"), F.min("event_timestamp").alias("first_seen_at"), F.max("event_timestamp").alias("last_seen_at"))
    return seen.withColumns({"event_category": event_category(F.col("event_type")), "silver_updated_at": run_ts})


_FACT = (
    "event_key event_id event_identity_source date_key user_key user_id session_key session_id device_key event_type_key event_type event_timestamp utm_source "
    "ip_address_hash product_id order_id url_path query wishlist_name payment_type shipping_method fulfillment_speed error_code success http_status quantity "
    "cart_total_items cart_value duration_sec results_count clicked_position rating text_length cart_items dq_flags kafka_topic kafka_partition kafka_offset "
    "kafka_timestamp bronze_ingestion_timestamp source_file processing_date pipeline_run_id silver_ingestion_timestamp"
).split()


def fact_events(df: DataFrame, run_ts: Column) -> DataFrame:
    """The 44 columns of the event fact."""
    made = df.withColumns(
        {
            "date_key": F.date_format("event_timestamp", "yyyyMMdd").cast("int"),
            "ip_address_hash": keys.ip_hash(F.col("ip_address")),
            "dq_flags": F.coalesce(F.col("validation_warnings"), F.array().cast("array<string>")),
            "source_file": F.col("_source_file"),
            "silver_ingestion_timestamp": run_ts,
        }
    )
    return made.select(*_FACT)


def sessions(fact: DataFrame, run_ts: Column, touched: DataFrame | None = None) -> DataFrame:
    """Session rollup; with ``touched`` (session_key) only of those. First values are of the earliest event that has one."""
    rows = fact.where("session_key is not null")
    if touched is not None:
        rows = rows.join(touched.select("session_key").distinct(), "session_key", "left_semi")
    # the least (time, key) among events that have the value: one partial aggregate instead of a window
    at = F.struct("event_timestamp", "event_key")
    first = lambda c: F.min_by(F.col(c), F.when(F.col(c).isNotNull(), at)).alias(c)
    rolled = rows.groupBy("session_key").agg(
        first("session_id"), first("user_key"), first("user_id"), F.min("event_timestamp").alias("session_start_at"), F.max("event_timestamp").alias("session_end_at"),
        first("device_key"), F.count(F.lit(1)).alias("event_count"),
    )
    seconds = F.col("session_end_at").cast("long") - F.col("session_start_at").cast("long")
    return rolled.select("session_key", "session_id", "user_key", "user_id", "session_start_at", "session_end_at", seconds.alias("session_duration_sec"), F.col("device_key").alias("primary_device_key"), "event_count", run_ts.alias("silver_updated_at"))
