"""Deterministic keys."""

from __future__ import annotations

import hashlib
from datetime import date

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from .clean import nonblank


def sha(*parts: Column, sep: str = "|") -> Column:
    return F.sha2(F.concat_ws(sep, *parts).cast("binary"), 256)


def kimball(prefix: str, *columns: str) -> Column:
    """PREFIX_ and the digest of the values; nulls count as a value."""
    return F.concat(F.lit(f"{prefix}_"), sha(*[F.coalesce(F.col(c).cast("string"), F.lit("__NULL__")) for c in columns], sep="||"))


def bronze_event_id(topic: str = "topic", partition: str = "partition", offset: str = "offset") -> Column:
    return sha(F.col(topic), F.col(partition).cast("string"), F.col(offset).cast("string"), sep="||")


def complete_coordinates(topic: str = "kafka_topic", partition: str = "kafka_partition", offset: str = "kafka_offset") -> Column:
    return nonblank(F.col(topic)) & F.col(partition).isNotNull() & F.col(offset).isNotNull()


_FALLBACK = ("session_id", "event_type", "timestamp", "event_timestamp", "user_id", "product_id", "order_id")


def event_identity(df: DataFrame) -> tuple[Column, Column]:
    """(event_key, event_identity_source): the event id, else the broker coordinates, else those of seven fields that there are."""
    text = lambda c: F.coalesce(F.col(c).cast("string"), F.lit("")) if c in df.columns else F.lit("")
    by_id = nonblank(F.col("event_id")) if "event_id" in df.columns else F.lit(False)
    by_place = complete_coordinates() if {"kafka_topic", "kafka_partition", "kafka_offset"} <= set(df.columns) else F.lit(False)
    key = (
        F.when(by_id, sha(F.lit("event_id"), F.trim(text("event_id"))))
        .when(by_place, sha(F.lit("kafka"), F.trim(text("kafka_topic")), text("kafka_partition"), text("kafka_offset")))
        .otherwise(sha(F.lit("fallback"), *[text(c) for c in _FALLBACK if c in df.columns]))
    )
    return key, F.when(by_id, "event_id").when(by_place, "kafka_coordinate").otherwise("fallback_fields")


def natural(prefix: str, c: Column, case_sensitive: bool = True) -> Column:
    t = F.trim(c) if case_sensitive else F.lower(F.trim(c))
    return F.when(nonblank(c), sha(F.lit(prefix), t))


def ip_hash(c: Column) -> Column:
    return F.when(nonblank(c), sha(F.lit("ip"), F.lower(F.trim(c))))


def record_key(kind: str, *parts: Column) -> Column:
    """The digest of a kind of record and its parts; nulls are blank."""
    return sha(F.lit(kind), *[F.coalesce(p.cast("string"), F.lit("")) for p in parts])


def run_key(day: date, pipeline: str = "silver_behavioral") -> str:
    return hashlib.sha256(f"{pipeline}|{day.isoformat()}".encode()).hexdigest()
