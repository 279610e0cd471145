"""Raw tables from broker streams. All transformations are stateless and work on batches too."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.streaming import StreamingQuery

from ..contracts import TABLES, valid_table
from ..functions.clean import event_time, nonblank
from ..functions.keys import bronze_event_id
from ..functions.rules import Rule, codes
from ..sources.avro import decode
from ..sources.kafka_shape import flatten_unions

UNDATED = "__UNDATED__"
# fixed values: the columns of raw events, lineage first, then business columns as far as the schema has them
LINEAGE = (
    "source_topic source_subject schema_id wire_schema_id kafka_key kafka_topic kafka_partition kafka_offset kafka_timestamp raw_value decode_success "
    "schema_id_matches decode_error bronze_ingestion_timestamp event_timestamp event_date is_valid validation_errors year month day"
).split()
BUSINESS = (
    "event_id timestamp user_id event_type device_type session_id ip_address utm_source product_id quantity cart_total_items cart_items cart_value shipping_method "
    "order_id fulfillment_speed url_path duration_sec http_status payment_type success error_code query results_count clicked_position rating text_length wishlist_name"
).split()
_TRIM = ("user_id", "session_id", "event_type", "device", "product_id", "order_id", "utm_source", "ip_address", "url_path", "query", "payment_type", "shipping_method", "fulfillment_speed", "error_code", "wishlist_name")


def bronze_events(records: DataFrame, schema_text: str, schema_id: int | None, ingested_at: Column | None = None, subject: str = "behavioral.events-value") -> DataFrame:
    """Decoded, trimmed, flagged and partitioned clickstream rows; invalid ones are flagged, never dropped.

    The broker's columns are renamed before the message is decoded, as a message has a time of its own by the same name.
    """
    df = decode(records.withColumnsRenamed({c: f"kafka_{c}" for c in ("key", "topic", "partition", "offset", "timestamp")}), schema_text, schema_id)
    have = set(df.columns)
    text = lambda c: F.trim(F.col(c)) if c in have else F.lit(None).cast("string")
    out = {c: text(c) for c in _TRIM}
    out |= {c: F.lower(out[c]) for c in ("event_type", "device")}
    written = F.trim(F.col("event_timestamp" if "event_timestamp" in have else "timestamp").cast("string")) if have & {"event_timestamp", "timestamp"} else F.lit(None).cast("string")
    df = df.withColumns(
        out
        | {
            # an id of the producer keeps its place beside the key of the broker's coordinates
            "producer_event_id": F.trim(F.col("event_id")) if "event_id" in have else F.lit(None).cast("string"),
            "event_id": bronze_event_id("kafka_topic", "kafka_partition", "kafka_offset"), "timestamp": written, "event_timestamp": event_time(written),
            "bronze_ingestion_timestamp": ingested_at if ingested_at is not None else F.current_timestamp(),
            "source_topic": F.col("kafka_topic"), "source_subject": F.lit(subject), "schema_id": F.lit(schema_id).cast("int"), "wire_schema_id": F.col("_wire_schema_id"),
            "schema_id_matches": F.lit(True) if schema_id is None else F.coalesce(F.col("_wire_schema_id") == schema_id, F.lit(False)),
            "kafka_key": F.col("kafka_key").cast("string") if "kafka_key" in have else F.lit(None).cast("string"),
        }
    ).withColumnRenamed("device", "device_type")
    gone = lambda c: ~nonblank(F.col(c))
    rules = [
        *[Rule(f"missing_{c}", gone(c)) for c in ("event_id", "timestamp", "user_id", "event_type", "device_type", "session_id")], Rule("invalid_event_timestamp", F.col("event_timestamp").isNull()),
        Rule("invalid_magic_byte", F.col("decode_error") == "invalid_magic_byte"), Rule("avro_decode_failed", F.col("decode_error").isin("avro_decode_failed", "message_too_short")),
        Rule("schema_id_mismatch", F.col("decode_error") == "schema_id_mismatch"),
    ]
    df = df.withColumn("validation_errors", codes(rules)).withColumn("is_valid", F.size("validation_errors") == 0)
    when = F.coalesce("event_timestamp", "kafka_timestamp")
    dated = df.withColumns({"event_date": F.to_date(when), "year": F.year(when), "month": F.month(when), "day": F.dayofmonth(when)})
    return dated.select(*LINEAGE, *[c for c in BUSINESS if c in dated.columns], "producer_event_id")


def bronze_transactional(records: DataFrame, table: str, schema_text: str, schema_id: int | None, ingested_at: Column | None = None) -> DataFrame:
    """Decoded rows of one entity with lineage, decode flags and a partition date; rows without any date keep one of their own."""
    columns = TABLES[valid_table(table)]
    broker = {"topic": "_kafka_topic", "partition": "_kafka_partition", "offset": "_kafka_offset", "timestamp": "_kafka_timestamp"}
    df = decode(records.withColumnsRenamed(broker), schema_text, schema_id)
    df = flatten_unions(df, [c for c, t in columns.items() if t == "string" and c in df.columns])
    typed = {}
    for c, t in columns.items():
        have = F.col(c) if c in df.columns else F.lit(None).cast("string")
        typed[c] = event_time(have.cast("string")) if t == "timestamp" else have.cast("string").try_cast(t)
    when = "event_timestamp" if table == "orders" else "_kafka_timestamp"
    df = df.withColumns(typed).withColumns({"source_table": F.lit(table), "bronze_ingestion_timestamp": ingested_at if ingested_at is not None else F.current_timestamp()})
    return df.withColumn("partition_date", F.coalesce(F.date_format(F.coalesce(when, "_kafka_timestamp"), "yyyyMMdd"), F.lit(UNDATED)))


def write_stream(df: DataFrame, path: str, checkpoint: str, partitions, name: str, trigger: str | None = None) -> StreamingQuery:
    """An exactly-once Parquet sink with its own checkpoint. Without ``trigger`` it takes what is there and ends."""
    writer = df.writeStream.format("parquet").queryName(name).option("path", path).option("checkpointLocation", checkpoint).option("maxRecordsPerFile", 500_000).partitionBy(*partitions).outputMode("append")
    return (writer.trigger(processingTime=trigger) if trigger else writer.trigger(availableNow=True)).start()


def await_all(queries: list[StreamingQuery], seconds: float | None = None) -> None:
    """Wait for every query; the first failure stops the others and is raised."""
    import time

    until = None if seconds is None else time.monotonic() + seconds
    while any(q.isActive for q in queries):
        for q in queries:
            if q.exception() is not None:
                for other in queries:
                    other.stop()
                raise q.exception()
        if until is not None and time.monotonic() > until:
            raise TimeoutError("streams are still running")
        time.sleep(0.2)
    for q in queries:
        if q.exception() is not None:
            raise q.exception()
