"""Serving tables fed by streams: the projection of each message, appended."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.streaming import StreamingQuery

from ..operators.serving import realtime
from .bronze import bronze_events, bronze_transactional

#: The time whose month is a table's partition; items have none.
MONTH_OF = {"behavioral": "event_timestamp", "orders": "event_timestamp", "users": "ingested_at", "products": "ingested_at", "categories": "ingested_at", "product_price_history": "valid_from_timestamp"}


def serve(messages: DataFrame, table: str, path: str, checkpoint: str, ingested_at: Column | None = None, trigger: str | None = None) -> StreamingQuery:
    """Append the projection of ``messages`` to a table partitioned by month."""
    rows = realtime(messages, table).withColumn("ingested_at", ingested_at if ingested_at is not None else F.current_timestamp())
    writer = rows.writeStream.format("parquet").queryName(f"realtime_{table}").option("path", path).option("checkpointLocation", checkpoint).outputMode("append")
    if table in MONTH_OF:
        writer = rows.withColumn("yyyymm", F.date_format(MONTH_OF[table], "yyyyMM").cast("int")).writeStream.format("parquet").queryName(f"realtime_{table}").option("path", path).option("checkpointLocation", checkpoint).partitionBy("yyyymm").outputMode("append")
    return (writer.trigger(processingTime=trigger) if trigger else writer.trigger(availableNow=True)).start()


def serve_messages(records: DataFrame, table: str, schema_text: str, schema_id: int | None, path: str, checkpoint: str, ingested_at: Column | None = None, trigger: str | None = None) -> StreamingQuery:
    """The serving table of a topic of framed messages: decoded, projected and appended as one stateless stream."""
    at = ingested_at if ingested_at is not None else F.current_timestamp()
    rows = bronze_events(records, schema_text, schema_id, at) if table == "behavioral" else bronze_transactional(records, table, schema_text, schema_id, at)
    return serve(rows.drop("validation_errors", "is_valid"), table, path, checkpoint, at, trigger)


def deduplicated(events: DataFrame, keys: list[str], at: str = "event_timestamp", late: str = "10 minutes") -> DataFrame:
    """An extension: copies of an event within the lateness are dropped, with bounded state."""
    return events.withWatermark(at, late).dropDuplicatesWithinWatermark(keys)


def per_window(events: DataFrame, width: str = "1 minute", at: str = "event_timestamp", late: str = "10 minutes") -> DataFrame:
    """An extension: counts per window and type as a stream, emitted when the watermark passes."""
    return events.withWatermark(at, late).groupBy(F.window(at, width).alias("w"), "event_type").agg(F.count(F.lit(1)).alias("events"))
