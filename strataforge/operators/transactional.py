"""Validation, cleaning and cross-validation of the transactional entities."""

from __future__ import annotations

from collections.abc import Sequence
from dataclasses import dataclass

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ..contracts import ID_PATTERNS, TABLES, TECHNICAL, conform, valid_table
from ..functions.clean import collapse
from ..functions.keys import sha
from ..functions.rules import codes, transactional_rejects, transactional_warnings
from .dedup import latest_per_key

REPAIR_NOTE = "event_timestamp replaced with kafka timestamp"


@dataclass(frozen=True)
class Validated:
    """All rows with errors and warnings, and views of them."""

    rows: DataFrame

    @property
    def valid(self) -> DataFrame:
        return self.rows.where(F.size("validation_errors") == 0)

    @property
    def rejected(self) -> DataFrame:
        return self.rows.where(F.size("validation_errors") > 0)

    @property
    def warned(self) -> DataFrame:
        return self.valid.where(F.size("validation_warnings") > 0)


def normalize_schema(df: DataFrame, table: str) -> DataFrame:
    """Business and technical columns, typed; what is missing or can't be cast is null."""
    return conform(df, TABLES[valid_table(table)] | TECHNICAL)


def snapshot(df: DataFrame) -> Column:
    """The row as JSON; binaries in base64."""
    return F.to_json(F.struct(*[(F.base64(F.col(f"`{f.name}`")) if f.dataType.simpleString() == "binary" else F.col(f"`{f.name}`")).alias(f.name) for f in df.schema.fields]))


def repair_timestamps(df: DataFrame, table: str) -> DataFrame:
    """Orders without a plausible time take the broker's."""
    if table != "orders":
        return df.withColumns({"_timestamp_repaired": F.lit(False), "repair_description": F.lit(None).cast("string")})
    bad = F.col("event_timestamp").isNull() | (F.year("event_timestamp") <= 1970)
    usable = bad & F.col("_kafka_timestamp").isNotNull()
    return df.withColumns(
        {
            "_timestamp_repaired": usable,
            "event_timestamp": F.when(usable, F.col("_kafka_timestamp")).otherwise(F.col("event_timestamp")),
            "repair_description": F.when(usable, F.lit(REPAIR_NOTE)),
        }
    )


def validate(df: DataFrame, table: str, keep: Sequence[str] = ()) -> Validated:
    """Columns in ``keep`` stay as they are and are no part of the record."""
    original, types = snapshot(df.drop(*keep)), dict(df.dtypes)
    typed = conform(df.withColumn("original_record", original), TABLES[valid_table(table)] | TECHNICAL | {"original_record": "string"} | {c: types[c] for c in keep})
    repaired = repair_timestamps(typed, table)
    return Validated(
        repaired.withColumns({"validation_errors": codes(transactional_rejects(table)), "validation_warnings": codes(transactional_warnings(table))})
    )


def issue_key() -> Column:
    """Digest of what identifies an issue; the volatile snapshot isn't part of it."""
    text = lambda c: F.coalesce(F.col(c).cast("string"), F.lit("__NULL__"))
    listed = lambda c: F.coalesce(F.to_json(c), F.lit("[]"))
    parts = [text("source_table"), text("record_id"), text("issue_status"), listed("validation_errors"), listed("validation_warnings"), text("repair_description"), text("_kafka_topic"), text("_kafka_partition"), text("_kafka_offset")]
    return sha(*parts, sep="||")


def quality_issues(checked: Validated, table: str, run_ts: Column) -> DataFrame:
    """One row per record with an issue; the gravest status names it."""
    rows = checked.rows
    rejected, repaired = F.size("validation_errors") > 0, F.col("_timestamp_repaired")
    status = F.when(rejected, "REJECTED").when(repaired, "REPAIRED").otherwise("WARNING")
    found = rows.where(rejected | repaired | (F.size("validation_warnings") > 0))
    key = next(iter(TABLES[table]))
    shaped = found.select(
        F.lit(table).alias("source_table"), F.col(key).alias("record_id"), status.alias("issue_status"), "validation_errors", "validation_warnings", "repair_description",
        "original_record", "_source_file", "_kafka_topic", "_kafka_partition", "_kafka_offset", "_kafka_timestamp", "bronze_ingestion_timestamp", run_ts.alias("detected_at"),
    )
    return shaped.withColumn("issue_key", issue_key())


_LOWER = {"users": ("email", "device", "loyalty_tier"), "orders": ("status", "payment_method")}


def clean_values(df: DataFrame, table: str) -> DataFrame:
    """Strings, case, types. Rows whose key is no value after cleaning go."""
    types = TABLES[valid_table(table)]
    out = {}
    for c, t in types.items():
        if t == "string":
            x = collapse(F.col(c))
            x = F.upper(x) if c in ID_PATTERNS else F.lower(x) if c in _LOWER.get(table, ()) else F.initcap(x) if (table, c) == ("categories", "name") else x
            out[c] = x
        else:
            out[c] = F.col(c).try_cast(t)
    if table == "order_items":
        out["item_total_amount"] = F.coalesce(F.col("item_total_amount").try_cast(types["item_total_amount"]), (F.col("quantity") * F.col("unit_price")).try_cast(types["item_total_amount"]))
    cleaned = df.withColumns(out)
    if table == "orders":
        cleaned = cleaned.withColumn("order_date", F.to_date("event_timestamp"))
    return cleaned.where(F.col(next(iter(types))).isNotNull())


def clean(df: DataFrame, table: str, run_ts: Column | None = None) -> DataFrame:
    """Cleaned values, one row per key."""
    once = latest_per_key(clean_values(df, table), table)
    return once if run_ts is None else once.withColumns({"silver_processed_at": run_ts})


def newest_valid(rows: DataFrame, table: str) -> DataFrame:
    """Of normalized rows the valid ones that ``clean`` keeps, with their values as they came.

    ``validate`` and ``clean_values`` make the rest of them again, so the exchange by key carries no records and issues.
    """
    was = {c: f"_was_{c}" for c in TABLES[table]}
    checked = validate(rows.withColumns({w: F.col(c) for c, w in was.items()}), table, list(was.values()))
    return latest_per_key(clean_values(checked.valid, table), table).select(*[F.col(was.get(c, c)).alias(c) for c in rows.columns])


def split_by_parent(items: DataFrame, orders: DataFrame) -> tuple[DataFrame, DataFrame]:
    """(items with a parent order, orphans)."""
    parents = orders.select("order_id").where("order_id is not null").distinct()
    return items.join(parents, "order_id", "left_semi"), items.join(parents, "order_id", "left_anti")


def orphan_issues(orphans: DataFrame, run_ts: Column) -> DataFrame:
    have = set(orphans.columns)
    col = lambda c, t: F.col(c).cast(t) if c in have else F.lit(None).cast(t)
    shaped = orphans.select(
        F.lit("order_items").alias("source_table"), F.col("order_item_id").alias("record_id"), F.lit("REJECTED").alias("issue_status"),
        F.array(F.lit("MISSING_PARENT_ORDER")).alias("validation_errors"), F.array().cast("array<string>").alias("validation_warnings"),
        F.lit(None).cast("string").alias("repair_description"), snapshot(orphans).alias("original_record"),
        *[col(c, t).alias(c) for c, t in (("_source_file", "string"), ("_kafka_topic", "string"), ("_kafka_partition", "int"), ("_kafka_offset", "bigint"), ("_kafka_timestamp", "timestamp"), ("bronze_ingestion_timestamp", "timestamp"))],
        run_ts.alias("detected_at"),
    )
    return shaped.withColumn("issue_key", issue_key())
