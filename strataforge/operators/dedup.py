"""Deduplication: one survivor per key under a total order."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from ..contracts import KEY_OF, TABLES


def first_by(df: DataFrame, keys: Sequence[str], order: Sequence[Column]) -> DataFrame:
    """The first row of each key. The order should end in unique columns, or ties survive at random."""
    ranked = df.withColumn("_rank", F.row_number().over(Window.partitionBy(*keys).orderBy(*order)))
    return ranked.where("_rank = 1").drop("_rank")


def newest_first(*columns: str) -> list[Column]:
    return [F.col(c).desc_nulls_last() for c in columns]


def oldest_first(*columns: str) -> list[Column]:
    return [F.col(c).asc_nulls_last() for c in columns]


_COORDINATES = ("_kafka_topic", "_kafka_partition", "_kafka_offset")


def dedup_coordinates(df: DataFrame, table: str) -> DataFrame:
    """One row per broker coordinate: with a business key, then the fullest, then the newest. Rows without one all stay."""
    complete = F.lit(True)
    for c in _COORDINATES:
        complete = complete & F.col(c).isNotNull()
    business = [c for c in TABLES[table] if c in df.columns]
    filled = sum((F.col(c).isNotNull().cast("int") for c in business), F.lit(0))
    key = KEY_OF[table]
    order = [F.col(key).isNotNull().desc(), filled.desc(), *newest_first("bronze_ingestion_timestamp", "_kafka_timestamp"), F.col(key), F.xxhash64(*business)]
    # copies are few, so rows are sorted once, behind the exchange, and by the offset first, which tells most of them apart
    w = Window.partitionBy("_kafka_offset", "_kafka_partition", "_kafka_topic").orderBy(*order)
    once = df.where(complete).withColumn("_later", F.lag(F.lit(True)).over(w)).where("_later is null").drop("_later")
    return once.unionByName(df.where(~complete))


def latest_per_key(df: DataFrame, table: str) -> DataFrame:
    """The newest row of each business key."""
    order = newest_first("_kafka_timestamp", "_kafka_partition", "_kafka_offset", "bronze_ingestion_timestamp")
    rest = [F.xxhash64(*[c for c in TABLES[table] if c in df.columns])]
    return first_by(df, [KEY_OF[table]], [*order, *rest])


def latest_version(df: DataFrame, keys: Sequence[str], version: str) -> DataFrame:
    """What a version-replacing table shows: per key the row of the greatest version."""
    others = [c for c in df.columns if c not in keys]
    best = df.groupBy(*keys).agg(F.max(F.struct(version, *[c for c in others if c != version])).alias("_best"))
    return best.select(*keys, *[F.col(f"_best.{c}") for c in others]).select(*df.columns)


def duplicate_keys(df: DataFrame, keys: Sequence[str]) -> DataFrame:
    return df.groupBy(*keys).agg(F.count(F.lit(1)).alias("copies")).where("copies > 1")
