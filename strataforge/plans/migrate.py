"""One-off migration of raw event keys to hashed keys, with proofs before the write."""

from __future__ import annotations

from dataclasses import dataclass

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ..contracts import ContractError
from ..functions.keys import event_identity
from .store import Store

HASHED = "^[0-9a-f]{64}$"
_PLACE = ["kafka_partition", "kafka_offset"]


def stale_rows(fact: DataFrame) -> DataFrame:
    """Rows whose key is no digest."""
    return fact.where(~F.col("event_key").rlike(HASHED))


def ambiguous(bronze: DataFrame, stale: DataFrame) -> DataFrame:
    """Coordinates of stale rows without a topic that several topics have."""
    wanted = stale.where("kafka_topic is null").select(*_PLACE).distinct()
    return bronze.join(wanted, _PLACE, "left_semi").groupBy(*_PLACE).agg(F.count_distinct("kafka_topic").alias("topics")).where("topics > 1")


def mapping(bronze: DataFrame, stale: DataFrame) -> DataFrame:
    """(old_key, new_key): stale keys and the keys that their raw events have now."""
    key, _ = event_identity(bronze)
    b = bronze.withColumn("new_key", key).select(F.col("kafka_topic").alias("b_topic"), *[F.col(c).alias(f"b_{c}") for c in _PLACE], "new_key").distinct()
    s = stale.select(F.col("event_key").alias("old_key"), "kafka_topic", *_PLACE)
    same = (F.col("b_kafka_partition") == F.col("kafka_partition")) & (F.col("b_kafka_offset") == F.col("kafka_offset"))
    joined = s.join(b, same & (F.col("b_topic").eqNullSafe(F.col("kafka_topic")) | F.col("kafka_topic").isNull()), "left")
    return joined.select("old_key", "new_key").distinct()


@dataclass(frozen=True)
class Proof:
    stale: int
    ambiguous: int
    unmapped: int
    repeated: int
    collisions: int

    @property
    def holds(self) -> bool:
        return not (self.ambiguous or self.unmapped or self.repeated or self.collisions)


def prove(fact: DataFrame, bronze: DataFrame) -> tuple[Proof, DataFrame]:
    stale = stale_rows(fact)
    pairs = mapping(bronze, stale)
    keys = pairs.groupBy("new_key").agg(F.count_distinct("old_key").alias("n"))
    per_old = pairs.groupBy("old_key").agg(F.count(F.lit(1)).alias("n"))
    kept = fact.where(F.col("event_key").rlike(HASHED)).select(F.col("event_key").alias("new_key"))
    proof = Proof(
        stale.count(), ambiguous(bronze, stale).count(), pairs.where("new_key is null").count(),
        keys.where("new_key is not null and n > 1").count() + per_old.where("n > 1").count(), pairs.join(kept, "new_key", "left_semi").count(),
    )
    return proof, pairs


def migrate(store: Store, table: str, bronze: DataFrame, dry_run: bool = True) -> Proof:
    """Replace stale keys if every proof holds; ``dry_run`` only proves."""
    fact = store.read(table)
    proof, pairs = prove(fact, bronze)
    if dry_run or not proof.stale:
        return proof
    if not proof.holds:
        raise ContractError(f"keys can't be migrated: {proof}")

    def rekey(rows: DataFrame) -> DataFrame:
        joined = rows.join(pairs.withColumnRenamed("old_key", "event_key"), "event_key", "left")
        return joined.withColumn("event_key", F.coalesce("new_key", "event_key")).select(*rows.columns)

    store.update(table, rekey)
    if not stale_rows(store.read(table)).isEmpty():
        raise ContractError("stale keys remain")
    return proof
