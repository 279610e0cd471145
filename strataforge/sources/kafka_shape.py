"""Broker records: the connector where it is installed, files of the same shape elsewhere; JSON values."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from ..contracts import KAFKA_RECORD


def has_connector(spark: SparkSession) -> bool:
    try:
        spark._jvm.java.lang.Class.forName("org.apache.spark.sql.kafka010.KafkaSourceProvider", False, spark._jvm.java.lang.Thread.currentThread().getContextClassLoader())
    except Exception:  # a Py4J error that wraps ClassNotFoundException
        return False
    return True


def read_topic(spark: SparkSession, topic: str, servers: str | None = None, directory: str | None = None, **options: str) -> DataFrame:
    """A stream of one topic: from ``servers``, or from Parquet files of records below ``directory``."""
    if servers is not None:
        settings = {"kafka.bootstrap.servers": servers, "subscribe": topic, "startingOffsets": "earliest", "failOnDataLoss": "false"} | options
        found = spark.readStream.format("kafka").options(**settings).load()
    elif directory is not None:
        found = spark.readStream.schema(KAFKA_RECORD).options(**options).parquet(directory)
    else:
        raise ValueError("give servers or a directory")
    return found.select(*KAFKA_RECORD.names).where(F.col("topic") == topic)


def read_topic_batch(spark: SparkSession, directory: str, topic: str | None = None) -> DataFrame:
    rows = spark.read.schema(KAFKA_RECORD).parquet(directory)
    return rows if topic is None else rows.where(F.col("topic") == topic)


def parse_json(records: DataFrame, schema: T.StructType) -> DataFrame:
    """The fields of JSON values beside the broker's columns."""
    parsed = records.withColumn("data", F.from_json(F.col("value").cast("string"), schema))
    return parsed.select("data.*", F.col("topic").alias("_kafka_topic"), F.col("partition").alias("_kafka_partition"), F.col("offset").alias("_kafka_offset"), F.col("timestamp").alias("_kafka_timestamp"))


def flatten_unions(df: DataFrame, names) -> DataFrame:
    """Columns of nullable unions as text: a struct gives its ``string`` field, text stays, anything else is an error."""
    out = {}
    for n in names:
        kind = df.schema[n].dataType
        if isinstance(kind, T.StructType) and "string" in kind.names:
            out[n] = F.col(f"{n}.string")
        elif not isinstance(kind, T.StringType):
            raise TypeError(f"{n} is {kind.simpleString()}, neither text nor a nullable union")
    return df.withColumns(out) if out else df
