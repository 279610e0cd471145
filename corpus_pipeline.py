"""The training-corpus pipeline over ``documents``: civil, distinct, uncontaminated and redacted texts, as tokens.

Every stage takes (spark, docs, sf_dir), with ``docs`` all that the stage before it kept, and returns a DataFrame that
is written as Parquet and read again. All but the last return the columns of ``documents``.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from strataforge.llm import decontaminate, ngram_join, pii, spiece, toxicity
from strataforge.llm.queries import SENTENCEPIECE_MODEL
from strataforge.llm.shared import cut


def drop_toxic(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that the toxicity operator rejects go."""
    return toxicity.keep_civil(docs, spark.read.parquet(f"{sf_dir}/labels.parquet"))


def drop_near_copies(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Of each component of the n-gram join the least document stays."""
    return ngram_join.one_of_each(docs)


def drop_benchmark(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents with a window of a benchmark item go."""
    return decontaminate.drop_contaminated(docs, spark.read.parquet(f"{sf_dir}/benchmark.parquet"))


def redact_pii(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Personal data becomes its kind in brackets; n_chars follows the text."""
    n_chars = F.when(F.col("text").isNotNull(), F.char_length("text").cast("bigint")).otherwise(F.col("n_chars"))
    return pii.redact(docs).withColumn("n_chars", n_chars)


def tokenize(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """The pieces of every text, under seeded merge dropout."""
    tokens = spiece.encode_documents(docs, SENTENCEPIECE_MODEL)
    return tokens.withColumn("n_tokens", F.size("token_ids").cast("bigint"))


STAGES = [
    ("toxicity", drop_toxic),
    ("ngram_jaccard_join", drop_near_copies),
    ("benchmark_decontamination", drop_benchmark),
    ("pii", redact_pii),
    ("sentencepiece", tokenize),
]

#: Learned models and hashes of pieces are beyond SQL; the tests hold the stages against brute force.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All stages on ``documents``."""
    docs = spark.read.parquet(f"{sf_dir}/documents.parquet")
    for name, stage in STAGES[:-1]:
        docs = cut(stage(spark, docs, sf_dir), name)
    return STAGES[-1][1](spark, docs, sf_dir)
