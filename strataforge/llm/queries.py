"""The registered queries of this subpackage: each applies one operator to its whole table."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession

from . import decontaminate, fingerprints, html_extract, licenses, ngram_join, pii, sharding, spiece, toxicity, warc

#: A public merge-type model; every executor has it at this place.
SENTENCEPIECE_MODEL = "/opt/tokenizers/piece_bpe_32k.model"


def _read(spark: SparkSession, sf_dir: str, table: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{table}.parquet")


def op1_fingerprints(spark: SparkSession, sf_dir: str) -> DataFrame:
    return fingerprints.fingerprint_documents(_read(spark, sf_dir, "documents"))


def op2_html_text(spark: SparkSession, sf_dir: str) -> DataFrame:
    return html_extract.extract_pages(_read(spark, sf_dir, "pages"))


def op3_ngram_join(spark: SparkSession, sf_dir: str) -> DataFrame:
    return ngram_join.linked_documents(_read(spark, sf_dir, "documents"))


def op4_toxicity(spark: SparkSession, sf_dir: str) -> DataFrame:
    return toxicity.score_documents(_read(spark, sf_dir, "documents"), _read(spark, sf_dir, "labels"))


def op5_decontamination(spark: SparkSession, sf_dir: str) -> DataFrame:
    return decontaminate.contamination(_read(spark, sf_dir, "documents"), _read(spark, sf_dir, "benchmark"))


def op6_warc(spark: SparkSession, sf_dir: str) -> DataFrame:
    return warc.warc_round_trip(_read(spark, sf_dir, "pages"))


def op7_sharding(spark: SparkSession, sf_dir: str) -> DataFrame:
    return sharding.reshard_documents(_read(spark, sf_dir, "documents"))


def op8_sentencepiece(spark: SparkSession, sf_dir: str) -> DataFrame:
    return spiece.round_trip(_read(spark, sf_dir, "documents"), SENTENCEPIECE_MODEL)


def op9_pii(spark: SparkSession, sf_dir: str) -> DataFrame:
    return pii.find_pii(_read(spark, sf_dir, "documents"))


def op10_licenses(spark: SparkSession, sf_dir: str) -> DataFrame:
    return licenses.scan_licenses(_read(spark, sf_dir, "documents"))


QUERIES = {
    f.__name__: f
    for f in (
        op1_fingerprints, op2_html_text, op3_ngram_join, op4_toxicity, op5_decontamination, op6_warc, op7_sharding, op8_sentencepiece, op9_pii, op10_licenses,
    )
}

#: Queries that SQL expresses on whole tables.
ORACLE_SQL: dict[str, str] = {"op5_decontamination": decontaminate.ORACLE_SQL}
