"""One session factory for all jobs."""

from __future__ import annotations

from pyspark.sql import SparkSession


def build_session(app: str = "strataforge", master: str | None = None, time_zone: str = "UTC", **conf: str) -> SparkSession:
    """A session with ANSI mode, adaptive execution and an explicit time zone. ``conf`` overrides, dots as underscores twice."""
    builder = SparkSession.builder.appName(app)
    if master:
        builder = builder.master(master)
    settings = {
        "spark.sql.ansi.enabled": "true",
        "spark.sql.session.timeZone": time_zone,
        "spark.sql.adaptive.enabled": "true",
        "spark.sql.adaptive.skewJoin.enabled": "true",
        "spark.sql.adaptive.advisoryPartitionSizeInBytes": "128m",
        "spark.sql.sources.partitionOverwriteMode": "dynamic",
    } | {k.replace("__", "."): v for k, v in conf.items()}
    return builder.config(map=settings).getOrCreate()
