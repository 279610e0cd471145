"""Date partitions of raw tables: discovery, which ones a day needs, and reads that survive schema drift."""

from __future__ import annotations

import re
from collections.abc import Iterator, Sequence
from datetime import date, timedelta

import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from ..contracts import TABLES, TECHNICAL, ContractError, conform, valid_partition, valid_table
from ..operators.dedup import dedup_coordinates

UNDATED = "19700101"


def _listing(spark: SparkSession, path: str):
    p = spark._jvm.org.apache.hadoop.fs.Path(path)
    fs = p.getFileSystem(spark._jsc.hadoopConfiguration())
    return fs, p, fs.exists(p)


def exists(spark: SparkSession, path: str) -> bool:
    return _listing(spark, path)[2]


def available(spark: SparkSession, table_path: str) -> list[str]:
    """Partitions (eight digits, or partition_date=eight digits) below a table, ascending."""
    fs, p, there = _listing(spark, table_path)
    names = [x.getPath().getName() for x in fs.listStatus(p) if x.isDirectory()] if there else []
    return sorted(m[1] for n in names if (m := re.fullmatch(r"(?:partition_date=)?([0-9]{8})", n)))


def parquet_files(spark: SparkSession, paths: Sequence[str]) -> list[str]:
    """All Parquet files below ``paths``, ascending. Hidden files don't count."""
    found = []
    for path in paths:
        fs, p, there = _listing(spark, path)
        if there:
            it = fs.listFiles(p, True)
            while it.hasNext():
                x = it.next().getPath()
                if x.getName().endswith(".parquet") and not x.getName().startswith(("_", ".")):
                    found.append(x.toString())
    return sorted(found)


def resolve(table: str, day: str, have: Sequence[str], window: int = 1) -> list[str]:
    """The partitions that a day needs.

    categories: the latest up to the day; users, products and prices: all up to the day; orders and items: the days
    around it, as their partitions are of broker or UTC dates, and orders without a time. ``window=0`` gives the day alone.
    """
    valid_table(table)
    valid_partition(day)
    have = sorted(have)
    past = [p for p in have if p <= day]
    if table == "categories":
        return past[-1:]
    if table in ("users", "products", "product_price_history"):
        return past
    d = date(int(day[:4]), int(day[4:6]), int(day[6:]))
    near = {(d + timedelta(days=i)).strftime("%Y%m%d") for i in range(-window, window + 1)}
    if table == "orders":
        near.add(UNDATED)
    return [p for p in have if p in near]


def footers(spark: SparkSession, files: Sequence[str], at_once: int = 64) -> list[tuple[str, str]]:
    """(file, digest of its footer's schema), ascending; a file system that only Spark can open gives every file its own."""
    if not files:
        return []

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        import hashlib

        import pyarrow.fs as pafs
        import pyarrow.parquet as pq

        for batch in batches:
            paths, digests = batch.column(0).to_pylist(), []
            for p in paths:
                try:
                    fs, at = pafs.FileSystem.from_uri(re.sub("^file:/+", "file:///", re.sub("^s3[an]://", "s3://", p)))
                    digests.append(hashlib.sha256(str(pq.read_schema(at, filesystem=fs).remove_metadata()).encode()).hexdigest())
                except (OSError, ValueError, pa.ArrowException):
                    digests.append(p)
            yield pa.RecordBatch.from_arrays([batch.column(0), pa.array(digests, pa.string())], names=["file", "digest"])

    listed = spark.createDataFrame([(f,) for f in files], "file string").repartition(-(-len(files) // at_once))
    return sorted((r[0], r[1]) for r in listed.mapInArrow(run, "file string, digest string").collect())


def read_schema_groups(spark: SparkSession, files: Sequence[str], columns: dict[str, str]) -> DataFrame:
    """Files of differing schemas as one table: files of one footer schema are read together, cast, and unioned.

    mergeSchema can't reconcile a double with a decimal; a cast per group can. Footers are read in tasks; the driver
    gets a digest per file and opens one file per group.
    """
    groups: dict[str, list[str]] = {}
    for f, digest in footers(spark, files):
        groups.setdefault(digest, []).append(f)
    parts = [_with_file(spark.read.schema(spark.read.parquet(paths[0]).schema).parquet(*paths), columns) for paths in groups.values()]
    if not parts:
        return spark.createDataFrame([], T.StructType.fromDDL(", ".join(f"`{c}` {t}" for c, t in columns.items())))
    out = parts[0]
    for p in parts[1:]:
        out = out.unionByName(p, allowMissingColumns=True)
    return out


def _with_file(df: DataFrame, columns: dict[str, str]) -> DataFrame:
    return conform(df.withColumn("_source_file", F.col("_metadata.file_path")), columns)


def read_bronze(spark: SparkSession, root: str, table: str, day: str, zone: str = "UTC", window: int = 1) -> DataFrame:
    """A day's rows of a raw table, one per broker coordinate. Orders are those whose own time falls on the day in ``zone``."""
    base = f"{root.rstrip('/')}/{valid_table(table)}"
    have = available(spark, base)
    if not have:
        raise ContractError(f"no partitions below {base}")
    paths = [f"{base}/{p}" if exists(spark, f"{base}/{p}") else f"{base}/partition_date={p}" for p in resolve(table, day, have, window)]
    rows = dedup_coordinates(read_schema_groups(spark, parquet_files(spark, paths), TABLES[table] | TECHNICAL), table)
    if table == "orders":
        own = F.when(F.year("event_timestamp") > 1970, F.col("event_timestamp"))
        # times are instants; the business day is that of the zone
        local = F.to_date(F.convert_timezone(F.current_timezone(), F.lit(zone), F.coalesce(own, F.col("_kafka_timestamp")).cast("timestamp_ntz")))
        rows = rows.where(F.date_format(local, "yyyyMMdd") == day)
    return rows


def read_events(spark: SparkSession, root: str, day: date, run_id: str) -> DataFrame:
    """A day's clickstream partition with lineage. Partition columns prune the scan."""
    path = f"{root.rstrip('/')}/year={day.year}/month={day.month}/day={day.day}"
    for at in (path, f"{root.rstrip('/')}/year={day.year:04d}/month={day.month:02d}/day={day.day:02d}"):
        if exists(spark, at):
            rows = spark.read.option("basePath", root).parquet(at)
            return rows.withColumns({"_source_file": F.col("_metadata.file_path"), "processing_date": F.lit(day), "pipeline_run_id": F.lit(run_id)})
    raise ContractError(f"no partition {path}")
