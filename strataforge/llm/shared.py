"""The folder that driver and executors share."""

from __future__ import annotations

import tempfile
import uuid
from collections.abc import Callable, Iterator

import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession

_own: dict[str, str] = {}


def shared_dir(spark: SparkSession) -> str:
    """spark.checkpoint.dir; where it is unset, as in tests, a folder of this driver."""
    found = spark.conf.get("spark.checkpoint.dir", None)
    if not found:
        app = spark.sparkContext.applicationId
        found = _own.setdefault(app, "file://" + tempfile.mkdtemp(prefix="shared-"))
    return found.rstrip("/")


def fresh_path(spark: SparkSession, name: str) -> str:
    return f"{shared_dir(spark)}/{name}-{uuid.uuid4().hex}"


def cut(df: DataFrame, name: str) -> DataFrame:
    """``df`` written as a table in the shared folder and read again: lineage ends here, and a lost executor costs nothing."""
    path = fresh_path(df.sparkSession, name)
    df.write.parquet(path)
    return df.sparkSession.read.schema(df.schema).parquet(path)


def remove(spark: SparkSession, path: str) -> None:
    """Delete a folder below the shared one."""
    p = spark._jvm.org.apache.hadoop.fs.Path(path)
    p.getFileSystem(spark._jsc.hadoopConfiguration()).delete(p, True)


def trimmed(run: Callable[[Iterator[pa.RecordBatch]], Iterator[pa.RecordBatch]]) -> Callable[[Iterator[pa.RecordBatch]], Iterator[pa.RecordBatch]]:
    """``run`` for ``mapInArrow``; at the end of a task, the worker gives back the memory that it no longer needs.

    Workers outlive their tasks, and what one stage has freed would else count beside what the next one takes.
    """

    def runs(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        import ctypes
        import gc

        yield from run(batches)
        gc.collect()
        pa.default_memory_pool().release_unused()
        give_back = getattr(ctypes.CDLL(None), "malloc_trim", None)
        if give_back is not None:
            give_back(0)

    return runs
