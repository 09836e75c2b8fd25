"""Intermediate tables in the folder that driver and executors share."""

from __future__ import annotations

import contextlib
import ctypes
import tempfile
import threading
import uuid
from functools import wraps

import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession

_CLEANUP = "spark.sql.classic.shuffleDependency.fileCleanup.enabled"
#: Of each thread, the paths of the tables that its ``save`` has written and nobody has dropped, in order.
_own = threading.local()


def _written() -> list[str]:
    if not hasattr(_own, "paths"):
        _own.paths = []
    return _own.paths


def shared_dir(spark: SparkSession) -> str:
    """``spark.checkpoint.dir`` of the session. Where it is unset: a new temporary folder on one machine, an error
    on a cluster, where executors would write to their own disks."""
    root = spark.conf.get("spark.checkpoint.dir", None)
    if not root:
        master = spark.sparkContext.master
        if master != "local" and not master.startswith("local["):
            raise ValueError("spark.checkpoint.dir must name a folder that the driver and all executors share")
        root = "file://" + tempfile.mkdtemp(prefix="spark-shared-")
        spark.conf.set("spark.checkpoint.dir", root)
    return root


@contextlib.contextmanager
def _shuffles_removed(spark: SparkSession):
    """The shuffle files of a write are of no use after it; by default they stay until the driver collects garbage."""
    before = spark.conf.get(_CLEANUP, None)
    spark.conf.set(_CLEANUP, "true")
    try:
        yield
    finally:
        spark.conf.set(_CLEANUP, before) if before else spark.conf.unset(_CLEANUP)


def save(df: DataFrame, name: str, *by: str) -> tuple[DataFrame, str]:
    """Writes ``df`` as Parquet, in a folder for each value of ``by``, to the shared folder and reads it again: lineage ends here, and
    a lost executor costs only the tasks that it was running. Returns the frame and its path."""
    spark = df.sparkSession
    path = f"{shared_dir(spark)}/{name}-{uuid.uuid4().hex}"
    _written().append(path)
    with _shuffles_removed(spark):
        (df.write.partitionBy(*by) if by else df.write).option("parquet.block.size", 1 << 25).parquet(path)
    where, files = _hadoop(spark, path)
    files.deleteOnExit(where)  # what a result still reads when its query returns goes with the session
    return spark.read.schema(df.schema).parquet(path), path


def save_bucketed(df: DataFrame, name: str, by: str) -> tuple[DataFrame, str]:
    """Writes ``df``, which a shuffle has dealt by ``by``, as a table of the warehouse with as many buckets as shuffles have
    partitions, sorted: joins by that column read it without a shuffle. Returns the frame and the table's name."""
    spark = df.sparkSession
    table = f"{name}_{uuid.uuid4().hex}"
    with _shuffles_removed(spark):
        df.write.bucketBy(int(spark.conf.get("spark.sql.shuffle.partitions")), by).sortBy(by).option("parquet.block.size", 1 << 25).saveAsTable(table)
    return spark.table(table), table


def drop_table(spark: SparkSession, *tables: str) -> None:
    for t in tables:
        spark.sql(f"DROP TABLE IF EXISTS {t}")


def drop(spark: SparkSession, *paths: str) -> None:
    """Deletes tables that ``save`` wrote and that no later step reads."""
    for path in paths:
        where, files = _hadoop(spark, path)
        files.delete(where, True)
        if path in _written():
            _written().remove(path)


def _hadoop(spark: SparkSession, path: str):
    where = spark._jvm.org.apache.hadoop.fs.Path(path)
    return where, where.getFileSystem(spark._jsc.hadoopConfiguration())


def mark() -> int:
    """A place in the list of tables that this thread has written, for ``since``."""
    return len(_written())


def since(at: int) -> list[str]:
    """The tables that this thread has written after ``mark`` and not dropped."""
    return _written()[at:]


def tidy(task):
    """For the function of a mapInArrow: when a task ends, what its allocators hold goes back to the system, so that
    a worker that waits for its next task is small."""

    @wraps(task)
    def run(batches):
        try:
            yield from task(batches)
        finally:
            pa.default_memory_pool().release_unused()
            with contextlib.suppress(OSError, AttributeError):
                ctypes.CDLL(None).malloc_trim(0)

    return run
