"""Written intermediate tables.

A table that several later steps read, or that a loop builds up, is written once to the shared folder of the
session and read back. That cuts the lineage, survives lost executors, and gives Spark real file sizes.
"""

from __future__ import annotations

import atexit
import shutil
import tempfile
import uuid
from collections.abc import Iterator
from contextlib import AbstractContextManager, contextmanager
from contextvars import ContextVar

from pyspark.sql import DataFrame, SparkSession

from tillweave.errors import ConfigError

_local_folders: dict[str, str] = {}
_owned: ContextVar[str | None] = ContextVar("owned", default=None)


def scratch_folder(spark: SparkSession) -> str:
    """The session's ``spark.checkpoint.dir``; for local sessions without one, a folder that ends with the process."""
    configured = spark.conf.get("spark.checkpoint.dir", None)
    if configured:
        return configured.rstrip("/")
    if not spark.sparkContext.master.startswith("local") or spark.sparkContext.master.startswith("local-cluster"):
        raise ConfigError("set spark.checkpoint.dir to a folder that all executors share")
    app = spark.sparkContext.applicationId
    if app not in _local_folders:
        _local_folders[app] = tempfile.mkdtemp(prefix="tillweave-")
        atexit.register(shutil.rmtree, _local_folders[app], ignore_errors=True)
    return _local_folders[app]


def scratch_path(spark: SparkSession, label: str) -> str:
    """A new path in the shared folder."""
    return f"{_owned.get() or scratch_folder(spark)}/{label}-{uuid.uuid4().hex}"


@contextmanager
def owned_scratch(spark: SparkSession) -> Iterator[str]:
    """What is staged inside belongs to one run and is deleted when the run ends, well or not."""
    folder = f"{scratch_folder(spark)}/run-{uuid.uuid4().hex}"
    token = _owned.set(folder)
    try:
        yield folder
    finally:
        _owned.reset(token)
        path = spark._jvm.org.apache.hadoop.fs.Path(folder)
        path.getFileSystem(spark._jsc.hadoopConfiguration()).delete(path, True)


_LIMIT = "spark.sql.codegen.hugeMethodLimit"
_ARROW = "spark.sql.execution.arrow.maxBytesPerBatch"
_CLEANUP = "spark.sql.classic.shuffleDependency.fileCleanup.enabled"
_ALL_KEYS = "spark.sql.requireAllClusterKeysForCoPartition"


@contextmanager
def _setting(spark: SparkSession, name: str, value: str) -> Iterator[None]:
    before = spark.conf.get(name, None)
    if before == value:  # set around several writes, which may run side by side
        yield
        return
    spark.conf.set(name, value)
    try:
        yield
    finally:
        if before is None:
            spark.conf.unset(name)
        else:
            spark.conf.set(name, before)


def compiled(spark: SparkSession) -> AbstractContextManager[None]:
    """For writes inside: wide projections run as several small generated methods.

    The JVM compiles no method of more than 8,000 bytes. Spark's own limit is 65,535, so that the projections of report
    rows make one method that is interpreted for every row.
    """
    return _setting(spark, _LIMIT, "8000")


def small_batches(spark: SparkSession, most: int) -> AbstractContextManager[None]:
    """For writes inside: tasks get Arrow batches of about ``most`` bytes, or one row.

    A batch is otherwise bounded by 10,000 rows, or 64 MB: with rows of some KB the whole input of a task, which the JVM
    and the worker both hold.
    """
    return _setting(spark, _ARROW, str(most))


def tidy(spark: SparkSession) -> AbstractContextManager[None]:
    """For writes inside: their shuffle files are deleted when they end, not when the driver's collector comes to them."""
    return _setting(spark, _CLEANUP, "true")


def as_laid(spark: SparkSession) -> AbstractContextManager[None]:
    """For writes inside: a side that lies by some of the join's keys stays as it lies, and the other is dealt out alike.

    Only for joins whose sides hold few rows of those keys, because a task gets all of them.
    """
    return _setting(spark, _ALL_KEYS, "false")


def stage(df: DataFrame, label: str, path: str | None = None) -> DataFrame:
    """Write ``df`` to the shared folder and return the written table.

    ``path`` is a path that ``scratch_path`` gave before, for a table that outlives the ``owned_scratch`` it is made in.
    Shuffle files of the write go when it ends: nothing reads them again.
    """
    path = path or scratch_path(df.sparkSession, label)
    with compiled(df.sparkSession), tidy(df.sparkSession):
        df.write.parquet(path)
    return df.sparkSession.read.schema(df.schema).parquet(path)
