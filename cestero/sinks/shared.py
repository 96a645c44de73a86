"""Tables kept for the length of a job, in a folder all executors can reach."""

from __future__ import annotations

import atexit
import tempfile
import uuid
from collections.abc import Callable, Iterator
from contextlib import contextmanager

from pyspark.sql import DataFrame, SparkSession


def shared_folder(spark: SparkSession) -> str:
    """A new folder name below the session's checkpoint folder.

    That is ``spark.checkpoint.dir``, or what ``setCheckpointDir`` was given; on
    a cluster it has to be one that all executors share, which a path alone does
    not show (a mounted one is ``file:`` too). Only a local session without any
    gets a temporary folder.
    """
    base = spark.conf.get("spark.checkpoint.dir", None)
    if not base:
        context = spark.sparkContext._jsc.sc().getCheckpointDir()
        base = context.get() if context.isDefined() else None
    if not base:
        if not spark.sparkContext.master.startswith("local"):
            raise ValueError("set spark.checkpoint.dir to a folder that all executors share")
        base = tempfile.mkdtemp(prefix="cestero-")
    return f"{base.rstrip('/')}/cestero-{uuid.uuid4().hex}"


def remove_folder(spark: SparkSession, folder: str) -> None:
    path = spark._jvm.org.apache.hadoop.fs.Path(folder)
    path.getFileSystem(spark._jsc.hadoopConfiguration()).delete(path, True)


def path_exists(spark: SparkSession, path: str) -> bool:
    found = spark._jvm.org.apache.hadoop.fs.Path(path)
    return found.getFileSystem(spark._jsc.hadoopConfiguration()).exists(found)


def passing_folder(spark: SparkSession) -> str:
    """A ``shared_folder`` that is removed when this process ends, if its session still runs.

    For what lazy results go on reading, so that no block can close around it.
    """
    folder = shared_folder(spark)

    def remove() -> None:
        if not spark._jsc.sc().isStopped():
            remove_folder(spark, folder)

    atexit.register(remove)
    return folder


def passing_table(spark: SparkSession) -> tuple[str, str]:
    """Name and path of a new table of the catalog; both go when this process ends."""
    name, path = f"cestero_{uuid.uuid4().hex}", passing_folder(spark)

    def drop() -> None:
        if not spark._jsc.sc().isStopped():
            spark.sql(f"DROP TABLE IF EXISTS {name}")

    atexit.register(drop)
    return name, path


def stage_table(df: DataFrame, path: str | None = None) -> DataFrame:
    """Write ``df`` once as Parquet and go on from what was written.

    Unlike a cache this does not compete for memory, survives the loss of
    executors, and lets later steps read single columns.
    """
    path = path or passing_folder(df.sparkSession)
    df.write.parquet(path)
    return df.sparkSession.read.schema(df.schema).parquet(path)


@contextmanager
def staging(spark: SparkSession) -> Iterator[Callable[[DataFrame], DataFrame]]:
    """``stage_table`` for tables that are removed at the end of the block."""
    folder = shared_folder(spark)
    try:
        yield lambda df: stage_table(df, f"{folder}/{uuid.uuid4().hex}")
    finally:
        remove_folder(spark, folder)
