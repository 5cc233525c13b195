"""Where intermediate results live: a folder every executor can reach."""

from __future__ import annotations

import uuid
from collections.abc import Callable, Iterator, Sequence
from contextlib import contextmanager
from contextvars import ContextVar

from pyspark.sql import DataFrame, SparkSession

_CLEANUP = "spark.sql.classic.shuffleDependency.fileCleanup.enabled"
_open: ContextVar[list[str] | None] = ContextVar("open_scope", default=None)


def shared_dir(spark: SparkSession) -> str:
    """The cluster's ``spark.checkpoint.dir``; where it is unset, a folder in the warehouse, which is shared too."""
    given = spark.conf.get("spark.checkpoint.dir", None)
    return (given or f"{spark.conf.get('spark.sql.warehouse.dir')}/_staged").rstrip("/")


def _session_dir(spark: SparkSession) -> str:
    """A folder of this application; Hadoop removes it with all it holds when the application ends."""
    path = f"{shared_dir(spark)}/millrace-{spark.sparkContext.applicationId}"
    make = spark._jvm.org.apache.hadoop.fs.Path(path)
    fs = make.getFileSystem(spark._jsc.hadoopConfiguration())
    fs.mkdirs(make)
    fs.deleteOnExit(make)
    return path


def fresh_path(spark: SparkSession, name: str) -> str:
    return f"{_session_dir(spark)}/{name}-{uuid.uuid4().hex}"


def stage(df: DataFrame, name: str, by: Sequence[str] = ()) -> DataFrame:
    """Write once, read many: for a result that several later steps use. Cuts the lineage too.

    Runs at once, so a plan that stages a step is not lazy up to that step. Inside a ``scope`` the files go with it. With
    ``by`` the files lie in a folder for each value, and later filters on these columns skip folders.
    """
    path = fresh_path(df.sparkSession, name)
    if (made := _open.get()) is not None:
        made.append(path)
    df.write.partitionBy(*by).parquet(path)
    staged = df.sparkSession.read.schema(df.schema).parquet(path)
    return staged.select(*[f"`{c}`" for c in df.columns]) if by else staged


def _delete(spark: SparkSession, path: str) -> None:
    folder = spark._jvm.org.apache.hadoop.fs.Path(path)
    folder.getFileSystem(spark._jsc.hadoopConfiguration()).delete(folder, True)


def unstage(*frames: DataFrame) -> None:
    """Delete the files of staged frames that nothing reads any more."""
    for df in frames:
        for file in df.inputFiles():
            folder = file.rpartition("/")[0]
            while "=" in folder.rpartition("/")[2]:  # laid out by values
                folder = folder.rpartition("/")[0]
            _delete(df.sparkSession, folder)
            break


@contextmanager
def scope(spark: SparkSession) -> Iterator[Callable[[DataFrame, str], DataFrame]]:
    """A job whose staged frames are deleted when it ends, also when it fails.

    Yields a function that stages the job's result so that it outlives the job (but not an outer scope). Inside, Spark
    removes the shuffle files of a query once it has run, instead of when the driver happens to collect its garbage: every
    query here ends in a staged frame or a collected number, and nothing reads its shuffles again.
    """
    outer, made = _open.get(), []
    before = spark.conf.get(_CLEANUP, None)
    token = _open.set(made)

    def keep(df: DataFrame, name: str) -> DataFrame:
        inner = _open.set(outer)
        try:
            return stage(df, name)
        finally:
            _open.reset(inner)

    spark.conf.set(_CLEANUP, "true")
    try:
        yield keep
    finally:
        _open.reset(token)
        if before is None:
            spark.conf.unset(_CLEANUP)
        else:
            spark.conf.set(_CLEANUP, before)
        for path in made:
            _delete(spark, path)
