"""Shared by the test-table queries: table access and text forms that Spark and the SQL check agree on."""

from __future__ import annotations

import functools
from collections.abc import Callable, Sequence

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from ..session import prepare
from ..sources.staging import fresh_path, scope
from ..sources.tables import parquet

Build = Callable[[SparkSession, str], DataFrame]
_written: dict[tuple[str, str, str], str] = {}


def job_input(build: Build | None = None, *, by: Sequence[str] = (), dealt: bool = False) -> Build:
    """A job's input table, derived from the test tables: written on first use in a session, then read.

    The jobs read tables, so their inputs are tables here too. As expressions over the test tables they
    would be inlined into every filter and evaluated again by every branch of a plan. ``by`` lays them out by day, as
    event tables are, so that a job reads the folders of its days. The rows are dealt out for that; ``dealt`` tells that the
    build has done so itself, before it made them wide.
    """
    if build is None:
        return functools.partial(job_input, by=by, dealt=dealt)

    @functools.wraps(build)
    def read(spark: SparkSession, folder: str) -> DataFrame:
        key = (spark.sparkContext.applicationId, folder, f"{build.__module__}.{build.__name__}")
        if key not in _written:
            path = fresh_path(spark, build.__name__)
            # several files, as a job's inputs are; a test table is a single one
            with scope(spark):
                rows = build(spark, folder)
                (rows if dealt else rows.repartition(spark.sparkContext.defaultParallelism)).write.partitionBy(*by).parquet(path)
            _written[key] = path
        return spark.read.parquet(_written[key])

    return read


def load(spark: SparkSession, folder: str, name: str) -> DataFrame:
    return parquet(prepare(spark), folder, name)


def day_text(col: str | Column) -> Column:
    return F.date_format(col, "yyyy-MM-dd")


def time_text(col: str | Column) -> Column:
    return F.date_format(col, "yyyy-MM-dd HH:mm:ss.SSS")


def text(col: str | Column) -> Column:
    return (F.col(col) if isinstance(col, str) else col).cast("string")


def rounded(df: DataFrame, *cols: str, scale: int = 4) -> DataFrame:
    return df.withColumns({c: F.round(c, scale) for c in cols})
