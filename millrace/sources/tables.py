"""Scans."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F


def table(spark: SparkSession, name: str) -> DataFrame:
    """Catalog table by one-, two- or three-part name; parts may start with a digit."""
    return spark.read.table(".".join(f"`{part.strip('`')}`" for part in name.split(".")))


def parquet(spark: SparkSession, folder: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{folder}/{name}.parquet")


def read_csv(spark: SparkSession, path: str, schema: str, multi_line: bool = False) -> DataFrame:
    """CSV with a header line and a declared schema (no inference pass).

    A quote inside a quoted field is doubled, as in JSON fields. Fields that hold line breaks need
    ``multi_line``; a file is then one task.
    """
    return (spark.read.schema(schema).option("header", True).option("escape", '"')
            .option("multiLine", multi_line).csv(path))


def read_in_order(spark: SparkSession, path: str, position: str) -> DataFrame:
    """A target that was written in order (``ordered_refresh``), with each row's place in it, from 1, as a column.

    A scan deals files to tasks by size, so the order must travel as a value: a row's number in its file, behind the rows of
    the files with lesser names. The first pass reads no data column, and the keyless window sees one row per file.
    """
    rows = spark.read.parquet(path).select("*", F.col("_metadata.file_name").alias("_file"), F.col("_metadata.row_index").alias("_row"))
    before = Window.orderBy("_file").rowsBetween(Window.unboundedPreceding, -1)
    offsets = (rows.groupBy("_file").agg(F.count("*").alias("_rows"))
               .select("_file", F.coalesce(F.sum("_rows").over(before), F.lit(0)).alias("_offset")))
    return (rows.join(offsets, "_file").withColumn(position, F.col("_offset") + F.col("_row") + 1)
            .drop("_file", "_row", "_offset"))


def lookup(spark: SparkSession, rows: Sequence[tuple], schema: str) -> DataFrame:
    """Inline code list. Its rows are written in the program, so broadcasting it is always safe."""
    return F.broadcast(spark.createDataFrame(list(rows), schema))
