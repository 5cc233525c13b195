"""Session settings the jobs count on. All can be changed on a running session."""

from __future__ import annotations

from pyspark.sql import SparkSession

SETTINGS = {
    "spark.sql.session.timeZone": "UTC",
    "spark.sql.adaptive.enabled": "true",
    "spark.sql.adaptive.skewJoin.enabled": "true",
    # split a hot partition even where the next step would have reused the join's partitioning
    "spark.sql.adaptive.forceOptimizeSkewedJoin": "true",
    # A task's memory follows its partition, and a row takes many times its shuffled size there (in sorts, hash tables and
    # behind joins that repeat it). So shuffles start with many partitions, and adaptive execution joins them up to a few MB.
    "spark.sql.adaptive.advisoryPartitionSizeInBytes": "8m",
    "spark.sql.caseSensitive": "false",
    "spark.sql.ansi.enabled": "true",
}


PARTITIONS = 400  # that a shuffle starts with at least; each costs every map task some 0.1 ms


def prepare(spark: SparkSession) -> SparkSession:
    for key, value in SETTINGS.items():
        spark.conf.set(key, value)
    asked = int(spark.conf.get("spark.sql.shuffle.partitions"))
    spark.conf.set("spark.sql.adaptive.coalescePartitions.initialPartitionNum", str(max(PARTITIONS, asked)))
    return spark
