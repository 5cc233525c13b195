"""Staged frames and their scope."""

import os

import pytest
from pyspark.sql import functions as F

from millrace.sources.staging import scope, stage, unstage


def files(spark):
    top = spark.conf.get("spark.checkpoint.dir").removeprefix("file:")
    return {os.path.join(d, f) for d, _, found in os.walk(top) for f in found if f.startswith("part-")}


def test_scope_frees_all_but_the_kept_result(spark):
    before = files(spark)
    with scope(spark) as keep:
        one = stage(spark.range(10), "one")
        within = files(spark) - before
        with scope(spark) as keep_inner:
            two = stage(one.withColumn("x", F.col("id") * 2), "two")
            inner = keep_inner(two.where("x > 4"), "inner")
        assert inner.count() == 7 and within < files(spark)
        unstage(one)
        assert not within & files(spark)
        out = keep(inner.groupBy().agg(F.sum("x").alias("s")), "out")
    assert out.first()["s"] == 84
    left = files(spark) - before
    assert left and all("/out-" in f for f in left)
    unstage(out)
    assert files(spark) == before


def test_scope_frees_after_a_failure(spark):
    before, key = files(spark), "spark.sql.classic.shuffleDependency.fileCleanup.enabled"
    setting = spark.conf.get(key, None)
    with pytest.raises(Exception, match="broken"):
        with scope(spark):
            stage(spark.range(5), "gone")
            stage(spark.range(5).select(F.raise_error(F.lit("broken"))), "failed")
    assert files(spark) == before and spark.conf.get(key, None) == setting


def test_a_frame_can_run_twice_inside_a_scope(spark):
    with scope(spark):
        df = spark.range(1000).groupBy((F.col("id") % 7).alias("k")).count()
        assert sorted(df.collect()) == sorted(df.collect()) and df.count() == 7
