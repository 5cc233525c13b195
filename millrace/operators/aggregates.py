"""Grouped results. All of these combine map-side, so a hot key reaches its reducer as few partial rows."""

from __future__ import annotations

from collections.abc import Callable, Sequence
from functools import reduce
from operator import and_

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F


def pivot_agg(df: DataFrame, keys: Sequence[str],
              outputs: dict[str, tuple[Column, Column, Callable[[Column], Column]]]) -> DataFrame:
    """One pass conditional pivot: ``{out: (predicate, value, aggregate)}``."""
    return df.groupBy(*keys).agg(*[fn(F.when(test, value)).alias(out) for out, (test, value, fn) in outputs.items()])


def spread(df: DataFrame, keys: Sequence[str], aggs: dict[str, Column]) -> DataFrame:
    """Every row plus group-level aggregates of its key (an unordered window, NULL keys grouped).

    Aggregate then join back, rather than a window: the window would gather a hot key's rows in one
    task, while here they only meet a one-row-per-key table and AQE can split the hot partition.
    """
    renamed = {k: f"_spread_{i}" for i, k in enumerate(keys)}
    stats = (df.groupBy(*[F.col(k).alias(r) for k, r in renamed.items()])
             .agg(*[a.alias(n) for n, a in aggs.items()]))
    same = reduce(and_, [F.col(k).eqNullSafe(F.col(r)) for k, r in renamed.items()])
    return df.join(stats, same, "left").drop(*renamed.values())


def latest_by(df: DataFrame, key: str, order: str) -> DataFrame:
    """Latest ``order`` value per key, as ``(key, order)`` rows."""
    return df.groupBy(key).agg(F.max(order).alias(order))


def latest_rows(df: DataFrame, keys: Sequence[str], order: str, cols: Sequence[str]) -> DataFrame:
    """Distinct ``cols`` of all rows that come first in their key by ``order`` descending.

    A NULL order comes before every value, as descending order has it in the source dialect: a key with
    undated rows gives those.
    """
    best = df.groupBy(*keys).agg(F.max(order).alias("_newest"), F.bool_or(F.col(order).isNull()).alias("_undated"))
    first = F.when(F.col("_undated"), F.col(order).isNull()).otherwise(F.col(order) == F.col("_newest"))
    return df.join(best, [*keys]).where(first).select(*cols).distinct()
