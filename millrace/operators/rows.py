"""Row filters and projections."""

from __future__ import annotations

from datetime import date

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ..functions.dates import RunWindow, effective


def in_window(df: DataFrame, col: str, window: RunWindow) -> DataFrame:
    """Closed interval on dates. A timestamp column compares with midnight, so the rest of the last day is out."""
    return df.filter(F.col(col).between(F.lit(window.start), F.lit(window.end)))


def on_day(df: DataFrame, col: str, day: date) -> DataFrame:
    return df.filter(F.col(col) == F.lit(day))


def on_days(df: DataFrame, col: str, days: DataFrame, day: str) -> DataFrame:
    """Rows whose date occurs in ``days``, a calendar that is only known at run time.

    Where ``df`` is laid out by ``col`` and ``days`` is filtered and small enough to be broadcast, Spark prunes the
    folders by the calendar's result before the scan; else it is a plain semi join with the same rows.
    """
    return df.join(days.select(F.col(day).alias(col)), col, "left_semi").select(*df.columns)


def effective_at(df: DataFrame, eff: str, term: str, as_of: date, strict: bool = True) -> DataFrame:
    return df.filter(effective(F.col(eff), F.col(term), as_of, strict))


def with_defaults(df: DataFrame, defaults: dict[str, tuple[object, str]]) -> DataFrame:
    """Add typed placeholder columns: ``{name: (value or None, type)}``."""
    return df.withColumns({n: F.lit(v).cast(t) for n, (v, t) in defaults.items()})


def union_distinct(first: DataFrame, *others: DataFrame) -> DataFrame:
    out = first
    for other in others:
        out = out.unionByName(other)
    return out.distinct()
