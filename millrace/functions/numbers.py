"""Arithmetic with defaults, sentinel values, match flags and threshold alerts."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column
from pyspark.sql import functions as F

from .text import first_match


def number_of(col: Column) -> Column:
    """Text to double; missing or unreadable text counts as zero."""
    return F.coalesce(F.trim(col).try_cast("double"), F.lit(0.0))


def sum_text(col: Column) -> Column:
    return F.sum(number_of(col))


def minus(a: Column, b: Column) -> Column:
    return a - F.coalesce(b, F.lit(0))


def times(a: Column, b: Column) -> Column:
    return a * F.coalesce(b, F.lit(1))


def kept_percent(total: Column, lost: Column, scale: int = 4) -> Column:
    """(total - lost) * 100 / total, rounded; zero when the total is zero or NULL."""
    kept = (total - F.coalesce(lost, F.lit(0))) * F.lit(100.0)
    return F.coalesce(F.round(F.try_divide(kept, total), scale), F.lit(0.0))


def if_matched(flag: Column, value: Column, default: object = "NA") -> Column:
    """``value`` (even NULL) for a row that found its partner, else ``default``."""
    return F.when(flag.isNotNull(), value).otherwise(F.lit(default))


def unsentinel(col: Column, sentinel: str, kind: str = "date") -> Column:
    """Placeholder back to NULL."""
    return F.nullif(col.cast(kind), F.lit(sentinel).cast(kind))


def alert_status(breached: Sequence[Column]) -> Column:
    any_breach = breached[0]
    for b in breached[1:]:
        any_breach = any_breach | b
    return F.when(any_breach, "alert").otherwise("no_alert")


def alert_reason(rules: Sequence[tuple[Column, str]]) -> Column:
    return first_match([(test, F.lit(reason)) for test, reason in rules])
