"""Dates, epochs and elapsed time. Jobs take ``as_of`` explicitly; nothing here reads the clock."""

from __future__ import annotations

from dataclasses import dataclass
from datetime import date, datetime, timedelta

from pyspark.sql import Column
from pyspark.sql import functions as F


@dataclass(frozen=True)
class RunWindow:
    """Closed date interval a run recomputes; both ends are included."""

    start: date
    end: date

    def __post_init__(self) -> None:
        if self.start > self.end:
            raise ValueError(f"window starts after it ends: {self.start} > {self.end}")

    @classmethod
    def ending(cls, as_of: date, days_back: int, end_back: int = 0) -> "RunWindow":
        return cls(as_of - timedelta(days=days_back), as_of - timedelta(days=end_back))

    @classmethod
    def day(cls, as_of: date) -> "RunWindow":
        return cls(as_of, as_of)


def epoch_ms(col: Column, precision: str = "exact") -> Column:
    """Epoch milliseconds to timestamp.

    The source jobs use three readings of the sub-second part: keep it (``exact``), round to the
    nearest second, half up (``round``), or cut it off (``floor``).
    """
    ms = col.cast("bigint")
    if precision == "exact":
        return F.timestamp_millis(ms)
    if precision == "round":
        return F.timestamp_seconds(F.floor((ms + 500) / 1000))
    if precision == "floor":
        return F.timestamp_seconds(F.floor(ms / 1000))
    raise ValueError(f"unknown precision {precision!r}")


def instant(col: Column) -> Column:
    """Text or number to timestamp. Whole numbers, also as text, count seconds, milliseconds, microseconds or
    nanoseconds since the epoch by their size, as in the source dialect; other text is read as a timestamp.
    """
    written = F.trim(col.cast("string"))
    number = F.when(written.rlike("^-?[0-9]{1,19}$"), written).try_cast("bigint")
    size = F.abs(number)
    return (F.when(size < 31_536_000_000, F.timestamp_seconds(number))
            .when(size < 31_536_000_000_000, F.timestamp_millis(number))
            .when(size < 31_536_000_000_000_000, F.timestamp_micros(number))
            .when(number.isNotNull(), F.timestamp_micros(F.floor(number / 1000)))
            .otherwise(F.try_to_timestamp(written)))


def seconds_between(start: Column, end: Column) -> Column:
    """Second boundaries crossed from start to end (not whole elapsed seconds)."""
    return F.unix_timestamp(end) - F.unix_timestamp(start)


def minutes_between(start: Column, end: Column) -> Column:
    return seconds_between(start, end) / F.lit(60.0)


def day_of_week(day: Column) -> Column:
    """0 = Sunday .. 6 = Saturday."""
    return F.dayofweek(day) - 1


def day_type(day: Column) -> Column:
    return F.when(F.dayofweek(day).isin(1, 7), "weekend").otherwise("weekday")


def age_years(born: Column, as_of: date) -> Column:
    """Whole years; a 29 February birthday counts on the last day of February in common years."""
    return F.floor(F.months_between(F.lit(as_of), born) / 12)


def opening_hour(clock: Column) -> Column:
    return F.split_part(clock, F.lit(":"), F.lit(1)).cast("int")


def closing_hour(clock: Column) -> Column:
    """Last open hour of an ``HH:MM:SS`` closing time; closing exactly on the hour gives the hour before."""
    part = lambda n: F.split_part(clock, F.lit(":"), F.lit(n)).cast("int")
    on_the_hour = (part(2) == 0) & (part(3) == 0)
    return F.when(on_the_hour, part(1) - 1).otherwise(part(1))


def text_date(col: Column, missing: date) -> Column:
    """Date text (yyyy-MM-dd): missing or the text NULL gives ``missing``, unreadable gives NULL."""
    absent = col.isNull() | (col == "NULL")
    return F.when(absent, F.lit(missing)).otherwise(F.try_to_date(col, "yyyy-MM-dd"))


def effective(eff: Column, term: Column, as_of: date, strict: bool = True) -> Column:
    """``as_of`` lies in [eff, term]; ``strict`` also asks that the span is longer than zero days."""
    inside = (eff <= F.lit(as_of)) & (term >= F.lit(as_of))
    return inside & (term > eff) if strict else inside


def stamp(as_of_ts: datetime) -> Column:
    return F.lit(as_of_ts).cast("timestamp")
