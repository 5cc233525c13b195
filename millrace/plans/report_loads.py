"""Load steps: every report into its target, and one run of the store operations.

Targets are Parquet folders, or catalog tables where the name says table. Each step can be repeated: it leaves the same
target behind, except the aligned append of the sales summary, which adds a batch by design.
"""

from __future__ import annotations

from collections.abc import Sequence
from dataclasses import dataclass, replace
from datetime import date, timedelta

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ..functions.dates import RunWindow
from ..operators.rows import in_window
from ..sources.sinks import append_nonempty, full_refresh, ordered_refresh, replace_window, save_report
from ..sources.staging import stage
from . import item_shortage, player_score, store_orders


@dataclass(frozen=True)
class StoreTables:
    """Event tables of the store reports, each with its load day in ``dt``."""

    order_states: DataFrame
    order_events: DataFrame
    order_confirm: DataFrame
    pigeon_hole: DataFrame
    job_logs: DataFrame
    store_city: DataFrame


DATED = ("order_states", "order_events", "order_confirm", "pigeon_hole", "job_logs")


def staged_day(tables: StoreTables, window: RunWindow, names: Sequence[str] = DATED) -> StoreTables:
    """The window's events of the named tables, written once, by day: the reports of a run read these and not the event
    tables, and those of one day read that day's folder."""
    return replace(tables, **{name: stage(in_window(getattr(tables, name), "dt", window), name, ["dt"]) for name in names})


def load_temperature_flags(day: StoreTables, window: RunWindow, path: str) -> None:
    replace_window(store_orders.temperature_flags(day.order_states, window), path, "dt", window)


def load_state_events(day: StoreTables, as_of: date, path: str) -> None:
    full_refresh(store_orders.order_state_events(day.order_states, as_of), path)


def load_job_status(day: StoreTables, as_of: date, path: str) -> None:
    """The day's job events that the shortage detail looks at; it reads this target in place of the logs."""
    full_refresh(item_shortage.stock_events(day.job_logs, as_of), path)


def load_order_legs(day: StoreTables, temperature: DataFrame, as_of: date, path: str) -> None:
    """Replace the day; the order time legs carry no date of their own."""
    legs = store_orders.order_time_legs(day.order_states, day.order_events, day.order_confirm, day.pigeon_hole, day.store_city,
                                        day.job_logs, temperature, as_of)
    replace_window(legs.withColumn("dt", F.lit(as_of)), path, "dt", RunWindow.day(as_of))


def load_leg_alerts(day: StoreTables, temperature: DataFrame, active: DataFrame, outlets: DataFrame, as_of: date, now, path: str) -> None:
    full_refresh(store_orders.time_leg_alerts(
        day.order_states, day.order_events, day.order_confirm, day.pigeon_hole, day.store_city, day.job_logs, temperature,
        active, outlets, as_of, as_of - timedelta(days=2), now), path)


def load_fill_rate(day: StoreTables, items: DataFrame, marked: DataFrame, outlets: DataFrame, as_of: date, now, path: str) -> None:
    full_refresh(item_shortage.fill_rate_alert(day.order_states, day.job_logs, items, marked, outlets, as_of, now), path)


def load_player_report(report: DataFrame, path: str) -> None:
    """The whole target is refreshed, in rank order."""
    ordered_refresh(report, path, player_score.rank_order())


def load_report(report: DataFrame, path: str) -> None:
    """Capacity and shortage detail: the whole target is refreshed."""
    full_refresh(report, path)


def load_sales_summary(summary: DataFrame, path: str) -> bool:
    """Append to the target by column name; False if there was nothing to add."""
    return append_nonempty(summary, path)


def load_member_report(report: DataFrame, table: str) -> None:
    """Overwrite the catalog table; report columns have names with spaces."""
    save_report(report, table)
