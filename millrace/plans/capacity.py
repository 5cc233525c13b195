"""Hourly order capacity of each active store."""

from __future__ import annotations

from datetime import date

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ..functions.dates import closing_hour, day_of_week, day_type, opening_hour
from ..functions.text import ieq
from ..operators.joins import grid
from .store_orders import STORE_NAME

NUMBERS = ["capacity", "cooldown", "capacity_mul", "cooldown_mul"]


def store_hour_capacity(hours: DataFrame, stores: DataFrame, business_hours: DataFrame, capacity: DataFrame,
                        as_of: date) -> DataFrame:
    """Store x open hour x capacity type with limits; a slot of the hour overrides the store default.

    The store x hour grid is generated from the opening hours, so only hours that survive ever exist and
    every join is an equi-join.
    """
    today = F.lit(as_of)
    active = (stores.filter(ieq(F.col("store_name"), STORE_NAME) & (F.col("active") == 1))
              .select("city", F.col("store_id").cast("string").alias("storeid")))
    opening = (business_hours.filter(F.col("deleted_time").isNull() & (F.col("day_id") == day_of_week(today)))
               .select(F.col("day_id").cast("string").alias("day_id"), F.col("store_id").cast("string").alias("storeid"),
                       opening_hour(F.col("open_time")).alias("open_hr"), closing_hour(F.col("close_time")).alias("close_hr")))
    base = (grid(active.join(opening, "storeid"), F.col("open_hr"), F.col("close_hr"), "hr")
            .join(hours.select(F.col("hour").alias("hr")), "hr")
            .withColumn("current_day_type", day_type(today)))

    part = lambda n: F.split_part("slot", F.lit("-"), F.lit(n))
    limits = capacity.select(
        F.col("storeid").alias("store_id"), "enabled", "slot", F.col("threshold").alias("capacity"), "cooldown",
        F.col("stressratiothreshold").alias("capacity_mul"), F.col("stressratiocooldown").alias("cooldown_mul"),
        part(1).alias("start_time"), part(3).alias("day_type"))
    whole_day = F.col("start_time").isin("default", "mfr")
    slots = limits.filter(~whole_day & (F.col("day_type") == day_type(today))).select(
        F.col("store_id").alias("storeid"),
        F.split_part("start_time", F.lit(":"), F.lit(1)).try_cast("int").alias("hr"),
        *[F.col(c).alias(f"slot_{c}") for c in NUMBERS])
    defaults = limits.filter(whole_day).select(
        F.when(F.col("slot") == "default", F.col("store_id")).otherwise(F.split_part("store_id", F.lit("_"), F.lit(3))).alias("storeid"),
        "enabled", (F.col("start_time") == "mfr").alias("ready_for_dispatch"), *[F.col(c).alias(f"default_{c}") for c in NUMBERS])

    out = (base.join(slots, ["storeid", "hr"], "left").join(defaults, "storeid", "left")
           .filter((F.col("enabled") == "true") | F.col("enabled").isNull()))
    pick = lambda c: (F.when(F.col("ready_for_dispatch"), F.col(f"default_{c}"))
                      .otherwise(F.coalesce(f"slot_{c}", f"default_{c}")))
    return out.select(
        "city", "storeid", "hr", "day_id", "current_day_type",
        F.when(F.col("ready_for_dispatch"), "RFD").otherwise("Pre-MFR").alias("capacity_type"),
        pick("capacity").alias("threshold"), pick("cooldown").alias("cooldown"),
        pick("capacity_mul").alias("threshold_mul"), pick("cooldown_mul").alias("cooldown_mul"))
