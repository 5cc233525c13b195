"""Shortage reports: items missing from orders with the stock known at the time, and the fill-rate alert."""

from __future__ import annotations

from datetime import date, datetime, timedelta

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ..functions.dates import epoch_ms, stamp
from ..functions.jsonx import parse
from ..functions.numbers import alert_status, kept_percent, minus, times
from ..functions.text import ieq, like_any, to_number
from ..operators.aggregates import latest_rows, spread
from ..operators.ordered import asof_join, top1
from ..operators.rows import on_day, union_distinct
from ..sources.staging import stage
from .store_orders import STOCK_STATES, STORE_NAME, job_status_events, order_state_events

# Cancellation reasons that count as a store shortage, staging area and stores left out.
SHORTAGE_REASONS = [
    "%DE Issue%", "%Order Item(s) not available%", "%Stores_VDC | VDC_DE found store closed%",
    "%Stores_VDC | VDC_vendor app issue%", "%Stores_VDC | VDC_OOS%", "%Stores_VDC | Others%",
    "%Stores_VDC| VDC_incorrect OOS%", "%Delivery Executive crowding at store%",
    "%Unable to service online orders%", "%Closing my store%", "%Customer rush at store%",
    "%Stores_VDC | VDC_incorrect store location%", "%Stores_VDC | VDC_bill difference%",
]
INWARD_AREA = "#inwarding_area"
UNMARKED_STORES = ["3141", "517194"]
FILL_RATE_LIMIT = 99.3

ITEMS = "array<struct<skuId:string,quantity:int>>"
CHANGE = f"struct<oldItems:{ITEMS},newItems:{ITEMS}>"
BILL = "struct<deliveryType:string,bill:struct<billedItems:array<struct<item:struct<itemId:string,quantity:int>>>>>"


def store_details(store: DataFrame, area: DataFrame, city: DataFrame) -> DataFrame:
    named = store.filter(ieq(F.col("name"), STORE_NAME))
    return (named.select(F.col("id").alias("store_id"), "area_id", F.lower("name").alias("store_name"))
            .join(area.select(F.col("id").alias("area_id"), F.col("name").alias("area"), "city_id"), "area_id", "left")
            .join(city.select(F.col("id").alias("city_id"), F.col("name").alias("city")), "city_id", "left")
            .select("store_id", "area", "city", "store_name").distinct())


def combo_parts(combo_sku: DataFrame, stores: DataFrame) -> DataFrame:
    """Constituents of each combo sold by a listed store; a combo of several is ``hetero``."""
    counted = spread(combo_sku, ["store_id", "combo_sku"], {"no_items": F.count("const_sku")})
    return (counted.join(stores.select("store_id"), "store_id", "left_semi")
            .select("combo_spin", F.col("const_sku").alias("const_sku_id"), "store_id", F.col("combo_sku").alias("combo_sku_id"),
                    F.when(F.col("no_items") > 1, "hetero").otherwise("homo").alias("combo_type"), "const_qty"))


def _changed(old: DataFrame, new: DataFrame, keys: list[str]) -> DataFrame:
    """Old item rows for which some new row of the same SKU differs, or which have no new row and are not zero.

    New quantities shrink to their extremes per SKU, so old and new rows never pair up.
    """
    extremes = new.groupBy(*keys).agg(F.min("new_qty").alias("least"), F.max("new_qty").alias("most"))
    joined = old.join(extremes, keys, "left")
    differs = (F.col("ordered_qty") != F.coalesce("least", F.lit(0))) | (F.col("ordered_qty") != F.coalesce("most", F.lit(0)))
    return joined.filter(differs).drop("least", "most")


def _items(rows: DataFrame, side: str, qty: str, keep: list[str]) -> DataFrame:
    value = F.col("_i.quantity")
    return (rows.select(*keep, F.explode(F.col(f"doc.{side}")).alias("_i"))
            .select(*keep, F.col("_i.skuId").alias("sku_id"), (F.coalesce(value, F.lit(0)) if side == "newItems" else value).alias(qty)))


def stock_levels(closing_stock: DataFrame, current_stock: DataFrame, as_of: date) -> DataFrame:
    """Sellable units per SKU and time: the closing stock two days back and the updates since."""
    opening = as_of - timedelta(days=2)
    closing = (closing_stock.filter((F.col("insert_date") == F.lit(opening)) & (F.col("loc") != INWARD_AREA))
               .groupBy("sku").agg(F.sum("sellable").alias("sellable_units"), F.max("update_time").alias("update_time")))
    current = (current_stock
               .select("sku", minus(F.col("sellable"), F.col("ordered")).alias("sellable_units"),
                       epoch_ms(F.col("sellable_updated")).alias("update_time"))
               .filter(F.to_date("update_time").between(F.lit(opening), F.lit(as_of))))
    kinds = {"sellable_units": "bigint", "update_time": "timestamp"}
    typed = lambda df: df.withColumns({c: F.col(c).cast(t) for c, t in kinds.items()})
    return union_distinct(typed(closing), typed(current))


def stock_events(job_logs: DataFrame, as_of: date) -> DataFrame:
    """The day's job events in the states of interest, status in lower case. Its result may be given as ``job_logs`` again."""
    return job_status_events(job_logs, as_of, STOCK_STATES, ("dt", "store_id", "update_time", "update_json"))


def shortage_rows(order_states: DataFrame, job_logs: DataFrame, stores: DataFrame, as_of: date) -> tuple[DataFrame, DataFrame]:
    """(short items of delivered and of cancelled orders, placed orders with their first time).

    Job events and picked orders are staged: the logs are scanned once and the item changes parsed once, for old and new.
    """
    in_store = stores.select("store_id")
    jobs = stage(stock_events(job_logs, as_of).withColumnRenamed("job_id", "orderjobid"), "job_events")
    placed = (jobs.filter(F.col("status") == "placed").join(in_store, "store_id", "left_semi")
              .groupBy("dt", "store_id", "orderjobid", "status").agg(F.min("update_time").alias("ordered_time")))
    known = placed.select("orderjobid")
    delivered = jobs.filter(F.col("status") == "delivery_delivered").join(known, "orderjobid", "left_semi").select("orderjobid")

    picked = (order_state_events(order_states, as_of).filter(F.col("state") == "picked")
              .withColumnRenamed("storeid", "store_id").join(in_store, "store_id", "left_semi")
              .withColumns({
                  "doc": parse(F.col("metadata"), CHANGE, strict=True),
                  "vdc_ftr_time": epoch_ms(F.col("time_stamp")),
                  "delivery_type": F.when(F.col("slotted") == "TRUE", "SLOTTED").otherwise("INSTANT"),
              })
              .join(delivered, "orderjobid", "left_semi"))
    keep = ["dt", "store_id", "orderjobid", "delivery_type", "vdc_ftr_time"]
    picked = stage(picked.select(*keep, "doc"), "picked")
    short = (_changed(_items(picked, "oldItems", "ordered_qty", keep), _items(picked, "newItems", "new_qty", ["orderjobid"]),
                      ["orderjobid", "sku_id"])
             .select("dt", "store_id", "orderjobid", "sku_id", "ordered_qty", "delivery_type", "vdc_ftr_time",
                     F.lit("FTR").alias("reason"), F.lit("FTR").alias("vdc_ftr_flag")))

    outer = parse(F.col("update_json"), "struct<status_meta:string,metadata:string>", strict=True)
    cancelled = (jobs.filter(F.col("status") == "cancelled").withColumn("u", outer)
                 .withColumns({"reason": parse(F.col("u.status_meta"), "struct<reason:string>", strict=True)["reason"],
                               "m": parse(F.col("u.metadata"), BILL, strict=True)})
                 .filter(like_any(F.col("reason"), SHORTAGE_REASONS))
                 .join(known, "orderjobid", "left_semi")
                 .select("dt", "store_id", "orderjobid", "update_time", "reason", F.col("m.deliveryType").alias("delivery_type"),
                         F.explode("m.bill.billedItems").alias("b"))
                 .groupBy("dt", "store_id", "orderjobid", F.col("b.item.itemId").alias("sku_id"),
                          F.col("b.item.quantity").alias("ordered_qty"), "reason", "delivery_type")
                 .agg(F.min("update_time").cast("timestamp").alias("vdc_ftr_time"))
                 .withColumn("vdc_ftr_flag", F.lit("VDC")))
    return union_distinct(short, cancelled), placed


def shortage_detail(order_states: DataFrame, job_logs: DataFrame, store: DataFrame, area: DataFrame, city: DataFrame,
                    combo_sku: DataFrame, closing_stock: DataFrame, current_stock: DataFrame, items: DataFrame,
                    as_of: date) -> DataFrame:
    """Order x SKU x combo with the stock last known before the order and before the event.

    A repeated (order, SKU, combo) keeps one row: the one with the newest stock, then the largest quantity.
    The short items and the stock levels are staged: they are small next to the event tables they come from,
    and each as-of join reads its sides twice.
    """
    stores = store_details(store, area, city)
    short, placed = shortage_rows(order_states, job_logs, stores, as_of)
    # stores repeat the same combo; one row per combo and constituent is enough, since one row per order survives anyway
    parts = (combo_parts(combo_sku, stores).groupBy("combo_sku_id", "const_sku_id")
             .agg(F.max("const_qty").alias("const_qty")))
    rows = (short.withColumnRenamed("sku_id", "temp_sku")
            .join(parts, F.col("temp_sku") == F.col("combo_sku_id"), "left")
            .select("dt", "store_id", "orderjobid", F.coalesce("const_sku_id", "temp_sku").alias("sku_id"),
                    F.when(F.col("const_sku_id").isNotNull(), F.col("temp_sku")).alias("combo_sku_id"),
                    "ordered_qty", "const_qty", times(F.col("ordered_qty"), F.col("const_qty")).alias("final_ordered_qty"),
                    "delivery_type", "vdc_ftr_time", "reason", "vdc_ftr_flag")
            .join(placed.select("orderjobid", F.col("ordered_time").cast("timestamp").alias("ordered_time")), "orderjobid", "left"))
    stock = stage(stock_levels(closing_stock, current_stock, as_of), "stock")
    at_order = asof_join(stage(rows, "short_items"), stock, {"sku_id": "sku"}, "ordered_time", "update_time",
                         {"update_time": "inv_ordered_time", "sellable_units": "order_time_qty"})
    single = top1(at_order, ["orderjobid", "sku_id", "combo_sku_id"],
                  [F.col("inv_ordered_time").desc_nulls_first()] + [F.col(c).desc_nulls_last() for c in
                   ("ordered_qty", "const_qty", "vdc_ftr_time", "ordered_time", "delivery_type", "reason", "vdc_ftr_flag", "store_id", "dt")])
    at_event = asof_join(stage(single, "short_items"), stock, {"sku_id": "sku"}, "vdc_ftr_time", "update_time",
                         {"update_time": "inv_vdc_ftr_time", "sellable_units": "vdc_ftr_time_qty"})
    named = items.select("sku_id", "item_code", "item_name")
    return (at_event.join(named, "sku_id", "left").join(stores.drop("store_name"), "store_id", "left")
            .select(F.to_date("ordered_time").alias("order_dt"), "store_id", "area", "city", "orderjobid", "sku_id", "combo_sku_id",
                    "item_code", "item_name", "ordered_qty", "const_qty", "final_ordered_qty", "delivery_type", "reason",
                    "vdc_ftr_flag", "ordered_time", "vdc_ftr_time", "inv_ordered_time", "order_time_qty", "inv_vdc_ftr_time",
                    "vdc_ftr_time_qty"))


def fill_rate_alert(picked_states: DataFrame, job_logs: DataFrame, items: DataFrame, mim_stores: DataFrame,
                    outlets: DataFrame, as_of: date, now: datetime) -> DataFrame:
    """Store x marked-store flag: delivered orders, orders with a changed item, percent unchanged, alert.

    Orders shrink to counts per store before the marked-store dates fan them out.
    """
    known = items.select(F.col("store_id").cast("decimal(38,0)").alias("_store"))
    picked = (on_day(picked_states, "dt", as_of).filter(F.col("state") == "PICKED")
              .withColumn("_store", to_number(F.col("storeid"))).join(known, "_store", "left_semi")
              .select("orderjobid", parse(F.col("metadata"), CHANGE, strict=True).alias("doc")))
    picked = stage(picked, "picked")  # parsed once, read for old and new items
    old = _items(picked, "oldItems", "ordered_qty", ["orderjobid"])
    changed = _changed(old, _items(picked, "newItems", "new_qty", ["orderjobid"]), ["orderjobid", "sku_id"])
    short = changed.select("orderjobid").distinct().withColumn("ftr_flag", F.lit(1))

    logs = (on_day(job_logs, "dt", as_of).filter(F.col("status").isin("PLACED", "DELIVERY_DELIVERED"))
            .join(items.select(F.col("store_id").cast("string").alias("store_id")), "store_id", "left_semi")
            .select("dt", "store_id", F.col("job_id").alias("orderjobid"), "status", "update_time"))
    first = top1(logs, ["orderjobid", "status"], [F.col("update_time").asc_nulls_last(), F.col("store_id")])
    delivered = first.filter(F.col("status") == "DELIVERY_DELIVERED").select("orderjobid")
    orders = (first.filter(F.col("status") == "PLACED").join(delivered, "orderjobid", "left_semi")
              .join(short, "orderjobid", "left"))
    per_store = orders.groupBy("dt", "store_id").agg(
        F.count("*").alias("order_count"), F.count("ftr_flag").alias("ftr_count"))
    marked = (mim_stores.select(F.col("store_id").cast("string").alias("store_id"), F.col("date").alias("mim_date"))
              .filter(~F.col("store_id").isin(UNMARKED_STORES)).distinct())
    final = (per_store.join(marked, "store_id", "left")
             .withColumn("mim_store_identifier", F.when(F.col("dt") >= F.col("mim_date"), 1).otherwise(0))
             .groupBy("dt", "store_id", "mim_store_identifier")
             .agg(F.sum("order_count").alias("order_count"), F.sum("ftr_count").alias("ftr_count"))
             .withColumn("ftr_percent", kept_percent(F.col("order_count"), F.col("ftr_count"))))
    names = latest_rows(outlets.withColumn("store_id", F.col("store_id").cast("string")), ["store_id"], "date",
                        ["store_id", "city", "outlet_name"])
    return (final.withColumns({"alert_status": alert_status([F.col("ftr_percent") < FILL_RATE_LIMIT]), "updated_time": stamp(now)})
            .join(names, "store_id", "left")
            .select("store_id", "mim_store_identifier", "ftr_count", "order_count", "ftr_percent", "alert_status", "city",
                    F.col("outlet_name").alias("store_name"), "updated_time"))
