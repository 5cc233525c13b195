"""Store order reports: state staging, temperature flag, time legs and the time-leg alert."""

from __future__ import annotations

from datetime import date, datetime

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from ..functions.dates import RunWindow, epoch_ms, instant, minutes_between, stamp
from ..functions.jsonx import parse
from ..functions.numbers import alert_reason, alert_status
from ..functions.text import ieq, unquoted
from ..operators.aggregates import latest_rows, pivot_agg
from ..operators.nested import flatten
from ..operators.ordered import last_event, top1
from ..operators.rows import in_window, on_day, with_defaults

# States and kinds the reports look at.
ORDER_STATES = ["picking", "picked", "delivery_ready", "cancelled", "assigned", "un_assigned"]
RIDER_STATES = ["delivery_pickedup", "delivery_arrived"]
STOCK_STATES = ["delivery_pickedup", "delivery_arrived", "placed", "delivery_delivered", "cancelled"]
JOB_TYPES = ["BUY", "CUSTOM", "instacart"]
CONFIRM_TYPES = ["BUY", "CUSTOM", "instacart", "HANDPICKED"]
PIGEON_HOLE = "place-order-in -pigeon-hole"
STORE_NAME = "instacart"
OPEN_CLAIMS = [
    "igcc_flag", "missing_item_igcc", "wrong_item_igcc", "packaging_igcc",
    "quality_fnv_igcc", "quality_nonfnv_igcc", "wrong_order_igcc", "missing_order_igcc",
]
O2C_LIMIT, P2B_LIMIT, C2P_LIMIT = 0.5, 0.5, 1.8

ITEMS = "array<struct<skuId:string,quantity:double>>"


def order_state_events(order_states: DataFrame, as_of: date) -> DataFrame:
    """Today's events in the states of interest, state in lower case."""
    rows = on_day(order_states, "dt", as_of).withColumn("state", F.lower("state"))
    return rows.filter(F.col("state").isin(ORDER_STATES)).select(
        "orderjobid", "slotted", "timestamp", "state", "dt", "storeid", "metadata", "time_stamp")


def job_status_events(job_logs: DataFrame, as_of: date, states: list[str] = RIDER_STATES,
                      extra: tuple[str, ...] = ()) -> DataFrame:
    rows = on_day(job_logs, "dt", as_of).withColumn("status", F.lower("status"))
    return rows.filter(F.col("status").isin(states)).select("job_id", "time_stamp", "status", *extra)


def temperature_flags(order_states: DataFrame, window: RunWindow) -> DataFrame:
    """Order and day with ``true`` if any item of the order in the window is perishable, else ``false``.

    Rows are distinct per hour but the hour is not in the output, so an order may repeat. After the
    distinct an order has a bounded number of rows, so the window over it stays small.
    """
    items = flatten(in_window(order_states, "dt", window), "itemdetails", "struct<perishable:string>", "item")
    seen = items.select("dt", F.col("item.perishable").alias("temp_sens"), "orderjobid",
                        F.hour(epoch_ms(F.col("timestamp"))).alias("order_hour")).distinct()
    warm = F.max(F.col("temp_sens") == "true").over(Window.partitionBy("orderjobid"))
    return (seen.filter(F.col("temp_sens").isin("true", "false")).withColumn("_any", warm)
            .filter((F.col("temp_sens") == "true") | ~F.col("_any"))
            .select("dt", "temp_sens", "orderjobid"))


def reduced_quantities(order_states: DataFrame, as_of: date) -> DataFrame:
    """Per order, units taken off at its first PICKED event, over the SKUs whose quantity went down.

    Old and new items go into one list with signed roles, so both sums come from one aggregation.
    """
    picked = on_day(order_states, "dt", as_of).filter(F.col("state") == "PICKED").select("orderjobid", "timestamp", "metadata")
    first = top1(picked, ["orderjobid"], [F.col("timestamp").asc_nulls_last(), F.col("metadata").asc_nulls_last()])
    doc = parse(F.col("metadata"), f"struct<oldItems:{ITEMS},newItems:{ITEMS}>")
    role = lambda items, is_old: F.transform(
        F.coalesce(items, F.array().cast(ITEMS)),
        lambda i: F.struct(i["skuId"].alias("sku"), i["quantity"].alias("quantity"), F.lit(is_old).alias("is_old")))
    items = (first.withColumn("doc", doc)
             .select("orderjobid", F.explode(F.concat(role(F.col("doc.oldItems"), True), role(F.col("doc.newItems"), False))).alias("i")))
    per_sku = pivot_agg(items, ["orderjobid", "i.sku"], {
        "old": (F.col("i.is_old"), F.col("i.quantity"), F.sum),
        "new": (~F.col("i.is_old"), F.col("i.quantity"), F.sum),
    }).withColumn("diff", F.col("old") - F.coalesce("new", F.lit(0.0)))
    # without a SKU the two sides cannot be matched, so nothing is set off
    cut = per_sku.withColumn("diff", F.when(F.col("sku").isNull(), F.col("old")).otherwise(F.col("diff"))).filter("diff > 0")
    return cut.groupBy("orderjobid").agg(F.lit(1).alias("ftr_flag"), F.sum("diff").alias("qty_diff"))


def order_identity(order_events: DataFrame, as_of: date) -> DataFrame:
    """Store, city and status of each order at its last event of the day."""
    doc = parse(F.col("metadata_json"), "struct<storeInfo:struct<id:string,name:string,storeType:string>>")
    rows = (on_day(order_events, "dt", as_of).filter(F.col("job_type").isin(JOB_TYPES))
            .withColumn("info", doc["storeInfo"])
            .filter(F.col("info.storeType").isNull() | ieq(unquoted(F.col("info.storeType")), "listed"))
            .select("id", "status", "dt", "city", "event_id", F.col("info.id").alias("store_id"),
                    unquoted(F.col("info.name")).alias("store_name")))
    return (last_event(rows, "id", "event_id")
            .groupBy("id", "status", "dt", "store_id", "store_name").agg(F.max("city").alias("order_city")))


def _confirmed(order_confirm: DataFrame, as_of: date) -> DataFrame:
    rows = on_day(order_confirm, "dt", as_of).filter(F.col("type").isin(CONFIRM_TYPES) & (F.col("status") == "CONFIRMED"))
    return rows.groupBy("job_id").agg(F.min(epoch_ms(F.col("time_stamp"), "floor")).alias("ordered_time"))


def _parked(pigeon_hole: DataFrame, as_of: date) -> DataFrame:
    rows = on_day(pigeon_hole, "dt", as_of).filter(F.col("object_name") == PIGEON_HOLE)
    return rows.groupBy("object_value").agg(F.max(instant(F.col("time_stamp"))).alias("vendor_ph_time"))


def _rider(job_logs: DataFrame, as_of: date, precision: str) -> DataFrame:
    ts = epoch_ms(F.col("time_stamp"), precision)
    return pivot_agg(job_status_events(job_logs, as_of), ["job_id"], {
        "de_arrived": (F.col("status") == "delivery_arrived", ts, F.min),
        "de_picked": (F.col("status") == "delivery_pickedup", ts, F.min),
    })


def _legs(df: DataFrame) -> DataFrame:
    c = F.col
    return df.withColumns({
        "o2a": minutes_between(c("ordered_time"), c("vendor_assigned_time")),
        "a2c": minutes_between(c("vendor_assigned_time"), c("vendor_pickingstart_time")),
        "c2p": minutes_between(c("vendor_pickingstart_time"), c("vendor_picked_time")),
        "p2b": minutes_between(c("vendor_picked_time"), c("vendor_markedready_time")),
        "o2p": minutes_between(c("ordered_time"), c("vendor_pickingstart_time")),
        "o2b": minutes_between(c("ordered_time"), c("vendor_markedready_time")),
        "b2ar": minutes_between(c("vendor_markedready_time"), c("de_arrived")),
        "ar2p": minutes_between(c("de_arrived"), c("de_picked")),
        "hr": F.hour("ordered_time"),
    })


def _states_by_slot(events: DataFrame) -> DataFrame:
    """Order x slotted with a picking event, and the order-wide times of the other states.

    One aggregation for all states. The order-wide values are then spread over the few slotted values
    of the order, which is all the window ever sees.
    """
    ts, state = epoch_ms(F.col("timestamp"), "round"), F.col("state")
    wide = pivot_agg(events, ["orderjobid", "slotted"], {
        "_picks": (state == "picking", F.lit(1), F.max),
        "vendor_pickingstart_time": (state == "picking", ts, F.max),
        "vendor_picked_time": (state == "picked", ts, F.max),
        "vendor_markedready_time": (state == "delivery_ready", ts, F.max),
        "vendor_cancelled_time": (state == "cancelled", ts, F.max),
        "vendor_assigned_time": (state == "assigned", ts, F.min),
        "unassigned_flag": (state == "un_assigned", F.lit(1), F.max),
    })
    order = Window.partitionBy("orderjobid")
    spread = {c: F.max(c).over(order) for c in
              ("vendor_picked_time", "vendor_markedready_time", "vendor_cancelled_time", "unassigned_flag")}
    spread["vendor_assigned_time"] = F.min("vendor_assigned_time").over(order)
    return wide.withColumns(spread).filter(F.col("_picks") == 1).drop("_picks")


def _states_by_order(events: DataFrame) -> DataFrame:
    ts, state = epoch_ms(F.col("timestamp"), "round"), F.col("state")
    times = pivot_agg(events, ["orderjobid"], {
        "slotted": (F.lit(True), F.col("slotted"), F.max),
        "vendor_pickingstart_time": (state == "picking", ts, F.max),
        "vendor_picked_time": (state == "picked", ts, F.max),
        "vendor_markedready_time": (state == "delivery_ready", ts, F.max),
        "vendor_cancelled_time": (state == "cancelled", ts, F.max),
        "vendor_assigned_time": (state == "assigned", ts, F.max),
    })
    return times


def _with_order_facts(orders: DataFrame, order_events: DataFrame, order_confirm: DataFrame, pigeon_hole: DataFrame,
                      store_city: DataFrame, job_logs: DataFrame, as_of: date, rider_precision: str) -> DataFrame:
    """Joins shared by the report and the alert. The store filter makes the identity join an inner one."""
    identity = (order_identity(order_events, as_of).filter(ieq(F.col("store_name"), STORE_NAME))
                .select(F.col("id").cast("string").alias("orderjobid"), F.col("store_id").cast("string").alias("store_id"),
                        "store_name", "status"))
    cities = (store_city.filter(ieq(F.col("store_name"), STORE_NAME))
              .select(F.col("store_id").cast("string").alias("store_id"), "city"))
    keyed = lambda df, key: df.withColumn("orderjobid", F.col(key).cast("string")).drop(*({key} - {"orderjobid"}))
    return (keyed(orders, "orderjobid")
            .join(identity, "orderjobid")
            .join(keyed(_parked(pigeon_hole, as_of), "object_value"), "orderjobid", "left")
            .join(keyed(_confirmed(order_confirm, as_of), "job_id"), "orderjobid", "left")
            .join(keyed(_rider(job_logs, as_of, rider_precision), "job_id"), "orderjobid", "left")
            .join(cities, "store_id", "left")
            .withColumn("dt", F.to_date("ordered_time"))
            .withColumn("del_flag", F.when(ieq(F.col("status"), "delivery_delivered"), 1).otherwise(0)))


def order_time_legs(order_states: DataFrame, order_events: DataFrame, order_confirm: DataFrame, pigeon_hole: DataFrame,
                    store_city: DataFrame, job_logs: DataFrame, temperature: DataFrame, as_of: date) -> DataFrame:
    """Order (x slotted) with its state times, store, rider times, reduced quantities and legs in minutes."""
    orders = _states_by_slot(order_state_events(order_states, as_of))
    facts = _with_order_facts(orders, order_events, order_confirm, pigeon_hole, store_city, job_logs, as_of, "exact")
    cut = reduced_quantities(order_states, as_of).withColumn("orderjobid", F.col("orderjobid").cast("string"))
    flags = temperature.select(F.col("orderjobid").cast("string").alias("orderjobid"), "temp_sens").distinct()
    out = (facts.join(cut, "orderjobid", "left")
           .withColumns({"ftr_flag": F.coalesce("ftr_flag", F.lit(0)), "qty_diff": F.coalesce("qty_diff", F.lit(0.0))})
           .join(flags, "orderjobid", "left"))
    return _legs(with_defaults(out, {c: (None, "int") for c in OPEN_CLAIMS}))


def time_leg_alerts(order_states: DataFrame, order_events: DataFrame, order_confirm: DataFrame, pigeon_hole: DataFrame,
                    store_city: DataFrame, job_logs: DataFrame, temperature: DataFrame, active_stores: DataFrame,
                    outlets: DataFrame, as_of: date, active_day: date, now: datetime) -> DataFrame:
    """Stores whose average legs of delivered, unslotted orders of the day are over the limit, with the first reason.

    ``avg_o2c`` averages the order-to-picking leg, as the report has always done.
    """
    orders = _states_by_order(order_state_events(order_states, as_of)).filter(F.col("slotted") == "FALSE")
    facts = _with_order_facts(orders, order_events, order_confirm, pigeon_hole, store_city, job_logs, as_of, "round")
    flags = temperature.select(F.col("orderjobid").cast("string").alias("orderjobid"), "temp_sens").distinct()
    rows = _legs(facts).filter((F.col("status") == "DELIVERY_DELIVERED") & (F.col("dt") == F.lit(as_of)))
    live = (on_day(active_stores, "dt", active_day).filter(ieq(F.col("type"), STORE_NAME))
            .select(F.col("store_id").cast("string").alias("store_id")))
    rows = rows.join(live, "store_id", "left_semi").join(flags, "orderjobid", "left")
    averages = rows.groupBy("dt", "city", "store_id", "status", "slotted").agg(
        F.avg("o2p").alias("avg_o2c"), F.avg("p2b").alias("avg_p2b"), F.avg("c2p").alias("avg_c2p"), F.avg("o2b").alias("avg_o2b"))
    breaches = [(F.col("avg_o2c") >= O2C_LIMIT, "O2C"), (F.col("avg_p2b") >= P2B_LIMIT, "P2B"), (F.col("avg_c2p") >= C2P_LIMIT, "C2P")]
    alerts = averages.withColumns({
        "alert_status": alert_status([b for b, _ in breaches]),
        "reason": alert_reason(breaches),
        "last_updated_data_at": stamp(now),
    }).filter(F.col("alert_status") == "alert")
    names = latest_rows(outlets.withColumn("store_id", F.col("store_id").cast("string")), ["store_id"], "date",
                        ["store_id", "outlet_name"]).withColumnRenamed("outlet_name", "store_name")
    return alerts.join(names, "store_id", "left")
