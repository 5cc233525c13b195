"""Store operations on the test tables.

Every event becomes a state change of an order (user x day). Nine in ten are loaded on one day, the tenth
on an earlier day that no report's window reaches, so that a missing date filter shows. Times keep their
time of day but move to the load day.
"""

from __future__ import annotations

from collections.abc import Callable
from datetime import date, datetime, timedelta

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from ..functions.dates import RunWindow, epoch_ms, minutes_between
from ..functions.numbers import alert_reason, alert_status, kept_percent
from ..plans import capacity, item_shortage, report_loads, store_orders
from ..plans.store_orders import PIGEON_HOLE
from ..sources.staging import fresh_path, scope
from .common import day_text, job_input, load, rounded, text, time_text

LOAD_DAY = date(2024, 1, 31)
OTHER_DAY = date(2024, 1, 20)
LOAD_DAY_MS = 1_706_659_200_000
DAY_MS = 86_400_000
NOW = datetime(2024, 1, 31, 12)


def _events(spark: SparkSession, folder: str) -> DataFrame:
    ts = F.col("ts").cast("timestamp")
    return load(spark, folder, "events").select(
        "event_id", "event_type", "value", "user_id",
        F.when(F.col("event_id") % 10 == 3, F.lit(OTHER_DAY)).otherwise(F.lit(LOAD_DAY)).alias("dt"),
        F.concat(F.lit("o"), text("user_id"), F.lit("-"), F.date_format("ts", "yyyyMMdd")).alias("oid"),
        text("user_id").alias("store"), F.get_json_object("props", "$.k").cast("int").alias("k"),
        (F.unix_millis(ts) % DAY_MS + LOAD_DAY_MS).alias("ms"))


def _case(col: str, mapping: dict[str, str], default: str):
    out = F
    for key, value in mapping.items():
        out = out.when(F.col(col) == key, value)
    return out.otherwise(default)


@job_input(by=["dt"])
def order_states(spark: SparkSession, folder: str) -> DataFrame:
    e = _events(spark, folder)
    units = F.floor("value").cast("int") + 1
    item = lambda sku, n: F.struct(text(sku).alias("skuId"), n.alias("quantity"))
    old = F.array(item(F.col("k"), units), item(F.col("k") + 1, F.lit(2)))
    new = F.when(F.col("value") > 40, F.array(item(F.col("k"), units - 1))).otherwise(old)
    cold = lambda test: F.struct(F.when(test, "true").otherwise("false").alias("perishable"))
    state = _case("event_type", {"view": "PICKING", "click": "PICKED", "purchase": "Delivery_Ready", "signup": "ASSIGNED"}, "x")
    return e.select(
        "dt", F.col("oid").alias("orderjobid"), F.when(F.col("value") >= 60, "TRUE").otherwise("FALSE").alias("slotted"),
        F.col("ms").alias("timestamp"), F.col("ms").alias("time_stamp"),
        F.when(F.col("event_type") == "error", F.when(F.col("value") < 10, "CANCELLED").otherwise("UN_ASSIGNED")).otherwise(state).alias("state"),
        F.col("store").alias("storeid"), F.to_json(F.struct(old.alias("oldItems"), new.alias("newItems"))).alias("metadata"),
        F.to_json(F.array(cold(F.col("k") < 20), cold(F.lit(False)))).alias("itemdetails"))


@job_input(by=["dt"])
def order_events(spark: SparkSession, folder: str) -> DataFrame:
    info = F.struct(F.col("store").alias("id"), F.when(F.col("value") < 80, "Instacart").otherwise("other").alias("name"),
                    F.when(F.col("k") < 50, "LISTED").alias("storeType"))
    return _events(spark, folder).select(
        "dt", F.col("oid").alias("id"), "event_id", F.when(F.col("event_type") == "purchase", "DELIVERY_DELIVERED").otherwise(F.upper("event_type")).alias("status"),
        F.when(F.col("event_type") == "signup", "OTHER").otherwise("BUY").alias("job_type"),
        F.concat(F.lit("c"), "store").alias("city"), F.col("ms").alias("created_at"),
        F.to_json(F.struct(info.alias("storeInfo"))).alias("metadata_json"))


@job_input(by=["dt"])
def order_confirm(spark: SparkSession, folder: str) -> DataFrame:
    return _events(spark, folder).select(
        "dt", F.col("oid").alias("job_id"), (F.col("ms") - 600_000).alias("time_stamp"), F.lit("BUY").alias("type"),
        F.when(F.col("event_type").isin("signup", "view"), "CONFIRMED").otherwise("OTHER").alias("status"))


@job_input(by=["dt"])
def pigeon_hole(spark: SparkSession, folder: str) -> DataFrame:
    return _events(spark, folder).select(
        "dt", F.when(F.col("event_type") == "error", PIGEON_HOLE).otherwise("other").alias("object_name"),
        F.col("oid").alias("object_value"),
        F.when(F.col("k") < 50, text("ms")).otherwise(text(epoch_ms(F.col("ms")))).alias("time_stamp"))


@job_input(by=["dt"])
def job_logs(spark: SparkSession, folder: str) -> DataFrame:
    status = _case("event_type", {"view": "PLACED", "purchase": "DELIVERY_DELIVERED", "click": "DELIVERY_PICKEDUP", "signup": "DELIVERY_ARRIVED"}, "CANCELLED")
    reason = F.when(F.col("value") >= 20, "late: Stores_VDC | VDC_OOS (auto)").otherwise("changed mind")
    billed = F.struct(F.struct(text("k").alias("itemId"), (F.floor("value").cast("int") + 1).alias("quantity")).alias("item"))
    update = F.struct(
        F.to_json(F.struct(reason.alias("reason"))).alias("status_meta"),
        F.to_json(F.struct(F.lit("INSTANT").alias("deliveryType"), F.struct(F.array(billed).alias("billedItems")).alias("bill"))).alias("metadata"))
    return _events(spark, folder).select(
        "dt", F.col("oid").alias("job_id"), F.col("ms").alias("time_stamp"), status.alias("status"), F.col("store").alias("store_id"),
        epoch_ms(F.col("ms")).alias("update_time"), F.to_json(update).alias("update_json"))


def _stores(spark: SparkSession, folder: str) -> DataFrame:
    return load(spark, folder, "events").select("user_id").distinct()


def store_city(spark: SparkSession, folder: str) -> DataFrame:
    return _stores(spark, folder).select(F.concat(F.lit("C"), text("user_id")).alias("city"), text("user_id").alias("store_id"),
                                         F.lit("InstaCart").alias("store_name"))


def outlets(spark: SparkSession, folder: str) -> DataFrame:
    return load(spark, folder, "customer").select(
        F.col("c_nationkey").alias("store_id"), F.col("c_mktsegment").alias("city"), F.col("c_mktsegment").alias("outlet_name"),
        F.when(F.col("c_custkey") % 40 != 0, F.date_add(F.lit(date(2024, 1, 1)), F.floor(F.col("c_acctbal") / 100).cast("int"))).alias("date"))


def _temperature(spark, folder):
    return store_orders.temperature_flags(order_states(spark, folder), RunWindow.ending(LOAD_DAY, 1))


def temp_flag(spark: SparkSession, folder: str) -> DataFrame:
    return _temperature(spark, folder).withColumn("dt", day_text("dt"))


def state_events(spark: SparkSession, folder: str) -> DataFrame:
    orders = store_orders.order_state_events(order_states(spark, folder), LOAD_DAY).groupBy("state").agg(
        F.count("*").alias("n_rows"), F.min("timestamp").alias("first_ms"))
    jobs = store_orders.job_status_events(job_logs(spark, folder), LOAD_DAY).groupBy(F.col("status").alias("state")).agg(
        F.count("*").alias("n_rows"), F.min("time_stamp").alias("first_ms"))
    return orders.unionByName(jobs)


def ftr_qty(spark: SparkSession, folder: str) -> DataFrame:
    return store_orders.reduced_quantities(order_states(spark, folder), LOAD_DAY)


LEGS = ["o2a", "a2c", "c2p", "p2b", "o2p", "o2b", "b2ar", "ar2p"]


def order_legs(spark: SparkSession, folder: str) -> DataFrame:
    s = lambda f: f(spark, folder)
    out = store_orders.order_time_legs(
        s(order_states), s(order_events), s(order_confirm), s(pigeon_hole), s(store_city), s(job_logs), s(_temperature), LOAD_DAY)
    return _shown_legs(out)


def _shown_legs(out: DataFrame) -> DataFrame:
    return rounded(out, *LEGS).select(
        "orderjobid", "slotted", "store_id", "city", "status", "del_flag", "ftr_flag", F.round("qty_diff", 2).alias("qty_diff"), "temp_sens",
        *LEGS, time_text("ordered_time").alias("ordered_time"), time_text("vendor_ph_time").alias("vendor_ph_time"),
        time_text("vendor_cancelled_time").alias("vendor_cancelled_time"),
        F.coalesce("unassigned_flag", F.lit(0)).alias("unassigned_flag"), F.coalesce("hr", F.lit(-1)).alias("hr"))


def _active(spark: SparkSession, folder: str) -> DataFrame:
    return _stores(spark, folder).select(F.col("user_id").alias("store_id"), F.lit("Instacart").alias("type"),
                                         F.lit(LOAD_DAY - timedelta(days=2)).alias("dt"))


def leg_alerts(spark: SparkSession, folder: str) -> DataFrame:
    s = lambda f: f(spark, folder)
    out = store_orders.time_leg_alerts(
        s(order_states), s(order_events), s(order_confirm), s(pigeon_hole), s(store_city), s(job_logs), s(_temperature),
        s(_active), s(outlets), LOAD_DAY, LOAD_DAY - timedelta(days=2), NOW)
    return _shown_alerts(out)


def _shown_alerts(out: DataFrame) -> DataFrame:
    return rounded(out, "avg_o2c", "avg_p2b", "avg_c2p", "avg_o2b").select(
        day_text("dt").alias("dt"), "city", "store_id", "status", "slotted", "avg_o2c", "avg_p2b", "avg_c2p", "avg_o2b",
        "alert_status", "reason", "store_name", time_text("last_updated_data_at").alias("last_updated_data_at"))


def hour_capacity(spark: SparkSession, folder: str) -> DataFrame:
    sup = load(spark, folder, "supplier").join(
        load(spark, folder, "nation").select(F.col("n_nationkey").alias("s_nationkey"), "n_name"), "s_nationkey")
    stores = sup.select(F.col("n_name").alias("city"), F.col("s_suppkey").alias("store_id"), F.lit("InstaCart").alias("store_name"),
                        F.when(F.col("s_acctbal") > 0, 1).otherwise(0).alias("active"))
    opens = F.concat(F.lpad(text(F.col("s_nationkey") % 10), 2, "0"), F.lit(":30:00"))
    closes = F.concat(text(F.col("s_nationkey") % 10 + 8), F.when(F.col("s_acctbal") > 5000, ":00:00").otherwise(":30:00"))
    open_days = sup.select(F.explode(F.sequence(F.lit(0), F.lit(6))).alias("day_id"), F.col("s_suppkey").alias("store_id"),
                           opens.alias("open_time"), closes.alias("close_time"), F.lit(None).cast("timestamp").alias("deleted_time"))
    numbers = [F.col("s_nationkey").alias("threshold"), (F.col("s_nationkey") + 1).alias("cooldown"),
               F.col("s_acctbal").alias("stressratiothreshold"), (F.col("s_acctbal") / 2).alias("stressratiocooldown")]
    store = text("s_suppkey")
    day_limits = sup.select(store.alias("storeid"), F.lit("true").alias("enabled"), F.lit("default").alias("slot"), *numbers)
    mfr = sup.select(F.concat(F.lit("m_x_"), store).alias("storeid"), F.when(F.col("s_acctbal") > 3000, "true").otherwise("false").alias("enabled"),
                     F.lit("mfr").alias("slot"), *numbers)
    slots = sup.select(store.alias("storeid"), F.lit("true").alias("enabled"),
                       F.concat(F.lpad(text(F.col("s_nationkey") % 10 + 3), 2, "0"), F.lit(":00-23:00-"),
                                F.when(F.col("s_acctbal") > 1000, "weekday").otherwise("weekend")).alias("slot"),
                       F.lit(99).alias("threshold"), F.lit(None).cast("int").alias("cooldown"), F.lit(1.5).alias("stressratiothreshold"),
                       F.lit(None).cast("double").alias("stressratiocooldown"))
    hours = spark.range(24).select(F.col("id").cast("int").alias("hour"))
    out = capacity.store_hour_capacity(hours, stores, open_days, day_limits.unionByName(mfr).unionByName(slots), LOAD_DAY)
    return rounded(out, "threshold_mul", "cooldown_mul")


def combo_sku(spark: SparkSession, folder: str) -> DataFrame:
    size = text("p_size")
    return load(spark, folder, "part").select(
        F.lit("spin").alias("combo_spin"), size.alias("store_id"), size.alias("combo_sku"),
        text(F.col("p_size") + F.length("p_type")).alias("const_sku"), F.length("p_name").alias("const_qty"))


def _shortage(spark: SparkSession, folder: str, states: DataFrame, jobs: DataFrame) -> DataFrame:
    e = _events(spark, folder)
    users = _stores(spark, folder)
    store = users.select(text("user_id").alias("id"), F.lit("InstaCart").alias("name"), (F.col("user_id") % 25).cast("int").alias("area_id"))
    nation, region = load(spark, folder, "nation"), load(spark, folder, "region")
    area = nation.select(F.col("n_nationkey").alias("id"), F.col("n_name").alias("name"), F.col("n_regionkey").alias("city_id"))
    city = region.select(F.col("r_regionkey").alias("id"), F.col("r_name").alias("name"))
    closing = e.select(text("k").alias("sku"), F.floor("value").cast("bigint").alias("sellable"), epoch_ms(F.col("ms") - 2 * DAY_MS).alias("update_time"),
                       F.date_sub("dt", 2).alias("insert_date"),
                       F.when(F.col("event_type") == "signup", item_shortage.INWARD_AREA).otherwise("A").alias("loc"))
    current = e.where(F.col("dt") == F.lit(LOAD_DAY)).select(text("k").alias("sku"), (F.floor("value") * 2).cast("bigint").alias("sellable"),
                       F.when(F.col("event_type") != "click", F.floor("value")).cast("bigint").alias("ordered"), F.col("ms").alias("sellable_updated"))
    items = load(spark, folder, "part").groupBy("p_size").agg(F.min("p_brand").alias("item_code"), F.min("p_name").alias("item_name")).select(
        text("p_size").alias("sku_id"), "item_code", "item_name")
    return item_shortage.shortage_detail(states, jobs, store, area, city, combo_sku(spark, folder), closing, current, items, LOAD_DAY)


def stock_asof(spark: SparkSession, folder: str) -> DataFrame:
    return _shown_shortage(_shortage(spark, folder, order_states(spark, folder), job_logs(spark, folder)))


def _shown_shortage(out: DataFrame) -> DataFrame:
    times = ["ordered_time", "vdc_ftr_time", "inv_ordered_time", "inv_vdc_ftr_time"]
    return out.withColumns({c: time_text(c) for c in times} | {"order_dt": day_text("order_dt")})


def _fill_rate_items(spark: SparkSession, folder: str) -> tuple[DataFrame, DataFrame]:
    items = load(spark, folder, "part").select(F.col("p_size").alias("store_id"))
    mim = load(spark, folder, "supplier").select(
        F.col("s_suppkey").alias("store_id"), F.when(F.col("s_acctbal") > 4000, F.lit(LOAD_DAY)).otherwise(F.lit(date(2030, 1, 1))).alias("date"))
    return items, mim


def fill_rate(spark: SparkSession, folder: str) -> DataFrame:
    items, mim = _fill_rate_items(spark, folder)
    out = item_shortage.fill_rate_alert(order_states(spark, folder), job_logs(spark, folder), items, mim, outlets(spark, folder), LOAD_DAY, NOW)
    return out.withColumn("updated_time", time_text("updated_time"))


def _day(spark: SparkSession, folder: str, *names: str) -> report_loads.StoreTables:
    s = lambda f: f(spark, folder)
    tables = report_loads.StoreTables(s(order_states), s(order_events), s(order_confirm), s(pigeon_hole), s(job_logs), s(store_city))
    return report_loads.staged_day(tables, RunWindow.ending(LOAD_DAY, 1), names or report_loads.DATED)


def _flags(spark: SparkSession, day: report_loads.StoreTables) -> DataFrame:
    path = fresh_path(spark, "temp_flag")
    report_loads.load_temperature_flags(day, RunWindow.ending(LOAD_DAY, 1), path)
    return spark.read.parquet(path)


def _reloaded(spark: SparkSession, name: str, load_into: Callable[[str], None]) -> DataFrame:
    """The target after two loads of the same day."""
    path = fresh_path(spark, name)
    for _ in range(2):
        load_into(path)
    return spark.read.parquet(path)


def loaded_temp_flag(spark: SparkSession, folder: str) -> DataFrame:
    with scope(spark):
        day = _day(spark, folder, "order_states")
        out = _reloaded(spark, "temp_flag", lambda path: report_loads.load_temperature_flags(day, RunWindow.ending(LOAD_DAY, 1), path))
    return out.select(day_text("dt").alias("dt"), "temp_sens", "orderjobid")


def loaded_state_events(spark: SparkSession, folder: str) -> DataFrame:
    """Both staging targets of the day, of order states and of job states."""
    with scope(spark):
        day = _day(spark, folder, "order_states", "job_logs")
        orders = _reloaded(spark, "state_events", lambda path: report_loads.load_state_events(day, LOAD_DAY, path))
        jobs = _reloaded(spark, "job_status", lambda path: report_loads.load_job_status(day, LOAD_DAY, path))
    per = lambda df, state, ms, kind: df.groupBy(F.col(state).alias("state")).agg(
        F.count("*").alias("n_rows"), F.min(ms).alias("first_ms")).withColumn("target", F.lit(kind))
    return per(orders, "state", "timestamp", "orders").unionByName(per(jobs, "status", "time_stamp", "jobs"))


def loaded_order_legs(spark: SparkSession, folder: str) -> DataFrame:
    with scope(spark):
        day = _day(spark, folder)
        flags = _flags(spark, day)
        out = _reloaded(spark, "order_legs", lambda path: report_loads.load_order_legs(day, flags, LOAD_DAY, path))
    return _shown_legs(out)


def loaded_leg_alerts(spark: SparkSession, folder: str) -> DataFrame:
    with scope(spark):
        day = _day(spark, folder)
        flags, active, outlet = _flags(spark, day), _active(spark, folder), outlets(spark, folder)
        out = _reloaded(spark, "leg_alerts", lambda path: report_loads.load_leg_alerts(day, flags, active, outlet, LOAD_DAY, NOW, path))
    return _shown_alerts(out)


def loaded_fill_rate(spark: SparkSession, folder: str) -> DataFrame:
    with scope(spark):
        day, (items, mim) = _day(spark, folder, "order_states", "job_logs"), _fill_rate_items(spark, folder)
        out = _reloaded(spark, "fill_rate", lambda path: report_loads.load_fill_rate(
            day, items, mim, outlets(spark, folder), LOAD_DAY, NOW, path))
    return out.withColumn("updated_time", time_text("updated_time"))


def loaded_stock_asof(spark: SparkSession, folder: str) -> DataFrame:
    """The shortage detail from the day's staged job events."""
    with scope(spark):
        day = _day(spark, folder, "order_states", "job_logs")
        jobs = _reloaded(spark, "job_status", lambda path: report_loads.load_job_status(day, LOAD_DAY, path))
        detail = _shortage(spark, folder, day.order_states, jobs)
        out = _reloaded(spark, "shortage", lambda path: report_loads.load_report(detail, path))
    return _shown_shortage(out)


def loaded_hour_capacity(spark: SparkSession, folder: str) -> DataFrame:
    return _reloaded(spark, "hour_capacity", lambda path: report_loads.load_report(hour_capacity(spark, folder), path))


LOADED = {f.__name__: f for f in (loaded_temp_flag, loaded_state_events, loaded_order_legs, loaded_leg_alerts, loaded_fill_rate,
                                  loaded_stock_asof, loaded_hour_capacity)}


def time_legs(spark: SparkSession, folder: str) -> DataFrame:
    """First view, click and purchase of a user's day and the minutes between them, for days with a purchase."""
    ev = load(spark, folder, "events").withColumn("day", F.to_date("ts"))
    first = lambda kind: F.min(F.when(F.col("event_type") == kind, F.col("ts")))
    times = ev.groupBy("user_id", "day").agg(first("view").alias("v"), first("click").alias("c"), first("purchase").alias("p"))
    return times.filter(F.col("p").isNotNull()).select(
        "user_id", day_text("day").alias("day"), F.round(minutes_between(F.col("v"), F.col("c")), 4).alias("view_to_click"),
        F.round(minutes_between(F.col("c"), F.col("p")), 4).alias("click_to_purchase"), F.hour("p").alias("hr"))


def epoch_legs(spark: SparkSession, folder: str) -> DataFrame:
    """Milliseconds read exactly, rounded and cut, and the seconds each reading is away from the day's start."""
    e = _events(spark, folder)
    read = {p: epoch_ms(F.col("ms"), p) for p in ("exact", "round", "floor")}
    return e.groupBy("event_type").agg(
        *[F.sum(F.unix_millis(t) - LOAD_DAY_MS).alias(f"sum_{p}") for p, t in read.items()],
        F.min(time_text(read["exact"])).alias("first_exact"), F.max(time_text(F.date_trunc("second", read["exact"]))).alias("last_cut"))


def alerts(spark: SparkSession, folder: str) -> DataFrame:
    """Share of lines not returned, per month of shipping and order priority, with alert and reason."""
    li = load(spark, folder, "lineitem").select("l_orderkey", "l_returnflag", "l_shipdate")
    od = load(spark, folder, "orders").select(F.col("o_orderkey").alias("l_orderkey"), "o_orderpriority")
    per = li.join(od, "l_orderkey").groupBy("o_orderpriority", F.month("l_shipdate").alias("ship_month"), F.weekofyear("l_shipdate").alias("ship_week")).agg(
        F.count("*").alias("n_lines"), F.sum(F.when(F.col("l_returnflag") == "R", 1)).alias("n_returned"))
    pct = kept_percent(F.col("n_lines"), F.col("n_returned"))
    low, busy = F.col("pct") < 66, F.col("n_lines") > 300
    return per.withColumn("pct", pct).select(
        "o_orderpriority", "ship_month", "ship_week", "n_lines", F.coalesce("n_returned", F.lit(0)).alias("n_returned"), "pct",
        alert_status([low, busy]).alias("alert_status"), alert_reason([(low, "LOW"), (busy, "BUSY")]).alias("reason"))


QUERIES = {
    "time_legs": time_legs, "epoch_legs": epoch_legs, "alerts": alerts, "state_events": state_events, "temp_flag": temp_flag,
    "ftr_qty": ftr_qty, "order_legs": order_legs, "leg_alerts": leg_alerts, "hour_capacity": hour_capacity,
    "stock_asof": stock_asof, "fill_rate": fill_rate, **LOADED,
}

_E_ALL = f"""e AS (
  SELECT event_id, event_type AS t, value AS v, user_id AS u, 'o' || user_id || '-' || strftime(ts, '%Y%m%d') AS oid,
         CAST(user_id AS VARCHAR) AS store, CAST(json_extract(props, '$.k') AS INTEGER) AS k,
         {LOAD_DAY_MS} + epoch_us(ts) // 1000 % {DAY_MS} AS ms FROM events)"""
_E = _E_ALL[:-1] + " WHERE event_id % 10 <> 3)"
_STATES = """st AS (
  SELECT *, CASE t WHEN 'view' THEN 'picking' WHEN 'click' THEN 'picked' WHEN 'purchase' THEN 'delivery_ready' WHEN 'signup' THEN 'assigned'
         ELSE CASE WHEN v < 10 THEN 'cancelled' ELSE 'un_assigned' END END AS state,
         CASE WHEN v >= 60 THEN 'TRUE' ELSE 'FALSE' END AS slotted, (ms + 500) // 1000 AS sec FROM e)"""
_TEMPS = """temps AS (
  SELECT DISTINCT oid, sens FROM (
    SELECT oid, CASE WHEN k < 20 THEN 'true' ELSE 'false' END AS sens, ms FROM e UNION ALL SELECT oid, 'false', ms FROM e)
  WHERE sens = 'true' OR oid NOT IN (SELECT oid FROM e WHERE k < 20))"""
_ITEMS = """old_items AS (
  SELECT oid, event_id, ms, CAST(k AS VARCHAR) AS sku, CAST(floor(v) AS INTEGER) + 1 AS qty, v, store, t, slotted FROM st
  UNION ALL SELECT oid, event_id, ms, CAST(k + 1 AS VARCHAR), 2, v, store, t, slotted FROM st),
new_items AS (
  SELECT oid, event_id, sku, CASE WHEN v > 40 THEN qty - 1 ELSE qty END AS qty, store, t FROM old_items
  WHERE v <= 40 OR sku = (SELECT CAST(k AS VARCHAR) FROM e WHERE e.event_id = old_items.event_id))"""
_FTR = """firsts AS (SELECT event_id FROM st WHERE t = 'click' QUALIFY row_number() OVER (PARTITION BY oid ORDER BY ms) = 1),
osum AS (SELECT oid, sku, sum(qty) AS q FROM old_items WHERE event_id IN (FROM firsts) GROUP BY 1, 2),
nsum AS (SELECT oid, sku, sum(qty) AS q FROM new_items WHERE event_id IN (FROM firsts) GROUP BY 1, 2),
ftr AS (SELECT o.oid, 1 AS ftr_flag, CAST(sum(o.q - coalesce(n.q, 0)) AS DOUBLE) AS qty_diff FROM osum o LEFT JOIN nsum n USING (oid, sku)
        WHERE o.q - coalesce(n.q, 0) > 0 GROUP BY 1)"""
_FACTS = """ident AS (
  SELECT oid, store AS store_id, CASE WHEN t = 'purchase' THEN 'DELIVERY_DELIVERED' ELSE upper(t) END AS status,
         CASE WHEN v < 80 THEN 'Instacart' ELSE 'other' END AS name FROM e WHERE t <> 'signup'
  QUALIFY last_value(event_id) OVER (PARTITION BY oid ORDER BY event_id ROWS BETWEEN UNBOUNDED PRECEDING AND UNBOUNDED FOLLOWING) = event_id),
parked AS (SELECT oid, max(ms) AS ph FROM e WHERE t = 'error' GROUP BY 1),
conf AS (SELECT oid, min((ms - 600000) // 1000) AS ord FROM e WHERE t IN ('signup', 'view') GROUP BY 1)"""


def _ms_text(ms: str) -> str:
    return f"strftime(make_timestamp_ms({ms}), '%Y-%m-%d %H:%M:%S.%g')"


def _leg(a: str, b: str) -> str:
    return f"round(({b} - {a}) / 60.0, 4)"


_OUTLETS = """outl AS (SELECT DISTINCT store_id, city, outlet FROM (
  SELECT CAST(c_nationkey AS VARCHAR) AS store_id, c_mktsegment AS city, c_mktsegment AS outlet,
         CASE WHEN c_custkey % 40 <> 0 THEN floor(c_acctbal / 100) END AS d FROM customer)
  QUALIFY dense_rank() OVER (PARTITION BY store_id ORDER BY d DESC NULLS FIRST) = 1)"""

ORACLE = {
    "time_legs": """
        WITH t AS (SELECT user_id, strftime(ts, '%Y-%m-%d') AS day, min(ts) FILTER (event_type = 'view') AS v,
                   min(ts) FILTER (event_type = 'click') AS c, min(ts) FILTER (event_type = 'purchase') AS p FROM events GROUP BY 1, 2)
        SELECT user_id, day, round(date_diff('second', v, c) / 60.0, 4) AS view_to_click,
               round(date_diff('second', c, p) / 60.0, 4) AS click_to_purchase, CAST(hour(p) AS INTEGER) AS hr FROM t WHERE p IS NOT NULL""",
    "epoch_legs": f"""WITH {_E_ALL} SELECT t AS event_type, CAST(sum(ms - {LOAD_DAY_MS}) AS BIGINT) AS sum_exact,
        CAST(sum((ms + 500) // 1000 * 1000 - {LOAD_DAY_MS}) AS BIGINT) AS sum_round, CAST(sum(ms // 1000 * 1000 - {LOAD_DAY_MS}) AS BIGINT) AS sum_floor,
        {_ms_text('min(ms)')} AS first_exact, {_ms_text('max(ms) // 1000 * 1000')} AS last_cut FROM e GROUP BY 1""",
    "alerts": """
        WITH p AS (SELECT o_orderpriority, CAST(month(l_shipdate) AS INTEGER) AS ship_month, CAST(week(l_shipdate) AS INTEGER) AS ship_week,
                          count(*) AS n_lines, count(*) FILTER (l_returnflag = 'R') AS n_returned
                   FROM lineitem JOIN orders ON l_orderkey = o_orderkey GROUP BY 1, 2, 3),
        q AS (SELECT *, round((n_lines - n_returned) * 100.0 / n_lines, 4) AS pct FROM p)
        SELECT *, CASE WHEN pct < 66 OR n_lines > 300 THEN 'alert' ELSE 'no_alert' END AS alert_status,
               CASE WHEN pct < 66 THEN 'LOW' WHEN n_lines > 300 THEN 'BUSY' END AS reason FROM q""",
    "state_events": f"""WITH {_E}, {_STATES}
        SELECT state, count(*) AS n_rows, min(ms) AS first_ms FROM st GROUP BY 1
        UNION ALL SELECT CASE t WHEN 'click' THEN 'delivery_pickedup' ELSE 'delivery_arrived' END, count(*), min(ms)
        FROM e WHERE t IN ('click', 'signup') GROUP BY 1""",
    "temp_flag": f"""WITH {_E},
        seen AS (SELECT DISTINCT oid, sens, hr FROM (
            SELECT oid, CASE WHEN k < 20 THEN 'true' ELSE 'false' END AS sens, ms % {DAY_MS} // 3600000 AS hr FROM e
            UNION ALL SELECT oid, 'false', ms % {DAY_MS} // 3600000 FROM e)),
        warm AS (SELECT * FROM seen WHERE sens = 'true')
        SELECT '{LOAD_DAY}' AS dt, sens AS temp_sens, oid AS orderjobid FROM (
            SELECT * FROM warm UNION SELECT * FROM seen WHERE sens = 'false' AND oid NOT IN (SELECT oid FROM warm))""",
    "ftr_qty": f"WITH {_E}, {_STATES}, {_ITEMS}, {_FTR} SELECT oid AS orderjobid, ftr_flag, qty_diff FROM ftr",
    "order_legs": f"""WITH {_E}, {_STATES}, {_TEMPS}, {_ITEMS}, {_FTR}, {_FACTS},
        a AS (SELECT oid, slotted, max(sec) AS pk FROM st WHERE state = 'picking' GROUP BY 1, 2),
        b AS (SELECT oid, max(sec) AS pd FROM st WHERE state = 'picked' GROUP BY 1),
        c AS (SELECT oid, max(sec) AS rd FROM st WHERE state = 'delivery_ready' GROUP BY 1),
        d AS (SELECT oid, max(sec) AS cn FROM st WHERE state = 'cancelled' GROUP BY 1),
        g AS (SELECT oid, min(sec) AS asg FROM st WHERE state = 'assigned' GROUP BY 1),
        ua AS (SELECT DISTINCT oid, 1 AS un FROM st WHERE state = 'un_assigned'),
        i AS (SELECT oid, min(ms) // 1000 AS ar FROM e WHERE t = 'signup' GROUP BY 1),
        j AS (SELECT oid, min(ms) // 1000 AS dp FROM e WHERE t = 'click' GROUP BY 1)
        SELECT oid AS orderjobid, slotted, store_id, 'C' || store_id AS city, status,
            CASE WHEN lower(status) = 'delivery_delivered' THEN 1 ELSE 0 END AS del_flag, coalesce(ftr_flag, 0) AS ftr_flag,
            coalesce(qty_diff, 0) AS qty_diff, sens AS temp_sens, {_leg('ord', 'asg')} AS o2a, {_leg('asg', 'pk')} AS a2c,
            {_leg('pk', 'pd')} AS c2p, {_leg('pd', 'rd')} AS p2b, {_leg('ord', 'pk')} AS o2p, {_leg('ord', 'rd')} AS o2b,
            {_leg('rd', 'ar')} AS b2ar, {_leg('ar', 'dp')} AS ar2p, {_ms_text('ord * 1000')} AS ordered_time,
            {_ms_text('ph')} AS vendor_ph_time, {_ms_text('cn * 1000')} AS vendor_cancelled_time, coalesce(un, 0) AS unassigned_flag,
            CAST(coalesce(hour(make_timestamp_ms(ord * 1000)), -1) AS INTEGER) AS hr
        FROM a JOIN ident USING (oid) LEFT JOIN b USING (oid) LEFT JOIN c USING (oid) LEFT JOIN d USING (oid) LEFT JOIN g USING (oid)
        LEFT JOIN ua USING (oid) LEFT JOIN i USING (oid) LEFT JOIN j USING (oid) LEFT JOIN parked USING (oid) LEFT JOIN conf USING (oid)
        LEFT JOIN ftr USING (oid) LEFT JOIN temps USING (oid) WHERE lower(name) = 'instacart'""",
    "leg_alerts": f"""WITH {_E}, {_STATES}, {_TEMPS}, {_FACTS}, {_OUTLETS},
        s AS (SELECT oid, max(slotted) AS slotted, max(sec) FILTER (state = 'picking') AS pk, max(sec) FILTER (state = 'picked') AS pd,
                     max(sec) FILTER (state = 'delivery_ready') AS rd FROM st GROUP BY 1),
        legs AS (SELECT 'C' || store_id AS city, store_id, status, slotted, (pk - ord) / 60.0 AS o2p, (rd - pd) / 60.0 AS p2b,
                        (pd - pk) / 60.0 AS c2p, (rd - ord) / 60.0 AS o2b
                 FROM s JOIN ident USING (oid) LEFT JOIN conf USING (oid) LEFT JOIN temps USING (oid)
                 WHERE lower(name) = 'instacart' AND status = 'DELIVERY_DELIVERED' AND slotted = 'FALSE' AND ord >= {LOAD_DAY_MS // 1000}),
        av AS (SELECT city, store_id, status, slotted, avg(o2p) AS avg_o2c, avg(p2b) AS avg_p2b, avg(c2p) AS avg_c2p, avg(o2b) AS avg_o2b
               FROM legs GROUP BY 1, 2, 3, 4)
        SELECT '{LOAD_DAY}' AS dt, av.city, av.store_id, status, slotted, round(avg_o2c, 4) AS avg_o2c, round(avg_p2b, 4) AS avg_p2b,
            round(avg_c2p, 4) AS avg_c2p, round(avg_o2b, 4) AS avg_o2b, 'alert' AS alert_status,
            CASE WHEN avg_o2c >= 0.5 THEN 'O2C' WHEN avg_p2b >= 0.5 THEN 'P2B' ELSE 'C2P' END AS reason, outlet AS store_name,
            '2024-01-31 12:00:00.000' AS last_updated_data_at
        FROM av LEFT JOIN outl ON outl.store_id = av.store_id WHERE avg_o2c >= 0.5 OR avg_p2b >= 0.5 OR avg_c2p >= 1.8""",
    "hour_capacity": """
        WITH s AS (SELECT s_suppkey, s_nationkey AS n, s_acctbal AS b, n_name FROM supplier JOIN nation ON s_nationkey = n_nationkey),
        grid AS (SELECT *, n % 10 AS open_hr, CASE WHEN b > 5000 THEN n % 10 + 7 ELSE n % 10 + 8 END AS close_hr
                 FROM s, (SELECT CAST(range AS INTEGER) AS hr FROM range(24)) WHERE b > 0),
        caps AS (SELECT s_suppkey, false AS rfd, true AS on_, n AS c, n + 1 AS d, b AS cm, b / 2 AS dm FROM s
                 UNION ALL SELECT s_suppkey, true, b > 3000, n, n + 1, b, b / 2 FROM s)
        SELECT n_name AS city, CAST(g.s_suppkey AS VARCHAR) AS storeid, hr, '3' AS day_id, 'weekday' AS current_day_type,
            CASE WHEN rfd THEN 'RFD' ELSE 'Pre-MFR' END AS capacity_type,
            CASE WHEN NOT rfd AND b > 1000 AND hr = n % 10 + 3 THEN 99 ELSE c END AS threshold, d AS cooldown,
            round(CASE WHEN NOT rfd AND b > 1000 AND hr = n % 10 + 3 THEN 1.5 ELSE cm END, 4) AS threshold_mul, round(dm, 4) AS cooldown_mul
        FROM grid g JOIN caps ON caps.s_suppkey = g.s_suppkey AND on_ WHERE hr BETWEEN open_hr AND close_hr""",
    "stock_asof": f"""WITH {_E}, {_STATES}, {_ITEMS},
        placed AS (SELECT oid, store, min(ms) AS ord FROM e WHERE t = 'view' GROUP BY 1, 2),
        short AS (
            SELECT DISTINCT o.store, o.oid, o.sku, o.qty, CASE WHEN o.slotted = 'TRUE' THEN 'SLOTTED' ELSE 'INSTANT' END AS dtype, o.ms AS at_ms,
                   'FTR' AS reason, 'FTR' AS flag
            FROM old_items o LEFT JOIN new_items n ON o.oid = n.oid AND o.sku = n.sku AND n.t = 'click'
            WHERE o.t = 'click' AND o.qty - coalesce(n.qty, 0) <> 0
              AND o.oid IN (SELECT oid FROM e WHERE t = 'purchase' AND oid IN (SELECT oid FROM placed))
            UNION
            SELECT store, oid, CAST(k AS VARCHAR), CAST(floor(v) AS INTEGER) + 1, 'INSTANT', min(ms), 'late: Stores_VDC | VDC_OOS (auto)', 'VDC'
            FROM e WHERE t = 'error' AND v >= 20 AND oid IN (SELECT oid FROM placed) GROUP BY 1, 2, 3, 4),
        combos AS (SELECT CAST(p_size AS VARCHAR) AS combo, CAST(p_size + length(p_type) AS VARCHAR) AS const, max(length(p_name)) AS cq
                   FROM part WHERE CAST(p_size AS BIGINT) IN (SELECT u FROM e) GROUP BY 1, 2),
        rows_ AS (SELECT s.*, coalesce(const, s.sku) AS sku_id, CASE WHEN const IS NOT NULL THEN s.sku END AS combo_sku_id, cq, placed.ord
                  FROM short s LEFT JOIN combos ON s.sku = combo LEFT JOIN placed ON placed.oid = s.oid),
        inv AS (SELECT CAST(k AS VARCHAR) AS sku, CAST(sum(CAST(floor(v) AS BIGINT)) AS BIGINT) AS units, max(ms - 2 * {DAY_MS}) AS at_ms FROM e WHERE t <> 'signup' GROUP BY 1
                UNION SELECT CAST(k AS VARCHAR), CAST(floor(v) AS BIGINT) * 2 - CASE WHEN t <> 'click' THEN CAST(floor(v) AS BIGINT) ELSE 0 END, ms FROM e),
        one AS (SELECT r.*, i.at_ms AS i1, i.units AS u1 FROM rows_ r LEFT JOIN inv i ON i.sku = r.sku_id AND r.ord > i.at_ms
                QUALIFY row_number() OVER (PARTITION BY oid, sku_id, combo_sku_id
                    ORDER BY i.at_ms DESC NULLS FIRST, r.qty DESC, cq DESC NULLS LAST, r.at_ms DESC, ord DESC, dtype DESC, reason DESC, flag DESC, i.units DESC) = 1),
        two AS (SELECT o.*, i.at_ms AS i2, i.units AS u2 FROM one o LEFT JOIN inv i ON i.sku = o.sku_id AND o.at_ms > i.at_ms
                QUALIFY row_number() OVER (PARTITION BY oid, sku_id, combo_sku_id ORDER BY i.at_ms DESC NULLS FIRST, i.units DESC) = 1),
        names AS (SELECT CAST(p_size AS VARCHAR) AS sku_id, min(p_brand) AS item_code, min(p_name) AS item_name FROM part GROUP BY 1)
        SELECT strftime(make_timestamp_ms(ord), '%Y-%m-%d') AS order_dt, two.store AS store_id, n_name AS area, r_name AS city, oid AS orderjobid,
            two.sku_id, combo_sku_id, item_code, item_name, qty AS ordered_qty, CAST(cq AS INTEGER) AS const_qty,
            CAST(qty * coalesce(cq, 1) AS INTEGER) AS final_ordered_qty, dtype AS delivery_type, reason, flag AS vdc_ftr_flag,
            {_ms_text('ord')} AS ordered_time, {_ms_text('at_ms')} AS vdc_ftr_time, {_ms_text('i1')} AS inv_ordered_time, u1 AS order_time_qty,
            {_ms_text('i2')} AS inv_vdc_ftr_time, u2 AS vdc_ftr_time_qty
        FROM two LEFT JOIN names USING (sku_id) LEFT JOIN nation ON n_nationkey = CAST(two.store AS BIGINT) % 25
        LEFT JOIN region ON r_regionkey = n_regionkey""",
    "fill_rate": f"""WITH {_E}, {_STATES}, {_ITEMS}, {_OUTLETS},
        known AS (SELECT DISTINCT CAST(p_size AS VARCHAR) AS store FROM part),
        bad AS (SELECT DISTINCT o.oid FROM old_items o LEFT JOIN new_items n ON o.oid = n.oid AND o.sku = n.sku AND n.t = 'click'
                WHERE o.t = 'click' AND o.store IN (FROM known) AND o.qty - coalesce(n.qty, 0) <> 0),
        done AS (SELECT oid, store FROM e WHERE t = 'view' AND store IN (FROM known)
                 AND oid IN (SELECT oid FROM e WHERE t = 'purchase' AND store IN (FROM known)) GROUP BY 1, 2),
        mim AS (SELECT DISTINCT CAST(s_suppkey AS VARCHAR) AS store, s_acctbal > 4000 AS m FROM supplier WHERE s_suppkey NOT IN (3141, 517194)),
        f AS (SELECT done.store, CASE WHEN m THEN 1 ELSE 0 END AS mim_store_identifier, count(*) AS order_count, count(bad.oid) AS ftr_count
              FROM done LEFT JOIN bad USING (oid) LEFT JOIN mim ON mim.store = done.store GROUP BY 1, 2),
        p AS (SELECT *, round((order_count - ftr_count) * 100.0 / order_count, 4) AS ftr_percent FROM f)
        SELECT p.store AS store_id, mim_store_identifier, ftr_count, order_count, ftr_percent,
            CASE WHEN ftr_percent < 99.3 THEN 'alert' ELSE 'no_alert' END AS alert_status, outl.city, outlet AS store_name,
            '2024-01-31 12:00:00.000' AS updated_time
        FROM p LEFT JOIN outl ON outl.store_id = p.store""",
}
ORACLE |= {name: ORACLE[name.removeprefix("loaded_")] for name in LOADED}
ORACLE["loaded_state_events"] = f"""WITH {_E}, {_STATES},
    jobs AS (SELECT CASE t WHEN 'view' THEN 'placed' WHEN 'purchase' THEN 'delivery_delivered' WHEN 'click' THEN 'delivery_pickedup'
                    WHEN 'signup' THEN 'delivery_arrived' ELSE 'cancelled' END AS state, ms FROM e)
    SELECT state, count(*) AS n_rows, min(ms) AS first_ms, 'orders' AS target FROM st GROUP BY 1
    UNION ALL SELECT state, count(*), min(ms), 'jobs' FROM jobs GROUP BY 1"""
