"""Checkout sessions (a user's day) and the plain session flags on the events table."""

from __future__ import annotations

from datetime import date, timedelta

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from ..functions.dates import RunWindow
from ..operators.aggregates import spread
from ..operators.ordered import last_event, top1
from ..operators.rows import in_window, on_day
from ..plans import checkout_sessions as plan
from ..sources.staging import fresh_path, scope, stage
from ..sources.tables import read_csv
from .common import day_text, job_input, load, text, time_text

WINDOW = RunWindow(date(2024, 1, 3), date(2024, 1, 27))


def _events(spark: SparkSession, folder: str, dealt: bool = False) -> DataFrame:
    e = load(spark, folder, "events").select("event_id", "event_type", "value", "user_id", "ts", "props")
    return (e.repartition(spark.sparkContext.defaultParallelism) if dealt else e).select(
        "event_id", "event_type", "value", "user_id", "ts", F.to_date("ts").alias("dt"),
        F.concat(F.lit("s"), text("user_id"), F.lit("-"), F.date_format("ts", "yyyyMMdd")).alias("sid"),
        F.get_json_object("props", "$.k").cast("int").alias("k"))


@job_input(dealt=True)
def place_orders(spark: SparkSession, folder: str) -> DataFrame:
    e = _events(spark, folder, dealt=True)
    source = F.when((F.col("event_type") == "purchase") & (F.col("value") < 100), "turbocheckout").otherwise("web")
    return e.select("dt", "sid", F.to_json(F.struct(source.alias("place_order_source"))).alias("request_params"))


@job_input(dealt=True)
def payment_api(spark: SparkSession, folder: str) -> DataFrame:
    e = _events(spark, folder, dealt=True)
    page = F.when(F.col("event_type") == "view", "payment").when(F.col("event_type").isin("click", "purchase"), "checkout").otherwise("cart")

    def method(i):
        code = F.when((F.col("k") + i) % 2 == 0, "UPIIntent").otherwise(F.concat(F.lit("Card"), text(F.col("k") % 7)))
        return F.struct(code.alias("payment_code"), F.lit("true").alias("enabled"),
                        F.concat(F.lit("App"), text((F.col("k") + i) % 30)).alias("name"))

    def group(name, *methods):
        return F.struct(F.lit(name).alias("group_name"), F.array(*methods).alias("payment_methods"))

    liked, quick = group("preferred", method(0), method(1), method(2)), group("single_click", method(3))
    shown = (F.when(F.col("k") < 30, F.to_json(F.array(liked, quick))).when(F.col("k") < 80, F.to_json(F.array(liked)))
             .when(F.col("k") < 90, "[]").otherwise(F.to_json(F.array(group("others", method(1))))))
    basic = F.struct("sid", F.concat("sid", F.lit("/"), text(F.floor(F.hour("ts") / 6))).alias("request_id"))
    return e.select(
        "dt", F.unix_micros(F.col("ts").cast("timestamp")).alias("time_stamp"),
        F.when(F.col("event_type") == "error", "OTHER").otherwise("SW-FOOD").alias("tenant"), text("user_id").alias("customer_id"),
        F.to_json(basic).alias("basic_data"), F.to_json(F.struct(page.alias("page_visited"))).alias("additional_details"),
        shown.alias("payment_group"))


def intent_apps(spark: SparkSession, folder: str) -> DataFrame:
    return load(spark, folder, "nation").select(F.concat(F.lit("app"), text("n_nationkey")).alias("package_name"),
                                                F.col("n_name").alias("intent_app"))


def _state(spark, folder):
    return plan.payment_sessions(place_orders(spark, folder), payment_api(spark, folder), WINDOW)


def payment_state(spark: SparkSession, folder: str) -> DataFrame:
    return _state(spark, folder).select(
        day_text("dt").alias("dt"), "sid", "request_id", "page", F.coalesce("dp_sid", F.lit("")).alias("dp_sid"), "finalflag",
        "s_finalflag", "p_flag", "p_session_flag", "pref_flag", "preferred_flag", F.coalesce("turbo_flag", F.lit("")).alias("turbo_flag"),
        F.coalesce("turbo_type", F.lit("")).alias("turbo_type"))


def _options(spark, folder, state):
    return plan.payment_options(state, intent_apps(spark, folder), WINDOW)


def payment_options(spark: SparkSession, folder: str) -> DataFrame:
    return _options(spark, folder, _state(spark, folder)).withColumn("dt", day_text("dt"))


def _fact(spark: SparkSession, folder: str) -> DataFrame:
    e = _events(spark, folder)
    bought = e.filter(F.col("event_type") == "purchase")
    checkout = e.select("dt", "user_id", F.to_json(F.struct("sid")).alias("basic_data"),
                        F.concat(F.lit(" nation_"), text(F.col("user_id") % 30), F.lit(" ")).alias("city"))
    orders = bought.select(
        "dt", "sid", F.when(F.col("value") > 50, "done").otherwise("open").alias("post_status"), F.col("event_id").alias("order_id"),
        F.lit("card").alias("composite_payment_method"), F.lit("gate").alias("payment_gateway"), F.col("k").alias("restaurant_id"),
        F.when(F.col("value") > 200, 1).otherwise(0).alias("ignore_order_flag"))
    paid = bought.select("dt", F.concat(F.lit("t"), text("event_id")).alias("order_id"),
                         F.to_json(F.struct(F.lit("a, b").alias("note"), text("event_id").alias("omsOrderId"))).alias("payment_details"))
    cities = load(spark, folder, "nation").select(
        F.when(F.col("n_regionkey") != 4, F.concat(F.lit("tier"), text("n_regionkey"))).alias("classification"),
        F.col("n_name").alias("city_name"), F.when(F.col("n_regionkey") < 2, "1").otherwise("2").alias("launch_version"))
    path = fresh_path(spark, "transactions")
    paid.write.option("header", True).option("escape", '"').csv(path)
    paid = read_csv(spark, path, "dt date, order_id string, payment_details string")
    state = _state(spark, folder)
    return plan.session_fact(checkout, state, _options(spark, folder, state), orders, paid, cities, WINDOW)


def session_fact(spark: SparkSession, folder: str) -> DataFrame:
    return _fact(spark, folder).withColumn("dt", day_text("dt"))


def loaded_session_fact(spark: SparkSession, folder: str) -> DataFrame:
    """The window loaded twice over a target with the same rows a month and 400 days back: the month stays, the rest is purged."""
    path = fresh_path(spark, "session_fact_target")
    with scope(spark):
        fact = stage(_fact(spark, folder), "fact")
        for back in (400, 30):
            earlier = RunWindow(WINDOW.start - timedelta(days=back), WINDOW.end - timedelta(days=back))
            plan.load_session_fact(fact.withColumn("dt", F.date_sub("dt", back)), path, earlier)
        for _ in range(2):
            plan.load_session_fact(fact, path, WINDOW)
    return spark.read.parquet(path).withColumn("dt", day_text("dt"))


def scan_window(spark: SparkSession, folder: str) -> DataFrame:
    """All days by closed interval, the days up to a timestamp bound (its last day ends at midnight), and one single day."""
    ev = load(spark, folder, "events").withColumn("day", F.to_date("ts"))
    rows = (in_window(ev, "day", WINDOW).select("day", F.lit("date").alias("kind"), "value")
            .unionByName(in_window(ev, "ts", RunWindow(date(2024, 1, 5), date(2024, 1, 20))).select("day", F.lit("time").alias("kind"), "value"))
            .unionByName(on_day(ev, "day", date(2024, 1, 10)).select("day", F.lit("single").alias("kind"), "value")))
    return rows.groupBy("kind", day_text("day").alias("day")).agg(F.count("*").alias("n_rows"), F.round(F.sum("value"), 2).alias("total"))


def latest_event(spark: SparkSession, folder: str) -> DataFrame:
    """Each user's last event by id."""
    rows = last_event(load(spark, folder, "events"), "user_id", "event_id")
    return rows.select("user_id", "event_id", "event_type", time_text(F.date_trunc("second", "ts")).alias("at"), F.round("value", 2).alias("value"))


def session_state(spark: SparkSession, folder: str) -> DataFrame:
    """Last non-error event of each user day that has a click, with the day's flags: filter first, then rank."""
    ev = load(spark, folder, "events").withColumn("day", F.to_date("ts"))
    flag = lambda kind: F.when(F.col("event_type") == kind, 1).otherwise(0)
    rows = spread(ev, ["user_id", "day"], {"n_events": F.count("*"), "has_click": F.max(flag("click")), "has_buy": F.max(flag("purchase"))})
    kept = rows.filter((F.col("has_click") == 1) & (F.col("event_type") != "error"))
    return top1(kept, ["user_id", "day"], [F.col("ts").desc(), F.col("event_id").desc()]).select(
        "user_id", day_text("day").alias("day"), "event_id", "event_type", "n_events", "has_buy")


QUERIES = {
    "scan_window": scan_window, "latest_event": latest_event, "session_state": session_state, "payment_state": payment_state,
    "payment_options": payment_options, "session_fact": session_fact, "loaded_session_fact": loaded_session_fact,
}

_E = """e AS (SELECT event_id, event_type AS t, value AS v, user_id AS u, CAST(ts AS DATE) AS dt, ts,
    's' || user_id || '-' || strftime(ts, '%Y%m%d') AS sid, CAST(json_extract(props, '$.k') AS INTEGER) AS k FROM events
    WHERE CAST(ts AS DATE) BETWEEN DATE '2024-01-03' AND DATE '2024-01-27')"""
_STATE = """po AS (SELECT DISTINCT sid, dt, sid AS dp FROM e WHERE t = 'purchase' AND v < 100),
api AS (SELECT e.sid, e.dt, ts, k, dp, e.sid || '/' || hour(ts) // 6 AS rid,
          CASE WHEN t = 'view' THEN 'payment' WHEN t IN ('click', 'purchase') THEN 'checkout' ELSE 'cart' END AS page
        FROM e LEFT JOIN po ON po.sid = e.sid AND po.dt = e.dt WHERE t <> 'error'),
flat AS (SELECT * FROM api, (VALUES ('preferred', 0, 79), ('single_click', 0, 29), ('others', 90, 99)) g(grp, lo, hi) WHERE k BETWEEN lo AND hi),
flagged AS (SELECT *, CASE WHEN page = 'payment' THEN 1 ELSE 0 END AS p_flag,
          max(CASE WHEN grp = 'single_click' THEN 1 ELSE 0 END) OVER (PARTITION BY rid) AS ff,
          max(CASE WHEN grp = 'single_click' THEN 1 ELSE 0 END) OVER (PARTITION BY sid) AS sf,
          max(CASE WHEN page = 'payment' THEN 1 ELSE 0 END) OVER (PARTITION BY sid) AS pf,
          max(CASE WHEN grp = 'preferred' THEN 1 ELSE 0 END) OVER (PARTITION BY sid) AS prf FROM flat),
typed AS (SELECT *, CASE WHEN page = 'payment' AND ff = 0 AND sf = 0 THEN 'F' WHEN page = 'checkout' AND ff = 1 AND dp IS NOT NULL THEN 'T'
             WHEN page = 'payment' AND ff = 0 AND sf = 1 THEN 'T' END AS tf,
          CASE WHEN page = 'payment' AND ff = 0 AND sf = 0 THEN 'NA' WHEN page = 'checkout' AND ff = 1 AND dp IS NOT NULL THEN 'TURBO-SLIDE'
             WHEN page = 'payment' AND ff = 0 AND sf = 1 THEN 'TURBO-CHANGE' END AS tt FROM flagged),
state AS (SELECT * FROM typed WHERE NOT (page = 'checkout' AND dp IS NULL AND pf = 0) AND NOT (page = 'checkout' AND tt IS NULL)
            AND NOT (page = 'payment' AND tt IS NULL)
          QUALIFY row_number() OVER (PARTITION BY sid ORDER BY ts DESC) = 1)"""
_OPTIONS = """m AS (
    SELECT dt, sid, 'preferred' AS grp, i AS idx, k + i AS w, k FROM state, (SELECT CAST(range AS INTEGER) AS i FROM range(3)) WHERE k < 80
    UNION ALL SELECT dt, sid, 'single_click', 0, k + 3, k FROM state WHERE k < 30
    UNION ALL SELECT dt, sid, 'others', 0, k + 1, k FROM state WHERE k >= 90),
named AS (SELECT dt, sid, grp, idx, CASE WHEN w % 2 = 0 THEN 'UPIIntent' ELSE 'Card' || k % 7 END AS code,
            CASE WHEN w % 2 = 0 AND n_name IS NOT NULL THEN n_name WHEN w % 2 <> 0 THEN 'INTENT N.A.' ELSE 'OTHER INTENT APP' END AS app
          FROM m LEFT JOIN nation ON n_nationkey = w % 30),
opts AS (SELECT dt, sid, max(CASE WHEN grp = 'preferred' AND idx = 0 THEN code END) AS ppm1,
            max(CASE WHEN grp = 'preferred' AND idx = 1 THEN code || '-' || app END) AS ppm2,
            max(CASE WHEN grp = 'preferred' AND idx = 2 THEN code || '-' || app END) AS ppm3,
            max(CASE WHEN grp = 'single_click' THEN code END) AS payment_shown_on_turbo FROM named GROUP BY 1, 2)"""

ORACLE = {
    "scan_window": """
        WITH r AS (SELECT CAST(ts AS DATE) AS day, 'date' AS kind, value FROM events WHERE CAST(ts AS DATE) BETWEEN DATE '2024-01-03' AND DATE '2024-01-27'
            UNION ALL SELECT CAST(ts AS DATE), 'time', value FROM events WHERE ts BETWEEN TIMESTAMP '2024-01-05' AND TIMESTAMP '2024-01-20'
            UNION ALL SELECT CAST(ts AS DATE), 'single', value FROM events WHERE CAST(ts AS DATE) = DATE '2024-01-10')
        SELECT kind, strftime(day, '%Y-%m-%d') AS day, count(*) AS n_rows, round(sum(value), 2) AS total FROM r GROUP BY 1, 2""",
    "latest_event": """
        SELECT user_id, event_id, event_type, strftime(date_trunc('second', ts), '%Y-%m-%d %H:%M:%S.%g') AS at, round(value, 2) AS value
        FROM events QUALIFY row_number() OVER (PARTITION BY user_id ORDER BY event_id DESC) = 1""",
    "session_state": """
        WITH r AS (SELECT *, CAST(ts AS DATE) AS d, count(*) OVER w AS n_events,
                max(CASE WHEN event_type = 'click' THEN 1 ELSE 0 END) OVER w AS has_click,
                max(CASE WHEN event_type = 'purchase' THEN 1 ELSE 0 END) OVER w AS has_buy
            FROM events WINDOW w AS (PARTITION BY user_id, CAST(ts AS DATE)))
        SELECT user_id, strftime(d, '%Y-%m-%d') AS day, event_id, event_type, n_events, has_buy FROM r
        WHERE has_click = 1 AND event_type <> 'error' QUALIFY row_number() OVER (PARTITION BY user_id, d ORDER BY ts DESC, event_id DESC) = 1""",
    "payment_state": f"""WITH {_E}, {_STATE} SELECT strftime(dt, '%Y-%m-%d') AS dt, sid, rid AS request_id, page, coalesce(dp, '') AS dp_sid,
        ff AS finalflag, sf AS s_finalflag, p_flag, pf AS p_session_flag, CASE WHEN k < 80 THEN 1 ELSE 0 END AS pref_flag,
        prf AS preferred_flag, coalesce(tf, '') AS turbo_flag, coalesce(tt, '') AS turbo_type FROM state""",
    "payment_options": f"WITH {_E}, {_STATE}, {_OPTIONS} SELECT * REPLACE (strftime(dt, '%Y-%m-%d') AS dt) FROM opts",
    "session_fact": f"""WITH {_E}, {_STATE}, {_OPTIONS},
        c AS (SELECT DISTINCT dt, u, sid, 'nation_' || u % 30 AS city FROM e),
        o AS (SELECT dt, sid, event_id, CASE WHEN v > 50 THEN 'done' ELSE 'open' END AS ps, k FROM e WHERE t = 'purchase' AND v <= 200)
        SELECT strftime(c.dt, '%Y-%m-%d') AS dt, c.u AS user_id, c.sid AS sid_c,
            CASE WHEN n_regionkey IS NULL OR n_regionkey = 4 THEN 'UNCLASSIFIED CITY' ELSE 'TIER' || n_regionkey END AS city_classifier,
            CASE WHEN n_regionkey < 2 THEN upper(n_name) ELSE 'OTHER CITIES' END AS city_name,
            CASE WHEN cart.sid IS NOT NULL THEN 1 ELSE 0 END AS turbo_shown_on_cart, CASE WHEN p.sid IS NOT NULL THEN 1 ELSE 0 END AS is_payment_session,
            CASE WHEN p.sid IS NOT NULL THEN p.tt ELSE 'NA' END AS turbo_type, CASE WHEN p.sid IS NOT NULL THEN p.tf ELSE 'NA' END AS turbo_flag,
            CASE WHEN p.sid IS NOT NULL THEN p.rid ELSE 'NA' END AS request_id,
            CASE WHEN p.sid IS NOT NULL THEN CAST(p.pf AS VARCHAR) ELSE 'NA' END AS p_session_flag,
            CASE WHEN p.sid IS NOT NULL THEN CAST(p.prf AS VARCHAR) ELSE 'NA' END AS preferred_flag,
            CASE WHEN x.sid IS NOT NULL THEN ppm1 ELSE 'NA' END AS ppm1, CASE WHEN x.sid IS NOT NULL THEN ppm2 ELSE 'NA' END AS ppm2,
            CASE WHEN x.sid IS NOT NULL THEN ppm3 ELSE 'NA' END AS ppm3,
            CASE WHEN x.sid IS NOT NULL THEN payment_shown_on_turbo ELSE 'NA' END AS payment_shown_on_turbo,
            CASE WHEN o.sid IS NOT NULL THEN 1 ELSE 0 END AS is_order_session,
            CASE WHEN o.sid IS NOT NULL THEN CAST(event_id AS VARCHAR) ELSE 'NA' END AS order_id, CASE WHEN o.sid IS NOT NULL THEN ps ELSE 'NA' END AS post_status,
            CASE WHEN o.sid IS NOT NULL THEN 'CARD' ELSE 'NA' END AS composite_payment_method,
            CASE WHEN o.sid IS NOT NULL THEN 't' || event_id ELSE 'NA' END AS transactin_id,
            CASE WHEN o.sid IS NOT NULL THEN CAST(o.k AS VARCHAR) ELSE 'NA' END AS restaurant_id
        FROM c LEFT JOIN state p ON c.sid = p.sid AND c.dt = p.dt
        LEFT JOIN (SELECT sid FROM state WHERE sf = 1 AND page = 'checkout') cart ON cart.sid = c.sid
        LEFT JOIN o ON p.sid = o.sid AND c.dt = o.dt LEFT JOIN opts x ON x.sid = c.sid LEFT JOIN nation ON lower(n_name) = c.city""",
}
ORACLE["loaded_session_fact"] = f"""WITH f AS ({ORACLE['session_fact']}) SELECT * FROM f
    UNION ALL SELECT * REPLACE (strftime(CAST(dt AS DATE) - 30, '%Y-%m-%d') AS dt) FROM f"""
