"""Checkout sessions: payment state of a session, payment options shown in it, and the session fact."""

from __future__ import annotations

from datetime import timedelta

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from ..functions.dates import RunWindow, instant
from ..functions.jsonx import field, parse
from ..functions.numbers import if_matched
from ..functions.text import first_match
from ..operators.aggregates import pivot_agg, spread
from ..operators.nested import flatten_typed
from ..operators.ordered import top1
from ..operators.rows import in_window
from ..sources.sinks import purge_before, replace_window
from ..sources.staging import scope, stage

# Fixed values.
TENANTS = ["SW-FOOD", "SW-FOOD-PWA"]
PLACED_FROM = "turbocheckout"
INTENT_METHOD = "UPIIntent"
KEEP_DAYS = 360

GROUPS = "array<struct<group_name:string,payment_methods:array<struct<payment_code:string,enabled:string,name:string>>>>"


def payment_sessions(place_order: DataFrame, payment_api: DataFrame, window: RunWindow) -> DataFrame:
    """One row per session: its last page event that settles whether the fast checkout was used.

    Events are tested first and ranked afterwards, so a session whose last event says nothing falls back
    to an earlier one. Only the group names in ``payment_group`` matter, so the array is tested in place
    instead of multiplying rows. The tested events are staged: a request's flag and its events both come from them, and a
    filter on parsed text would have it parsed once more. Session-wide flags need every event of a session; to keep a huge
    session out of one task, its events first shrink to the latest one per day and combination of flags. What is left meets
    the session's order days (one row per session, no more days than the window has) in the partitioning of its flags.
    The result is staged.
    """
    with scope(place_order.sparkSession) as keep:
        return keep(_settled(place_order, stage(_shown(payment_api, window), "payment_events"), window), "sessions")


def _shown(payment_api: DataFrame, window: RunWindow) -> DataFrame:
    """Payment page events of the window, their JSON parsed once; ``_shown`` where they list any group, else not to be used."""
    named = lambda name: F.exists(F.col("_groups"), lambda g: F.coalesce(g["group_name"] == name, F.lit(False))).cast("int")
    shown = F.size("_groups") > 0
    basic = parse(F.col("basic_data"), "struct<sid:string,request_id:string>", strict=True)
    return (in_window(payment_api, "dt", window).filter(F.col("tenant").isin(TENANTS))
            .withColumn("_groups", parse(F.col("payment_group"), "array<struct<group_name:string>>"))
            .withColumn("_basic", F.when(shown, basic))
            .select("dt", F.when(shown, instant(F.col("time_stamp"))).alias("time_stamp"), F.col("_basic.request_id").alias("request_id"),
                    F.col("_basic.sid").alias("sid"), field(F.col("additional_details"), "page_visited").alias("page"), "payment_group",
                    named("single_click").alias("_tc"), named("preferred").alias("_pref"), shown.alias("_shown")))


def _settled(place_order: DataFrame, events: DataFrame, window: RunWindow) -> DataFrame:
    placed = (in_window(place_order, "dt", window).filter(parse(F.col("request_params"), "struct<place_order_source:string>", strict=True)["place_order_source"] == PLACED_FROM)
              .groupBy("sid").agg(F.collect_set("dt").alias("_days")))
    events = spread(events.filter("_shown").drop("_shown"), ["request_id"], {"finalflag": F.max("_tc")})
    kind = F.when(F.col("page").isin("payment", "checkout"), F.col("page")).otherwise(F.when(F.col("page").isNotNull(), "other"))
    newest = [F.col("time_stamp").desc_nulls_first(), F.col("request_id").desc_nulls_last(), F.col("page").desc_nulls_last(),
              F.col("payment_group").desc_nulls_last()]
    few = (top1(events.withColumn("_kind", kind), ["sid", "dt", "_kind", "finalflag", "_tc", "_pref"], newest)
           .join(placed, "sid", "left").withColumn("dp_sid", F.when(F.array_contains("_days", F.col("dt")), F.col("sid"))))
    session = Window.partitionBy("sid")
    p_flag = F.when(F.col("page") == "payment", 1).otherwise(0)
    few = few.withColumns({"p_flag": p_flag}).withColumns({
        "s_finalflag": F.max("_tc").over(session),
        "p_session_flag": F.max("p_flag").over(session),
        "preferred_flag": F.max("_pref").over(session),
    })
    page, final, s_final = F.col("page"), F.col("finalflag"), F.col("s_finalflag")
    paid_plain = (page == "payment") & (final == 0) & (s_final == 0)
    slid = (page == "checkout") & (final == 1) & F.col("dp_sid").isNotNull()
    changed = (page == "payment") & (final == 0) & (s_final == 1)
    few = few.withColumns({
        "turbo_flag": first_match([(paid_plain, F.lit("F")), (slid, F.lit("T")), (changed, F.lit("T"))]),
        "turbo_type": first_match([(paid_plain, F.lit("NA")), (slid, F.lit("TURBO-SLIDE")), (changed, F.lit("TURBO-CHANGE"))]),
    })
    unknown = F.col("turbo_type").isNull()
    settled = (~((page == "checkout") & F.col("dp_sid").isNull() & (F.col("p_session_flag") == 0))
               & ~((page == "checkout") & unknown) & ~((page == "payment") & unknown))
    return (top1(few.filter(settled), ["sid"], newest)
            .select("dt", "request_id", "sid", "finalflag", "s_finalflag", "page", "dp_sid", "p_flag", "p_session_flag",
                    F.col("_pref").alias("pref_flag"), "preferred_flag", "turbo_flag", "turbo_type", "payment_group"))


def payment_options(sessions: DataFrame, intent_apps: DataFrame, window: RunWindow) -> DataFrame:
    """Day x session: first three preferred methods and the one-click method on offer."""
    shown = (in_window(sessions, "dt", window).withColumn("_groups", parse(F.col("payment_group"), GROUPS))
             .select("dt", "sid", "_groups"))
    methods = flatten_typed(flatten_typed(shown, "_groups", "g", "group_index")
                            .select("dt", "sid", F.col("g.group_name").alias("group_name"), F.col("g.payment_methods").alias("_m")),
                            "_m", "m", "payment_index")
    methods = methods.select("dt", "sid", "group_name", "payment_index", F.col("m.payment_code").alias("payment_name"),
                             F.lower("m.name").alias("app"))
    apps = intent_apps.select(F.col("package_name").alias("app"), F.col("intent_app").alias("_intent"), F.lit(True).alias("_known"))
    code = F.col("payment_name")
    methods = methods.join(apps, "app", "left").withColumn("intent_app", first_match([
        ((code == INTENT_METHOD) & F.col("_known"), F.col("_intent")),
        (code != INTENT_METHOD, F.lit("INTENT N.A.")),
    ], F.lit("OTHER INTENT APP")))
    at = lambda group, i: (F.col("group_name") == group) & (F.col("payment_index") == i)
    with_app = F.concat(code, F.lit("-"), F.col("intent_app"))
    return pivot_agg(methods, ["dt", "sid"], {
        "ppm1": (at("preferred", 0), code, F.max),
        "ppm2": (at("preferred", 1), with_app, F.max),
        "ppm3": (at("preferred", 2), with_app, F.max),
        "payment_shown_on_turbo": (at("single_click", 0), code, F.max),
    })


def session_fact(checkout: DataFrame, sessions: DataFrame, options: DataFrame, orders: DataFrame, transactions: DataFrame,
                 cities: DataFrame, window: RunWindow) -> DataFrame:
    """Checkout session (day, user, session, city) with payment state, options, order and city class.

    Session state and options are both one row per session, so they meet once and reach the checkout rows
    in a single join on the session id; the day test becomes a match flag. Orders hang on the payment
    session, so a checkout without one has no order. Most checkouts have none: orders take their transaction before they meet
    the checkouts, by the checkout's own session id, since all rows without a match would share the key NULL and one task.
    """
    base = (in_window(checkout, "dt", window)
            .select("dt", "user_id", field(F.col("basic_data"), "sid").alias("sid_c"),
                    F.trim(F.lower("city")).alias("city_key")).distinct())
    state = (sessions.select("sid", F.col("dt").alias("p_dt"), "turbo_type", "turbo_flag", "request_id", "p_session_flag",
                             "preferred_flag", ((F.col("s_finalflag") == 1) & (F.col("page") == "checkout")).alias("_on_cart"))
             .join(options.drop("dt").withColumnRenamed("sid", "pa_sid"), F.col("sid") == F.col("pa_sid"), "left"))
    placed = (in_window(orders, "dt", window).filter(F.col("ignore_order_flag") == 0)
              .select("dt", F.col("sid").alias("sid_o"), F.col("order_id").cast("string").alias("order_id"), "post_status",
                      F.upper("composite_payment_method").alias("composite_payment_method"), "restaurant_id"))
    paid = (in_window(transactions, "dt", window)
            .select("dt", F.col("order_id").alias("transactin_id"), field(F.col("payment_details"), "omsOrderId").alias("oms_order_id")))
    classes = cities.select(F.upper("classification").alias("_class"), F.trim(F.lower("city_name")).alias("city_key"),
                            F.upper(F.trim(F.lower("city_name"))).alias("_city"), "launch_version")

    bought = (placed.withColumnRenamed("dt", "o_dt")
              .join(paid.withColumnRenamed("dt", "t_dt"), (F.col("order_id") == F.col("oms_order_id")) & (F.col("o_dt") == F.col("t_dt")), "left"))
    out = (base.join(state, F.col("sid_c") == F.col("sid"), "left")
           .withColumn("p_sid", F.when(F.col("p_dt") == F.col("dt"), F.col("sid")))
           .join(bought, F.col("p_sid").isNotNull() & (F.col("sid_c") == F.col("sid_o")) & (F.col("dt") == F.col("o_dt")), "left")
           .join(classes, "city_key", "left"))
    from_session = {c: if_matched(F.col("p_sid"), F.col(c).cast("string")) for c in
                    ("turbo_type", "turbo_flag", "request_id", "p_session_flag", "preferred_flag")}
    from_options = {c: if_matched(F.col("pa_sid"), F.col(c).cast("string")) for c in ("ppm1", "ppm2", "ppm3", "payment_shown_on_turbo")}
    from_order = {c: if_matched(F.col("sid_o"), F.col(c).cast("string")) for c in
                  ("order_id", "post_status", "composite_payment_method", "transactin_id", "restaurant_id")}
    one = lambda test: F.when(test, 1).otherwise(0)
    return out.select(
        "dt", "user_id", "sid_c",
        F.coalesce("_class", F.lit("UNCLASSIFIED CITY")).alias("city_classifier"),
        F.when(F.col("launch_version") == "1", F.col("_city")).otherwise("OTHER CITIES").alias("city_name"),
        one(F.col("_on_cart")).alias("turbo_shown_on_cart"),
        one(F.col("p_sid").isNotNull()).alias("is_payment_session"),
        *[v.alias(c) for c, v in from_session.items()], *[v.alias(c) for c, v in from_options.items()],
        one(F.col("sid_o").isNotNull()).alias("is_order_session"), *[v.alias(c) for c, v in from_order.items()])


def load_session_fact(fact: DataFrame, path: str, window: RunWindow) -> None:
    """Replace the window's days in the target and drop days past retention."""
    replace_window(fact, path, "dt", window)
    purge_before(fact.sparkSession, path, "dt", window.start - timedelta(days=KEEP_DAYS))
