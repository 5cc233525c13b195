"""Reports on hand-made rows: the edge cases where a wrong reading gives a wrong answer without failing."""

import json
from datetime import date, datetime
from decimal import Decimal

import pytest
from pyspark.sql import functions as F

from millrace.functions.dates import RunWindow
from millrace.plans import capacity, checkout_sessions, item_shortage, members, payment_ledger, player_score, sales_summary, store_orders

DAY = date(2024, 1, 31)
DAY_MS = 1_706_659_200_000


def ledger_input(spark, *rows):
    schema = ("order_id string, pg_chargeback string, pg_chargeback_reversal string, pg_refund string, pg_transaction string, "
              "created_at timestamp, transaction_id string, lob string, updated_at timestamp")
    return spark.createDataFrame([(*r[:5], None, None, "food", r[5]) for r in rows], schema)


def test_ledger_rows(spark):
    one = json.dumps([{"pg": "(p)", "utr": '["U1"]', "paymentMode": "upi", "pgTransactionAmount": None}])
    noon = datetime(2024, 1, 30, 12)
    df = ledger_input(
        spark, ("1", one, None, "[]", one, noon), ("1", one, None, "[]", one, noon), ("2", None, None, None, one, datetime(2024, 1, 29)),
        ("3", None, None, None, one, datetime(2024, 1, 31)), ("4", None, None, None, one, datetime(2024, 1, 31, 1)),
        ("5", None, None, None, one, datetime(2024, 1, 28, 23)))
    out = payment_ledger.payment_ledger(df, RunWindow(date(2024, 1, 29), DAY))
    assert out.columns == payment_ledger.COLUMNS
    got = sorted((r.order_id, r.description, r.pg, r.utr, r.gross_txn_value, r.createdby, r.txn_id, r.created_at) for r in out.collect())
    row = lambda o, d: (o, d, "p", "U1", "", "upi", "", "")
    assert got == [row("1", "PG_CHARGEBACK"), row("1", "PG_TRANSACTION"), row("2", "PG_TRANSACTION"), row("3", "PG_TRANSACTION")]


def test_ledger_bad_json(spark):
    df = ledger_input(spark, ("1", "[oops", None, None, '[{"pg":"a"}]', datetime(2024, 1, 30)))
    with pytest.raises(Exception, match="MALFORMED"):
        payment_ledger.payment_ledger(df, RunWindow.day(date(2024, 1, 30))).collect()
    assert payment_ledger.payment_ledger(df, RunWindow(date(2024, 1, 30), DAY), strict=False).count() == 1


def test_ledger_is_distinct_with_and_without_repeated_payments(spark, rows, monkeypatch):
    """Payments that other rows repeat, a few or many, and those that none does; key order and number form make no element."""
    a, b = '[{"pg":"a","pgTransactionAmount":1.50},{"pgTransactionAmount":1.5,"pg":"a"},{"pg":"b"}]', '[{"pg":"b"},{"pg":"c"}]'
    noon, window = datetime(2024, 1, 30, 12), RunWindow(date(2024, 1, 30), DAY)
    apart = [(str(i), a, None, b, a, noon) for i in range(5)]
    found = lambda df: rows(payment_ledger.payment_ledger(df, window).select("order_id", "description", "pg"))
    each = [("PG_CHARGEBACK", "a"), ("PG_CHARGEBACK", "b"), ("PG_REFUND", "b"), ("PG_REFUND", "c"), ("PG_TRANSACTION", "a"), ("PG_TRANSACTION", "b")]
    want = [(str(i), *e) for i in range(5) for e in each]
    lone = ledger_input(spark, *apart)
    assert found(lone) == want
    twice = ledger_input(spark, *apart, ("1", None, None, '[{"pg":"c"},{"pg":"d"}]', a, noon), (None, a, None, None, None, noon), (None, a, None, None, None, noon))
    extra = sorted([*want, ("1", "PG_REFUND", "d"), (None, "PG_CHARGEBACK", "a"), (None, "PG_CHARGEBACK", "b")], key=repr)
    assert found(twice) == extra
    monkeypatch.setattr(payment_ledger, "FEW", 0)
    assert found(twice) == extra
    plan = payment_ledger.payment_ledger(lone, window)._jdf.queryExecution().executedPlan().toString()
    assert "Exchange" not in plan  # no other row has a part in a lone payment


def test_ledger_reads_an_array_and_not_each_element(spark):
    """What is parsed is parsed before the elements become rows."""
    df = ledger_input(spark, ("1", None, None, None, '[{"pg":"a"}]', datetime(2024, 1, 30)))
    plan = payment_ledger.payment_ledger(df, RunWindow(date(2024, 1, 30), DAY))._jdf.queryExecution().executedPlan().toString()
    above, _, generate = plan.partition("Generate ")
    assert "from_json" not in above and "from_json" in generate


def states(spark, *rows):
    """(order, slotted, minute of the day, state[, metadata, itemdetails])"""
    full = [(DAY, o, s, DAY_MS + m * 60_000, DAY_MS + m * 60_000, st, "s1", *(rest or [None, None])) for o, s, m, st, *rest in rows]
    return spark.createDataFrame(full, "dt date, orderjobid string, slotted string, timestamp long, time_stamp long, state string, storeid string, "
                                       "metadata string, itemdetails string")


def test_temperature_any_true_wins(spark, rows):
    item = lambda *flags: json.dumps([{"perishable": f} for f in flags])
    df = states(spark, ("a", "F", 1, "x", None, item("true", "false")), ("b", "F", 1, "x", None, item("false", "false")),
                ("b", "F", 61, "x", None, item("false")), ("c", "F", 1, "x", None, item(None)))
    out = store_orders.temperature_flags(df, RunWindow.ending(DAY, 1))
    assert rows(out) == [(DAY, "false", "b"), (DAY, "false", "b"), (DAY, "true", "a")]


def test_state_names_are_lowered_into_state(spark, rows):
    out = store_orders.order_state_events(states(spark, ("a", "F", 1, "PICKING"), ("a", "F", 1, "Other")), DAY)
    assert rows(out.select("orderjobid", "state")) == [("a", "picking")]


def test_reduced_quantities(spark, rows):
    doc = lambda old, new: json.dumps({"oldItems": [{"skuId": k, "quantity": q} for k, q in old], "newItems": [{"skuId": k, "quantity": q} for k, q in new]})
    df = states(
        spark, ("a", "F", 1, "PICKED", doc([("x", 2), ("x", 3), ("y", 1), ("z", 1)], [("x", 4), ("z", 2)]), None),
        ("a", "F", 5, "PICKED", doc([("x", 50)], []), None), ("b", "F", 1, "PICKED", doc([("x", 1)], [("x", 1)]), None), ("c", "F", 1, "picked", doc([("x", 9)], []), None))
    assert rows(store_orders.reduced_quantities(df, DAY)) == [("a", 1, 2.0)]


def order_context(spark):
    info = lambda name: json.dumps({"storeInfo": {"id": "9", "name": name, "storeType": "Listed"}})
    events = spark.createDataFrame(
        [(DAY, "a", 1, "PLACED", "BUY", "c", 0, info("other")), (DAY, "a", 2, "DELIVERY_DELIVERED", "BUY", "c", 0, info("Instacart")),
         (DAY, "a", 3, "LATER", "NOT BOUGHT", "c", 0, info("other")), (DAY, "b", 1, "DELIVERY_DELIVERED", "BUY", "c", 0, info("other"))],
        "dt date, id string, event_id long, status string, job_type string, city string, created_at long, metadata_json string")
    confirm = spark.createDataFrame([(DAY, "a", DAY_MS + 600_900, "BUY", "CONFIRMED"), (DAY, "a", DAY_MS, "BUY", "NO")],
                                    "dt date, job_id string, time_stamp long, type string, status string")
    hole = spark.createDataFrame([], "dt date, object_name string, object_value string, time_stamp timestamp")
    city = spark.createDataFrame([("Town", "9", "InstaCart")], "city string, store_id string, store_name string")
    logs = spark.createDataFrame([(DAY, "a", DAY_MS + 3_000_000, "DELIVERY_ARRIVED"), (DAY, "a", DAY_MS + 2_940_000, "delivery_arrived")],
                                 "dt date, job_id string, time_stamp long, status string")
    temps = spark.createDataFrame([(DAY, "true", "a")], "dt date, temp_sens string, orderjobid string")
    return events, confirm, hole, city, logs, temps


def test_order_time_legs(spark):
    events = states(spark, ("a", "TRUE", 11, "Picking"), ("a", "TRUE", 12, "picking"), ("a", None, 13, "ASSIGNED"), ("a", "TRUE", 14, "assigned"),
                    ("a", "TRUE", 20, "picked"), ("b", "TRUE", 11, "picking"), ("c", "TRUE", 11, "picked"))
    got = [r.asDict() for r in store_orders.order_time_legs(events, *order_context(spark)[:5], order_context(spark)[5], DAY).collect()]
    assert len(got) == 1
    r = got[0]
    assert (r["orderjobid"], r["store_id"], r["city"], r["status"], r["del_flag"], r["temp_sens"], r["ftr_flag"]) == ("a", "9", "Town", "DELIVERY_DELIVERED", 1, "true", 0)
    assert (r["o2p"], r["o2a"], r["c2p"], r["hr"], r["unassigned_flag"], r["p2b"]) == (2.0, 3.0, 8.0, 0, None, None)
    assert r["de_arrived"] == datetime(2024, 1, 31, 0, 49) and r["ordered_time"] == datetime(2024, 1, 31, 0, 10)


@pytest.mark.parametrize("minute, reason", [(10.5, "O2C"), (10.4, "P2B")])
def test_leg_alert_limits(spark, minute, reason):
    ready = int(DAY_MS + 600_000)
    at = lambda m: ready + int((m - 10) * 60_000)
    full = [(DAY, "a", "FALSE", at(m), at(m), s, "s", None, None) for m, s in ((minute, "picking"), (11, "picked"), (11.5, "delivery_ready"))]
    events = spark.createDataFrame(full, states(spark, ("a", "F", 1, "x")).schema)
    e, confirm, hole, city, logs, temps = order_context(spark)
    active = spark.createDataFrame([("9", "Instacart", date(2024, 1, 29))], "store_id string, type string, dt date")
    outlets = spark.createDataFrame([(9, "Old", date(2023, 1, 1)), (9, "New", date(2024, 1, 1))], "store_id int, outlet_name string, date date")
    out = store_orders.time_leg_alerts(events, e, confirm, hole, city, logs, temps, active, outlets, DAY, date(2024, 1, 29), datetime(2024, 1, 31)).collect()
    assert [(r.reason, r.store_name, r.alert_status) for r in out] == [(reason, "New", "alert")]


def test_capacity(spark, rows):
    hours = spark.range(24).select(F.col("id").cast("int").alias("hour"))
    stores = spark.createDataFrame([("T", 1, "Instacart", 1), ("T", 2, "Instacart", 0), ("T", 3, "x", 1)], "city string, store_id int, store_name string, active int")
    open_ = spark.createDataFrame([(0, 1, "08:00:00", "10:00:00", None), (1, 1, "00:00:00", "23:30:00", None)],
                                  "day_id int, store_id string, open_time string, close_time string, deleted_time timestamp")
    caps = spark.createDataFrame(
        [("1", "true", "default", 5, 1), ("a_b_1", "true", "mfr", 7, 2), ("1", "true", "09:00-12:00-weekend", 50, None), ("1", "true", "08:00-12:00-weekday", 60, None)],
        "storeid string, enabled string, slot string, threshold int, cooldown int").withColumns(
        {"stressratiothreshold": F.lit(1.0), "stressratiocooldown": F.lit(2.0)})
    sunday = date(2024, 1, 7)
    out = capacity.store_hour_capacity(hours, stores, open_, caps, sunday)
    assert rows(out.select("storeid", "hr", "day_id", "capacity_type", "threshold", "cooldown")) == [
        ("1", 8, "0", "Pre-MFR", 5, 1), ("1", 8, "0", "RFD", 7, 2), ("1", 9, "0", "Pre-MFR", 50, 1), ("1", 9, "0", "RFD", 7, 2)]


def test_combo_kinds_and_stock(spark, rows):
    combos = spark.createDataFrame([("sp", "p1", "s", "c1", 2), ("sp", "p2", "s", "c1", 1), ("sp", "p3", "s", "c2", 1), ("sp", "p3", "x", "c3", 1)],
                                   "combo_spin string, const_sku string, store_id string, combo_sku string, const_qty int")
    out = item_shortage.combo_parts(combos, spark.createDataFrame([("s",)], "store_id string"))
    assert rows(out.select("combo_sku_id", "const_sku_id", "combo_type")) == [("c1", "p1", "hetero"), ("c1", "p2", "hetero"), ("c2", "p3", "homo")]
    closing = spark.createDataFrame([("k", 3, datetime(2024, 1, 29, 1), date(2024, 1, 29), "A"), ("k", 4, datetime(2024, 1, 29, 2), date(2024, 1, 29), "B"),
                                     ("k", 9, datetime(2024, 1, 29), date(2024, 1, 29), "#inwarding_area"), ("k", 9, datetime(2024, 1, 28), date(2024, 1, 28), "A")],
                                    "sku string, sellable int, update_time timestamp, insert_date date, loc string")
    current = spark.createDataFrame([("k", 5, None, DAY_MS), ("k", 5, 2, DAY_MS + 1000), ("k", 1, 0, DAY_MS - 3 * 86_400_000)],
                                    "sku string, sellable int, ordered int, sellable_updated long")
    assert rows(item_shortage.stock_levels(closing, current, DAY)) == [
        ("k", 3, datetime(2024, 1, 31, 0, 0, 1)), ("k", 5, datetime(2024, 1, 31)), ("k", 7, datetime(2024, 1, 29, 2))]


@pytest.mark.parametrize("orders, changed, percent, alert", [(1000, 7, 99.3, "no_alert"), (100, 1, 99.0, "alert")])
def test_fill_rate_limit(spark, orders, changed, percent, alert):
    ids = spark.range(orders).select(F.concat(F.lit("o"), "id").alias("orderjobid"), "id")
    doc = F.when(F.col("id") < changed, '{"oldItems":[{"skuId":"x","quantity":2}],"newItems":[]}').otherwise(
        '{"oldItems":[{"skuId":"x","quantity":2},{"skuId":"y","quantity":0}],"newItems":[{"skuId":"x","quantity":2}]}')
    picked = ids.select(F.lit(DAY).alias("dt"), F.lit("7").alias("storeid"), F.lit("PICKED").alias("state"), "orderjobid", doc.alias("metadata"))
    logs = ids.select(F.lit(DAY).alias("dt"), F.col("orderjobid").alias("job_id"), F.lit("7").alias("store_id"),
                      F.explode(F.array(F.lit("PLACED"), F.lit("DELIVERY_DELIVERED"), F.lit("PLACED"))).alias("status"),
                      F.lit(datetime(2024, 1, 31)).alias("update_time"))
    out = item_shortage.fill_rate_alert(
        picked, logs, spark.createDataFrame([(7,)], "store_id int"), spark.createDataFrame([(7, DAY), (3141, DAY)], "store_id int, date date"),
        spark.createDataFrame([(7, "T", "A", date(2024, 1, 1)), (7, "T", "B", date(2024, 1, 1)), (7, "T", "C", date(2023, 1, 1))],
                              "store_id int, city string, outlet_name string, date date"), DAY, datetime(2024, 1, 31)).collect()
    assert sorted((r.store_name, r.order_count, r.ftr_count, r.ftr_percent, r.alert_status, r.mim_store_identifier) for r in out) == [
        (n, orders, changed, percent, alert, 1) for n in ("A", "B")]


PLAYER = ("playerid long, firstname string, location string, amntbet decimal(18,2), total_no_games decimal(38,0), time_spent decimal(38,0), "
          "value_of_promotions_used decimal(18,2), visit_frequency_days decimal(38,0), risk_category string, age string")


def test_player_tiers(spark):
    D = Decimal
    p = lambda i, name, loc, games, time, visits, age, risk="High": (i, name, loc, D(500), D(games), D(time), D(0), D(visits), risk, age)
    df = spark.createDataFrame([
        p(1, "Ann", "York", 100, 125, 0, "25"), p(2, "A1", "New York", 100, 125, 0, "30"), p(3, None, None, 100, 125, 0, "30"),
        p(4, "Bob", "york", 100, 50, 0, "abc"), p(5, "Cy", None, 100, 0, 0, "20"), p(6, "Di", "x", 1, 1, 0, "x", "Low"), (None, *p(7, "No", "x", 1, 1, 0, "1")[1:])], PLAYER)
    out = {r.playerid: r for r in player_score.player_report(df, keyword=None).collect()}
    assert {k: v.playertier for k, v in out.items()} == {1: "Gold", 2: "Newbie", 3: "Newbie", 4: "Bronze", 5: "Bronze", 6: "Newbie"}
    assert out[1].engagementscore == 80.0 and out[4].engagementscore == 50.0 and out[3].namehasdigits is None
    assert [out[k].playerrank for k in (1, 2, 3, 4, 5, 6)] == [1, 2, 3, 4, 5, 6]
    keyed = {r.playerid: r.playertier for r in player_score.player_report(df, keyword="YORK").collect()}
    assert keyed == {1: "Gold", 2: "Silver", 4: "Silver"}
    assert [r.playerid for r in player_score.player_report(df, risk="Low").collect()] == [6]
    assert player_score.player_report(df, min_bet=501).count() == 0


def payment_events(spark, *rows):
    """(sid, request, time, page, groups)"""
    full = [(DAY, t, "SW-FOOD", "u", json.dumps({"sid": s, "request_id": q}), json.dumps({"page_visited": p}),
             json.dumps([{"group_name": g, "payment_methods": []} for g in groups])) for s, q, t, p, groups in rows]
    return spark.createDataFrame(full, "dt date, time_stamp long, tenant string, customer_id string, basic_data string, additional_details string, payment_group string")


def test_session_falls_back_to_the_event_that_settles_it(spark, rows):
    api = payment_events(
        spark, ("s1", "r1", 1, "payment", ["preferred"]), ("s1", "r2", 2, "checkout", ["preferred"]),
        ("s2", "r3", 1, "checkout", ["single_click"]), ("s2", "r3", 2, "payment", ["x"]), ("s3", "r5", 1, "payment", []),
        ("s4", "r6", 1, "checkout", ["single_click"]), ("s5", "r7", 1, "payment", ["x"]), ("s5", "r8", 2, "cart", ["single_click"]), ("s5", "r9", 3, "payment", ["x"]))
    placed = spark.createDataFrame([(DAY, "s2", '{"place_order_source":"turbocheckout"}'), (DAY, "s1", '{"place_order_source":"web"}')],
                                   "dt date, sid string, request_params string")
    out = checkout_sessions.payment_sessions(placed, api, RunWindow.day(DAY))
    assert rows(out.select("sid", "request_id", "page", "turbo_flag", "turbo_type", "s_finalflag", "p_session_flag")) == [
        ("s1", "r1", "payment", "F", "NA", 0, 1), ("s2", "r3", "checkout", "T", "TURBO-SLIDE", 1, 1), ("s5", "r9", "payment", "T", "TURBO-CHANGE", 1, 1)]


def test_session_fact_and_load(spark, rows, tmp_path):
    sessions = spark.createDataFrame([(DAY, "s1", "NA", "F", "r1", 1, 0, 0, "payment"), (date(2024, 1, 30), "s2", "NA", "F", "r2", 1, 0, 1, "checkout")],
                                     "dt date, sid string, turbo_type string, turbo_flag string, request_id string, p_session_flag int, preferred_flag int, s_finalflag int, page string")
    options = spark.createDataFrame([(DAY, "s1", None, "b", None, None)], "dt date, sid string, ppm1 string, ppm2 string, ppm3 string, payment_shown_on_turbo string")
    checkout = spark.createDataFrame([(DAY, "u", json.dumps({"sid": s}), c) for s, c in (("s1", " New Town "), ("s1", "new town"), ("s2", "X"), ("s3", "X"))],
                                     "dt date, user_id string, basic_data string, city string")
    orders = spark.createDataFrame([(DAY, s, "ok", i, "card", "g", 5, flag) for s, i, flag in (("s1", 1, 0), ("s3", 2, 0), ("s1", 3, 1))],
                                   "dt date, sid string, post_status string, order_id int, composite_payment_method string, payment_gateway string, restaurant_id int, ignore_order_flag int")
    paid = spark.createDataFrame([(DAY, "t1", '{"omsOrderId":"1"}'), (DAY, "t9", "{bad")], "dt date, order_id string, payment_details string")
    cities = spark.createDataFrame([("gold", "NEW TOWN", "1")], "classification string, city_name string, launch_version string")
    window = RunWindow.day(DAY)
    out = checkout_sessions.session_fact(checkout, sessions, options, orders, paid, cities, window)
    assert rows(out.select("sid_c", "city_classifier", "city_name", "turbo_shown_on_cart", "is_payment_session", "turbo_flag", "ppm1", "ppm2", "order_id", "transactin_id")) == [
        ("s1", "GOLD", "NEW TOWN", 0, 1, "F", None, "b", "1", "t1"), ("s2", "UNCLASSIFIED CITY", "OTHER CITIES", 1, 0, "NA", "NA", "NA", "NA", "NA"),
        ("s3", "UNCLASSIFIED CITY", "OTHER CITIES", 0, 0, "NA", "NA", "NA", "NA", "NA")]
    path = str(tmp_path / "fact")
    old = out.limit(0).select([F.col(c) for c in out.columns]).unionByName(out.filter("sid_c = 's3'").withColumn("dt", F.lit(date(2023, 2, 4))))
    old.unionByName(out.filter("sid_c = 's3'").withColumn("dt", F.lit(date(2023, 2, 5)))).write.partitionBy("dt").parquet(path)
    for _ in range(2):
        checkout_sessions.load_session_fact(out, path, window)
    assert rows(spark.read.parquet(path).groupBy("dt").count()) == [(date(2023, 2, 5), 1), (DAY, 3)]


def test_session_over_days_has_the_order_of_its_day_only(spark, rows):
    api = payment_events(spark, ("s1", "r1", 1, "checkout", ["single_click"]), ("s2", "r2", 1, "checkout", ["single_click"]),
                         (None, "r4", 1, "checkout", ["single_click"]), ("s3", "r5", 1, "payment", []))
    next_day = payment_events(spark, ("s1", "r1", 2, "checkout", ["single_click"])).withColumn("dt", F.date_add("dt", 1))
    unread = payment_events(spark, ("s4", "r6", 1, "payment", [])).withColumn("basic_data", F.concat(F.lit("{"), "customer_id"))
    api = api.unionByName(next_day).unionByName(unread)
    fast = '{"place_order_source":"turbocheckout"}'
    placed = spark.createDataFrame([(DAY, "s1", fast), (DAY, "s1", fast), (date(2024, 2, 1), "s2", fast), (DAY, None, fast)],
                                   "dt date, sid string, request_params string")
    out = checkout_sessions.payment_sessions(placed, api, RunWindow(DAY, date(2024, 2, 1)))
    assert rows(out.select("dt", "sid", "dp_sid", "turbo_type", "finalflag", "pref_flag")) == [(DAY, "s1", "s1", "TURBO-SLIDE", 1, 0)]
    bad = unread.withColumn("payment_group", F.lit('[{"group_name":"x"}]'))
    with pytest.raises(Exception):
        checkout_sessions.payment_sessions(placed, bad, RunWindow.day(DAY)).collect()


def test_checkouts_without_an_order_share_no_task(spark):
    """rows that match no session or no order must not all go to the task of the key NULL."""
    checkout = spark.range(400).select(F.lit(DAY).alias("dt"), F.col("id").alias("user_id"), F.lit("x").alias("city"),
                                       F.to_json(F.struct(F.concat(F.lit("s"), "id").alias("sid"))).alias("basic_data"))
    sessions = spark.range(0, 400, 2).select(
        F.lit(DAY).alias("dt"), F.concat(F.lit("s"), "id").alias("sid"), F.lit("NA").alias("turbo_type"), F.lit("F").alias("turbo_flag"), F.lit("r").alias("request_id"),
        F.lit(1).alias("p_session_flag"), F.lit(0).alias("preferred_flag"), F.lit(0).alias("s_finalflag"), F.lit("payment").alias("page"))
    options = spark.createDataFrame([], "dt date, sid string, ppm1 string, ppm2 string, ppm3 string, payment_shown_on_turbo string")
    orders = spark.createDataFrame([(DAY, s, "ok", i, "card", "g", 5, 0) for s, i in (("s2", 1), ("s3", 2))],
                                   "dt date, sid string, post_status string, order_id int, composite_payment_method string, payment_gateway string, restaurant_id int, ignore_order_flag int")
    paid = spark.createDataFrame([(DAY, "t1", '{"omsOrderId":"1"}'), (DAY, "t2", '{"omsOrderId":"2"}')], "dt date, order_id string, payment_details string")
    cities = F.broadcast(spark.createDataFrame([("gold", "Y", "1")], "classification string, city_name string, launch_version string"))
    plain = {"spark.sql.adaptive.enabled": "false", "spark.sql.autoBroadcastJoinThreshold": "-1"}
    before = {k: spark.conf.get(k) for k in plain}
    for k, v in plain.items():
        spark.conf.set(k, v)
    try:
        out = checkout_sessions.session_fact(checkout, sessions, options, orders, paid, cities, RunWindow.day(DAY))
        found = out.select("sid_c", "is_payment_session", "order_id", "transactin_id", F.spark_partition_id().alias("task")).collect()
    finally:
        for k, v in before.items():
            spark.conf.set(k, v)
    assert sorted((r.sid_c, r.order_id, r.transactin_id) for r in found if r.order_id != "NA") == [("s2", "1", "t1")]
    assert len(found) == 400 and sum(r.is_payment_session for r in found) == 200
    assert max(sum(r.task == t for r in found) for t in {r.task for r in found}) < 120


def test_sales_fan_out_is_kept(spark):
    sales = spark.createDataFrame([(" a b", "1", "sku1", "o1", v) for v in (" 12 ", "3", "abc", "0", None)] + [("NULL", "NULL", "sku2", "o2", "1")],
                                  "companycode string, statecode string, skucode string, customercode string, volumeactualcase string")
    df = lambda data, schema: spark.createDataFrame(data, schema)
    args = (sales, df([(" a b", " Alpha")], "companycode string, companyname string"), df([("1", " North ")], "statecode string, statename string"),
            df([("sku1", "big can")], "skucode string, itemname string"), df([("1", "sku1", "10"), ("1", "sku1", "x")], "statecode string, skucode string, plan_qty string"),
            df([("o1", 1)], "outlet_code string, active_flag int"),
            df([("sku1", "p", "2024-01-01", "NULL"), ("sku1", "p", "bad", None)], "productlevelcode string, promotiondescription string, effectivefrom string, effectiveto string"), DAY)
    out = {(r.companycode, r.effective_date_range_start): r for r in sales_summary.sales_summary(*args).collect()}
    assert set(out) == {("AB", date(2024, 1, 1)), ("AB", None), ("UNKNOWN", date(1900, 1, 1))}
    r = out[("AB", date(2024, 1, 1))]
    assert (r.total_volumeactualcase, r.total_plan_qty, r.average_volume) == (30.0, 20.0, 7.5)
    assert (r.companyname, r.statename, r.itemname, r.active_flag, r.promotion_desc, r.effective_date_range_end) == ("Alp***", "north", "big_can", "YES", "Promo: p", DAY)
    newest = sales_summary.sales_summary(*args, latest_activation=True).collect()
    assert {(r.companycode, r.effective_date_range_start) for r in newest} == {("AB", None), ("UNKNOWN", date(1900, 1, 1))}


def test_active_members_and_retro(spark, rows):
    d = lambda text: date.fromisoformat(text)
    keys = spark.createDataFrame(
        [("e1", "m1", "QMXBP7971", "A1", "C1", "int", d("2023-01-01"), d("2024-12-31"), d("2023-01-01"), d("2023-01-05")),
         ("e2", "m2", "QMXBP7971", "A1", "C2", "EXT", d("2023-01-01"), d("2024-12-31"), d("2023-01-01"), d("2023-01-05")),
         ("e3", "m1", "other", "A1", "C1", "INT", d("2023-01-01"), d("2024-12-31"), d("2023-01-01"), d("2023-01-05"))],
        "enrollid string, memid string, planid string, ratecode string, carriermemid string, segtype string, effdate date, termdate date, lastupdate date, createdate date")
    coverage = spark.createDataFrame([("e1", "A1", "cc", d("2023-01-01"), d("2024-12-31")), ("e1", "IC00099", "cx", d("2023-01-01"), d("2024-12-31")),
                                      ("e2", "A1", "cc", d("2023-01-01"), d("2024-12-31"))], "enrollid string, ratecode string, coveragecodeid string, effdate date, termdate date")
    member = spark.createDataFrame([("m1", "n1", d("1990-01-31"), "F"), ("m2", "n1", d("1990-01-31"), "F")], "memid string, entityid string, dob date, sex string")
    entity = spark.createDataFrame([("n1", "Doe ", "Jo ", "Member", d("2078-12-31"))], "entid string, lastname string, firstname string, enttype string, termdate date")
    e = members.Enrolment(keys, coverage, member, entity)
    out = members.active_members(e, DAY)
    assert rows(out.select("memid", "memname", "age", "lob", "coveragecodeid")) == [("m1", "Doe, Jo", 34, "MMP", "cc")]


def test_member_keeps_a_row_for_each_case(spark, rows):
    """Two cases, one member without a case; each case row keeps its own acuity with its own phase."""
    df, day = spark.createDataFrame, date.fromisoformat
    active = df([("C1", "m1", "MMP"), ("C1", "m1", "MMP"), ("C2", "m2", "MMP")], "carriermemid string, memid string, lob string")
    case = ("carriermemid string, memid string, lob string, membercid int, acuity string, phase string, `population stream` string, category_name string, "
            "name string, caseid long, casetype string, caseopendate date, lastupdated date")
    streams = df([("C1", "m1", "MMP", 1, "LOW", "Monitoring", "3", "a", "n1", 7, "t", day("2023-01-01"), day("2023-02-01")),
                  ("C1", "m1", "MMP", 1, "Catastrophic", "Active", "1", "b", "n0", 9, "t", day("2022-01-01"), None)], case)
    keys = df([(f"e{i}", f"m{i}", "QMXBP7971", "A1", f"C{i}", "int", day("2023-01-01"), day("2024-12-31"), day("2023-01-01")) for i in (1, 2)],
              "enrollid string, memid string, planid string, ratecode string, carriermemid string, segtype string, effdate date, termdate date, createdate date")
    member = df([(f"m{i}", f"n{i}", f"Jo {i}", day("1990-01-31"), "l") for i in (1, 2)], "memid string, entityid string, fullname string, dob date, primarylanguage string")
    entity = df([(f"n{i}", "", "", "", "", "", "", day("2078-12-31")) for i in (1, 2)],
                "entid string, phyaddr1 string, phyaddr2 string, phycity string, phycounty string, phyzip string, phone string, termdate date")
    none = lambda schema: df([], schema)
    frame = members.member_frame(
        active, streams, members.Enrolment(keys, none("enrollid string"), member, entity), none("memid string, delegate string"),
        none("memid string, currentpcp string, assignedpcp string, paytoname string"), none("memid string, ccacm string, `Login ID` string"),
        none("employee_userid string, employee_supervisorname string"), none("memberid string, datasource string, effdate date, termdate date"),
        df([("l", "lang")], "languageid string, description string"), DAY)
    assert rows(frame.select("memid", "caseid", "ccaacuity", "ccaphase", "ccacasename")) == [
        ("m1", 7, "LOW", "Monitoring", "n1"), ("m1", 9, "Catastrophic", "Active", "n0"), ("m2", None, None, None, None)]


def test_staged_job_events_stand_in_for_the_logs(spark, rows):
    """Staging is idempotent: other days and states go once, the staged rows pass again unchanged."""
    logs = spark.createDataFrame([(DAY, "o1", 1, "PLACED", "s", DAY_MS, "{}"), (DAY, "o1", 2, "Cancelled", "s", None, None), (DAY, "o2", 3, "OPEN", "s", 1, "{}"),
                                  (date(2024, 1, 30), "o3", 4, "PLACED", "s", 1, "{}"), (DAY, None, None, None, None, None, None)],
                                 "dt date, job_id string, time_stamp long, status string, store_id string, update_time long, update_json string")
    once = item_shortage.stock_events(logs, DAY)
    assert [r.status for r in once.orderBy("time_stamp").collect()] == ["placed", "cancelled"]
    assert rows(item_shortage.stock_events(once, DAY)) == rows(once)
