"""Single operators and the sales and player reports on the test tables."""

from __future__ import annotations

from datetime import date

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from ..functions.numbers import if_matched, sum_text
from ..functions.text import classify_like, clean, ieq, like_any, mask_prefix, without_spaces
from ..operators.aggregates import latest_rows as latest_rows_of
from ..operators.joins import cast_key, not_in
from ..operators.ordered import asof_join, global_rank, numbered
from ..plans import player_score, report_loads
from ..plans.members import line_of_business, population_group
from ..plans.sales_summary import sales_summary as build_sales_summary
from ..sources.staging import fresh_path, scope
from ..sources.tables import lookup, read_csv, read_in_order
from .common import day_text, load, rounded, text, time_text

AS_OF = date(2001, 8, 1)


def csv_lookup(spark: SparkSession, folder: str) -> DataFrame:
    """Nations through a CSV file, joined to an inline list of region names."""
    path = fresh_path(spark, "nations")
    load(spark, folder, "nation").write.option("header", True).csv(path)
    nations = read_csv(spark, path, "n_nationkey int, n_name string, n_regionkey int")
    names = lookup(spark, [(0, "south"), (1, "west"), (2, "east")], "n_regionkey int, zone string")
    return nations.join(names, "n_regionkey", "left").select(
        "n_nationkey", "n_name", if_matched(F.col("zone"), F.col("zone")).alias("zone"))


def clean_dims(spark: SparkSession, folder: str) -> DataFrame:
    """Customer volume by cleaned, masked and defaulted dimensions."""
    cust = load(spark, folder, "customer").join(
        load(spark, folder, "nation").select(F.col("n_nationkey").alias("c_nationkey"), "n_name"), "c_nationkey")
    segment = F.when(F.col("c_mktsegment") == "BUILDING", "NULL").otherwise(F.concat(F.lit(" "), F.col("c_mktsegment"), F.lit(" x ")))
    amount = F.when(F.col("c_acctbal") < 0, "n/a").otherwise(F.concat(F.lit(" "), text(F.floor("c_acctbal")), F.lit(" ")))
    rows = cust.select(
        clean(segment, "UNKNOWN", lambda x: F.upper(F.trim(without_spaces(x)))).alias("segment"),
        clean(F.nullif(F.col("n_name"), F.lit("NATION_3")), "UNKNOWN", mask_prefix).alias("nation"),
        clean(segment, "none", lambda x: without_spaces(F.trim(F.lower(x)), "_")).alias("tag"), amount.alias("amount"))
    return rows.groupBy("segment", "nation", "tag").agg(F.count("*").alias("n_rows"), sum_text(F.col("amount")).alias("total"))


def _sales_summary(spark: SparkSession, folder: str, latest: bool = False) -> DataFrame:
    """Every line item is a sale of its customer; parts carry plans and up to two promotions."""
    li, od, cust = (load(spark, folder, t) for t in ("lineitem", "orders", "customer"))
    nation, part = load(spark, folder, "nation"), load(spark, folder, "part")
    buyer = od.select(F.col("o_orderkey").alias("l_orderkey"), F.col("o_custkey").alias("c_custkey"))
    state = F.when(F.col("c_nationkey") == 3, F.lit("NULL")).otherwise(text("c_nationkey"))
    volume = (F.when(F.col("l_linenumber") == 7, "n/a").when(F.col("l_discount") == 0, "0")
              .otherwise(F.concat(F.lit(" "), text(F.col("l_quantity").cast("int")), F.lit(" "))))
    sales = li.join(buyer, "l_orderkey").join(cust, "c_custkey").select(
        F.when(F.col("l_returnflag") != "N", F.concat(F.lit("c "), F.lower("l_returnflag"))).alias("companycode"),
        state.alias("statecode"), text("l_partkey").alias("skucode"), text("c_custkey").alias("customercode"), volume.alias("volumeactualcase"))
    company = lookup(spark, [("c a", " Alpha Ltd"), ("c r", "NULL")], "companycode string, companyname string")
    geography = nation.select(text("n_nationkey").alias("statecode"), F.col("n_name").alias("statename"))
    product = part.select(text("p_partkey").alias("skucode"), F.col("p_name").alias("itemname"))
    plan = part.withColumn("state", F.explode(F.sequence(F.lit(0), F.lit(4)))).select(
        text("state").alias("statecode"), text("p_partkey").alias("skucode"), text("p_size").alias("plan_qty"))
    outlet = cust.select(text("c_custkey").alias("outlet_code"), F.when(F.col("c_acctbal") > 0, 1).otherwise(0).alias("active_flag"))
    promos = F.when(F.col("p_size") > 25, F.array(F.lit(1), F.lit(2))).otherwise(F.array(F.lit(1)))
    activation = part.filter(F.col("p_size") > 10).withColumn("i", F.explode(promos)).select(
        text("p_partkey").alias("productlevelcode"), F.concat(F.lit(" "), F.col("p_type")).alias("promotiondescription"),
        F.when(F.col("i") == 1, "1999-01-01").otherwise("bad date").alias("effectivefrom"), F.lit(None).cast("string").alias("effectiveto"))
    return build_sales_summary(sales, company, geography, product, plan, outlet, activation, AS_OF, latest)


def _shown_sales(out: DataFrame) -> DataFrame:
    return rounded(out, "average_volume").withColumns(
        {c: F.coalesce(day_text(c), F.lit("")) for c in ("effective_date_range_start", "effective_date_range_end")})


def sales_summary(spark: SparkSession, folder: str) -> DataFrame:
    return _shown_sales(_sales_summary(spark, folder))


def latest_activation(spark: SparkSession, folder: str) -> DataFrame:
    """The summary with the newest activation of each SKU alone."""
    return _shown_sales(_sales_summary(spark, folder, latest=True))


def loaded_sales_summary(spark: SparkSession, folder: str) -> DataFrame:
    """The summary appended to a target with other column order, and an empty batch after it that changes nothing."""
    path = fresh_path(spark, "sales_summary")
    out = _sales_summary(spark, folder)
    report_loads.load_sales_summary(out.select(*out.columns[::-1]).limit(0), path)
    report_loads.load_sales_summary(out, path)
    report_loads.load_sales_summary(out.where("false"), path)
    return _shown_sales(spark.read.parquet(path))


RULES = [("%ECONOMY%", "cheap"), (["%pro_o%", "%promo x%"], "campaign"), ("medium%", "middle"), ("%econ%", "never reached")]


def classify_rules(spark: SparkSession, folder: str) -> DataFrame:
    """Rule-table labels of parts, case-blind, with plan and rate classes of their orders' priorities."""
    part = load(spark, folder, "part").select(
        classify_like([F.col("p_type"), F.col("p_name")], RULES, "rest").alias("label"),
        like_any(F.col("p_name"), ["red%", "%bolt"]).cast("int").alias("is_red_or_bolt"),
        ieq(F.col("p_type"), "small").cast("int").alias("is_small"),
        F.when(~F.col("p_name").like("%ring%"), 1).otherwise(0).alias("no_ring"))
    parts = part.groupBy("label", "is_red_or_bolt", "is_small", "no_ring").agg(F.count("*").alias("n_rows"))
    plan = F.when(F.col("o_orderpriority").isin("1-URGENT", "2-HIGH"), "QMXBP7971").otherwise("other")
    orders = load(spark, folder, "orders").select(
        F.concat(line_of_business(plan), F.lit("/"), population_group(F.col("o_orderpriority"))).alias("label"),
        F.lit(0).alias("is_red_or_bolt"), F.lit(0).alias("is_small"), F.lit(0).alias("no_ring"))
    return parts.unionByName(orders.groupBy("label", "is_red_or_bolt", "is_small", "no_ring").agg(F.count("*").alias("n_rows")))


def latest_rows(spark: SparkSession, folder: str) -> DataFrame:
    """Distinct status and priority of all orders on each customer's latest date; some orders are undated."""
    od = load(spark, folder, "orders").withColumn("o_orderdate", F.when(F.col("o_orderkey") % 50 != 0, F.col("o_orderdate")))
    out = latest_rows_of(od, ["o_custkey"], "o_orderdate", ["o_custkey", "o_orderdate", "o_orderstatus", "o_orderpriority"])
    return out.withColumn("o_orderdate", day_text("o_orderdate"))


def asof_purchase(spark: SparkSession, folder: str) -> DataFrame:
    """Each purchase with the user's last view strictly before it."""
    ev = load(spark, folder, "events")
    buy, view = ev.filter(F.col("event_type") == "purchase"), ev.filter(F.col("event_type") == "view")
    out = asof_join(buy.select("event_id", "user_id", "ts"), view, {"user_id": "user_id"}, "ts", "ts",
                    {"event_id": "view_id", "ts": "view_ts"})
    return out.select("event_id", "user_id", F.coalesce("view_id", F.lit(-1)).alias("view_id"),
                      F.coalesce(time_text(F.date_trunc("second", "view_ts")), F.lit("")).alias("view_ts"))


def order_number(spark: SparkSession, folder: str) -> DataFrame:
    """Row number and rank of a customer's orders, newest month first, oldest day first inside the month."""
    od = load(spark, folder, "orders").select("o_orderkey", "o_custkey", F.col("o_orderdate").cast("date").alias("d"), "o_orderpriority")
    month = F.trunc("d", "month")
    rows = numbered(od, ["o_custkey"], [month.desc(), F.col("d").asc(), F.col("o_orderkey").asc()], "rn", bucket=month, bucket_desc=True)
    ranks = numbered(rows, ["o_custkey"], [month.desc()], "rk", bucket=month, bucket_desc=True, ties=True)
    return ranks.select("o_orderkey", "o_custkey", "rn", "rk")


def quantity_rank(spark: SparkSession, folder: str) -> DataFrame:
    """Rank of every line item by quantity over the whole table, where thousands of rows share a rank."""
    li = load(spark, folder, "lineitem").select("l_orderkey", "l_linenumber", "l_quantity", "l_linestatus")
    ranked = global_rank(li, {"l_quantity": False, "l_linestatus": True}, "place")
    return ranked.groupBy("l_quantity", "l_linestatus", "place").agg(F.count("*").alias("n_rows"))


def key_cast_join(spark: SparkSession, folder: str) -> DataFrame:
    """Text keys, some of them not numbers, against numeric keys."""
    ev = load(spark, folder, "events").select(
        F.when(F.col("event_type") == "error", F.concat(F.lit("x"), text("user_id"))).otherwise(text("user_id")).alias("c_custkey"), "value")
    cust = load(spark, folder, "customer").select("c_custkey", "c_mktsegment")
    joined = cast_key(ev, "c_custkey", kind="decimal(38,0)").join(cast_key(cust, "c_custkey", kind="decimal(38,0)"), "c_custkey")
    return joined.groupBy("c_mktsegment").agg(F.count("*").alias("n_rows"), F.round(F.sum("value"), 2).alias("total"))


def anti_join(spark: SparkSession, folder: str) -> DataFrame:
    """Orders without a returned line, counted by priority next to those with one."""
    od = load(spark, folder, "orders").select(F.col("o_orderkey").alias("k"), "o_orderpriority")
    back = load(spark, folder, "lineitem").filter(F.col("l_returnflag") == "R").select(F.col("l_orderkey").alias("k"))
    side = lambda df, name: df.groupBy("o_orderpriority").agg(F.count("*").alias("n_rows")).withColumn("side", F.lit(name))
    return side(not_in(od, back, "k"), "kept").unionByName(side(od.join(back, "k", "left_semi"), "returned"))


def players(spark: SparkSession, folder: str) -> DataFrame:
    """Customers as players; games and time come from their orders."""
    played = load(spark, folder, "orders").groupBy(F.col("o_custkey").alias("c_custkey")).agg(
        F.count("*").alias("games"), F.sum(F.floor(F.col("o_totalprice") / 30000)).alias("spent"))
    cust = load(spark, folder, "customer").join(played, "c_custkey", "left")
    whole = F.floor("c_acctbal").cast("int")
    return cust.select(
        F.col("c_custkey").alias("playerid"), F.when(F.col("c_mktsegment") == "BUILDING", "Ann").when(F.col("c_mktsegment") == "FURNITURE", None)
        .otherwise(F.col("c_name")).alias("firstname"), F.concat(F.lit("City-"), text("c_nationkey")).alias("location"),
        F.col("c_acctbal").cast("decimal(18,2)").alias("amntbet"), F.col("games").alias("total_no_games"), F.col("spent").alias("time_spent"),
        F.floor(F.col("c_acctbal") / 50).cast("decimal(18,2)").alias("value_of_promotions_used"),
        F.when(F.col("c_mktsegment") != "MACHINERY", whole % 12).alias("visit_frequency_days"),
        F.when(F.col("c_nationkey") < 10, "High").otherwise("Low").alias("risk_category"),
        F.when(F.col("c_mktsegment") == "HOUSEHOLD", "abc").otherwise(text(F.floor(F.col("c_acctbal") / 200))).alias("age"))


SETTINGS = {"default": {}, "high risk": {"risk": "High"}, "city one": {"keyword": "CITY-1", "min_bet": 1000}}


def player360(spark: SparkSession, folder: str) -> DataFrame:
    """The player report under three settings."""
    out = None
    for name, args in SETTINGS.items():
        part = player_score.player_report(players(spark, folder), **args).withColumn("setting", F.lit(name))
        out = part if out is None else out.unionByName(part)
    flag = lambda c: F.coalesce(F.col(c).cast("int"), F.lit(-1))
    return rounded(out, "engagementscore").withColumns(
        {"namehasdigits": flag("namehasdigits"), "loccontainskeyword": flag("loccontainskeyword"), "ageint": F.coalesce("ageint", F.lit(-1))})


def ranked_report(spark: SparkSession, folder: str) -> DataFrame:
    """The player report loaded twice in rank order, and the place at which each row is read back."""
    path = fresh_path(spark, "player_report")
    with scope(spark):
        report = player_score.player_report(players(spark, folder))
        for _ in range(2):
            report_loads.load_player_report(report, path)
    return read_in_order(spark, path, "position").select("playerid", "playertier", "playerrank", "position")


QUERIES = {
    "csv_lookup": csv_lookup, "clean_dims": clean_dims, "sales_summary": sales_summary, "latest_activation": latest_activation,
    "loaded_sales_summary": loaded_sales_summary, "ranked_report": ranked_report, "classify_rules": classify_rules,
    "latest_rows": latest_rows, "asof_purchase": asof_purchase, "order_number": order_number, "quantity_rank": quantity_rank,
    "key_cast_join": key_cast_join, "anti_join": anti_join, "player360": player360,
}

_PLAYERS = """
played AS (SELECT o_custkey, count(*) AS games, sum(floor(o_totalprice / 30000)) AS spent FROM orders GROUP BY 1),
pl AS (SELECT c_custkey AS playerid, CASE c_mktsegment WHEN 'BUILDING' THEN 'Ann' WHEN 'FURNITURE' THEN NULL ELSE c_name END AS firstname,
         'City-' || c_nationkey AS location, CAST(c_acctbal AS DECIMAL(18,2)) AS bet, games, spent, CAST(floor(c_acctbal / 50) AS DECIMAL(18,2)) AS promo,
         CASE WHEN c_mktsegment <> 'MACHINERY' THEN CAST(floor(c_acctbal) AS INTEGER) % 12 END AS visits,
         CASE WHEN c_nationkey < 10 THEN 'High' ELSE 'Low' END AS risk,
         CASE WHEN c_mktsegment = 'HOUSEHOLD' THEN NULL ELSE CAST(floor(c_acctbal / 200) AS INTEGER) END AS age
       FROM customer LEFT JOIN played ON o_custkey = c_custkey)"""


def _player_sql(name: str, min_bet: float = 500, risk: str | None = None, keyword: str | None = None) -> str:
    known = f"contains(lower(location), '{keyword.lower()}')" if keyword else "false"
    where = f"bet >= {min_bet}" + (f" AND risk = '{risk}'" if risk else "") + (f" AND {known}" if keyword else "")
    return f"""SELECT '{name}' AS setting, playerid, CASE
            WHEN score >= 80 AND coalesce(visits, 999) <= 5 AND NOT digits AND age BETWEEN 25 AND 45 THEN 'Gold'
            WHEN score >= 50 AND coalesce(visits, 999) <= 10 AND known THEN 'Silver'
            WHEN score >= 30 AND coalesce(age, 0) < 25 THEN 'Bronze' ELSE 'Newbie' END AS playertier,
            round(score, 4) AS engagementscore, risk AS risk_category, coalesce(CAST(digits AS INTEGER), -1) AS namehasdigits,
            CAST(known AS INTEGER) AS loccontainskeyword, coalesce(age, -1) AS ageint, rank() OVER (ORDER BY score DESC, playerid) AS playerrank
        FROM (SELECT *, {known} AS known, regexp_matches(firstname, '[0-9]') AS digits,
                CAST(coalesce(games, 0) * 0.3 + CAST(coalesce(spent, 0) AS BIGINT) * 0.4 + promo * 0.2 - coalesce(visits, 0) * 0.1 AS DOUBLE) AS score
              FROM pl WHERE {where})"""


ORACLE = {
    "csv_lookup": """SELECT n_nationkey, n_name, CASE n_regionkey WHEN 0 THEN 'south' WHEN 1 THEN 'west' WHEN 2 THEN 'east' ELSE 'NA' END AS zone FROM nation""",
    "clean_dims": """
        SELECT CASE WHEN c_mktsegment = 'BUILDING' THEN 'UNKNOWN' ELSE c_mktsegment || 'X' END AS segment,
            CASE WHEN n_name = 'NATION_3' THEN 'UNKNOWN' ELSE 'NAT***' END AS nation,
            CASE WHEN c_mktsegment = 'BUILDING' THEN 'none' ELSE lower(c_mktsegment) || '_x' END AS tag, count(*) AS n_rows,
            sum(CASE WHEN c_acctbal < 0 THEN 0 ELSE floor(c_acctbal) END) AS total
        FROM customer JOIN nation ON c_nationkey = n_nationkey GROUP BY 1, 2, 3""",
    "sales_summary": f"""
        WITH s AS (SELECT l_returnflag AS rf, CASE WHEN c_nationkey = 3 THEN NULL ELSE c_nationkey END AS st, l_partkey AS pk, c_acctbal > 0 AS act,
                   CASE WHEN l_linenumber = 7 OR l_discount = 0 THEN 0 ELSE l_quantity END AS vol
            FROM lineitem JOIN orders ON l_orderkey = o_orderkey JOIN customer ON c_custkey = o_custkey),
        a AS (SELECT p_partkey AS pk, p_type, '1999-01-01' AS f FROM part WHERE p_size > 10
              UNION ALL SELECT p_partkey, p_type, '' FROM part WHERE p_size > 25)
        SELECT CASE rf WHEN 'A' THEN 'CA' WHEN 'R' THEN 'CR' ELSE 'UNKNOWN' END AS companycode,
            CASE rf WHEN 'A' THEN 'Alp***' ELSE 'UNKNOWN' END AS companyname, coalesce(CAST(st AS VARCHAR), 'UNKNOWN') AS statecode,
            coalesce(lower(n_name), 'UNKNOWN') AS statename, CAST(s.pk AS VARCHAR) AS skucode, replace(p_name, ' ', '_') AS itemname,
            CASE WHEN act THEN 'YES' ELSE 'NO' END AS active_flag, coalesce('Promo: ' || a.p_type, 'NO PROMOTION') AS promotion_desc,
            coalesce(a.f, '1900-01-01') AS effective_date_range_start, '{AS_OF}' AS effective_date_range_end,
            sum(vol) AS total_volumeactualcase, sum(CASE WHEN st < 5 THEN CAST(p_size AS DOUBLE) ELSE 0 END) AS total_plan_qty, round(avg(vol), 4) AS average_volume
        FROM s JOIN part ON s.pk = part.p_partkey LEFT JOIN nation ON n_nationkey = st LEFT JOIN a ON a.pk = s.pk
        WHERE vol > 0 GROUP BY ALL""",
    "classify_rules": """
        SELECT CASE WHEN p_type ILIKE '%ECONOMY%' OR p_name ILIKE '%ECONOMY%' THEN 'cheap' WHEN p_type ILIKE '%pro_o%' OR p_name ILIKE '%pro_o%' OR p_name ILIKE '%promo x%' THEN 'campaign'
               WHEN p_type ILIKE 'medium%' OR p_name ILIKE 'medium%' THEN 'middle' ELSE 'rest' END AS label,
            CASE WHEN p_name LIKE 'red%' OR p_name LIKE '%bolt' THEN 1 ELSE 0 END AS is_red_or_bolt, CASE WHEN p_type = 'SMALL' THEN 1 ELSE 0 END AS is_small,
            CASE WHEN p_name LIKE '%ring%' THEN 0 ELSE 1 END AS no_ring, count(*) AS n_rows FROM part GROUP BY 1, 2, 3, 4
        UNION ALL SELECT CASE WHEN o_orderpriority IN ('1-URGENT', '2-HIGH') THEN 'MMP' ELSE 'Unknown' END || '/' ||
            CASE WHEN o_orderpriority LIKE '%A%' THEN 'Group A' ELSE 'Group B' END, 0, 0, 0, count(*) FROM orders GROUP BY 1""",
    "latest_rows": """
        SELECT DISTINCT o_custkey, strftime(o_orderdate, '%Y-%m-%d') AS o_orderdate, o_orderstatus, o_orderpriority FROM (
            SELECT * FROM (SELECT * REPLACE (CASE WHEN o_orderkey % 50 <> 0 THEN o_orderdate END AS o_orderdate) FROM orders)
            QUALIFY dense_rank() OVER (PARTITION BY o_custkey ORDER BY o_orderdate DESC NULLS FIRST) = 1)""",
    "asof_purchase": """
        SELECT b.event_id, b.user_id, coalesce(v.event_id, -1) AS view_id, coalesce(strftime(date_trunc('second', v.ts), '%Y-%m-%d %H:%M:%S.%g'), '') AS view_ts
        FROM (SELECT * FROM events WHERE event_type = 'purchase') b
        ASOF LEFT JOIN (SELECT * FROM events WHERE event_type = 'view') v ON b.user_id = v.user_id AND b.ts > v.ts""",
    "order_number": """
        SELECT o_orderkey, o_custkey,
            CAST(row_number() OVER (PARTITION BY o_custkey ORDER BY date_trunc('month', o_orderdate) DESC, CAST(o_orderdate AS DATE), o_orderkey) AS INTEGER) AS rn,
            CAST(rank() OVER (PARTITION BY o_custkey ORDER BY date_trunc('month', o_orderdate) DESC) AS INTEGER) AS rk FROM orders""",
    "quantity_rank": """
        WITH r AS (SELECT l_quantity, l_linestatus, rank() OVER (ORDER BY l_quantity DESC, l_linestatus) AS place FROM lineitem)
        SELECT l_quantity, l_linestatus, place, count(*) AS n_rows FROM r GROUP BY 1, 2, 3""",
    "key_cast_join": """
        SELECT c_mktsegment, count(*) AS n_rows, round(sum(value), 2) AS total FROM events JOIN customer ON c_custkey = user_id
        WHERE event_type <> 'error' GROUP BY 1""",
    "anti_join": """
        SELECT o_orderpriority, CASE WHEN o_orderkey IN (SELECT l_orderkey FROM lineitem WHERE l_returnflag = 'R') THEN 'returned' ELSE 'kept' END AS side,
            count(*) AS n_rows FROM orders GROUP BY 1, 2""",
    "player360": f"WITH {_PLAYERS} " + " UNION ALL ".join(_player_sql(n, **a) for n, a in SETTINGS.items()),
}
ORACLE["loaded_sales_summary"] = ORACLE["sales_summary"]
ORACLE["latest_activation"] = ORACLE["sales_summary"].replace(
    "WHERE p_size > 10\n", "WHERE p_size > 10 AND p_size <= 25\n")  # later ones have a newer activation
ORACLE["ranked_report"] = f"""WITH {_PLAYERS} SELECT playerid, playertier, playerrank, row_number() OVER (ORDER BY playerrank) AS position
    FROM ({_player_sql("default")})"""
