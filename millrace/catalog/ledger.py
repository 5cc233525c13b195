"""Payment ledger on the test tables: one payment per line item, its parts as JSON arrays."""

from __future__ import annotations

import uuid
from datetime import date

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from ..functions.dates import RunWindow
from ..functions.jsonx import inner_json, parse
from ..functions.text import blank_safe_cast
from ..operators.nested import flatten
from ..plans.payment_ledger import KEYS, SOURCES, merge_payment_ledger, payment_ledger
from ..sources.sinks import full_refresh, merge_insert_only, merge_into_buckets
from ..sources.staging import fresh_path, scope
from ..sources.tables import table
from .common import job_input, load, text

BUCKETS = 16
WINDOW = RunWindow(date(1995, 6, 1), date(2000, 12, 31))


@job_input(dealt=True)
def payments(spark: SparkSession, folder: str) -> DataFrame:
    """Every line item is a payment; returned ones carry refunds, and so on. Arrays have at most three elements."""
    li = load(spark, folder, "lineitem").select(
        "l_orderkey", "l_partkey", "l_suppkey", "l_linenumber", "l_quantity", "l_returnflag", "l_linestatus", "l_shipdate").repartition(
        spark.sparkContext.defaultParallelism)
    order, part, line = text("l_orderkey"), text("l_partkey"), text("l_linenumber")
    whole = text(F.col("l_quantity").cast("int"))

    def element(pg, kind, amount, refund):
        return F.struct(
            F.concat(F.lit("("), pg, F.lit(")")).alias("pg"), text("l_suppkey").alias("merchantId"),
            F.concat(part, F.lit("-"), line).alias("pgTransactionId"), F.lit(kind).alias("transactionType"),
            amount.alias("pgTransactionAmount"), amount.alias("amountTransferredToNodal"),
            F.concat(F.lit('["U'), part, F.lit('"]')).alias("utr"), refund.alias("pgRefundId"),
            F.col("l_linestatus").alias("paymentMode"), F.col("l_returnflag").alias("bank"))

    def array_if(test, *elements):
        return F.when(test, F.to_json(F.array(*elements))).otherwise(F.lit("[]"))

    def swapped(text_):
        """The same objects with their last key first."""
        return F.regexp_replace(text_, r'\{(.*?),("bank":"[^"]*")\}', r'{$2,$1}')

    flag, none = F.col("l_returnflag"), F.lit(None).cast("string")
    sale = element(F.lit("alpha"), "SALE", whole, none)
    fee = element(F.lit("beta"), "FEE", F.lit("1"), none)
    back = element(F.lit("alpha"), "REFUND", whole, F.concat(F.lit("R"), order))
    return li.select(
        order.alias("order_id"), F.concat(order, F.lit("/"), line).alias("transaction_id"), F.col("l_linestatus").alias("lob"),
        F.lit(None).cast("timestamp").alias("created_at"), F.col("l_shipdate").cast("timestamp").alias("updated_at"),
        F.when(flag == "A", F.to_json(F.array(back))).alias("pg_chargeback"),
        array_if((flag == "A") & (F.col("l_linestatus") == "F"), sale).alias("pg_chargeback_reversal"),
        array_if(flag == "R", back).alias("pg_refund"), F.concat(F.lit("["), F.concat_ws(",", F.to_json(sale), F.to_json(fee), swapped(F.to_json(sale))), F.lit("]")).alias("pg_transaction"))


def ledger_split(spark: SparkSession, folder: str) -> DataFrame:
    return payment_ledger(payments(spark, folder), WINDOW)


def ledger_merge(spark: SparkSession, folder: str) -> DataFrame:
    """Refund rows are in the bucketed target already; two runs add the rest once and leave them alone. Counted per kind."""
    name = f"ledger_{uuid.uuid4().hex}"
    paid = payments(spark, folder)
    refunds = paid.withColumns({c: F.lit(None).cast("string") for c in SOURCES if c != "pg_refund"})
    with scope(spark):
        merge_into_buckets(payment_ledger(refunds, WINDOW).withColumn("lob", F.lit("old")), name, KEYS, BUCKETS)
        for _ in range(2):
            merge_payment_ledger(paid, WINDOW, name, BUCKETS)
    return (table(spark, name).groupBy("description", "lob")
            .agg(F.count("*").alias("n_rows"), F.sum(F.col("gross_txn_value").cast("bigint")).alias("gross")))


def merge_insert(spark: SparkSession, folder: str) -> DataFrame:
    """Insert-only merge twice over: the second run finds every key and adds nothing, repeats in the source stay."""
    path = fresh_path(spark, "merged")
    orders = load(spark, folder, "orders")
    row = orders.select("o_custkey", "o_orderstatus", F.lit("new").alias("origin"), "o_totalprice")
    full_refresh(row.filter(F.col("o_orderstatus") == "F").withColumn("origin", F.lit("old")), path)
    for _ in range(2):
        merge_insert_only(row, path, ["o_custkey", "o_orderstatus"])
    return (spark.read.parquet(path).groupBy("o_orderstatus", "origin")
            .agg(F.count("*").alias("n_rows"), F.round(F.sum("o_totalprice"), 2).alias("total")))


def json_lenient(spark: SparkSession, folder: str) -> DataFrame:
    """Good, broken and doubly encoded JSON next to each other; inner and outer flatten of an empty array."""
    ev = load(spark, folder, "events")
    broken = F.when(F.col("event_type") == "error", F.lit("{broken")).otherwise(F.col("props"))
    twice = F.to_json(F.struct(F.to_json(F.struct(F.struct(F.col("event_type").alias("kind")).alias("deep"))).alias("meta")))
    items = F.when(F.col("event_type") == "click", F.lit("[]")).otherwise(F.concat(F.lit("["), F.col("props"), F.lit(",{}]")))
    number = F.when(F.col("event_type") == "view", F.lit(" ")).otherwise(F.get_json_object("props", "$.k"))
    rows = ev.select("event_id", parse(broken, "struct<k:int>")["k"].alias("k"), inner_json(twice, "meta", "deep.kind").alias("kind"),
                     items.alias("items"), blank_safe_cast(number, "int").alias("safe_k"))
    kept = flatten(rows, "items", "struct<k:int>", "item", outer=True, index="pos")
    return kept.groupBy("kind").agg(
        F.count("*").alias("n_rows"), F.count("k").alias("n_k"), F.coalesce(F.sum("k"), F.lit(0)).alias("sum_k"),
        F.count("pos").alias("n_items"), F.count("item.k").alias("n_item_k"), F.coalesce(F.sum("safe_k"), F.lit(0)).alias("sum_safe"))


_PAY = """
li AS (SELECT CAST(l_orderkey AS VARCHAR) AS o, CAST(l_partkey AS VARCHAR) AS p, CAST(l_linenumber AS VARCHAR) AS n,
              CAST(l_suppkey AS VARCHAR) AS s, CAST(CAST(l_quantity AS INTEGER) AS VARCHAR) AS q, l_returnflag AS f,
              l_linestatus AS st, strftime(l_shipdate, '%Y-%m-%d %H:%M:%S') AS moment FROM lineitem
       WHERE l_shipdate BETWEEN TIMESTAMP '1995-06-01' AND TIMESTAMP '2000-12-31'),
parts AS (
  SELECT *, 'PG_CHARGEBACK' AS tag, 'alpha' AS pg, 'REFUND' AS kind, q AS amount, 'R' || o AS refund FROM li WHERE f = 'A'
  UNION ALL SELECT *, 'PG_CHARGEBACK_REVERSAL', 'alpha', 'SALE', q, NULL FROM li WHERE f = 'A' AND st = 'F'
  UNION ALL SELECT *, 'PG_REFUND', 'alpha', 'REFUND', q, 'R' || o FROM li WHERE f = 'R'
  UNION ALL SELECT *, 'PG_TRANSACTION', 'alpha', 'SALE', q, NULL FROM li
  UNION ALL SELECT *, 'PG_TRANSACTION', 'beta', 'FEE', '1', NULL FROM li),
ledger AS (
  SELECT DISTINCT o AS order_id, tag AS description, pg, s AS mid, o || '/' || n AS txn_id, p || '-' || n AS pg_txn_id, kind AS txn_type,
    '' AS txn_date, '' AS settlement_date, amount AS gross_txn_value, '' AS pg_commission, '' AS cgst, '' AS sgst, '' AS igst,
    amount AS amount_transferred_to_nodal, 'U' || p AS utr, coalesce(refund, '') AS refund_id, '' AS created_at, st AS paymentmode,
    f AS cardissuer, '' AS cardtype, st AS createdby, '' AS cardnumber, '' AS binnumber, '' AS cardlastfourdigits, '' AS authcode,
    '' AS bankreference, '' AS rrn, st AS lob, moment AS updated_at,
    '{"amountTransferredToNodal":"' || amount || '","bank":"' || f || '","merchantId":"' || s || '","paymentMode":"' || st || '","pg":"(' || pg || ')"'
      || coalesce(',"pgRefundId":"' || refund || '"', '') || ',"pgTransactionAmount":"' || amount || '","pgTransactionId":"' || p || '-' || n
      || '","transactionType":"' || kind || '","utr":"[\\"U' || p || '\\"]"}' AS arr
  FROM parts)
"""

QUERIES = {"ledger_split": ledger_split, "ledger_merge": ledger_merge, "merge_insert": merge_insert, "json_lenient": json_lenient}

ORACLE = {
    "ledger_split": f"WITH {_PAY} SELECT * FROM ledger",
    "ledger_merge": f"""WITH {_PAY},
        target AS (SELECT * REPLACE ('old' AS lob) FROM ledger WHERE description = 'PG_REFUND'),
        merged AS (SELECT * FROM target UNION ALL SELECT l.* FROM ledger l WHERE NOT EXISTS (SELECT 1 FROM target t WHERE
            {' AND '.join(f't.{k} = l.{k}' for k in KEYS)}))
        SELECT description, lob, count(*) AS n_rows, CAST(sum(CAST(gross_txn_value AS BIGINT)) AS BIGINT) AS gross
        FROM merged GROUP BY 1, 2""",
    "merge_insert": """
        WITH src AS (SELECT o_custkey, o_orderstatus, o_totalprice FROM orders),
        old AS (SELECT *, 'old' AS origin FROM src WHERE o_orderstatus = 'F'),
        merged AS (SELECT * FROM old UNION ALL SELECT s.*, 'new' FROM src s WHERE NOT EXISTS (
            SELECT 1 FROM old o WHERE o.o_custkey = s.o_custkey AND o.o_orderstatus = s.o_orderstatus))
        SELECT o_orderstatus, origin, count(*) AS n_rows, round(sum(o_totalprice), 2) AS total FROM merged GROUP BY 1, 2""",
    "json_lenient": """
        WITH e AS (SELECT event_type AS kind, CAST(json_extract(props, '$.k') AS INTEGER) AS k FROM events),
        r AS (SELECT kind, CASE WHEN kind <> 'error' THEN k END AS k, CASE WHEN kind <> 'view' THEN k END AS safe_k,
                     CASE WHEN kind = 'click' THEN [NULL] ELSE [0, 1] END AS pos, k AS raw FROM e),
        x AS (SELECT kind, k, safe_k, unnest(pos) AS pos, raw FROM r)
        SELECT kind, count(*) AS n_rows, count(k) AS n_k, CAST(coalesce(sum(k), 0) AS BIGINT) AS sum_k, count(pos) AS n_items,
               count(CASE WHEN pos = 0 THEN raw END) AS n_item_k, CAST(coalesce(sum(safe_k), 0) AS BIGINT) AS sum_safe
        FROM x GROUP BY kind""",
}
