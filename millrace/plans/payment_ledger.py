"""Payment ledger: four JSON array columns per payment become one ledger row per element."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ..functions.dates import RunWindow
from ..functions.jsonx import canonical, parse, text_fields
from ..functions.text import strip_list_marks, strip_parens, text_or_empty
from ..operators.nested import tagged_elements, tagged_objects
from ..operators.rows import in_window
from ..sources.sinks import merge_insert_only, merge_into_buckets
from ..sources.staging import scope, stage

# JSON array column -> description, ledger column -> element field, merge key.
SOURCES = {
    "pg_chargeback": "PG_CHARGEBACK",
    "pg_chargeback_reversal": "PG_CHARGEBACK_REVERSAL",
    "pg_refund": "PG_REFUND",
    "pg_transaction": "PG_TRANSACTION",
}
FIELDS = {
    "pg": "pg",
    "mid": "merchantId",
    "pg_txn_id": "pgTransactionId",
    "txn_type": "transactionType",
    "txn_date": "transactionTime",
    "settlement_date": "settlementDate",
    "gross_txn_value": "pgTransactionAmount",
    "pg_commission": "pgCommission",
    "cgst": "cgst",
    "sgst": "sgst",
    "igst": "igst",
    "amount_transferred_to_nodal": "amountTransferredToNodal",
    "utr": "utr",
    "refund_id": "pgRefundId",
    "paymentmode": "paymentMode",
    "cardissuer": "bank",
    "cardtype": "cardType",
    "createdby": "paymentMode",
    "cardnumber": "cardNumber",
    "binnumber": "binNumber",
    "cardlastfourdigits": "last4Digits",
    "authcode": "authCode",
    "bankreference": "bankReference",
    "rrn": "rrn",
}
KEYS = ["pg", "mid", "pg_txn_id", "txn_type", "amount_transferred_to_nodal", "utr", "refund_id", "paymentmode"]
OWN = ["order_id", "txn_id", "lob", "created_at", "updated_at"]
FEW = 100_000  # repeated payments, by hash, that are broadcast
COLUMNS = [
    "order_id", "description", "pg", "mid", "txn_id", "pg_txn_id", "txn_type", "txn_date", "settlement_date",
    "gross_txn_value", "pg_commission", "cgst", "sgst", "igst", "amount_transferred_to_nodal", "utr", "refund_id",
    "created_at", "paymentmode", "cardissuer", "cardtype", "createdby", "cardnumber", "binnumber",
    "cardlastfourdigits", "authcode", "bankreference", "rrn", "lob", "updated_at", "arr",
]


def payment_ledger(payments: DataFrame, window: RunWindow, strict: bool = True) -> DataFrame:
    """Ledger rows of the payments updated in the window; no two rows are the same.

    Bad JSON fails the job unless ``strict`` is off.
    """
    return _read(_elements(payments, window, strict), COLUMNS)


def _elements(payments: DataFrame, window: RunWindow, strict: bool) -> DataFrame:
    """The distinct (payment's own columns, kind, element), the element's text with sorted keys, and its fields as ``e``.

    Every ledger column follows from these. Elements that differ only in the order of their keys are one. Two rows can be
    equal only if their payments' own columns are, so a payment that no other row repeats is made distinct where it lies,
    inside its arrays, and is not shuffled. To find the others only a number for each payment is: a hash of those columns,
    so some may be taken for repeated that are not. Repeated ones are compared across rows.
    """
    base = in_window(payments, "updated_at", window).select(
        "order_id", text_or_empty(F.col("transaction_id")).alias("txn_id"), text_or_empty(F.col("lob")).alias("lob"),
        text_or_empty(F.col("created_at")).alias("created_at"), text_or_empty(F.col("updated_at")).alias("updated_at"), *SOURCES)
    payment = F.xxhash64(*OWN)
    repeated = stage(base.groupBy(payment.alias("_payment")).agg(F.count("*").alias("_n")).filter("_n > 1").select("_payment"), "repeated")
    n = repeated.count()
    if n > FEW:  # then both parts would be shuffled, to be told apart
        return _distinct_across(base, strict)
    alone = lambda rows: tagged_objects(rows, SOURCES, "description", "arr", FIELDS.values(), "e", strict)
    if not n:
        return alone(base)
    part = lambda how: base.join(F.broadcast(repeated), payment == F.col("_payment"), how)
    return alone(part("left_anti")).unionByName(_distinct_across(part("left_semi"), strict))


def _distinct_across(base: DataFrame, strict: bool) -> DataFrame:
    """The same where several rows hold one payment.

    The text with sorted keys is dear to make. So the rows are shuffled
    once as plain text, by their payment and by ``_identity``, which no order of keys changes: equal elements meet, and a
    payment with very many elements is split. Behind the shuffle repeats of one text go first, and only what is left is put
    in that form and made distinct by it in the same place.
    """
    rows = tagged_elements(base, SOURCES, "description", "arr", strict, F.array_distinct)
    rows = rows.withColumn("_identity", _identity(F.col("arr")))
    own = [c for c in rows.columns if c != "arr"]
    rows = rows.repartition(*own).distinct().withColumn("arr", canonical(F.col("arr"), strict)).distinct().drop("_identity")
    return rows.withColumn("e", parse(F.col("arr"), text_fields(sorted(set(FIELDS.values())))))


def _read(rows: DataFrame, columns: Sequence[str]) -> DataFrame:
    """The named ledger columns; those that the rows do not have are read from the element."""
    fields = {out: FIELDS[out] for out in columns if out in FIELDS and out not in rows.columns}
    if "e" not in rows.columns:
        rows = rows.withColumn("e", parse(F.col("arr"), text_fields(sorted(set(fields.values())))))
    read = {out: text_or_empty((strip_list_marks if out == "utr" else strip_parens)(F.col(f"e.{name}"))).alias(out)
            for out, name in fields.items()}
    return rows.select(*[read.get(c, c) for c in columns])


def _identity(element: Column) -> Column:
    """The same for elements that are equal up to the order of their keys and the form of their numbers."""
    value = F.get_json_object(element, f"$.{FIELDS['pg_txn_id']}")
    return F.xxhash64(F.coalesce(value.try_cast("double").cast("string"), value))


def load_payment_ledger(payments: DataFrame, window: RunWindow, path: str) -> None:
    merge_insert_only(payment_ledger(payments, window), path, KEYS)


def merge_payment_ledger(payments: DataFrame, window: RunWindow, name: str, buckets: int = 200) -> None:
    """The same into a catalog table bucketed by the merge key, which no run shuffles.

    The rows are shuffled with the key and the element's text; the other columns are read from it behind the merge, for the
    rows that are new. The shuffle goes when the run ends.
    """
    with scope(payments.sparkSession):
        rows = _read(_elements(payments, window, True), [*OWN, "description", *KEYS, "arr"])
        merge_into_buckets(rows, name, KEYS, buckets, lambda new: _read(new, COLUMNS))
