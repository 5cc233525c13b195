"""Load patterns: each query fills a fresh target, loads it again and reads it back."""

from __future__ import annotations

from datetime import date, datetime

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from ..functions.dates import RunWindow
from ..operators.rows import in_window, on_day, on_days
from ..sources import sinks
from ..sources.staging import fresh_path
from .common import day_text, load, time_text

NOW = datetime(2024, 1, 31, 12)


def full_refresh(spark: SparkSession, folder: str) -> DataFrame:
    """Orders per priority, loaded twice and stamped; the second load reads the first one's target."""
    path = fresh_path(spark, "refresh")
    per = load(spark, folder, "orders").groupBy("o_orderpriority").agg(F.count("*").alias("n_rows"))
    sinks.full_refresh(sinks.load_stamps(per, NOW, "loader"), path)
    again = spark.read.parquet(path).withColumn("n_rows", F.col("n_rows") + 1)
    sinks.full_refresh(again, path)
    return spark.read.parquet(path).withColumn("createddate", time_text("createddate"))


def _daily(spark: SparkSession, folder: str, run: str) -> DataFrame:
    return load(spark, folder, "events").select(_day().alias("dt"), "event_id", "event_type", F.lit(run).alias("run"))


def _day():
    return F.when(F.col("event_id") % 97 != 0, F.to_date("ts"))


def _by_day(spark: SparkSession, path: str) -> DataFrame:
    return (spark.read.parquet(path).groupBy(F.coalesce(day_text("dt"), F.lit("-")).alias("dt"), "run")
            .agg(F.count("*").alias("n_rows"), F.sum("event_id").alias("id_sum")))


def replace_window(spark: SparkSession, folder: str) -> DataFrame:
    """A window of days is recomputed twice, some rows undated. Its last days come out empty and must vanish; other days
    stay, and undated rows replace undated ones."""
    path = fresh_path(spark, "window")
    window = RunWindow(date(2024, 1, 10), date(2024, 1, 20))
    sinks.replace_window(_daily(spark, folder, "old"), path, "dt", RunWindow(date(2024, 1, 1), date(2024, 1, 31)))
    new = _daily(spark, folder, "new").filter(
        F.col("dt").isNull() | F.col("dt").between(F.lit(window.start), F.lit(date(2024, 1, 18))))
    for _ in range(2):
        sinks.replace_window(new, path, "dt", window)
    return _by_day(spark, path)


def purge(spark: SparkSession, folder: str) -> DataFrame:
    path = fresh_path(spark, "purge")
    sinks.full_refresh(_daily(spark, folder, "old"), path, ["dt"])
    sinks.purge_before(spark, path, "dt", date(2024, 1, 15))
    return _by_day(spark, path)


def aligned_append(spark: SparkSession, folder: str) -> DataFrame:
    """Rows with other columns, order and letter case are appended to a target; an empty load changes nothing."""
    path = fresh_path(spark, "append")
    od = load(spark, folder, "orders")
    sinks.full_refresh(od.select("o_orderkey", "o_orderstatus", "o_totalprice", F.lit("first").alias("batch")), path)
    other = od.select(F.lit("second").alias("BATCH"), F.lit(1).alias("extra"), F.col("o_orderkey").cast("string").alias("O_ORDERKEY"), "o_orderstatus")
    sinks.append(other, path)
    sinks.append_nonempty(od.select("o_orderkey", F.lit("third").alias("batch")), path)
    sinks.append_nonempty(od.filter("o_orderkey < 0").select("o_orderkey", F.lit("none").alias("batch")), path)
    return spark.read.parquet(path).groupBy("batch", F.coalesce("o_orderstatus", F.lit("")).alias("o_orderstatus")).agg(
        F.count("*").alias("n_rows"), F.sum("o_orderkey").alias("key_sum"), F.count("o_totalprice").alias("n_priced"))


def pruned_scan(spark: SparkSession, folder: str) -> DataFrame:
    """A target laid out by day, read for a window, for one day, and for the days of a calendar (those with an order over
    a price limit): each read opens the folders of its days only."""
    path = fresh_path(spark, "by_day")
    sinks.full_refresh(_daily(spark, folder, "old").where("dt IS NOT NULL"), path, ["dt"])
    days = load(spark, folder, "orders").where(F.col("o_totalprice") > 490_000).select(
        F.date_add(F.lit(date(2024, 1, 1)), F.dayofmonth("o_orderdate") - 1).alias("day"))
    target = spark.read.parquet(path)
    reads = {"window": in_window(target, "dt", RunWindow(date(2024, 1, 5), date(2024, 1, 9))),
             "single": on_day(target, "dt", date(2024, 1, 10)), "calendar": on_days(target, "dt", days, "day")}
    parts = [df.groupBy(day_text("dt").alias("dt")).agg(F.count("*").alias("n_rows"), F.sum("event_id").alias("id_sum"))
             .withColumn("kind", F.lit(kind)) for kind, df in reads.items()]
    return parts[0].unionByName(parts[1]).unionByName(parts[2])


QUERIES = {"pruned_scan": pruned_scan, "full_refresh": full_refresh, "replace_window": replace_window, "purge": purge, "aligned_append": aligned_append}

ORACLE = {
    "pruned_scan": """
        WITH e AS (SELECT CAST(ts AS DATE) AS d, event_id FROM events WHERE event_id % 97 <> 0),
        r AS (SELECT 'window' AS kind, * FROM e WHERE d BETWEEN DATE '2024-01-05' AND DATE '2024-01-09'
              UNION ALL SELECT 'single', * FROM e WHERE d = DATE '2024-01-10'
              UNION ALL SELECT 'calendar', * FROM e WHERE d IN (
                  SELECT DATE '2024-01-01' + CAST(day(o_orderdate) - 1 AS INTEGER) FROM orders WHERE o_totalprice > 490000))
        SELECT kind, strftime(d, '%Y-%m-%d') AS dt, count(*) AS n_rows, CAST(sum(event_id) AS BIGINT) AS id_sum FROM r GROUP BY 1, 2""",
    "full_refresh": """SELECT o_orderpriority, count(*) + 1 AS n_rows, '2024-01-31 12:00:00.000' AS createddate, 'loader' AS createdby FROM orders GROUP BY 1""",
    "replace_window": """
        WITH e AS (SELECT CASE WHEN event_id % 97 <> 0 THEN CAST(ts AS DATE) END AS d, event_id FROM events)
        SELECT coalesce(strftime(d, '%Y-%m-%d'), '-') AS dt,
            CASE WHEN d IS NULL OR d BETWEEN DATE '2024-01-10' AND DATE '2024-01-20' THEN 'new' ELSE 'old' END AS run,
            count(*) AS n_rows, CAST(sum(event_id) AS BIGINT) AS id_sum FROM e
        WHERE d IS NULL OR d NOT BETWEEN DATE '2024-01-19' AND DATE '2024-01-20' GROUP BY 1, 2""",
    "purge": """
        SELECT coalesce(CASE WHEN event_id % 97 <> 0 THEN strftime(ts, '%Y-%m-%d') END, '-') AS dt, 'old' AS run, count(*) AS n_rows,
            CAST(sum(event_id) AS BIGINT) AS id_sum FROM events
        WHERE ts >= TIMESTAMP '2024-01-15' OR event_id % 97 = 0 GROUP BY 1""",
    "aligned_append": """
        SELECT batch, o_orderstatus, count(*) AS n_rows, CAST(sum(o_orderkey) AS BIGINT) AS key_sum, count(o_totalprice) AS n_priced FROM (
            SELECT 'first' AS batch, o_orderstatus, o_orderkey, o_totalprice FROM orders
            UNION ALL SELECT 'second', o_orderstatus, o_orderkey, NULL FROM orders
            UNION ALL SELECT 'third', '', o_orderkey, NULL FROM orders) GROUP BY 1, 2""",
}
