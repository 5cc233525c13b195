"""Sales summary by cleaned dimensions."""

from __future__ import annotations

from datetime import date

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ..functions.dates import text_date
from ..functions.numbers import number_of
from ..functions.text import clean, mask_prefix, without_spaces
from ..operators.aggregates import latest_by
from ..operators.joins import star

FIRST_DATE = date(1900, 1, 1)


def sales_summary(sales: DataFrame, company: DataFrame, geography: DataFrame, product: DataFrame, plan: DataFrame,
                  outlet: DataFrame, activation: DataFrame, as_of: date, latest_activation: bool = False) -> DataFrame:
    """Volume and plan per company, state, SKU, outlet activity and promotion, for sales with volume.

    Several plans or activations of a SKU repeat its volume, as the report has always done;
    ``latest_activation`` keeps only a SKU's newest activation. Sales shrink to one row per raw key before
    any join: the measures add up, so a fan-out repeats the sums just as it would repeat the rows, and a
    SKU holding a third of all sales reaches the joins as a few rows.
    """
    volume = number_of(F.col("volumeactualcase"))
    keys = ["companycode", "statecode", "skucode", "customercode"]
    sold = (sales.withColumn("_volume", volume).filter(F.col("_volume") > 0)
            .groupBy(*keys).agg(F.sum("_volume").alias("_volume"), F.count("*").alias("_rows")))
    if latest_activation:
        activation = activation.join(latest_by(activation, "productlevelcode", "effectivefrom"),
                                     ["productlevelcode", "effectivefrom"], "left_semi")
    joined = star(sold, [
        (company.select("companycode", "companyname"), ["companycode"], "left"),
        (geography.select("statecode", "statename"), ["statecode"], "left"),
        (product.select("skucode", "itemname"), ["skucode"], "left"),
        (plan.select("statecode", "skucode", number_of(F.col("plan_qty")).alias("_plan")), ["statecode", "skucode"], "left"),
        (outlet.select(F.col("outlet_code").alias("customercode"), "active_flag"), ["customercode"], "left"),
        (activation.select(F.col("productlevelcode").alias("skucode"), "promotiondescription", "effectivefrom", "effectiveto"),
         ["skucode"], "left"),
    ])
    unknown = "UNKNOWN"
    c = F.col
    dims = {
        "companycode": clean(c("companycode"), unknown, lambda x: F.upper(F.trim(without_spaces(x)))),
        "companyname": clean(c("companyname"), unknown, mask_prefix),
        "statecode": clean(c("statecode"), unknown),
        "statename": clean(c("statename"), unknown, lambda x: F.lower(F.trim(x))),
        "skucode": clean(c("skucode"), unknown, lambda x: F.substring(F.trim(x), 1, 10)),
        "itemname": clean(c("itemname"), unknown, lambda x: without_spaces(F.trim(x), "_")),
        "active_flag": F.when(c("active_flag") == 1, "YES").otherwise("NO"),
        "promotion_desc": clean(c("promotiondescription"), "NO PROMOTION", lambda x: F.concat(F.lit("Promo: "), F.trim(x))),
        "effective_date_range_start": text_date(c("effectivefrom"), FIRST_DATE),
        "effective_date_range_end": text_date(c("effectiveto"), as_of),
    }
    shaped = joined.select(*[v.alias(k) for k, v in dims.items()], "_volume", "_rows", "_plan")
    return (shaped.groupBy(*dims).agg(
                F.sum("_volume").alias("total_volumeactualcase"),
                F.sum(F.coalesce("_plan", F.lit(0.0)) * F.col("_rows")).alias("total_plan_qty"),
                F.sum("_rows").alias("_rows"))
            .withColumn("average_volume", F.col("total_volumeactualcase") / F.col("_rows")).drop("_rows"))
