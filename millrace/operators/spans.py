"""Validity spans per key: gaps between consecutive spans and what follows from them."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from .ordered import next_row


def span_gaps(df: DataFrame, key: str, eff: str, term: str, tie_break: Sequence[str] = (),
              restart_days: int = 90, gap_days: int = 2, bucket: Column | None = None) -> DataFrame:
    """Days from each span's end to the next span's start, with flags for a restart and a gap.

    The last span of a key has no next one: its gap is NULL and both flags are 0.
    """
    order = [eff, term, *tie_break]
    out = next_row(df, [key], order, {eff: "next_eff", term: "next_term"}, bucket)
    gap = F.datediff(F.col("next_eff"), F.col(term))
    return out.withColumns({
        "gap": gap,
        "restart": F.when(gap > restart_days, 1).otherwise(0),
        "enrollgap": F.when(gap >= gap_days, 1).otherwise(0),
    })


def continuous_start(eff: str) -> Column:
    """Aggregate over a key's gaps: start of the span after its last restart, else its first start.

    Starts only grow along the spans, so the last restart is the one with the greatest next start.
    """
    return F.coalesce(F.max(F.when(F.col("restart") == 1, F.col("next_eff"))), F.min(eff))


def term_before_gap(eff: str, term: str, tie_break: Sequence[str] = ()) -> Column:
    """Aggregate over a key's gaps: end of the span before its last gap, else its latest end."""
    place = F.when(F.col("enrollgap") == 1, F.struct(eff, term, *tie_break))
    return F.coalesce(F.max_by(term, place), F.max(term))


def days_since_opt_out(opt_outs: DataFrame, opt_ins: DataFrame, key: str, extra: Sequence[str]) -> DataFrame:
    """Latest opt-in that began after an opt-out ended, per key, and the days since the nearest such end.

    Only a key's latest opt-in can be the answer: if any opt-in follows an opt-out, the latest one does.
    So opt-ins shrink to one row per key before they meet the opt-outs, and no span pairs are formed.
    Inputs have ``eff`` and ``term``; spans that end before they start are ignored.
    """
    newest = (opt_ins.filter(F.col("eff") <= F.col("term")).groupBy(key).agg(F.max("eff").alias("latest_opt_in")))
    return (opt_outs.filter(F.col("eff") <= F.col("term")).join(newest, key)
            .filter(F.col("latest_opt_in") > F.col("term"))
            .groupBy(key, *extra)
            .agg(F.max("latest_opt_in").alias("latest_opt_in"),
                 F.min(F.datediff("latest_opt_in", "term")).alias("days")))
