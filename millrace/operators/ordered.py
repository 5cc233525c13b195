"""Operators that need an order inside a key.

A window over one key runs in one task. Top-1 forms are safe at any skew, since Spark prunes them to
one row per key and map task before the shuffle (``WindowGroupLimit``). Numbering and next row, which keep
every row, take a ``bucket``: a column that never decreases along the order, such as the month. Work is then
split per (key, bucket) and what must cross a bucket boundary is carried over on one summary row per (key,
bucket). The as-of join and the rank over a whole result cut their rows into ranges sized from the data.
"""

from __future__ import annotations

from collections.abc import Sequence
from functools import reduce
from operator import and_

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F
from pyspark.sql.types import TimestampType


DEAL = 64  # parts over which the rows of a range that is all ties are dealt


def top1(df: DataFrame, keys: Sequence[str], order: Sequence[Column]) -> DataFrame:
    """First row of each key; give ``order`` a full tie-break."""
    numbered_rows = df.withColumn("_rn", F.row_number().over(Window.partitionBy(*keys).orderBy(*order)))
    return numbered_rows.filter(F.col("_rn") == 1).drop("_rn")


def first_ties(df: DataFrame, keys: Sequence[str], order: Sequence[Column]) -> DataFrame:
    """All rows of each key that share its first ``order`` value."""
    ranked = df.withColumn("_rk", F.rank().over(Window.partitionBy(*keys).orderBy(*order)))
    return ranked.filter(F.col("_rk") == 1).drop("_rk")


def last_event(df: DataFrame, key: str, order: str) -> DataFrame:
    """Rows holding the greatest ``order`` of their key (the whole-partition ``last_value`` form)."""
    return first_ties(df, [key], [F.col(order).desc_nulls_last()])


def _same(keys: Sequence[str], renamed: dict[str, str]) -> Column:
    return reduce(and_, [F.col(k).eqNullSafe(F.col(renamed[k])) for k in keys])


def numbered(df: DataFrame, keys: Sequence[str], order: Sequence[Column], name: str,
             bucket: Column | None = None, bucket_desc: bool = False, ties: bool = False) -> DataFrame:
    """``row_number`` (or ``rank`` with ``ties``) kept as a column.

    With ``bucket``, rows are numbered inside (key, bucket) and shifted by the count of earlier buckets.
    """
    count_rows = F.rank() if ties else F.row_number()
    if bucket is None:
        return df.withColumn(name, count_rows.over(Window.partitionBy(*keys).orderBy(*order)))
    rows = df.withColumn("_bucket", bucket)
    parts = [*keys, "_bucket"]
    renamed = {k: f"_n_{i}" for i, k in enumerate(parts)}
    step = F.col(renamed["_bucket"])
    earlier = (Window.partitionBy(*[renamed[k] for k in keys])
               .orderBy(step.desc_nulls_last() if bucket_desc else step.asc_nulls_first())
               .rowsBetween(Window.unboundedPreceding, -1))
    shift = (rows.groupBy(*[F.col(k).alias(renamed[k]) for k in parts]).agg(F.count("*").alias("_n"))
             .withColumn("_shift", F.coalesce(F.sum("_n").over(earlier), F.lit(0))).drop("_n"))
    local = rows.withColumn("_local", count_rows.over(Window.partitionBy(*parts).orderBy(*order)))
    return (local.join(shift, _same(parts, renamed), "left")
            .withColumn(name, (F.col("_local") + F.col("_shift")).cast("int"))
            .drop("_bucket", "_local", "_shift", *renamed.values()))


def next_row(df: DataFrame, keys: Sequence[str], order: Sequence[str], cols: dict[str, str],
             bucket: Column | None = None) -> DataFrame:
    """Adds, under new names, columns of the following row of the key: ``{column: new name}``.

    ``order`` is ascending and needs a full tie-break. Replaces a self join on row number + 1.
    """
    row = F.struct(*cols)
    if bucket is None:
        out = df.withColumn("_next", F.lead(row).over(Window.partitionBy(*keys).orderBy(*order)))
        return out.select(*df.columns, *[F.col(f"_next.{c}").alias(n) for c, n in cols.items()])
    rows = df.withColumn("_bucket", bucket)
    parts = [*keys, "_bucket"]
    renamed = {k: f"_f_{i}" for i, k in enumerate(parts)}
    heads = (rows.groupBy(*[F.col(k).alias(renamed[k]) for k in parts])
             .agg(F.min(F.struct(*[F.col(o).alias(f"_o{i}") for i, o in enumerate(order)], row.alias("row"))).alias("head")))
    following = Window.partitionBy(*[renamed[k] for k in keys]).orderBy(F.col(renamed["_bucket"]).asc_nulls_first())
    heads = heads.withColumn("_after", F.lead("head.row").over(following)).drop("head")
    out = (rows.withColumn("_next", F.lead(row).over(Window.partitionBy(*parts).orderBy(*order)))
           .join(heads, _same(parts, renamed), "left")
           .withColumn("_next", F.coalesce("_next", "_after")))
    return out.select(*df.columns, *[F.col(f"_next.{c}").alias(n) for c, n in cols.items()])


def range_of(df: DataFrame, order: dict[str, bool], ranges: int | None = None, nulls_last: bool = True) -> Column:
    """Number of a row's range when ``df`` is cut, along ``order`` (``{column: ascending}``), into ranges of like size.

    Bounds come from a sample of some 64 rows a range, as many ranges as shuffle partitions unless given. They are literals,
    so the number depends on the row alone: every step and every retry sees the same ranges. Rows equal to a bound are a
    range of their own, with an odd number; frequent values become bounds. All rows of an even range lie between two
    bounds, so neither kind holds a large share of the rows but one that is all ties. A row finds its range by halving, so
    the work on it hardly grows with the number of ranges. Timestamps are compared as microseconds: a local time that comes
    twice a year would put the bounds out of order.
    """
    ranges = ranges or int(df.sparkSession.conf.get("spark.sql.shuffle.partitions"))
    n = df.count()
    value = {c: F.unix_micros(c) if df.schema[c].dataType == TimestampType() else F.col(c) for c in order}
    keys = df.select(*[v.alias(c) for c, v in value.items()])
    null_place = "nulls_last" if nulls_last else "nulls_first"
    sort = [getattr(F.col(c), f"{'asc' if up else 'desc'}_{null_place}")() for c, up in order.items()]
    rows = keys.sample(min(1.0, 64 * ranges / max(1, n)), 7).orderBy(*sort).collect()
    step = max(1, len(rows) // ranges)
    bounds = list(dict.fromkeys(tuple(r) for r in rows[step // 2::step]))
    if not bounds:
        return F.lit(0)
    literal = F.array(*[F.struct(*[F.lit(v).cast(f.dataType).alias(f"b{i}") for i, (v, f) in enumerate(zip(b, keys.schema))])
                        for b in bounds])

    def place(bound: Column) -> Column:
        """2 behind the bound, 1 at it, 0 before it."""
        out = F.lit(1)
        for i, (c, up) in reversed(list(enumerate(order.items()))):
            mine, other = value[c], bound.getField(f"b{i}")
            behind = (F.when(mine.isNull(), F.lit(nulls_last)).when(other.isNull(), F.lit(not nulls_last))
                      .otherwise(mine > other if up else mine < other))
            out = F.when(mine.eqNullSafe(other), out).when(behind, 2).otherwise(0)
        return out

    n, steps = len(bounds), F.array(*[F.lit(1 << i) for i in reversed(range(len(bounds).bit_length()))])

    def search(given: Column) -> Column:
        def further(passed: Column, step: Column) -> Column:
            return passed + F.when((passed + step <= n) & (place(F.get(given, passed + step - 1)) == 2), step).otherwise(0)

        return F.aggregate(steps, F.lit(0), further,
                           lambda passed: 2 * passed + F.when((passed < n) & (place(F.get(given, passed)) == 1), 1).otherwise(0))

    return F.get(F.transform(F.array(literal), search), F.lit(0))  # the bounds stand in the plan once


def asof_join(left: DataFrame, right: DataFrame, on: dict[str, str], left_ts: str, right_ts: str,
              values: dict[str, str], strict: bool = True, ranges: int | None = None) -> DataFrame:
    """Every left row with the latest right row of its key before it; unmatched rows get NULLs.

    ``on`` maps left to right key columns and ``values`` right columns to their output names. With
    ``strict`` a right row at the very same time does not match. Right rows of one key and time are
    ordered by their values, greatest wins. NULL keys never match.

    Both sides are interleaved and the last right row is carried forward, so nothing multiplies. (key, time) is cut into
    ranges sized from the data (``range_of``): a task carries inside one key and range, and what earlier ranges hand on
    comes from one summary row per key and range. Rows of one key and time that fill a range by themselves are dealt over
    ``DEAL`` parts: they need no order among them, as the summary alone tells what they find.
    """
    keys = [f"_k{i}" for i in range(len(on))]
    hit = F.struct(*[F.col(v).alias(n) for v, n in values.items()])
    known = reduce(and_, [F.col(r).isNotNull() for r in [*on.values(), right_ts]])
    lefts = left.select(*[F.col(c).alias(k) for c, k in zip(on, keys)], F.col(left_ts).alias("_ts"),
                        F.lit(0 if strict else 2).alias("_side"), F.struct(*left.columns).alias("_row"))
    rights = right.filter(known).select(*[F.col(c).alias(k) for c, k in zip(on.values(), keys)],
                                        F.col(right_ts).alias("_ts"), F.lit(1).alias("_side"), hit.alias("_hit"))
    both = lefts.unionByName(rights, allowMissingColumns=True)
    cut = range_of(both.select(*keys, "_ts"), {**{k: True for k in keys}, "_ts": True}, ranges, nulls_last=False)
    tied = F.col("_range") % 2 == 1
    both = both.withColumn("_range", cut).withColumn(
        "_deal", F.when(tied, F.pmod(F.xxhash64("_row", "_hit"), F.lit(DEAL))).otherwise(0).cast("int"))
    earlier = Window.partitionBy(*keys).orderBy("_range").rowsBetween(Window.unboundedPreceding, -1)
    handed = (both.groupBy(*keys, "_range")
              .agg(F.max(F.when(F.col("_side") == 1, F.struct("_ts", "_hit"))).alias("_best"))
              .withColumn("_before", F.last("_best", ignorenulls=True).over(earlier))
              .select(*keys, "_range", F.col("_best._hit").alias("_best"), F.col("_before._hit").alias("_before"),
                      F.explode(F.when(tied, F.sequence(F.lit(0), F.lit(DEAL - 1))).otherwise(F.array(F.lit(0)))).alias("_deal")))
    parts = [*keys, "_range", "_deal"]
    so_far = F.last("_hit", ignorenulls=True).over(
        Window.partitionBy(*parts).orderBy(F.col("_ts").asc_nulls_first(), "_side", "_hit")
        .rowsBetween(Window.unboundedPreceding, 0))
    own = F.when(~tied, F.col("_so_far")).when(F.lit(not strict), F.col("_best"))
    found = [F.col(f"_found.{n}").alias(n) for n in values.values()]
    return (both.withColumn("_so_far", so_far).filter(F.col("_row").isNotNull()).join(handed, parts, "left")
            .withColumn("_found", F.coalesce(own, "_before")).select("_row.*", *found))


def global_rank(df: DataFrame, order: dict[str, bool], name: str, ranges: int | None = None) -> DataFrame:
    """``rank()`` over the whole result; ``order`` is ``{column: ascending}``, NULLs last.

    A window without a key would sort everything in one task. Instead the rows are cut into ranges (``range_of``), ranked
    inside each, and shifted by the number of rows in the ranges before it, which is one row per range. That is one shuffle
    of the rows. Rows of a range that is all ties share its first rank, so they are dealt out evenly and not ranked.
    """
    sort = [F.col(c).asc_nulls_last() if up else F.col(c).desc_nulls_last() for c, up in order.items()]
    rows = df.withColumn("_range", range_of(df, order, ranges))
    # one row per range, so the keyless window below and the broadcast are bounded by the number of ranges
    before = Window.orderBy("_range").rowsBetween(Window.unboundedPreceding, -1)
    shift = (rows.groupBy("_range").agg(F.count("*").alias("_rows"))
             .select("_range", F.coalesce(F.sum("_rows").over(before), F.lit(0)).alias("_shift")))
    tied = F.col("_range") % 2 == 1
    deal = F.when(tied, F.pmod(F.xxhash64(*df.columns), F.lit(DEAL))).otherwise(0)
    local = F.rank().over(Window.partitionBy("_range", "_deal").orderBy(*sort))
    return (rows.withColumn("_deal", deal).withColumn("_local", F.when(tied, 1).otherwise(local))
            .join(F.broadcast(shift), "_range")
            .select(*df.columns, (F.col("_local") + F.col("_shift")).cast("long").alias(name)))
