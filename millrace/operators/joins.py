"""Join shapes. Strategy is left to Catalyst/AQE unless a side's size is fixed by construction."""

from __future__ import annotations

from collections.abc import Sequence
from dataclasses import dataclass
from functools import reduce
from operator import and_
from typing import Literal

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from .ordered import top1


def star(base: DataFrame, dims: Sequence[tuple[DataFrame, Column | list[str], str]]) -> DataFrame:
    """Chain of ``(frame, condition, how)`` joins from one driving table."""
    out = base
    for dim, on, how in dims:
        out = out.join(dim, on, how)
    return out


def not_in(left: DataFrame, right: DataFrame, key: str) -> DataFrame:
    """Rows whose non-NULL key is absent from ``right``; ``key`` must not be NULL on the right."""
    return left.join(right.select(key), key, "left_anti")


def decode_multi(df: DataFrame, codes: DataFrame, key: str, value: str,
                 wanted: dict[str, tuple[str, Column]]) -> DataFrame:
    """Same dimension joined once per code column: ``{out: (code column, filter of the code list)}``."""
    out = df
    for name, (code, rule) in wanted.items():
        part = codes.filter(rule).select(F.col(key).cast("string").alias(f"_{name}_key"), F.col(value).alias(name))
        out = out.join(part, F.col(code).cast("string") == F.col(f"_{name}_key"), "left").drop(f"_{name}_key")
    return out


def grid(df: DataFrame, low: Column, high: Column, name: str) -> DataFrame:
    """One row per integer of the closed interval [low, high]; empty intervals give no row.

    Where an integer domain is crossed with a table and then cut by a range (store x hour within opening
    hours), generating just the points inside the range makes the rest an equi-join.
    """
    inside = F.when(low <= high, F.sequence(low, high))
    return df.withColumn(name, F.explode(inside))


def point_in_range_join(points: DataFrame, spans: DataFrame, keys: list[str], point: str,
                        low: str, high: str) -> DataFrame:
    """Equi + range join of an integer point within [low, high], bounds included, as a pure equi-join."""
    return points.join(grid(spans, F.col(low), F.col(high), point), [*keys, point])


def update_from(df: DataFrame, src: DataFrame, on: dict[str, str], assign: dict[str, Column],
                keep: Literal["coalesce", "flag"] = "coalesce", pick: Sequence[Column] | None = None) -> DataFrame:
    """Set-based UPDATE ... FROM. Unmatched rows keep their values; row count never changes.

    ``on`` maps target to source key columns, ``assign`` target columns to expressions over ``src``.
    ``coalesce`` keeps the old value where the new one is NULL; ``flag`` lets a matched NULL win. If the
    source is not unique per key, ``pick`` orders its rows and the first one counts.
    """
    keys = {t: f"_u_k{i}" for i, t in enumerate(on)}
    new = {t: f"_u_v{i}" for i, t in enumerate(assign)}
    order = {f"_u_o{i}": c for i, c in enumerate(pick or [])}
    unique = src.select(*[F.col(s).alias(keys[t]) for t, s in on.items()], *[v.alias(new[t]) for t, v in assign.items()],
                        *[c.alias(n) for n, c in order.items()], F.lit(True).alias("_u_hit"))
    if order:
        unique = top1(unique, list(keys.values()), [F.col(c).desc_nulls_last() for c in [*order, *new.values()]])
    types = {f.name: f.dataType for f in df.schema}

    def updated(t: str) -> Column:
        old, given = F.col(f"`{t}`"), F.col(new[t]).cast(types[t])
        return F.coalesce(given, old) if keep == "coalesce" else F.when(F.col("_u_hit"), given).otherwise(old)

    cond = reduce(and_, [F.col(t) == F.col(k) for t, k in keys.items()])
    return df.join(unique, cond, "left").select(*[updated(c).alias(c) if c in new else F.col(f"`{c}`") for c in types])


@dataclass(frozen=True)
class Overlay:
    """One source of ``overlay``: its key column, what it assigns, and as in ``update_from`` ``keep`` and ``pick``."""

    src: DataFrame
    key: str
    assign: dict[str, Column]
    keep: Literal["coalesce", "flag"] = "coalesce"
    pick: Sequence[Column] = ()


def overlay(df: DataFrame, key: str, overlays: Sequence[Overlay]) -> DataFrame:
    """Several set-based UPDATE ... FROM on one key at once, in the order given; row count never changes.

    The sources become one union of rows (key, one struct for each source), which is aggregated once: the greatest struct
    of a source, its ``pick`` values first, is the row that counts. So there is one shuffle of all sources, combined before
    it, and one join, where a chain of updates has two shuffles and a join for each.
    """
    types = {f.name: f.dataType for f in df.schema}
    rows = [o.src.select(F.col(o.key).alias("_o_key"), F.struct(
        *[c.alias(f"o{i}") for i, c in enumerate(o.pick)],
        *[v.cast(types[t]).alias(f"v{i}") for i, (t, v) in enumerate(o.assign.items())]).alias(f"_o_{n}"))
        for n, o in enumerate(overlays)]
    tagged = reduce(lambda a, b: a.unionByName(b, allowMissingColumns=True), rows).filter(F.col("_o_key").isNotNull())
    best = tagged.groupBy("_o_key").agg(*[F.max(f"_o_{n}").alias(f"_o_{n}") for n in range(len(overlays))])
    new = {t: F.col(f"`{t}`") for t in types}
    for n, o in enumerate(overlays):
        for i, t in enumerate(o.assign):
            given, hit = F.col(f"_o_{n}.v{i}"), F.col(f"_o_{n}").isNotNull()
            new[t] = F.coalesce(given, new[t]) if o.keep == "coalesce" else F.when(hit, given).otherwise(new[t])
    return df.join(best, F.col(key) == F.col("_o_key"), "left").select(*[v.alias(t) for t, v in new.items()])


def cast_key(df: DataFrame, *cols: str, kind: str = "string") -> DataFrame:
    """Keys brought to one type before the join, so the join itself stays a plain equi-join."""
    return df.withColumns({c: F.col(c).try_cast(kind) for c in cols})
