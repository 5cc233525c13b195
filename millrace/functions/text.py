"""Text cleaning, masking, matching and safe casts."""

from __future__ import annotations

from collections.abc import Callable, Iterable, Sequence
from functools import reduce
from operator import or_

from pyspark.sql import Column
from pyspark.sql import functions as F


def clean(col: Column, default: str, fn: Callable[[Column], Column] = F.trim) -> Column:
    """``default`` for NULL or the text NULL, else ``fn(col)``."""
    return F.when(col.isNull() | (col == "NULL"), F.lit(default)).otherwise(fn(col))


def mask_prefix(col: Column, keep: int = 3, tail: str = "***") -> Column:
    return F.concat(F.substring(F.trim(col), 1, keep), F.lit(tail))


def without_spaces(col: Column, by: str = "") -> Column:
    return F.regexp_replace(col, " ", by)


def without(col: Column, marks: str) -> Column:
    """Text without any of the characters ``marks``. Text that has none is passed on as it is, not looked up by character."""
    return reduce(lambda left, mark: F.replace(left, F.lit(mark), F.lit("")), marks, col)


def strip_parens(col: Column) -> Column:
    return without(col, "()")


def strip_list_marks(col: Column) -> Column:
    """Drop the brackets and quotes of a list kept as text: ``["U1"]`` -> ``U1``."""
    return without(col, '[]"')


def unquoted(col: Column) -> Column:
    return F.translate(col, '"', "")


def text_or_empty(col: Column) -> Column:
    """NULL to empty text. Casts first: ``coalesce(ts, '')`` would try to read '' as a timestamp."""
    return F.coalesce(col.cast("string"), F.lit(""))


def ieq(a: Column, b: Column | str) -> Column:
    """Equality under a case-blind collation."""
    other = F.lit(b.lower()) if isinstance(b, str) else F.lower(b)
    return F.lower(a) == other


def like_any(col: Column, patterns: Sequence[str], ignore_case: bool = False) -> Column:
    match = (lambda p: col.ilike(p)) if ignore_case else (lambda p: col.like(p))
    return reduce(or_, [match(p) for p in patterns])


def first_match(rules: Iterable[tuple[Column, object]], default: object = None) -> Column:
    """Ordered CASE: the first true predicate wins; a NULL predicate does not match."""
    chain = None
    for test, value in rules:
        chain = (F if chain is None else chain).when(test, value)
    if chain is None:
        raise ValueError("no rules given")
    return chain.otherwise(default)


def classify_like(cols: Sequence[Column], rules: Iterable[tuple[str | Sequence[str], str]],
                  default: str = "", ignore_case: bool = True) -> Column:
    """Label of the first rule one of whose patterns matches any of ``cols``."""

    def hit(patterns: str | Sequence[str]) -> Column:
        given = [patterns] if isinstance(patterns, str) else list(patterns)
        return reduce(or_, [F.coalesce(like_any(c, given, ignore_case), F.lit(False)) for c in cols])

    return first_match([(hit(p), F.lit(label)) for p, label in rules], F.lit(default))


def contains_text(col: Column, needle: str) -> Column:
    return F.lower(col).contains(needle.lower())


def has_digit(col: Column, anchored: bool = False) -> Column:
    """A digit anywhere; ``anchored`` is the whole-string reading (exactly one digit)."""
    return col.rlike("^[0-9]$" if anchored else "[0-9]")


def to_number(col: Column, kind: str = "decimal(38,0)") -> Column:
    """NULL instead of an error when the text is not a number."""
    return col.try_cast(kind)


def blank_safe_cast(col: Column, kind: str) -> Column:
    return F.nullif(F.trim(col), F.lit("")).try_cast(kind)
