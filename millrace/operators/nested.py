"""Arrays held as JSON text, turned into rows."""

from __future__ import annotations

from collections.abc import Callable, Mapping, Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ..functions.jsonx import canonical, holds_texts, parse, text_fields


def flatten(df: DataFrame, col: str, schema: str, name: str = "elem", outer: bool = False,
            index: str | None = None, strict: bool = False) -> DataFrame:
    """One row per element of the JSON array in ``col``.

    Rows with a NULL or empty array vanish unless ``outer``; ``index`` adds the zero-based position.
    Element type ``string`` keeps each element as JSON text.
    """
    items = parse(F.col(col), f"array<{schema}>", strict)
    if index is None:
        return df.select("*", (F.explode_outer if outer else F.explode)(items).alias(name))
    make = F.posexplode_outer if outer else F.posexplode
    return df.select("*", make(items).alias(index, name))


def flatten_typed(df: DataFrame, col: str, name: str, index: str | None = None) -> DataFrame:
    """Same for a column that is an array already, e.g. the inner level of a nested array."""
    if index is None:
        return df.select("*", F.explode(col).alias(name))
    return df.select("*", F.posexplode(col).alias(index, name))


def tagged_elements(df: DataFrame, columns: Mapping[str, str], tag: str, name: str,
                    strict: bool = False, form: Callable[[Column], Column] = lambda elements: elements) -> DataFrame:
    """Elements of several JSON array columns as rows, tagged with where they came from.

    One scan for all columns: the columns become one array of (tag, elements) that is exploded twice,
    instead of one scan, extraction and union branch per column. ``form`` changes the array of a column's
    elements before it is exploded.
    """
    sets = F.array(*[
        F.struct(F.lit(t).alias("tag"), form(parse(F.col(c), "array<string>", strict)).alias("elems"))
        for c, t in columns.items()
    ])
    rest = [c for c in df.columns if c not in columns]
    return (df.select(*rest, F.explode(sets).alias("_set"))
            .select(*rest, F.col("_set.tag").alias(tag), F.explode("_set.elems").alias(name)))


def tagged_objects(df: DataFrame, columns: Mapping[str, str], tag: str, name: str, fields: Sequence[str], values: str,
                   strict: bool = False) -> DataFrame:
    """Distinct elements of each array: ``tagged_elements`` as ``canonical`` text, and ``fields`` read from it as a struct.

    An array that consists of these fields as text is parsed as a whole, and its elements' text is written from the fields:
    with sorted keys that is the canonical text. That the array holds nothing else follows from its form and its length, which
    an unknown or repeated key would add to. Any other array is split into texts, each of which is parsed and read.
    """
    rest, wanted = [c for c in df.columns if c not in columns], text_fields(sorted(set(fields)))
    sets = F.array(*[F.struct(F.lit(t).alias("_tag"), F.col(c).alias("_text")) for c, t in columns.items()])
    rows = df.select(*rest, F.inline(sets)).filter(F.trim("_text") != "[]")
    # A select of its own for each: what is used several times is not computed anew.
    rows = rows.select("*", F.when(holds_texts(F.col("_text")), parse(F.col("_text"), f"array<{wanted}>", strict)).alias("_items"))
    rows = rows.select("*", F.transform("_items", lambda e: F.to_json(e)).alias("_texts"))
    rows = rows.select("*", F.array_distinct("_texts").alias("_once"))
    listed = lambda texts: F.concat(F.lit("["), F.array_join(texts, ","), F.lit("]"))
    pairs = lambda texts, items: F.zip_with(texts, items, lambda t, e: F.struct(t.alias(name), e.alias(values)))
    whole = F.coalesce(F.octet_length(listed("_texts")) == F.octet_length("_text"), F.lit(False))
    split = F.array_distinct(F.transform(parse(F.col("_text"), "array<string>", strict), lambda e: canonical(e, strict)))
    elements = (F.when(~whole, F.transform(split, lambda t: F.struct(t.alias(name), parse(t, wanted).alias(values))))
                .when(F.size("_once") == F.size("_texts"), pairs("_texts", "_items"))
                .otherwise(pairs("_once", parse(listed("_once"), f"array<{wanted}>"))))
    return rows.select(*rest, F.col("_tag").alias(tag), F.inline(elements))
