"""JSON text columns. Each column is parsed once with a declared schema, not once per field."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F


def parse(col: Column, schema: str, strict: bool = False) -> Column:
    """Typed view of JSON text. Bad text gives NULL, or fails the job when ``strict``.

    Empty text is absent data, not bad JSON, in either mode.
    """
    text = F.nullif(F.trim(col), F.lit(""))
    return F.from_json(text, schema, {"mode": "FAILFAST" if strict else "PERMISSIVE"})


def text_fields(names: list[str]) -> str:
    """Schema of an object all of whose named fields are read as text."""
    return "struct<" + ",".join(f"`{n}`:string" for n in names) + ">"


# A compact array of objects whose values all are text, with no escapes but the short ones that a writer makes. Groups are
# possessive: a match takes no stack, however long the text.
_IN_TEXT = r'[^"\\]*'
_TEXTS_ONLY = rf'^\[(?:\{{(?:"{_IN_TEXT}":"{_IN_TEXT}(?:\\["\\bfnrt]{_IN_TEXT})*+",?+)*+\}},?+)*+\]$'


def holds_texts(col: Column) -> Column:
    """Whether JSON text is an array of objects of text alone, without spaces. Commas are not looked at: ``parse`` does that."""
    return col.rlike(_TEXTS_ONLY)


def field(col: Column, path: str, kind: str = "string") -> Column:
    """One value out of JSON text, e.g. ``field(c, "a.b")``. For several fields use ``parse``."""
    return F.get_json_object(col, f"$.{path}").try_cast(kind)


def inner_json(col: Column, outer: str, path: str, kind: str = "string") -> Column:
    """A value inside JSON that is itself held as text in a field of JSON (encoded twice)."""
    return field(F.get_json_object(col, f"$.{outer}"), path, kind)


def canonical(col: Column, strict: bool = False) -> Column:
    """JSON text in one form per value: keys sorted, no spaces, numbers as plain as they go (``1.50`` is ``1.5``).

    Two objects that differ only in key order are one value in semi-structured columns. Bad text is NULL,
    or fails the job when ``strict``.
    """
    return F.to_json((F.parse_json if strict else F.try_parse_json)(col))
