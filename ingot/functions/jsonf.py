"""JSON predicates and parsers on raw NDJSON lines."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F
from pyspark.sql import types as T


def is_json_object(value: Column) -> Column:
    """Good-line predicate.

    True for a JSON object (also ``{}`` and objects with duplicate keys); false
    for blank, truncated, non-JSON, ``null`` and array lines.  Text after a
    complete object still passes, as with a streaming line parser.
    """
    return F.json_object_keys(value).isNotNull()


def is_blank(value: Column) -> Column:
    return F.trim(value) == F.lit("")


def top_level_keys(value: Column) -> Column:
    return F.json_object_keys(value)


def unknown_keys(value: Column, known: list[str]) -> Column:
    """Top-level keys of a line that the schema does not know (K4)."""
    return F.sort_array(F.array_except(F.json_object_keys(value),
                                       F.array(*[F.lit(k) for k in known]).cast("array<string>")))


def object_or_array(text: Column, element_type: T.DataType) -> Column:
    """A JSON value that is either one object or an array of objects -> array.

    ``from_json`` into ``array<struct>`` accepts a single object and wraps it.
    """
    return F.from_json(text, T.ArrayType(element_type))
