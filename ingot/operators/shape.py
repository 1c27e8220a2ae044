"""The shape of raw records, taken from the data: read schemas that lose nothing.

One JVM aggregate per file merges the record shapes of its lines (``schema_of_variant_agg``).
Structure becomes structs and arrays where a repair rule has to reach into it; everything
else, and every scalar outside an array, is read as VARIANT, which keeps numbers, quoted
numbers, timestamps, explicit nulls and values of mixed kind as they are.
"""

from __future__ import annotations

import re

from pyspark.sql import Column
from pyspark.sql import functions as F
from pyspark.sql import types as T

VARIANT = T.VariantType()
#: Scalars that arrays hold as themselves, so that a NULL element is a NULL.
ELEMENT_TYPES = (T.StringType, T.LongType, T.BooleanType)


def record_shape(value: Column, keys: tuple[str, ...] | None, unions: tuple[str, ...] = (), skip: tuple[str, ...] = ()) -> Column:
    """A variant per line whose shape is what the rules need to know: all top-level keys, with
    the values of ``keys`` (None: of all but ``skip``).  A value of ``unions`` that is one object
    counts as an array of it."""
    def kept(k: Column, v: Column) -> Column:
        out = F.when(k.isin(*unions) & F.schema_of_variant(v).startswith("OBJECT"),
                     F.parse_json(F.concat(F.lit("["), F.to_json(v), F.lit("]")))).otherwise(v) if unions else v
        if keys is not None:
            return F.when(k.isin(*keys), out)
        return F.when(~k.isin(*skip), out) if skip else out

    return F.to_variant_object(F.transform_values(F.from_json(value, "map<string,variant>"), kept))


def parse_shape(text: str) -> T.DataType:
    """Spark's text of a variant schema as a type; objects become structs."""
    parts = re.split(r"(`(?:[^`]|``)*`)", text)
    return T.DataType.fromDDL("".join(p if i % 2 else p.replace("OBJECT<>", "STRUCT<>").replace("OBJECT<", "STRUCT<") for i, p in enumerate(parts)))


def merge_shapes(a: T.DataType, b: T.DataType) -> T.DataType:
    """Shape of records of either shape; VARIANT where the kinds differ."""
    if isinstance(a, T.NullType):
        return b
    if isinstance(b, T.NullType) or a == b:
        return a
    if isinstance(a, T.StructType) and isinstance(b, T.StructType):
        out = {f.name: f.dataType for f in a.fields}
        for f in b.fields:
            out[f.name] = merge_shapes(out[f.name], f.dataType) if f.name in out else f.dataType
        return T.StructType([T.StructField(k, v) for k, v in out.items()])
    if isinstance(a, T.ArrayType) and isinstance(b, T.ArrayType):
        return T.ArrayType(merge_shapes(a.elementType, b.elementType))
    if isinstance(a, T.NumericType) and isinstance(b, T.NumericType):
        return T.DoubleType()  # any number; scalars of several number types are read as VARIANT
    return VARIANT


def mixed(shape: T.DataType) -> bool:
    """Whether values of different kinds meet somewhere in the shape."""
    if isinstance(shape, T.StructType):
        return any(mixed(f.dataType) for f in shape.fields)
    return mixed(shape.elementType) if isinstance(shape, T.ArrayType) else isinstance(shape, T.VariantType)


def reader(shape: T.DataType, element: bool = False) -> T.DataType:
    """The type that reads a shape without loss."""
    if isinstance(shape, T.StructType) and shape.fields:
        return T.StructType([T.StructField(f.name, reader(f.dataType)) for f in shape.fields])
    if isinstance(shape, T.ArrayType):
        return T.ArrayType(reader(shape.elementType, True))
    return shape if element and isinstance(shape, ELEMENT_TYPES) else VARIANT


def with_table_fields(read: T.DataType, table: T.DataType) -> T.DataType:
    """``read`` with the table's fields that the data lacks, for placeholders; where the two
    disagree the data decides."""
    if isinstance(read, T.StructType) and isinstance(table, T.StructType):
        fields = [T.StructField(f.name, with_table_fields(f.dataType, table[f.name].dataType) if f.name in table.names else f.dataType) for f in read.fields]
        return T.StructType(fields + [T.StructField(f.name, reader(f.dataType)) for f in table.fields if f.name not in read.names])
    if isinstance(read, T.ArrayType) and isinstance(table, T.ArrayType):
        if isinstance(read.elementType, T.VariantType) and isinstance(table.elementType, (T.StructType, T.ArrayType)):
            return read
        return T.ArrayType(with_table_fields(read.elementType, table.elementType))
    return read


def check_names(shape: T.StructType) -> None:
    """Spark tells fields apart without case; two keys that differ only in case would merge."""
    seen: dict[str, str] = {}
    for f in shape.fields:
        other = seen.setdefault(f.name.lower(), f.name)
        if other != f.name:
            raise ValueError(f"keys {other!r} and {f.name!r} differ only in case")
        d = f.dataType
        while isinstance(d, T.ArrayType):
            d = d.elementType
        if isinstance(d, T.StructType):
            check_names(d)


def rename_in_variant(c: Column, old: str = "-", new: str = "_") -> Column:
    """``old`` to ``new`` in every key of a variant of mixed kinds, on its JSON text: an
    ``old`` is in a key if the next quote closes a string that a colon follows."""
    return F.try_parse_json(F.regexp_replace(F.to_json(c), re.escape(old) + r'(?=[^"]*"\s*:)', new))


def is_null(c: Column, dt: T.DataType) -> Column:
    return c.isNull() | F.coalesce(F.is_variant_null(c), F.lit(False)) if isinstance(dt, T.VariantType) else c.isNull()
