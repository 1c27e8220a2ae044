"""Schema-driven builders for nested columns.

Every builder takes the column's Spark type, so it works at any depth and the
generated plan is one projection (``transform`` / ``withField`` / ``filter``),
with no shuffle and no Python per row.
"""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import Column
from pyspark.sql import functions as F
from pyspark.sql import types as T

ColFn = Callable[[Column, T.DataType], Column]


def typed_null(dt: T.DataType) -> Column:
    return F.lit(None).cast(dt)


def empty_value(dt: T.DataType, overrides=None, arrays_empty: bool = True) -> Column:
    """A typed placeholder value.

    Structs are rebuilt field by field: every leaf is NULL unless ``overrides``
    (a nested dict) names it; array fields become ``[]`` when ``arrays_empty``
    (the table contract), NULL otherwise.  Overrides naming fields that the
    target type lacks are ignored, so a placeholder always fits its column.
    """
    if isinstance(dt, T.StructType):
        ov = overrides if isinstance(overrides, dict) else {}
        parts = []
        for f in dt.fields:
            sub = ov.get(f.name)
            if isinstance(f.dataType, T.StructType) and isinstance(sub, dict):
                val = empty_value(f.dataType, sub, arrays_empty)
            elif f.name in ov and not isinstance(sub, dict):
                val = F.lit(sub).cast(f.dataType) if sub is not None else typed_null(f.dataType)
                if isinstance(f.dataType, T.ArrayType) and sub == []:
                    val = F.array().cast(f.dataType)
            elif isinstance(f.dataType, T.ArrayType) and arrays_empty:
                val = F.array().cast(f.dataType)
            else:
                val = typed_null(f.dataType)
            parts.append(val.alias(f.name))
        return F.struct(*parts)
    if isinstance(dt, T.ArrayType):
        return F.array().cast(dt) if arrays_empty else typed_null(dt)
    if overrides is not None:
        return F.lit(overrides).cast(dt)
    return typed_null(dt)


def ensure_array(c: Column, dt: T.ArrayType) -> Column:
    """NULL array -> ``[]`` (R6); a VARIANT keeps what is not null."""
    if isinstance(dt, T.VariantType):
        return F.when(c.isNull() | F.coalesce(F.is_variant_null(c), F.lit(False)), F.parse_json(F.lit("[]"))).otherwise(c)
    return F.coalesce(c, F.array().cast(dt))


def as_variant(c: Column, dt: T.DataType) -> Column:
    """Any column as a VARIANT."""
    if isinstance(dt, T.VariantType):
        return c
    return F.parse_json(F.to_json(c)) if isinstance(dt, (T.StructType, T.ArrayType, T.MapType)) else c.cast("variant")


def compact(c: Column, dt: T.DataType | None = None) -> Column:
    """Remove NULL elements from an array (NULL stays NULL); elements of mixed kinds are
    VARIANTs, whose null is a value."""
    if isinstance(dt, T.VariantType):
        return c
    if isinstance(dt, T.ArrayType) and isinstance(dt.elementType, T.VariantType):
        return F.filter(c, lambda x: x.isNotNull() & ~F.coalesce(F.is_variant_null(x), F.lit(False)))
    return F.filter(c, lambda x: x.isNotNull())


def placeholder_array(c: Column, dt: T.ArrayType, default: Column | None = None) -> Column:
    """NULL or empty array -> one placeholder element.

    The one all-null element makes ``explode`` behave like ``explode_outer``.
    """
    if default is None:
        default = empty_value(dt.elementType, arrays_empty=False)
    return F.when(F.coalesce(F.size(c), F.lit(0)) <= 0, F.array(default)).otherwise(c)


def ensure_struct(c: Column, default: Column) -> Column:
    """NULL struct -> default struct."""
    return F.coalesce(c, default)


def at_path(c: Column, dt: T.DataType, path: str | list[str], fn: ColFn) -> Column:
    """Apply ``fn(col, type)`` to the field at ``path`` (dot-separated).

    Arrays on the way are traversed with ``transform``; structs are updated with
    ``withField``, which leaves a NULL parent NULL (the reference only touches
    a nested field when its parent exists).
    """
    parts = path.split(".") if isinstance(path, str) else list(path)
    if not parts:
        return fn(c, dt)
    if isinstance(dt, T.ArrayType):
        return F.transform(c, lambda x: at_path(x, dt.elementType, parts, fn))
    if isinstance(dt, T.VariantType):
        return c  # of mixed kinds: left as it is
    if not isinstance(dt, T.StructType):
        raise TypeError(f"cannot descend into {dt.simpleString()} at {parts}")
    name = parts[0]
    if name not in dt.names:
        return c  # the target type lacks the field: nothing to repair
    sub_dt = dt[name].dataType
    return c.withField(name, at_path(c.getField(name), sub_dt, parts[1:], fn))


def drop_path(c: Column, dt: T.DataType, path: str) -> Column:
    """Drop a nested field, through arrays."""
    parts = path.split(".")
    parent, leaf = parts[:-1], parts[-1]

    def _drop(x: Column, d: T.DataType) -> Column:
        if isinstance(d, T.ArrayType):
            return F.transform(x, lambda e: _drop(e, d.elementType))
        return x.dropFields(leaf) if leaf in d.names else x

    return at_path(c, dt, parent, _drop)


def contains_array(dt: T.DataType) -> bool:
    if isinstance(dt, T.ArrayType):
        return True
    if isinstance(dt, T.StructType):
        return any(contains_array(f.dataType) for f in dt.fields)
    return False


def compact_arrays(c: Column, dt: T.DataType) -> Column:
    """Recursively remove NULL elements from every array at any depth.

    Only fields whose type holds an array are rebuilt, which keeps the plan small.
    NULL arrays and NULL structs stay NULL; top-level defaults are the rule's job.
    """
    if isinstance(dt, T.ArrayType):
        inner = dt.elementType
        kept = compact(c, dt)
        if contains_array(inner):
            return F.transform(kept, lambda x: compact_arrays(x, inner))
        return kept
    if isinstance(dt, T.StructType):
        out = c
        for f in dt.fields:
            if contains_array(f.dataType):
                out = out.withField(f.name, compact_arrays(c.getField(f.name), f.dataType))
        return out
    return c


def renamed_type(dt: T.DataType, old: str = "-", new: str = "_") -> T.DataType:
    """Type with ``old`` replaced by ``new`` in every field name; collisions merge."""
    if isinstance(dt, T.ArrayType):
        return T.ArrayType(renamed_type(dt.elementType, old, new), dt.containsNull)
    if isinstance(dt, T.MapType):
        return T.MapType(dt.keyType, renamed_type(dt.valueType, old, new), dt.valueContainsNull)
    if isinstance(dt, T.StructType):
        seen: dict[str, T.StructField] = {}
        for f in dt.fields:
            name = f.name.replace(old, new)
            ft = renamed_type(f.dataType, old, new)
            if name in seen and old in f.name:
                seen[name] = T.StructField(name, ft, True)  # the renamed key wins
            elif name not in seen:
                seen[name] = T.StructField(name, ft, f.nullable)
        return T.StructType(list(seen.values()))
    return dt


def _has_collision(dt: T.DataType, old: str, new: str) -> bool:
    if isinstance(dt, T.ArrayType):
        return _has_collision(dt.elementType, old, new)
    if isinstance(dt, T.MapType):
        return _has_collision(dt.valueType, old, new)
    if isinstance(dt, T.StructType):
        names = [f.name.replace(old, new) for f in dt.fields]
        if len(set(names)) != len(names):
            return True
        return any(_has_collision(f.dataType, old, new) for f in dt.fields)
    return False


def rename_keys(c: Column, dt: T.DataType, old: str = "-", new: str = "_") -> Column:
    """Replace ``old`` by ``new`` in every key at every depth.

    Without collisions a single cast renames all levels (struct casts match by
    position).  With a collision (``a-b`` next to ``a_b``) the struct is rebuilt
    and the hyphenated key's value wins, as in the reference; a hyphenated key
    holding NULL cannot be told from an absent one, so the clean value is kept then.
    """
    target = renamed_type(dt, old, new)
    if not _has_collision(dt, old, new):
        return c.cast(target)
    return _rebuild(c, dt, old, new)


def _rebuild(c: Column, dt: T.DataType, old: str, new: str) -> Column:
    if isinstance(dt, T.ArrayType):
        return F.transform(c, lambda x: _rebuild(x, dt.elementType, old, new))
    if isinstance(dt, T.MapType):
        return F.transform_values(c, lambda k, v: _rebuild(v, dt.valueType, old, new))
    if not isinstance(dt, T.StructType):
        return c
    groups: dict[str, list[T.StructField]] = {}
    for f in dt.fields:
        groups.setdefault(f.name.replace(old, new), []).append(f)
    parts = []
    for name, fields in groups.items():
        # renamed (hyphenated) keys first: their value overwrites the clean key
        ordered = sorted(fields, key=lambda f: old not in f.name)
        vals = [_rebuild(c.getField(f.name), f.dataType, old, new) for f in ordered]
        types = [renamed_type(f.dataType, old, new) for f in ordered]
        if len({t.simpleString() for t in types}) > 1:
            vals = [as_variant(v, t) for v, t in zip(vals, types)]
        parts.append((F.coalesce(*vals) if len(vals) > 1 else vals[0]).alias(name))
    return F.when(c.isNull(), F.lit(None)).otherwise(F.struct(*parts))


def fill_arrays(c: Column, dt: T.DataType) -> Column:
    """Table contract (1.4) at every depth: NULL arrays -> ``[]``, NULL elements removed.

    NULL structs stay NULL (a struct's presence is a rule's decision, R3/R4).
    """
    if isinstance(dt, T.ArrayType):
        inner = dt.elementType
        kept = compact(F.coalesce(c, F.array().cast(dt)))
        if contains_array(inner):
            return F.transform(kept, lambda x: fill_arrays(x, inner))
        return kept
    if isinstance(dt, T.StructType):
        out = c
        for f in dt.fields:
            if contains_array(f.dataType):
                out = out.withField(f.name, fill_arrays(c.getField(f.name), f.dataType))
        return out
    return c


def relaxed(dt: T.DataType) -> T.DataType:
    """The same type with every array element, map value and struct field nullable
    (a cast target that accepts any parsed value; emptiness rules are separate)."""
    if isinstance(dt, T.ArrayType):
        return T.ArrayType(relaxed(dt.elementType), True)
    if isinstance(dt, T.MapType):
        return T.MapType(dt.keyType, relaxed(dt.valueType), True)
    if isinstance(dt, T.StructType):
        return T.StructType([T.StructField(f.name, relaxed(f.dataType), True) for f in dt.fields])
    return dt
