"""Record repair (R1-R18) as Column rules, and the per-dataset rule registry.

A rule is ``Rule(id, fn)`` with ``fn(df, ctx) -> DataFrame``; every rule is a
projection over one record, so a whole repair is one map stage with no shuffle.
Types come from the DataFrame itself, so a rule works whatever subset of the
schema was read; the dataset's table schema supplies types for absent columns.
"""

from __future__ import annotations

from collections.abc import Callable
from dataclasses import dataclass, field

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from ingot.catalog import CONVERTIBLE, check_datasets, table_schema
from ingot.functions.jsonf import object_or_array
from ingot.functions.nested import (
    at_path, compact, compact_arrays, contains_array, drop_path, empty_value, ensure_array, ensure_struct,
    as_variant, fill_arrays, placeholder_array, relaxed, rename_keys, renamed_type,
)
from ingot.operators.shape import is_null, rename_in_variant
from ingot.functions.text import with_reconstructed_text

# --- fixed values ------------------------------------------------------------
# Non-null leaves of the empty location placeholder (everything else is NULL,
# arrays are []).
EMPTY_LOCATION_OVERRIDES = {"is_oa": False, "source": {"is_oa": False, "is_in_doaj": False}}
# Top-level works arrays that must never be NULL.
WORKS_TOP_LEVEL_ARRAYS = ("corresponding_author_ids", "corresponding_institution_ids", "indexed_in",
                          "referenced_works", "related_works")
# Known top-level array fields of sources (NULL -> []).
SOURCES_ARRAY_FIELDS = ("apc_prices", "alternate_titles", "issn", "societies", "counts_by_year",
                        "topics", "topic_share", "host_organization_lineage",
                        "host_organization_lineage_names")
# Columns removed by the (unwired) cleanup rule.
UNWANTED_COLUMNS = ("host_venue", "alternate_host_venues")
# --- end of fixed values -----------------------------------------------------


@dataclass
class Ctx:
    dataset: str
    target: T.StructType
    placeholders: bool = True
    #: top-level keys whose values are of several kinds (read as VARIANT)
    mixed: frozenset[str] = frozenset()


#: Column of a line's top-level keys, where the plan provides it: tells NULL from absent.
KEYS = "_keys"


@dataclass
class Rule:
    id: str
    name: str
    fn: Callable[[DataFrame, Ctx], DataFrame]
    wired: bool = True
    doc: str = field(default="")

    def __call__(self, df: DataFrame, ctx: Ctx) -> DataFrame:
        return self.fn(df, ctx)


def _type_of(df: DataFrame, ctx: Ctx, name: str) -> T.DataType | None:
    if name in df.columns:
        return df.schema[name].dataType
    if name in ctx.target.names:
        return ctx.target[name].dataType
    return None


def _target_type(ctx: Ctx, name: str) -> T.DataType | None:
    return ctx.target[name].dataType if name in ctx.target.names else None


def _col_or_null(df: DataFrame, name: str, dt: T.DataType) -> Column:
    return F.col(f"`{name}`") if name in df.columns else F.lit(None).cast(dt)


def _or_default(c: Column, dt: T.DataType, default: Column) -> Column:
    """``default`` for NULL; a column of mixed kinds keeps its other values as they are."""
    if isinstance(dt, T.VariantType):
        return F.when(is_null(c, dt), F.parse_json(F.to_json(default))).otherwise(c)
    return F.coalesce(c, default)


# R1 ------------------------------------------------------------------------
def fix_object_or_array(name: str) -> Callable[[DataFrame, Ctx], DataFrame]:
    """Array kept; one object wrapped in a 1-element array; null -> []; then empty ->
    one all-null element (placeholders) (R1)."""
    def fn(df: DataFrame, ctx: Ctx) -> DataFrame:
        target = _target_type(ctx, name) or _type_of(df, ctx, name)
        if not isinstance(target, T.ArrayType):
            raise TypeError(f"{name}: target must be an array type")
        src = df.schema[name].dataType if name in df.columns else None
        c = F.col(name) if src is not None else F.lit(None).cast("string")
        if src is None or isinstance(src, T.StringType):
            arr = object_or_array(c, target.elementType)
        elif isinstance(src, T.StructType):
            arr = F.when(c.isNull(), F.lit(None)).otherwise(F.array(c)).cast(target)
        else:
            arr = c.cast(target)
        arr = placeholder_array(arr, target) if ctx.placeholders else ensure_array(arr, target)
        return df.withColumn(name, arr)
    return fn


# R2 / R3 / R4 --------------------------------------------------------------
def _issn_fix(c: Column, dt: T.DataType) -> Column:
    return at_path(c, dt, "source.issn", lambda x, d: ensure_array(x, d))


def fix_locations(name: str = "locations"):
    """NULL -> [empty location]; an empty array stays empty; in each element with
    a source, ``source.issn`` NULL -> [] (R2)."""
    def fn(df: DataFrame, ctx: Ctx) -> DataFrame:
        dt = _type_of(df, ctx, name)
        c = _issn_fix(_col_or_null(df, name, dt), dt)
        full = dt if isinstance(dt, T.ArrayType) else table_schema("works")[name].dataType
        default = (F.array(empty_value(full.elementType, EMPTY_LOCATION_OVERRIDES)) if ctx.placeholders
                   else F.array().cast(full))
        return df.withColumn(name, _or_default(c, dt, default))
    return fn


def fix_location_struct(name: str):
    """NULL -> empty location; else ``source.issn`` NULL -> []."""
    def fn(df: DataFrame, ctx: Ctx) -> DataFrame:
        dt = _type_of(df, ctx, name)
        c = _issn_fix(_col_or_null(df, name, dt), dt)
        if ctx.placeholders:
            full = dt if isinstance(dt, T.StructType) else table_schema("works")[name].dataType
            c = _or_default(c, dt, empty_value(full, EMPTY_LOCATION_OVERRIDES))
        return df.withColumn(name, c)
    return fn


# R5 ------------------------------------------------------------------------
def fix_authorships(name: str = "authorships"):
    """NULL -> [].  Per author: institutions NULL/empty -> [empty institution];
    ``institutions[].lineage`` NULL -> []; ``affiliations[].institution_ids``
    NULL -> [], else NULL elements removed; countries and raw_affiliation_strings
    NULL -> [] (R5)."""
    def fn(df: DataFrame, ctx: Ctx) -> DataFrame:
        dt: T.ArrayType = _type_of(df, ctx, name)
        if not isinstance(dt, T.ArrayType) or not isinstance(dt.elementType, T.StructType):
            return df.withColumn(name, ensure_array(_col_or_null(df, name, dt), dt))
        at: T.StructType = dt.elementType

        def per_author(a: Column) -> Column:
            out = a
            if "institutions" in at.names:
                it: T.ArrayType = at["institutions"].dataType
                inst = a.getField("institutions")
                if ctx.placeholders and isinstance(it, T.ArrayType):
                    inst = placeholder_array(inst, it, empty_value(it.elementType, arrays_empty=False))
                else:
                    inst = ensure_array(inst, it)
                inst = at_path(inst, it, "lineage", lambda x, d: ensure_array(x, d))
                out = out.withField("institutions", inst)
            if "affiliations" in at.names:
                aft: T.ArrayType = at["affiliations"].dataType
                aff = at_path(a.getField("affiliations"), aft, "institution_ids",
                              lambda x, d: ensure_array(compact(x, d), d))
                out = out.withField("affiliations", ensure_array(aff, aft))
            for arr in ("countries", "raw_affiliation_strings"):
                if arr in at.names:
                    out = out.withField(arr, ensure_array(a.getField(arr), at[arr].dataType))
            return out

        c = ensure_array(_col_or_null(df, name, dt), dt)
        return df.withColumn(name, F.transform(c, per_author))
    return fn


# R6 ------------------------------------------------------------------------
def fix_top_level_arrays(names=WORKS_TOP_LEVEL_ARRAYS):
    """Listed top-level arrays NULL or absent -> []."""
    def fn(df: DataFrame, ctx: Ctx) -> DataFrame:
        cols = {}
        for n in names:
            dt = _type_of(df, ctx, n)
            if dt is not None:
                cols[n] = ensure_array(_col_or_null(df, n, dt), dt)
        return df.withColumns(cols)
    return fn


# R7 ------------------------------------------------------------------------
def stringify(name: str):
    """Open map -> JSON text; NULL stays NULL; ``{}`` -> ``"{}"``.

    Declaring the column STRING in the read schema makes ``from_json`` return the
    nested value as compact text in source key order; this rule then only has
    to handle sources where the value arrives as a struct or map.  Text passes
    through unchanged, so the rule is idempotent.
    """
    def fn(df: DataFrame, ctx: Ctx) -> DataFrame:
        if name not in df.columns:
            return df.withColumn(name, F.lit(None).cast("string"))
        dt = df.schema[name].dataType
        if isinstance(dt, T.StringType):
            return df
        return df.withColumn(name, F.to_json(F.col(name)))
    return fn


# R8 / R9 -------------------------------------------------------------------
def rename_hyphen_keys(old: str = "-", new: str = "_"):
    """Hyphen -> underscore in all keys at every depth, through arrays."""
    def fn(df: DataFrame, ctx: Ctx) -> DataFrame:
        groups: dict[str, list[str]] = {}
        for c in df.columns:
            groups.setdefault(c.replace(old, new), []).append(c)
        cols = []
        for new_name, srcs in groups.items():
            srcs = sorted(srcs, key=lambda s: old not in s)  # renamed key wins
            types = [df.schema[s].dataType for s in srcs]
            vals = [rename_in_variant(F.col(f"`{s}`"), old, new) if s in ctx.mixed else rename_keys(F.col(f"`{s}`"), dt, old, new)
                    for s, dt in zip(srcs, types)]
            if len({renamed_type(dt, old, new).simpleString() for dt in types}) > 1:
                vals = [as_variant(v, renamed_type(dt, old, new)) for v, dt in zip(vals, types)]
            cols.append((F.coalesce(*vals) if len(vals) > 1 else vals[0]).alias(new_name))
        return df.select(*cols)
    return fn


def drop_top_level(*names: str):
    """Drop top-level columns (R9, R13); nested occurrences stay."""
    def fn(df: DataFrame, ctx: Ctx) -> DataFrame:
        return df.drop(*[n for n in names if n in df.columns])
    return fn


# R10 / R11 -----------------------------------------------------------------
def fix_nulls(array_fields=SOURCES_ARRAY_FIELDS, all_arrays: bool = False):
    """Drop NULL elements from every array at any depth; listed top-level arrays
    NULL -> [] (R10, R11).  ``all_arrays`` widens the list to every top-level array.
    Where the line's keys are at hand, an absent array stays absent."""
    def fn(df: DataFrame, ctx: Ctx) -> DataFrame:
        cols = {}
        for f in df.schema.fields:
            dt = f.dataType
            c = F.col(f"`{f.name}`")
            changed = False
            if contains_array(dt):
                c, changed = compact_arrays(c, dt), True
            if isinstance(dt, T.ArrayType) and (all_arrays or f.name in array_fields) or f.name in array_fields and isinstance(dt, T.VariantType):
                full = ensure_array(c, dt)
                c = F.when(F.array_contains(KEYS, f.name), full).otherwise(c) if KEYS in df.columns else full
                changed = True
            if changed and f.name != KEYS:
                cols[f.name] = c
        return df.withColumns(cols)
    return fn


# R12 - R16 (unwired in the reference, offered here) ------------------------
def drop_nested(path: str):
    """Drop a nested field, e.g. ``authorships.countries``."""
    top, rest = path.split(".", 1)

    def fn(df: DataFrame, ctx: Ctx) -> DataFrame:
        if top not in df.columns:
            return df
        return df.withColumn(top, drop_path(F.col(top), df.schema[top].dataType, rest))
    return fn


def fix_placeholder(name: str):
    """NULL or empty array -> one all-null element."""
    def fn(df: DataFrame, ctx: Ctx) -> DataFrame:
        dt = _type_of(df, ctx, name)
        if dt is None:
            return df
        return df.withColumn(name, placeholder_array(_col_or_null(df, name, dt), dt))
    return fn


def reconstruct_abstract(src: str = "abstract_inverted_index", dst: str = "abstract"):
    """Text from an inverted index (R18); NULL or empty index -> NULL."""
    def fn(df: DataFrame, ctx: Ctx) -> DataFrame:
        dt = df.schema[src].dataType
        return with_reconstructed_text(df, src, dst, is_json=isinstance(dt, T.StringType))
    return fn


# --- registry ----------------------------------------------------------------
WORKS_RULES = [
    Rule("R1", "fix_apc_list", fix_object_or_array("apc_list")),
    Rule("R2", "fix_locations", fix_locations("locations")),
    Rule("R3", "fix_best_oa_location", fix_location_struct("best_oa_location")),
    Rule("R4", "fix_primary_location", fix_location_struct("primary_location")),
    Rule("R5", "fix_authorships", fix_authorships("authorships")),
    Rule("R6", "fix_top_level_arrays", fix_top_level_arrays()),
    Rule("R7", "stringify_abstract_inverted_index", stringify("abstract_inverted_index")),
]
HYPHEN_RULES = [
    Rule("R8", "rename_hyphen_keys", rename_hyphen_keys()),
    Rule("R9", "drop_international", drop_top_level("international")),
]
SOURCES_RULES = [Rule("R10", "fix_nulls", fix_nulls())]

REGISTRY: dict[str, list[Rule]] = {
    "works": WORKS_RULES,
    "concepts": HYPHEN_RULES,
    "institutions": HYPHEN_RULES,
    "sources": SOURCES_RULES,
}

UNWIRED: dict[str, Rule] = {
    "R12": Rule("R12", "remove_countries", drop_nested("authorships.countries"), wired=False),
    "R13": Rule("R13", "remove_unwanted", drop_top_level(*UNWANTED_COLUMNS), wired=False),
    "R14": Rule("R14", "fix_host_venue", fix_placeholder("host_venue"), wired=False),
    "R15a": Rule("R15", "fix_counts_by_year", fix_placeholder("counts_by_year"), wired=False),
    "R15b": Rule("R15", "fix_mesh", fix_placeholder("mesh"), wired=False),
    "R15c": Rule("R15", "fix_concepts", fix_placeholder("concepts"), wired=False),
    "R16": Rule("R16", "fix_alternate_host_venues", fix_placeholder("alternate_host_venues"), wired=False),
    "R18": Rule("R18", "reconstruct_abstract", reconstruct_abstract(), wired=False),
}


def rules_for(dataset: str) -> list[Rule]:
    check_datasets([dataset])
    return REGISTRY.get(dataset, [])


def repair(df: DataFrame, dataset: str, placeholders: bool = True, extra: list[Rule] | None = None,
           target: T.StructType | None = None, mixed: frozenset[str] = frozenset()) -> DataFrame:
    """Apply the dataset's rules in order (one projection per rule, fused by Catalyst)."""
    ctx = Ctx(dataset, target if target is not None else table_schema(dataset), placeholders, mixed)
    for rule in rules_for(dataset) + list(extra or []):
        df = rule(df, ctx)
    return df


def with_hyphen_twins(dt: T.DataType, old: str = "_", new: str = "-") -> T.DataType:
    """Add, at every depth, a twin field with ``_`` spelled ``-`` for each name that
    has one, so raw hyphenated keys are parsed and R8 can fold them in."""
    if isinstance(dt, T.ArrayType):
        return T.ArrayType(with_hyphen_twins(dt.elementType, old, new), dt.containsNull)
    if isinstance(dt, T.StructType):
        out = []
        for f in dt.fields:
            ft = with_hyphen_twins(f.dataType, old, new)
            out.append(T.StructField(f.name, ft, True))
            if old in f.name:
                out.append(T.StructField(f.name.replace(old, new), ft, True))
        return T.StructType(out)
    return dt


def read_schema(dataset: str) -> T.StructType:
    """Read schema derived from the table schema.

    Object-or-array unions (works ``apc_list``) are read as STRING so both shapes
    parse; open maps are already STRING in the table.  ``international`` is not
    in any table schema, so it is never parsed (R9).  Datasets with the key
    rename rule (R8) also read the hyphenated spelling of every underscore name.
    """
    target = table_schema(dataset)
    if any(r.id == "R8" for r in rules_for(dataset)):
        return with_hyphen_twins(target)
    if dataset != "works":
        return target
    fields = [T.StructField(f.name, T.StringType(), True) if f.name == "apc_list" else f for f in target.fields]
    return T.StructType(fields)


def conform(df: DataFrame, target: T.StructType, contract: bool = True) -> DataFrame:
    """Select the table's columns in table order; absent columns become typed NULLs.

    With ``contract`` every array at every depth is made non-NULL and NULL-free,
    which is what the warehouse load does with absent REPEATED fields (1.4).
    """
    return df.select(*conform_columns(target, contract, df.columns))


def conform_columns(target: T.StructType, contract: bool = True, present: list[str] | None = None) -> list[Column]:
    """Column expressions of :func:`conform` (for use inside a larger projection)."""
    cols = []
    for f in target.fields:
        dt = relaxed(f.dataType)
        if present is None or f.name in present:
            c = F.col(f"`{f.name}`").cast(dt)
        else:
            c = F.lit(None).cast(dt)
        if contract and contains_array(f.dataType):
            c = fill_arrays(c, f.dataType)
        cols.append(c.alias(f.name))
    return cols


__all__ = ["Rule", "Ctx", "REGISTRY", "UNWIRED", "CONVERTIBLE", "repair", "read_schema", "conform",
           "rules_for", "renamed_type", "fix_object_or_array", "fix_locations", "fix_location_struct",
           "fix_authorships", "fix_top_level_arrays", "stringify", "rename_hyphen_keys", "drop_top_level",
           "fix_nulls", "drop_nested", "fix_placeholder", "reconstruct_abstract"]
