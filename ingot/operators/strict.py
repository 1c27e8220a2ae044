"""Load strictness (K4) and the bad-record limit.

Spark's JSON reader ignores unknown fields and nulls quoted numbers, while the
warehouse load coerces quoted numbers and rejects unknown fields and NULL for
a REPEATED field.  So: parse every line once with a *loose* read schema (typed
scalar leaves read as STRING), coerce with ``try_cast``, and flag a record bad
when the line is not an object, the parser marks it corrupt (shape error), a
coercion fails, a key is unknown, an array is explicit null, or an array below the top level
holds a null element (at any depth, :func:`nested_issues`).
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from ingot.functions.jsonf import is_blank, is_json_object

_COERCED = (T.LongType, T.IntegerType, T.DoubleType, T.FloatType, T.BooleanType, T.DateType,
            T.TimestampType, T.TimestampNTZType, T.DecimalType, T.ShortType, T.ByteType)


def loose_type(dt: T.DataType) -> T.DataType:
    """Same shape, typed scalar leaves as STRING (so ``"123"`` and ``123`` both parse)."""
    if isinstance(dt, T.StructType):
        return T.StructType([T.StructField(f.name, loose_type(f.dataType), True) for f in dt.fields])
    if isinstance(dt, T.ArrayType):
        return T.ArrayType(loose_type(dt.elementType), True)
    if isinstance(dt, _COERCED):
        return T.StringType()
    return dt


def coerce(c: Column, dt: T.DataType) -> tuple[Column, Column]:
    """(typed value, coercion-failed flag) for a loose value ``c`` of target type ``dt``."""
    if isinstance(dt, T.StructType):
        parts, bads = [], []
        for f in dt.fields:
            v, b = coerce(c.getField(f.name), f.dataType)
            parts.append(v.alias(f.name))
            bads.append(b)
        value = F.when(c.isNull(), F.lit(None)).otherwise(F.struct(*parts))
        bad = c.isNotNull() & _any(bads)
        return value, bad
    if isinstance(dt, T.ArrayType):
        et = dt.elementType
        value = F.transform(c, lambda x: coerce(x, et)[0])
        bad = F.coalesce(F.exists(c, lambda x: coerce(x, et)[1]), F.lit(False))
        return value, bad
    if isinstance(dt, _COERCED):
        value = c.try_cast(dt)
        return value, c.isNotNull() & value.isNull()
    return c, F.lit(False)


def _any(flags: list[Column]) -> Column:
    flags = [f for f in flags]
    if not flags:
        return F.lit(False)
    out = flags[0]
    for f in flags[1:]:
        out = out | f
    return F.coalesce(out, F.lit(False))


def _let(value: Column, body) -> Column:
    """``body(value)`` with the value computed once (a lambda variable is not re-evaluated)."""
    return F.get(F.transform(F.array(value), body), 0)


def nested_issues(v: Column, dt: T.DataType, path: str = "") -> Column:
    """What the table contract refuses below the top level of a parsed line (a VARIANT): unknown
    fields, explicit null for a repeated field, null elements.  An array of texts, empty if there
    is nothing.  Only structure that the schema has is entered, so open maps stay closed."""
    none = F.array().cast("array<string>")
    if isinstance(dt, T.ArrayType):
        if not isinstance(dt.elementType, (T.StructType, T.ArrayType)):
            nulls = F.exists(F.try_variant_get(v, "$", "array<variant>"), lambda x: F.is_variant_null(x))
            return F.when(F.coalesce(nulls, F.lit(False)), F.array(F.lit(f"null element: {path}"))).otherwise(none)
        items = F.transform(F.try_variant_get(v, "$", "array<variant>"), lambda x: F.when(
            F.is_variant_null(x), F.array(F.lit(f"null element: {path}"))).otherwise(nested_issues(x, dt.elementType, path)))
        return F.coalesce(F.flatten(items), none)
    if not isinstance(dt, T.StructType):
        return none

    def inside(m: Column) -> Column:
        parts = []
        if path:
            unknown = F.array_except(F.map_keys(m), F.array(*[F.lit(n) for n in dt.names]).cast("array<string>"))
            parts.append(F.transform(unknown, lambda k: F.concat(F.lit(f"unknown field: {path}."), k)))
        for f in dt.fields:
            own = f"{path}.{f.name}" if path else f.name
            if path and isinstance(f.dataType, T.ArrayType):
                parts.append(F.when(F.coalesce(F.is_variant_null(m[f.name]), F.lit(False)), F.array(F.lit(f"null for repeated field: {own}"))).otherwise(none))
            if isinstance(f.dataType, (T.StructType, T.ArrayType)):
                parts.append(nested_issues(m[f.name], f.dataType, own))
        return F.concat(*parts) if parts else none

    return F.coalesce(_let(F.try_variant_get(v, "$", "map<string,variant>"), inside), none)


def strict_parse(lines: DataFrame, schema: T.StructType, keep: tuple[str, ...] = ("file", "rel_path", "folder"),
                 null_repeated_is_error: bool = True, nested_is_error: bool = True, value_col: str = "value") -> DataFrame:
    """Typed records plus ``_bad`` (bool) and ``_bad_reason`` (string).  Blank lines are skipped.

    One ``from_json`` over the whole line with the full loose schema, so the
    corrupt marker does not depend on which columns a query later selects.
    """
    loose = loose_type(schema)
    read = T.StructType(loose.fields + [T.StructField("_corrupt", T.StringType(), True)])
    v = F.col(value_col)
    df = lines.where(~is_blank(v))
    rec = F.from_json(v, read, {"columnNameOfCorruptRecord": "_corrupt", "mode": "PERMISSIVE"})
    df = df.select(v.alias("_line"), rec.alias("_r"), *[c for c in keep if c in lines.columns])
    typed, reasons = [], []
    cast_bad = []
    for f in schema.fields:
        val, bad = coerce(F.col("_r").getField(f.name), f.dataType)
        typed.append(val.alias(f.name))
        cast_bad.append(bad)
    df = df.withColumn("_keys", F.json_object_keys("_line"))
    keys = F.col("_keys")
    nested = nested_issues(F.try_parse_json("_line"), schema)
    unknown = F.array_except(keys, F.array(*[F.lit(n) for n in schema.names]).cast("array<string>"))
    null_rep = [F.array_contains(keys, f.name) & F.col("_r").getField(f.name).isNull()
                for f in schema.fields if isinstance(f.dataType, T.ArrayType)] if null_repeated_is_error else []
    reason = (F.when(keys.isNull(), F.lit("not a JSON object"))
              .when(F.col("_r._corrupt").isNotNull(), F.lit("shape"))
              .when(_any(cast_bad), F.lit("coercion"))
              .when(F.size(unknown) > 0, F.concat(F.lit("unknown field: "), F.array_join(F.sort_array(unknown), ",")))
              .when(_any(null_rep), F.lit("null for repeated field"))
              .when(F.lit(nested_is_error), F.get(nested, 0)))
    kept = [c for c in keep if c in lines.columns]
    return df.select(*typed, *kept, reason.isNotNull().alias("_bad"), reason.alias("_bad_reason"))


def bad_record_report(parsed: DataFrame, by: tuple[str, ...] = ("folder",), max_bad: int = 0) -> DataFrame:
    """Per group: good and bad counts and whether the limit is exceeded."""
    return (parsed.groupBy(*by)
            .agg(F.count_if(~F.col("_bad")).alias("n_good"), F.count_if(F.col("_bad")).alias("n_bad"))
            .withColumn("over_limit", F.col("n_bad") > F.lit(max_bad)))


def tolerant_report(lines: DataFrame, by: tuple[str, ...] = ("folder",), max_bad: int = 0,
                    value_col: str = "value") -> DataFrame:
    """Same report for a tolerant scan: bad = non-blank line that is not a JSON object."""
    v = F.col(value_col)
    good = is_json_object(v)
    return (lines.where(~is_blank(v)).groupBy(*by)
            .agg(F.count_if(good).alias("n_good"), F.count_if(~good).alias("n_bad"))
            .withColumn("over_limit", F.col("n_bad") > F.lit(max_bad)))


def unknown_paths(lines: DataFrame, schema: T.StructType, value_col: str = "value", opaque: tuple[str, ...] = ()) -> DataFrame:
    """Field paths present in the lines but absent from the schema, at any depth,
    with the number of occurrences (K4, nested part).

    Uses the profile's per-task pre-aggregated facts, so the shuffle carries one
    row per path per task; the schema's path table is schema-sized and broadcast.
    """
    from ingot import schemas
    from ingot.operators.profile import OPEN_MAPS, json_facts

    spark = lines.sparkSession
    known = spark.createDataFrame([(p,) for p, _, _ in schemas.flatten(schema)], "path string")
    # known text is not entered, whatever the line holds there: open maps stay one path
    closed = [p for p, t, _ in schemas.flatten(schema) if t == "STRING"]
    facts = json_facts(lines, value_col, opaque=tuple({*closed, *OPEN_MAPS, *opaque})).where(F.col("path") != "")
    return (facts.groupBy("path").agg(F.sum("n").cast("bigint").alias("n"))
            .join(F.broadcast(known), "path", "left_anti"))
