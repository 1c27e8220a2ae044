"""Table contract check (R19): arrays are never NULL and hold no NULL element;
required structs are present.  One aggregate pass, one ``count_if`` per path."""

from __future__ import annotations

from collections.abc import Callable, Iterator

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

Pred = Callable[[Column], Column]
Wrap = Callable[[Pred], Column]

KINDS = ("null_arrays", "null_elements", "null_structs")


def _walk(dt: T.DataType, path: str, wrap: Wrap, required: set[str]) -> Iterator[tuple[str, str, Column]]:
    if isinstance(dt, T.ArrayType):
        yield path, "null_arrays", wrap(lambda v: v.isNull())
        yield path, "null_elements", wrap(lambda v: F.exists(v, lambda x: x.isNull()))
        inner = dt.elementType
        if isinstance(inner, (T.ArrayType, T.StructType)):
            def sub(pb: Pred, wrap=wrap) -> Column:
                return wrap(lambda v: F.exists(v, lambda x: x.isNotNull() & pb(x)))
            yield from _walk_children(inner, path, sub, required)
    elif isinstance(dt, T.StructType):
        if path in required:
            yield path, "null_structs", wrap(lambda v: v.isNull())
        yield from _walk_children(dt, path, wrap, required)


def _walk_children(dt: T.DataType, path: str, wrap: Wrap, required: set[str]):
    if isinstance(dt, T.StructType):
        for f in dt.fields:
            def sub(pb: Pred, wrap=wrap, name=f.name) -> Column:
                return wrap(lambda v: v.isNotNull() & pb(v.getField(name)))
            yield from _walk(f.dataType, f"{path}.{f.name}", sub, required)
    elif isinstance(dt, T.ArrayType):
        yield from _walk(dt, path, wrap, required)


def contract_check(df: DataFrame, required_structs: tuple[str, ...] = ()) -> DataFrame:
    """Rows violating the contract, per column path: column, null_arrays, null_elements, null_structs.

    Only paths that can violate the contract appear (arrays, required structs).
    """
    req = set(required_structs)
    checks: list[tuple[str, str, Column]] = []
    for f in df.schema.fields:
        def top(pb: Pred, name=f.name) -> Column:
            return pb(F.col(f"`{name}`"))
        if isinstance(f.dataType, (T.ArrayType, T.StructType)):
            checks.extend(_walk(f.dataType, f.name, top, req))
    if not checks:
        return df.sparkSession.createDataFrame([], "column string, null_arrays bigint, null_elements bigint, null_structs bigint")
    aggs = [F.count_if(F.coalesce(pred, F.lit(False))).alias(f"c{i}") for i, (_, _, pred) in enumerate(checks)]
    one = df.agg(*aggs)
    paths = list(dict.fromkeys(p for p, _, _ in checks))
    idx = {(p, k): i for i, (p, k, _) in enumerate(checks)}
    rows = []
    for p in paths:
        vals = [F.col(f"c{idx[(p, k)]}") if (p, k) in idx else F.lit(0).cast("bigint") for k in KINDS]
        rows.append(F.struct(F.lit(p).alias("column"), *[v.alias(k) for v, k in zip(vals, KINDS)]))
    return one.select(F.inline(F.array(*rows)))
