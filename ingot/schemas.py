"""Warehouse schema files (JSON arrays of ``{name, type, mode, fields}``) and StructType.

A schema file is control data (kilobytes), so conversion happens on the driver.
For set-style work (merge, drift, resolution) a schema is flattened into a
path table ``(dataset, version, path, type, mode)`` and handled as a DataFrame.
"""

from __future__ import annotations

import json
from collections.abc import Iterable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import types as T

# --- fixed values: warehouse type names <-> Spark types --------------------
TO_SPARK = {
    "STRING": T.StringType(),
    "INTEGER": T.LongType(),
    "INT64": T.LongType(),
    "FLOAT": T.DoubleType(),
    "FLOAT64": T.DoubleType(),
    "NUMERIC": T.DecimalType(38, 9),
    "BOOLEAN": T.BooleanType(),
    "BOOL": T.BooleanType(),
    "DATE": T.DateType(),
    "TIMESTAMP": T.TimestampType(),
}
# --- end of fixed values ---------------------------------------------------

PATH_SCHEMA = "dataset string, version string, path string, type string, mode string"


def _scalar_name(dt: T.DataType) -> str:
    if isinstance(dt, T.StringType):
        return "STRING"
    if isinstance(dt, (T.LongType, T.IntegerType, T.ShortType, T.ByteType)):
        return "INTEGER"
    if isinstance(dt, (T.DoubleType, T.FloatType)):
        return "FLOAT"
    if isinstance(dt, T.DecimalType):
        return "NUMERIC"
    if isinstance(dt, T.BooleanType):
        return "BOOLEAN"
    if isinstance(dt, T.DateType):
        return "DATE"
    if isinstance(dt, (T.TimestampType, T.TimestampNTZType)):
        return "TIMESTAMP"
    if isinstance(dt, T.StructType):
        return "RECORD"
    if isinstance(dt, T.MapType):
        return "STRING"  # open maps are carried as JSON text in the table
    raise TypeError(f"no warehouse type for {dt.simpleString()}")


def field_from_json(f: dict) -> T.StructField:
    """One schema-file field -> StructField (REPEATED -> array without null elements)."""
    typ = f.get("type", "STRING").upper()
    mode = f.get("mode", "NULLABLE").upper()
    if typ in ("RECORD", "STRUCT"):
        dt: T.DataType = T.StructType([field_from_json(c) for c in f.get("fields", [])])
    elif typ in TO_SPARK:
        dt = TO_SPARK[typ]
    else:
        raise ValueError(f"unsupported type {typ} for field {f.get('name')}")
    if mode == "REPEATED":
        dt = T.ArrayType(dt, containsNull=False)
    meta = {"description": f["description"]} if "description" in f else None
    return T.StructField(f["name"], dt, nullable=(mode != "REQUIRED"), metadata=meta)


def struct_from_json(fields: list | str) -> T.StructType:
    """Schema file text or parsed list -> StructType."""
    if isinstance(fields, str):
        fields = json.loads(fields)
    return T.StructType([field_from_json(f) for f in fields])


def field_to_json(f: T.StructField, sort: bool = True) -> dict:
    dt, mode = f.dataType, ("NULLABLE" if f.nullable else "REQUIRED")
    if isinstance(dt, T.ArrayType):
        dt, mode = dt.elementType, "REPEATED"
    out = {"name": f.name, "type": _scalar_name(dt), "mode": mode}
    if f.metadata and "description" in f.metadata:
        out["description"] = f.metadata["description"]
    if isinstance(dt, T.StructType):
        out["fields"] = struct_to_json(dt, sort)
    return out


def struct_to_json(schema: T.StructType, sort: bool = True) -> list:
    """StructType -> schema-file list; fields alphabetical at every level (H5)."""
    fields = sorted(schema.fields, key=lambda f: f.name) if sort else schema.fields
    return [field_to_json(f, sort) for f in fields]


def dumps(schema: T.StructType, sort: bool = True) -> str:
    return json.dumps(struct_to_json(schema, sort), indent=2)


def flatten(schema: T.StructType, prefix: str = "") -> list[tuple[str, str, str]]:
    """Depth-first ``(path, type, mode)`` list; arrays are transparent in the path.  Dots and
    backslashes inside a name are escaped with a backslash."""
    rows: list[tuple[str, str, str]] = []
    for f in schema.fields:
        path = prefix + f.name.replace("\\", "\\\\").replace(".", "\\.")
        dt, mode = f.dataType, ("NULLABLE" if f.nullable else "REQUIRED")
        if isinstance(dt, T.ArrayType):
            dt, mode = dt.elementType, "REPEATED"
        rows.append((path, _scalar_name(dt), mode))
        if isinstance(dt, T.StructType):
            rows.extend(flatten(dt, path + "."))
    return rows


def path_table(spark: SparkSession, schemas: dict[tuple[str, str], T.StructType]) -> DataFrame:
    """``{(dataset, version): StructType}`` -> path table DataFrame."""
    rows = [(ds, ver, p, t, m) for (ds, ver), st in schemas.items() for (p, t, m) in flatten(st)]
    return spark.createDataFrame(rows, PATH_SCHEMA)


def split_path(path: str) -> list[str]:
    """The names of a path; a backslash takes the next character as part of its name."""
    if "\\" not in path:
        return path.split(".")
    names, chars = [""], iter(path)
    for c in chars:
        if c == ".":
            names.append("")
        else:
            names[-1] += next(chars, "") if c == "\\" else c
    return names


def struct_from_paths(rows: Iterable[tuple[str, str, str]]) -> T.StructType:
    """Inverse of :func:`flatten`: rebuild a StructType from ``(path, type, mode)`` rows.

    Paths are emitted alphabetically at every level.  Used for the (small)
    profile result of H2-H5, which is collected once on the driver.
    """
    tree: dict = {}
    for path, typ, mode in rows:
        node = tree
        parts = split_path(path)
        for p in parts[:-1]:
            node = node.setdefault(p, {"type": "RECORD", "mode": "NULLABLE", "children": {}})["children"]
        leaf = node.setdefault(parts[-1], {"children": {}})
        leaf["type"], leaf["mode"] = typ, mode

    def build(children: dict) -> list:
        out = []
        for name in sorted(children):
            n = children[name]
            d = {"name": name, "type": n["type"], "mode": n["mode"]}
            if n["type"] == "RECORD":
                d["fields"] = build(n["children"])
            out.append(d)
        return out

    return struct_from_json(build(tree))
