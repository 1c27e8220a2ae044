"""Distributed schema profiling and evolution.

H2 walks every sampled JSON line to ``(path, kind, repeated)`` facts.  The
walk runs in ``mapInArrow`` with a small Python helper because the lattice needs
the *source text* kind of each number (``12.0`` is FLOAT, ``"12"`` is a quoted
INTEGER) and Spark's VARIANT normalises both away; each task pre-aggregates its
facts, so the shuffle carries one row per (path, kind) per task.  Grouping,
the type lattice (H3), merging (H4/U2), drift (U3) and resolution (J5) are
plain Spark SQL.
"""

from __future__ import annotations

import json
import re
from collections import Counter

import pyarrow as pa
from pyspark.sql import DataFrame, Observation, Window
from pyspark.sql import functions as F
from pyspark.sql import types as T

from ingot import schemas
from ingot.operators.selection import sample_head

# Ship this module's walker with the task (pickled by value), so Python workers
# need no installed copy of the package: executors only see what the task carries.
try:
    import sys as _sys

    from pyspark import cloudpickle as _cloudpickle

    _cloudpickle.register_pickle_by_value(_sys.modules[__name__])
except Exception:  # pragma: no cover - older cloudpickle: the package must be installed on workers
    pass

FACT_DDL = "path string, kind string, repeated boolean, n bigint"
FACT_SCHEMA = pa.schema([("path", pa.string()), ("kind", pa.string()), ("repeated", pa.bool_()), ("n", pa.int64())])

# --- fixed values: text patterns recognised inside quotes -------------------
_INT = re.compile(r"^[+-]?\d+$")
_FLOAT = re.compile(r"^[+-]?(\d+\.\d*|\.\d+|\d+)([eE][+-]?\d+)?$")
_BOOL = re.compile(r"^(true|false)$", re.I)
_DATE = re.compile(r"^\d{4}-\d{1,2}-\d{1,2}$")
_TS = re.compile(r"^\d{4}-\d{1,2}-\d{1,2}[T ]\d{1,2}:\d{1,2}(:\d{1,2}(\.\d{1,6})?)?"
                 r"( ?(Z|UTC|[+-]\d{1,2}(:?\d{2})?))?$")
# --- end of fixed values ----------------------------------------------------


def scalar_kind(v) -> str:
    if v is None:
        return "NULL"
    if isinstance(v, bool):
        return "BOOLEAN"
    if isinstance(v, int):
        return "INTEGER"
    if isinstance(v, float):
        return "FLOAT"
    s = str(v)
    if _INT.match(s):
        return "INTEGER"
    if _FLOAT.match(s):
        return "FLOAT"
    if _BOOL.match(s):
        return "BOOLEAN"
    if _DATE.match(s):
        return "DATE"
    if _TS.match(s):
        return "TIMESTAMP"
    return "STRING"


def path_step(key: str) -> str:
    """A key as one step of a path: its own dots and backslashes are escaped."""
    return key.replace("\\", "\\\\").replace(".", "\\.")


def _visit(v, path: str, out: Counter, in_array: bool, opaque: frozenset = frozenset()) -> None:
    if path in opaque and v is not None:
        # an open map kept as JSON text: one STRING fact, no descent into its keys
        out[(path, "STRING", in_array)] += 1
        return
    if isinstance(v, dict):
        out[(path, "RECORD", in_array)] += 1
        for k, x in v.items():
            _visit(x, f"{path}.{path_step(k)}", out, False, opaque)
    elif isinstance(v, list):
        if in_array:
            out[(path, "NESTED_ARRAY", True)] += 1
            return
        if not v:
            out[(path, "EMPTY_ARRAY", True)] += 1
        for e in v:
            _visit(e, path, out, True, opaque)
    else:
        out[(path, scalar_kind(v), in_array)] += 1


def facts_of_lines(lines, opaque: frozenset = frozenset()) -> Counter:
    """Facts for an iterable of JSON lines; non-object lines count as ('', INVALID).

    ``opaque`` paths (open maps such as an inverted index) are recorded as STRING
    without descending, so the number of paths stays bounded by the schema and
    does not grow with the maps' vocabularies.
    """
    out: Counter = Counter()
    for line in lines:
        if line is None or not line.strip():
            continue
        try:
            rec = json.loads(line)
        except ValueError:
            out[("", "INVALID", False)] += 1
            continue
        if not isinstance(rec, dict):
            out[("", "INVALID", False)] += 1
            continue
        for k, x in rec.items():
            _visit(x, path_step(k), out, False, opaque)
    return out


def _facts_partition_fn(opaque: frozenset):
    return lambda batches: _facts_partition(batches, opaque)


def _facts_partition(batches, opaque: frozenset = frozenset()):
    """One task: walk its lines, yield its facts once (pre-aggregated).

    Batches carry the JSON line in the last column and, when grouping, the
    group key (a string) in the first.
    """
    acc: dict = {}
    for b in batches:
        values = b.column(b.num_columns - 1).to_pylist()
        groups = b.column(0).to_pylist() if b.num_columns > 1 else [None] * len(values)
        for g, line in zip(groups, values):
            acc.setdefault(g, Counter()).update(facts_of_lines([line], opaque))
    rows = [(p, k, r, n, g) for g, c in acc.items() for (p, k, r), n in c.items()]
    if rows:
        cols = list(zip(*rows))
        yield pa.RecordBatch.from_arrays(
            [pa.array(cols[0], pa.string()), pa.array(cols[1], pa.string()), pa.array(cols[2], pa.bool_()),
             pa.array(cols[3], pa.int64()), pa.array(cols[4], pa.string())],
            schema=FACT_SCHEMA.append(pa.field("_g", pa.string())))


def json_facts(lines: DataFrame, value_col: str = "value", by: tuple[str, ...] = (),
               opaque: tuple[str, ...] = ()) -> DataFrame:
    """``(path, kind, repeated, n)`` facts, pre-aggregated per task, then summed (H2).

    With ``by`` (e.g. dataset) the facts are kept per group: one walk serves all groups.
    ``opaque`` lists open-map paths recorded as STRING without descending.
    """
    out_ddl = FACT_DDL + ", _g string"
    walk = _facts_partition_fn(frozenset(opaque))
    if by:
        key = F.to_json(F.struct(*[F.col(c) for c in by]))
        raw = lines.select(key.alias("_key"), F.col(value_col)).mapInArrow(walk, out_ddl)
        gs = T.StructType([lines.schema[c] for c in by])
        return (raw.groupBy("_g", "path", "kind", "repeated").agg(F.sum("n").alias("n"))
                .select(F.from_json("_g", gs).alias("_k"), "path", "kind", "repeated", "n")
                .select(*[F.col("_k").getField(c).alias(c) for c in by], "path", "kind", "repeated", "n"))
    raw = lines.select(value_col).mapInArrow(walk, out_ddl)
    return raw.groupBy("path", "kind", "repeated").agg(F.sum("n").alias("n"))


def _has(kind: str):
    return F.max(F.when(F.col("kind") == kind, 1).otherwise(0)) == 1


def merge_facts(facts: DataFrame, by: tuple[str, ...] = ()) -> DataFrame:
    """Type lattice per path (H3) -> path, type, mode, n.

    INTEGER+FLOAT -> FLOAT; any other scalar conflict -> STRING; numbers,
    booleans, dates and timestamps are recognised inside quotes; NULL-only and
    empty-array-only -> STRING; RECORD beside a scalar -> STRING; any array
    occurrence -> REPEATED.  The merge is commutative, associative and idempotent
    over the set of kinds.
    """
    f = facts.where(F.col("path") != "")
    g = f.groupBy(*by, "path").agg(
        _has("RECORD").alias("rec"), _has("INTEGER").alias("i"), _has("FLOAT").alias("fl"),
        _has("BOOLEAN").alias("b"), _has("DATE").alias("d"), _has("TIMESTAMP").alias("ts"),
        _has("STRING").alias("s"), _has("NESTED_ARRAY").alias("na"),
        F.max(F.col("repeated").cast("int")).alias("rep"), F.sum("n").alias("n"))
    scalar = F.col("i") | F.col("fl") | F.col("b") | F.col("d") | F.col("ts") | F.col("s") | F.col("na")
    flags = ("i", "fl", "b", "d", "ts", "s", "na")

    def only(*keep):
        cond = F.lit(True)
        for fl in flags:
            if fl not in keep:
                cond = cond & ~F.col(fl)
        return cond

    typ = (F.when(F.col("rec") & ~scalar, "RECORD")
           .when(F.col("rec") & scalar, "STRING")
           .when(~scalar, "STRING")
           .when(F.col("i") & only("i"), "INTEGER")
           .when((F.col("i") | F.col("fl")) & only("i", "fl"), "FLOAT")
           .when(F.col("b") & only("b"), "BOOLEAN")
           .when(F.col("d") & only("d"), "DATE")
           .when(F.col("ts") & only("ts"), "TIMESTAMP")
           .otherwise("STRING"))
    return g.select(*by, "path", typ.alias("type"),
                    F.when(F.col("rep") == 1, "REPEATED").otherwise("NULLABLE").alias("mode"),
                    F.col("n").cast("bigint").alias("n"))


# --- fixed values: open maps (word -> positions, language -> name) ----------
OPEN_MAPS = ("abstract_inverted_index", "international")
# --- end of fixed values ----------------------------------------------------


def profile_schema(lines: DataFrame, sample: int = 1000, value_col: str = "value",
                   by: tuple[str, ...] = (), file_col: str = "file",
                   opaque: tuple[str, ...] = OPEN_MAPS, observation: Observation | None = None) -> DataFrame:
    """H1 + H2 + H3: first ``sample`` lines of every file, facts, lattice.
    ``sample <= 0`` profiles every line.  An ``observation`` receives the
    sampled-line total (G8) from the same pass."""
    src = sample_head(lines, sample, file_col) if sample and sample > 0 else lines
    if observation is not None:
        src = src.observe(observation, F.count(F.lit(1)).alias("sampled_lines"))
    return merge_facts(json_facts(src, value_col, by, opaque), by)


def facts_from_paths(paths: DataFrame, by: tuple[str, ...] = ()) -> DataFrame:
    """An existing schema's path table as facts, so it merges like sampled data (H4)."""
    kind = F.when(F.col("type").isin("RECORD", "STRUCT"), "RECORD").otherwise(F.col("type"))
    return paths.select(*by, "path", kind.alias("kind"), (F.col("mode") == "REPEATED").alias("repeated"),
                        F.lit(0).cast("bigint").alias("n"))


def merge_schema(existing_paths: DataFrame, new_facts: DataFrame, by: tuple[str, ...] = ()) -> DataFrame:
    """Incremental merge (H4, U2): fields are only added or widened."""
    cols = [*by, "path", "kind", "repeated", "n"]
    return merge_facts(facts_from_paths(existing_paths, by).select(*cols).unionByName(new_facts.select(*cols)), by)


def drift(old: DataFrame, new: DataFrame, by: tuple[str, ...] = ()) -> DataFrame:
    """Path difference between two schema generations (U3): added, removed, changed."""
    k = [*by, "path"]
    o = old.select(*k, F.col("type").alias("old_type"), F.col("mode").alias("old_mode"))
    n = new.select(*k, F.col("type").alias("new_type"), F.col("mode").alias("new_mode"))
    j = o.join(n, k, "full")
    change = (F.when(F.col("old_type").isNull(), "added")
              .when(F.col("new_type").isNull(), "removed")
              .when((F.col("old_type") != F.col("new_type")) & (F.col("old_mode") != F.col("new_mode")),
                    "type_and_mode_changed")
              .when(F.col("old_type") != F.col("new_type"), "type_changed")
              .when(F.col("old_mode") != F.col("new_mode"), "mode_changed"))
    return j.withColumn("change", change).where(F.col("change").isNotNull())


def resolve_schema(catalog: DataFrame, version: str) -> DataFrame:
    """Schema per dataset: exact version first, else the newest other version;
    within a version the file-name patterns in rank order (J5 / W3).

    ``catalog`` columns: dataset, version, pattern_rank, path.  A dataset with
    no schema simply has no row (the caller warns and skips it).
    """
    w = Window.partitionBy("dataset").orderBy((F.col("version") == F.lit(version)).desc(),
                                              F.col("version").desc(), F.col("pattern_rank").asc())
    return (catalog.withColumn("_rn", F.row_number().over(w)).where(F.col("_rn") == 1).drop("_rn"))


def to_struct(profile: DataFrame) -> T.StructType:
    """Profile (path, type, mode) -> StructType (H5).  Collects one row per path:
    schema-sized, not data-sized."""
    rows = [(r["path"], r["type"], r["mode"]) for r in profile.select("path", "type", "mode").collect()]
    return schemas.struct_from_paths(rows)
