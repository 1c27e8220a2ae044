"""``convert <dataset> [START-END]`` (section 3.1).

listing -> batch range (B1) -> skip files already converted (B6/J4, ledger) -> groups of files:
one pass takes line counts and record shapes per file; a second parses with the shape the data
has, applies the repair rules (R*) and writes gzip NDJSON by folder and source file (K1); then
the group's ledger rows with record counts are appended (K5).  What no rule touches passes
through as it is.  Every rule is row-local: each pass is map-only, one task per input file, and
the driver never holds more than one group's file names.
"""

from __future__ import annotations

import time
from functools import reduce

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from ingot.catalog import CONVERTIBLE, SCAN_MODE, check_datasets, table_schema
from ingot.operators.repair import KEYS, repair, rules_for
from ingot.operators.selection import parse_batch_range, pending, select_batch
from ingot.operators.shape import VARIANT, check_names, merge_shapes, mixed, parse_shape, reader, record_shape, with_table_fields
from ingot.plans.groups import GROUP_FILES, bisected, in_groups, names_by_path, setting
from ingot.sinks.ndjson import write_ndjson
from ingot.sources.ledger import LEDGER_DDL, append_ledger, read_ledger
from ingot.sources.listing import list_files
from ingot.sources.ndjson import line_kind, raw_lines
from ingot.sources.paths import metadata_path

#: Keys the works rules reach into; the other rules reach everywhere.
WORKS_KEYS = ("apc_list", "locations", "best_oa_location", "primary_location", "authorships", "corresponding_author_ids",
              "corresponding_institution_ids", "indexed_in", "referenced_works", "related_works")
UNIONS, TEXTS = ("apc_list",), ("abstract_inverted_index",)


def profiles(spark: SparkSession, dataset: str, rows: list) -> list[tuple]:
    """(rel_path, records, bad, shape or None) of each file, in one pass."""
    whole = dataset != "works"
    shape = record_shape(F.col("value"), None if whole else WORKS_KEYS, UNIONS if not whole else (), ("international",) if whole else ())
    kind = line_kind(F.col("value"))
    got = (raw_lines(spark, [r["path"] for r in rows]).groupBy("raw_path")
           .agg(F.count_if(kind == "good").alias("records"), F.count_if(kind == "bad").alias("bad"),
                F.schema_of_variant_agg(F.when(kind == "good", shape)).alias("shape")))
    found = {r["file"]: r for r in got.withColumn("file", metadata_path(F.col("raw_path"))).collect()}  # a row per file of the group
    out = []
    for r in rows:
        x = found.get(r["path"])
        out.append((r["rel_path"], x["records"] if x else 0, x["bad"] if x else 0, x["shape"] if x else None))
    return out


def batch_schema(dataset: str, shapes: list[str]) -> tuple[T.StructType, T.StructType, frozenset[str]]:
    """Read schema, rule target and keys of mixed kinds for records of these shapes."""
    shape = reduce(merge_shapes, map(parse_shape, shapes), T.StructType([]))
    if not isinstance(shape, T.StructType):
        raise ValueError(f"{dataset}: records of several kinds")
    check_names(shape)
    table = table_schema(dataset)
    works, renames = dataset == "works", any(r.id == "R8" for r in rules_for(dataset))
    read, target, unclear = [], [], set()
    for f in shape.fields:
        if works and f.name not in WORKS_KEYS:
            kind = T.StringType() if f.name in TEXTS else VARIANT
            read.append(T.StructField(f.name, kind))
            target.append(T.StructField(f.name, kind))
            continue
        if not works and f.name == "international":
            read.append(T.StructField(f.name, VARIANT))
            continue
        if renames and mixed(f.dataType):
            unclear.add(f.name)
        kind = VARIANT if f.name in unclear else reader(f.dataType)
        own = with_table_fields(kind, table[f.name].dataType) if works and f.name in table.names else kind
        if works and f.name in table.names and isinstance(f.dataType, T.NullType):
            own = reader(table[f.name].dataType)  # never filled: the table says what it would be
        read.append(T.StructField(f.name, T.StringType() if works and f.name in UNIONS else own))
        target.append(T.StructField(f.name, own))
    names = {f.name for f in target}
    if works:
        target += [T.StructField(f.name, reader(f.dataType)) for f in table.fields if f.name in WORKS_KEYS and f.name not in names]
    return T.StructType(read), T.StructType(target), frozenset(unclear)


def converted(spark: SparkSession, dataset: str, rows: list, shapes: list[str], placeholders: bool) -> DataFrame:
    """The repaired records of some files, with ``folder`` and ``file``."""
    read, target, unclear = batch_schema(dataset, shapes)
    names = names_by_path(spark, rows)
    lines = raw_lines(spark, [r["path"] for r in rows])
    lines = lines.withColumn(KEYS, F.json_object_keys("value")).where(F.col(KEYS).isNotNull())
    recs = lines.select(F.from_json("value", read).alias("_rec"), KEYS, "raw_path")
    recs = recs.select("_rec.*", KEYS, F.col("raw_path").alias("_raw_path"))
    fixed = repair(recs, dataset, placeholders, target=target, mixed=unclear).drop(KEYS)
    if {c.lower() for c in fixed.columns} & {"folder", "file"}:
        raise ValueError(f"{dataset}: records with a key 'folder' or 'file' clash with the output's partitions")
    return fixed.join(F.broadcast(names), fixed["_raw_path"] == names["raw_path"]).drop("_raw_path", "raw_path")  # a row per file of the group


def convert(spark: SparkSession, dataset: str, version: str, raw_root: str, out_root: str,
            ledger_root: str, batch: str | None = None, placeholders: bool = True, batch_id: int = 0,
            keep_nulls: bool = False, group_files: int = GROUP_FILES) -> dict:
    """Convert one dataset; returns counters (files, skipped, failed, records, dropped).

    A group's output and ledger rows are committed before the next group starts: a rerun skips
    finished files and overwrites the output of unfinished ones.  A file that cannot be read, or
    that holds a bad line where the dataset is strict, gets a FAIL row and is tried again by
    the next run; the others of its group are not affected.
    ``keep_nulls=False`` leaves NULL fields out of the output lines (see
    :func:`ingot.sinks.ndjson.write_ndjson`); placeholders survive as ``{}``
    elements, ``false`` and ``[]`` overrides are written."""
    check_datasets([dataset])
    if dataset not in CONVERTIBLE:
        # no repair rules: the raw files are used as they are (A9 picks raw)
        return {"files": 0, "skipped": 0, "failed": 0, "records": 0, "dropped": 0, "converted": False}
    t0 = time.monotonic()
    files = list_files(spark, f"{raw_root.rstrip('/')}/{dataset}")
    if batch:
        start, end = parse_batch_range(batch)
        files = select_batch(files, start, end)
    done = read_ledger(spark, ledger_root, "convert", version, dataset)
    todo = pending(files, done, on="rel_path", done_status=("OK",), ledger_on="file")
    n_files, n_todo, failed, records, dropped, errors = files.count(), 0, 0, 0, 0, {}
    strict = SCAN_MODE[dataset] == "strict"
    for rows in in_groups(todo, group_files):
        n_todo += len(rows)
        found, lost = bisected(rows, lambda part: profiles(spark, dataset, part))
        if strict:
            lost |= {name: f"{bad} bad lines" for name, _, bad, _ in found if bad}
        good = [x for x in found if x[0] not in lost]
        full = [x for x in good if x[1]]
        if full:
            names = {x[0] for x in full}
            out = converted(spark, dataset, [r for r in rows if r["rel_path"] in names], [x[3] for x in full], placeholders)
            # one file per task and partition: open writers instead of a sort of whole records
            with setting(spark, "spark.sql.maxConcurrentOutputFileWriters", "100"):
                write_ndjson(out, f"{out_root.rstrip('/')}/{dataset}", partition_by=["folder", "file"], mode="overwrite", keep_nulls=keep_nulls)
        rows_out = [(n, k, "OK") for n, k, _, _ in good] + [(n, None, "FAIL") for n in lost]
        append_ledger(spark.createDataFrame(rows_out, LEDGER_DDL["convert"]), ledger_root, "convert", version, dataset, batch_id)
        failed += len(lost)
        records += sum(x[1] for x in good)
        dropped += sum(x[2] for x in good)
        errors |= dict(list(lost.items())[:20 - len(errors)])
    secs = time.monotonic() - t0
    return {"files": n_files, "skipped": n_files - n_todo, "failed": failed, "records": records, "dropped": dropped, "errors": errors,
            "seconds": round(secs, 3), "records_per_sec": round(records / secs, 1) if secs > 0 else None}


def convert_all(spark: SparkSession, datasets: list[str], version: str, raw_root: str, out_root: str,
                ledger_root: str, batch: str | None = None, placeholders: bool = True,
                batch_id: int = 0) -> dict[str, dict]:
    """``convert <dataset...|all> [START-END]``: every convertible dataset in turn
    (each one a parallel Spark job); the others pass through unchanged."""
    return {ds: convert(spark, ds, version, raw_root, out_root, ledger_root, batch, placeholders, batch_id)
            for ds in check_datasets(datasets)}

