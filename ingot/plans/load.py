"""``schema`` then ``load`` (section 3.3): profile a sample (H1-H3), merge into the
existing schema (H4), emit (H5/K7); resolve a schema (J5) and load strictly
(K4) into a versioned table with a bad-record limit (K3, B7)."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, Observation, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from ingot import schemas
from ingot.catalog import table_name
from ingot.operators.profile import OPEN_MAPS, json_facts, merge_facts, merge_schema, to_struct
from ingot.operators.repair import conform_columns
from ingot.operators.strict import strict_parse
from ingot.plans.groups import GROUP_FILES, in_groups
from ingot.sinks.schema_file import write_schema_file
from ingot.sinks.table import publish_table
from ingot.sinks.versions import publish_version
from ingot.sources.heads import head_lines
from ingot.sources.listing import DATA_GLOB, list_files
from ingot.sources.ndjson import raw_lines


def data_lines(spark: SparkSession, root: str, max_files: int = 0) -> DataFrame:
    """Lines (value, raw_path) of all ``*.gz`` under ``root``, at any depth."""
    if max_files > 0:
        paths = [r["path"] for r in list_files(spark, root, DATA_GLOB).orderBy("path").limit(max_files).collect()]  # max_files names
        return raw_lines(spark, paths)
    return raw_lines(spark, root, DATA_GLOB)


def infer_schema(spark: SparkSession, dataset: str, data_root: str, sample: int = 1000,
                 existing: T.StructType | None = None, out_path: str | None = None, max_files: int = 0,
                 observation: Observation | None = None) -> T.StructType:
    """H1-H5: sample every file, profile, merge into ``existing`` (only adds or
    widens), emit (and write ``out_path``).  ``max_files`` > 0 takes the first files by path
    (the schema step's ``-m N``).  ``observation`` gets the sampled-line total (G8)."""
    root = f"{data_root.rstrip('/')}/{dataset}"
    src = head_lines(spark, root, sample, max_files=max_files).select("value") if sample > 0 else data_lines(spark, root, max_files).select("value")
    if observation is not None:
        src = src.observe(observation, F.count(F.lit(1)).alias("sampled_lines"))
    facts = json_facts(src, opaque=OPEN_MAPS)
    if existing is not None:
        prof = merge_schema(schemas.path_table(spark, {(dataset, ""): existing}).drop("dataset", "version"), facts)
    else:
        prof = merge_facts(facts)
    st = to_struct(prof)
    if out_path:
        write_schema_file(spark, st, out_path)
    return st


def load_dataset(spark: SparkSession, dataset: str, version: str, data_root: str, schema: T.StructType,
                 table_root: str, max_bad: int = 0, contract: bool = True) -> dict:
    """Strict load (K4) into ``<dataset>_<version>`` with a bad-record limit.

    With ``contract`` absent arrays become ``[]`` at every depth, as the
    warehouse does for an absent REPEATED field (an explicit null is still bad).
    """
    lines = data_lines(spark, f"{data_root.rstrip('/')}/{dataset}")
    parsed = strict_parse(lines, schema, keep=())
    table = parsed.select(*conform_columns(schema, contract), "_bad")
    return publish_table(spark, table, dataset, version, table_root, max_bad, bad=F.col("_bad"))


def load_version(spark: SparkSession, dataset: str, version: str, data_root: str, schema: T.StructType, table_root: str, max_bad: int = 0, contract: bool = True,
                 group_files: int = GROUP_FILES, parallel: int = 4, progress: Callable[[dict], None] | None = None, append: bool = False) -> dict:
    """``load_dataset`` into a table with a version log (:class:`TableLog` at ``<table_root>/<dataset>_<version>``), in
    groups of files; it stops as soon as the finished groups hold more than ``max_bad`` bad records."""
    files = list_files(spark, f"{data_root.rstrip('/')}/{dataset}", DATA_GLOB)
    columns = conform_columns(schema, contract)

    def groups():
        for rows in in_groups(files, group_files):
            yield strict_parse(raw_lines(spark, [r["path"] for r in rows]), schema, keep=()).select(*columns, "_bad")

    return publish_version(spark, groups(), f"{table_root.rstrip('/')}/{table_name(dataset, version)}", schema, max_bad, parallel=parallel, progress=progress, append=append)


def load_all(spark: SparkSession, datasets: list[str], version: str, converted_root: str, raw_root: str,
             schemas_root: str, table_root: str, max_bad: int = 0) -> tuple[dict, list[str]]:
    """``load <dataset...|all>``: per dataset, data from converted else raw (A9), the
    schema resolved exact-version-first (J5), a strict load (K3/K4).  Datasets
    without data or schema are skipped and returned, as the reference warns."""
    from ingot.catalog import check_datasets
    from ingot.operators.profile import resolve_schema
    from ingot.sources.listing import choose_source
    from ingot.sources.schema_files import read_schema_file, schema_catalog

    chosen = resolve_schema(schema_catalog(spark, schemas_root), version).select("dataset", "path")
    paths = {r["dataset"]: r["path"] for r in chosen.collect()}  # one row per dataset
    results, skipped = {}, []
    for ds in check_datasets(datasets):
        src = choose_source(spark, f"{converted_root.rstrip('/')}/{ds}", f"{raw_root.rstrip('/')}/{ds}")
        if src is None or ds not in paths:
            skipped.append(ds)
            continue
        schema = read_schema_file(spark, paths[ds])
        results[ds] = load_dataset(spark, ds, version, src.rstrip("/").rsplit("/", 1)[0], schema, table_root, max_bad)
    return results, skipped


def infer_all(spark: SparkSession, datasets: list[str], version: str, converted_root: str, raw_root: str,
              schemas_root: str, sample: int = 1000) -> tuple[dict[str, T.StructType], list[str]]:
    """``schema <dataset...|all>``: per dataset, converted data if present else raw
    (A9), a sample of every file profiled, merged into the existing
    ``<schemas_root>/<version>/<dataset>.schema.json`` if there is one (H4), and
    the file replaced through a temporary name (K7).  Datasets without data are
    skipped and returned."""
    from ingot.catalog import check_datasets
    from ingot.session import fs_exists
    from ingot.sources.listing import choose_source
    from ingot.sources.schema_files import read_schema_file

    out, skipped = {}, []
    for ds in check_datasets(datasets):
        src = choose_source(spark, f"{converted_root.rstrip('/')}/{ds}", f"{raw_root.rstrip('/')}/{ds}")
        if src is None:
            skipped.append(ds)
            continue
        path = f"{schemas_root.rstrip('/')}/{version}/{ds}.schema.json"
        existing = read_schema_file(spark, path) if fs_exists(spark, path) else None
        out[ds] = infer_schema(spark, ds, src.rstrip("/").rsplit("/", 1)[0], sample, existing, path)
    return out, skipped
