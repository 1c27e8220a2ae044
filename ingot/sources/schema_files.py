"""Schema files on storage (A5) and the schema catalog built from a listing (J5 input)."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from ingot import schemas
from ingot.session import fs_read_text
from ingot.sources.listing import list_files

# --- fixed values: schema file-name patterns, tried in this order ----------
SCHEMA_FILE_PATTERNS = ("{dataset}.schema.json", "{dataset}_schema.json")
# --- end of fixed values -----------------------------------------------------


def read_schema_file(spark: SparkSession, path: str) -> T.StructType:
    """A schema file (kilobytes of control data) -> StructType."""
    return schemas.struct_from_json(fs_read_text(spark, path))


def schema_catalog(spark: SparkSession, schemas_root: str) -> DataFrame:
    """``<root>/<version>/<dataset>{.schema.json|_schema.json}`` -> dataset, version,
    pattern_rank, path.  Feed to :func:`ingot.operators.profile.resolve_schema`."""
    files = list_files(spark, schemas_root)
    name = F.col("name")
    rank = (F.when(name.endswith(".schema.json"), 1).when(name.endswith("_schema.json"), 2))
    dataset = F.regexp_extract(name, r"^(.*?)(\.schema\.json|_schema\.json)$", 1)
    return (files.where(rank.isNotNull())
            .select(dataset.alias("dataset"), F.col("folder").alias("version"),
                    rank.cast("bigint").alias("pattern_rank"), "path"))
