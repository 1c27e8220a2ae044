"""Schema file sink (K7 / H5): written to a temporary name, then renamed."""

from __future__ import annotations

from pyspark.sql import SparkSession
from pyspark.sql import types as T

from ingot import schemas
from ingot.session import fs_rename, fs_write_text


def write_schema_file(spark: SparkSession, schema: T.StructType, path: str) -> str:
    text = schemas.dumps(schema, sort=True) + "\n"
    tmp = path + ".tmp"
    fs_write_text(spark, tmp, text)
    fs_rename(spark, tmp, path)
    return path
