"""Sinks: gzip NDJSON trees, versioned tables with a bad-record limit, schema files."""

from ingot.sinks.ndjson import write_ndjson  # noqa: F401
from ingot.sinks.table import publish_table, read_table  # noqa: F401
from ingot.sinks.versions import TableLog, publish_version  # noqa: F401
from ingot.sinks.schema_file import write_schema_file  # noqa: F401
