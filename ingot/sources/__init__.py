"""Scans: NDJSON lines and records, manifests, file listings, ledgers, schema files."""

from ingot.sources.ndjson import read_lines, read_records, scan_counts  # noqa: F401
from ingot.sources.manifest import MANIFEST_DDL, read_manifest  # noqa: F401
from ingot.sources.listing import choose_source, count_folders, list_files  # noqa: F401
from ingot.sources.ledger import LEDGER_DDL, read_ledger, read_ledger_tsv  # noqa: F401
from ingot.sources.schema_files import read_schema_file, schema_catalog  # noqa: F401
