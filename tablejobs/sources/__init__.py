"""Sources and sinks: file readers, writers with save modes, file listings."""

from tablejobs.sources.audit import footers, schema_audit, schema_offences
from tablejobs.sources.exact_csv import read_csv_exact, write_csv_exact
from tablejobs.sources.inventory import check_inventory, part_files, write_numbered, write_with_inventory
from tablejobs.sources.listing import file_inventory
from tablejobs.sources.readers import (
    NULL_MARKER_OPTIONS,
    TEXT_TIMESTAMP_OPTIONS,
    conform,
    raw_preview,
    read_csv,
    read_files,
    read_json,
    read_parquet,
    require_columns,
)
from tablejobs.sources.writers import SAVE_MODES, write_csv, write_files

__all__ = [
    "NULL_MARKER_OPTIONS", "TEXT_TIMESTAMP_OPTIONS", "SAVE_MODES", "check_inventory", "conform",
    "file_inventory", "footers", "part_files", "raw_preview", "read_csv", "read_csv_exact", "read_files",
    "read_json", "read_parquet", "require_columns", "schema_audit", "schema_offences", "write_csv",
    "write_csv_exact", "write_files", "write_numbered", "write_with_inventory",
]
