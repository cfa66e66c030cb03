"""Sources and sinks: CSV files and catalog tables."""

from gradeline.sources.arrivals import arrival_status, digest_files
from gradeline.sources.completeness import missing_sources
from gradeline.sources.files import read_raw_csv, read_raw_csv_split
from gradeline.sources.tables import (
    NotAViewError,
    SchemaMismatchError,
    append_table,
    drop_published,
    publish_table,
    read_table,
    register_views,
    scratch_dir,
    write_table,
)

__all__ = [
    "NotAViewError",
    "SchemaMismatchError",
    "append_table",
    "arrival_status",
    "digest_files",
    "drop_published",
    "missing_sources",
    "publish_table",
    "read_raw_csv",
    "read_raw_csv_split",
    "read_table",
    "register_views",
    "scratch_dir",
    "write_table",
]
