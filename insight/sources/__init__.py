"""Scans and sinks."""

from insight.sources.tables import (  # noqa: F401
    TABLE_NAMES,
    Tables,
    drop_all_null_columns,
    load,
    read_csv,
    read_table,
    write_table,
)
