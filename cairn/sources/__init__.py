"""Sources and sinks: parquet tables, CSV, in-memory rows, series, writes."""

from cairn.sources.tables import TABLES, read_table  # noqa: F401
