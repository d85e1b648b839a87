"""Reading and writing: raw text lines, JSON documents, tables."""

from .documents import (
    explode_incidents,
    explode_items,
    explode_section,
    explode_tender,
    parse_headers,
)
from .raw import add_ingest_columns, raw_line_stream, raw_lines, source_path, unique_records
from .tables import (
    ensure_database,
    overwrite_graph_table,
    overwrite_table,
    read_table,
    stream_table,
    write_ndjson,
)

__all__ = [
    "add_ingest_columns",
    "ensure_database",
    "explode_incidents",
    "explode_items",
    "explode_section",
    "explode_tender",
    "overwrite_graph_table",
    "overwrite_table",
    "parse_headers",
    "raw_line_stream",
    "raw_lines",
    "read_table",
    "source_path",
    "stream_table",
    "unique_records",
    "write_ndjson",
]
