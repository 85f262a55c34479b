"""Sources: file streams (JSON with rescue, evolving CSV), stored tables and the
sliced API stream source."""

from lakeshift.sources.files import (
    file_headers,
    infer_or_load_schema,
    load_schema,
    merge_schemas,
    read_csv_evolving,
    read_csv_text,
    read_json,
    read_json_stream,
    read_stored,
    read_stored_stream,
    save_schema,
    with_ingest_metadata,
)
from lakeshift.sources.rescue import parse_json_with_rescue

__all__ = [
    "file_headers",
    "infer_or_load_schema",
    "load_schema",
    "merge_schemas",
    "read_csv_evolving",
    "read_csv_text",
    "read_json",
    "read_json_stream",
    "read_stored",
    "read_stored_stream",
    "save_schema",
    "with_ingest_metadata",
    "parse_json_with_rescue",
]
