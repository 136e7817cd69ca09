"""Sinks: bulk NDJSON files, a push hook, and a typed table; each also as a ``sink`` of ``load_events``."""

from .bulk import bulk_files, bulk_lines, bulk_push, file_requests, push_bulk, start_bulk_push, write_bulk_files
from .table import (
    append_events, clear_event_table, create_event_table, event_store, event_table, loaded_events, lookup_events, quarantined_events,
    store_events, table_frame,
)

__all__ = [
    "append_events",
    "bulk_files",
    "bulk_lines",
    "bulk_push",
    "clear_event_table",
    "create_event_table",
    "event_store",
    "event_table",
    "file_requests",
    "loaded_events",
    "lookup_events",
    "push_bulk",
    "quarantined_events",
    "start_bulk_push",
    "store_events",
    "table_frame",
    "write_bulk_files",
]
