"""Event XML derived by Spark from the given tables (FIXTURES.md F1, F3)."""

from .event_xml import chunk_records, documents_as_events, events_as_xml, write_cut_exports, write_event_chunks, write_event_export, xml_escape

__all__ = ["chunk_records", "documents_as_events", "events_as_xml", "write_cut_exports", "write_event_chunks", "write_event_export", "xml_escape"]
