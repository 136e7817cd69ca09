"""DataFrame -> DataFrame operators of the event load."""

from .document import bulk_action_json, bulk_source_json, document_body, document_json, stamp_destination
from .parse import classify_events, event_schema_ddl, parse_events
from .quarantine import accepted_events, reject_summary, rejected_events
from .shape import eventdata_map, reshape_events

__all__ = [
    "accepted_events",
    "bulk_action_json",
    "bulk_source_json",
    "classify_events",
    "document_body",
    "document_json",
    "event_schema_ddl",
    "eventdata_map",
    "parse_events",
    "reject_summary",
    "rejected_events",
    "reshape_events",
    "stamp_destination",
]
