"""Sources of event records: exported XML files (S2), binary event files (S1), tables; each also on streams."""

from .event_files import scan_event_files, stream_event_files
from .xml_records import events_from_table, scan_event_xml, split_records, stream_event_xml

__all__ = ["events_from_table", "scan_event_files", "scan_event_xml", "split_records", "stream_event_files", "stream_event_xml"]
