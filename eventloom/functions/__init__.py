"""Column functions: JSON text, event time, open XML subtrees."""

from .jsontext import json_str
from .timefmt import iso_text, parse_event_time
from .xmltree import full_records, xml_to_tree

__all__ = ["full_records", "iso_text", "json_str", "parse_event_time", "xml_to_tree"]
