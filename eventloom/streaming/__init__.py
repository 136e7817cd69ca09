"""Structured Streaming form of the event load (same operators, micro-batches)."""

from ..sinks.bulk import start_bulk_push
from ..sources import stream_event_files, stream_event_xml
from .stream import start_event_stream

__all__ = ["start_bulk_push", "start_event_stream", "stream_event_files", "stream_event_xml"]
