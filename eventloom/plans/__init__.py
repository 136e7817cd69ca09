"""Load plans: the end-to-end event load and batch numbering."""

from .load import DEFAULT_BATCH_SIZE, EventLoad, LoadReport, load_events, prepare_events

__all__ = ["DEFAULT_BATCH_SIZE", "EventLoad", "LoadReport", "load_events", "prepare_events"]
