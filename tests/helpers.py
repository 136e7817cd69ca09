"""Shared helpers for the tests."""

from __future__ import annotations

TIME = "2024-01-02 03:04:05.123456"
ISO = "2024-01-02T03:04:05.123456"


def event(body: str, time: str | None = TIME, system: str | None = None) -> str:
    """An Event record with a valid time (unless told otherwise) around ``body``."""
    if system is None:
        system = "" if time is None else f'<TimeCreated SystemTime="{time}"/>'
        system = f"<System>{system}</System>"
    return f"<Event>{system}{body}</Event>"


def load_rows(spark, records: list[str], metadata=None):
    """prepare_events over literal records; returns rows in input order."""
    from eventloom import prepare_events

    df = spark.createDataFrame([(i, x) for i, x in enumerate(records)], "rid long, xml string")
    out = prepare_events(df, metadata=metadata).orderBy("rid").collect()
    return out
