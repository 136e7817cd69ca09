"""The event load on Structured Streaming.

New exported event files in a folder, and what is added to those that are there, are
loaded as they arrive, with the same column operators as the batch load (all of them are stateless projections, so
no watermark or state store is involved).  Each micro-batch is written by the
bulk-file sink into a folder named after the stream and its epoch, with ``overwrite``:
a micro-batch replayed after a failure rewrites the same files instead of adding
a second copy.  The stream's id is kept in its checkpoint, which the caller must put
in a durable folder: a stream with a new checkpoint is a new stream, starts at epoch 0
and never writes over an earlier one's output.
"""

from __future__ import annotations

from typing import Any

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql.streaming import StreamingQuery

from ..plans.load import DEFAULT_BATCH_SIZE, EventLoad, prepare_events
from ..sinks.bulk import write_bulk_files
from ..sources.xml_records import stream_event_xml


def start_event_stream(
    spark: SparkSession,
    path: str,
    out_path: str,
    checkpoint_location: str,
    index: str = "hostlogs",
    batch_size: int = DEFAULT_BATCH_SIZE,
    metadata: Any = None,
    available_now: bool = False,
    name: str = "eventloom",
) -> StreamingQuery:
    """Start loading ``path`` continuously into bulk files under ``out_path/stream=ID/epoch=N``."""
    prepared = prepare_events(stream_event_xml(spark, path), index=index, metadata=metadata)

    def write_epoch(batch: DataFrame, epoch_id: int) -> None:
        stream = batch.sparkSession.sparkContext.getLocalProperty("sql.streaming.queryId")
        out = f"{out_path}/stream={stream}/epoch={epoch_id}"
        write_bulk_files(EventLoad(batch), out, batch_size=batch_size, mode="overwrite")

    writer = prepared.writeStream.foreachBatch(write_epoch).option("checkpointLocation", checkpoint_location)
    writer = writer.trigger(availableNow=True) if available_now else writer
    return writer.queryName(name).start()
