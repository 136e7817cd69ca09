"""Bulk sinks (K2, K3, K4, K7).

A bulk request is NDJSON: an action line naming the destination, then the
record's source line.  Records are cut into requests of ``batch_size`` inside
each task; nothing is gathered on the driver or in one task.

* :func:`write_bulk_files` writes request bodies as text files, many requests per
  file (``requests_per_file``, through ``maxRecordsPerFile``), accepted and rejected
  records in one job (``status=loaded`` / ``status=rejected`` folders), each in the
  input's order, with a sort inside the task and no setting of the session touched.  A file holds whole requests but for its last;
  :func:`file_requests` cuts the lines of one file into its requests again.
* :func:`push_bulk` hands each request to a caller-supplied ``send(lines)``
  through a Python data source writer.  ``send`` raising fails the task; Spark
  retries it and, when retries are spent, aborts the job and calls ``abort``.
  The reference ends a load on a failed request too; its accidental retry of the
  whole remainder as one final request (a swallowed exit) is not reproduced.
  The commit gets every task's request sizes (the load report).
* :func:`start_bulk_push` does the same on a stream, an epoch at a time: a failing ``send``
  fails the epoch and ends the query, which goes on from there when it is started again.

No ``_id`` is sent, so a re-run adds the records again (at-least-once, K7), as
in the reference.
"""

from __future__ import annotations

import uuid
from collections import Counter
from collections.abc import Callable, Iterable, Iterator
from dataclasses import dataclass, field
from itertools import islice

from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql.datasource import DataSource, DataSourceStreamWriter, DataSourceWriter, WriterCommitMessage
from pyspark.sql.streaming import StreamingQuery

from ..operators.document import bulk_action_json, bulk_source_json
from ..operators.quarantine import accepted_events
from ..plans.load import EventLoad, LoadReport
from ..sources.ranges import check_readable, file_exists, write_file

# The default number of requests in a file: 200,000 records with the default request size.
REQUESTS_PER_FILE = 400


def bulk_lines(df: DataFrame) -> DataFrame:
    """K2: add ``line`` = action line + newline + source line, for loaded records."""
    return df.withColumn("line", F.concat(bulk_action_json(), F.lit("\n"), bulk_source_json()))


def write_bulk_files(
    load: EventLoad, path: str, batch_size: int = 500, mode: str = "append", requests_per_file: int = REQUESTS_PER_FILE
) -> LoadReport:
    """K2 as files: ``requests_per_file`` bulk requests a file, rejected records alongside; one job, no shuffle.

    With ``batch_size`` <= 0 a task's records are one request in one file.  Returns the counts of this very job.
    """
    df = load.observed(load.all)
    rejected_json = F.to_json(F.struct(*[F.col(c) for c in _input_columns(df)], F.col("reason")))
    value = F.when(F.col("reason").isNull(), F.concat(bulk_action_json(), F.lit("\n"), bulk_source_json())).otherwise(
        rejected_json
    )
    status = F.when(F.col("reason").isNull(), F.lit("loaded")).otherwise(F.lit("rejected"))
    # A task writes one folder after the other; its place in the input keeps the order of either.
    out = df.select(value.alias("value"), status.alias("status"), F.monotonically_increasing_id().alias("place"))
    writer = out.sortWithinPartitions("status", "place").drop("place").write.mode(mode).partitionBy("status")
    if batch_size > 0:
        writer = writer.option("maxRecordsPerFile", batch_size * requests_per_file)
    writer.text(path)
    return load.report


def file_requests(lines: Iterable[str], batch_size: int = 500) -> Iterator[list[str]]:
    """The bulk requests in the lines of one file: action and source lines of ``batch_size`` records each."""
    rest = iter(lines)
    while request := list(islice(rest, 2 * batch_size if batch_size > 0 else None)):
        yield request


def bulk_files(path: str, mode: str = "append", requests_per_file: int = REQUESTS_PER_FILE) -> Callable[[EventLoad, int], None]:
    """:func:`write_bulk_files` as the ``sink`` of :func:`eventloom.load_events`."""
    return lambda load, batch_size: write_bulk_files(load, path, batch_size, mode, requests_per_file)


def _input_columns(df: DataFrame) -> list[str]:
    derived = {
        "reason", "shape", "time_text", "event_time", "@timestamp", "event_data", "eventdata_raw", "event_raw",
        "other_json", "Event", "System", "_index", "_type", "meta", "document", "event_tree", "_doc_body", "_meta_json",
    }
    return [c for c in df.columns if c not in derived]


@dataclass
class BatchReport(WriterCommitMessage):
    """Commit message of one task: how many requests of each size it sent (a full size and a last one)."""

    requests: dict[int, int] = field(default_factory=dict)


def push_bulk(
    load: EventLoad,
    send: Callable[[list[str]], None],
    batch_size: int = 500,
    on_commit: Callable[[dict[int, int]], None] | None = None,
    on_abort: Callable[[int], None] | None = None,
) -> None:
    """K2 + K3 + K4: send loaded records in requests of ``batch_size`` through ``send``.

    ``send`` runs in the tasks; ``on_commit(requests)`` runs once, in the data source's
    commit step (a Python process on the driver host, not the caller's process),
    with the number of requests of each size; two numbers come from each task.  If a
    task fails for good the load fails and ``on_abort(finished)`` runs there instead, with
    the number of tasks whose requests were all sent.
    """
    class _Writer(DataSourceWriter):
        def write(self, iterator):
            return send_requests(iterator, send, batch_size)

        def commit(self, messages):
            if on_commit is not None:
                on_commit(all_requests(messages))

        def abort(self, messages):
            if on_abort is not None:
                on_abort(sum(m is not None for m in messages))

    name = f"eventloom_bulk_{uuid.uuid4().hex[:12]}"

    class _Source(DataSource):
        @classmethod
        def name(cls):
            return name

        def schema(self):
            return "line string"

        def writer(self, schema, overwrite):
            return _Writer()

    spark = load.all.sparkSession
    spark.dataSource.register(_Source)
    lines = bulk_lines(accepted_events(load.observed(load.all))).select("line")
    lines.write.format(name).mode("append").save()


def send_requests(rows: Iterator, send: Callable[[list[str]], None], size: int) -> BatchReport:
    """One task's rows through ``send``, in requests of ``size`` and a short last one."""
    requests: Counter[int] = Counter()
    batch: list[str] = []
    for row in rows:
        batch.append(row[0])
        if size > 0 and len(batch) == size:
            send(batch)
            requests[len(batch)] += 1
            batch = []
    if batch:
        send(batch)
        requests[len(batch)] += 1
    return BatchReport(dict(requests))


def all_requests(messages: list[BatchReport | None]) -> dict[int, int]:
    """The number of requests of each size over all tasks."""
    return dict(sum((Counter(m.requests) for m in messages if m is not None), Counter()))


def start_bulk_push(
    prepared: DataFrame,
    send: Callable[[list[str]], None],
    checkpoint_location: str,
    batch_size: int = 500,
    on_commit: Callable[[int, dict[int, int]], None] | None = None,
    on_abort: Callable[[int, int], None] | None = None,
    available_now: bool = False,
    name: str | None = None,
) -> StreamingQuery:
    """K2 + K3 + K4 on a stream of prepared records: push each epoch's loaded records in requests of ``batch_size``.

    ``on_commit(epoch, requests)`` runs when all of an epoch's requests were sent, ``on_abort(epoch, finished)`` when a
    task failed for good.  A mark in the checkpoint folder tells epochs that were committed: should one be run
    again after a stop, it sends nothing and ``on_commit`` is not called anew.  An epoch that did not get that far is
    sent again (at-least-once, K7).
    """
    check_readable([checkpoint_location])
    marks = f"{checkpoint_location.rstrip('/')}/eventloom-sent"

    class _Writer(DataSourceStreamWriter):
        def write(self, iterator):
            from pyspark import TaskContext

            epoch = TaskContext.get().getLocalProperty("streaming.sql.batchId")
            if file_exists(f"{marks}/{epoch}"):
                return BatchReport({})
            return send_requests(iterator, send, batch_size)

        def commit(self, messages, batchId):
            if file_exists(f"{marks}/{batchId}"):
                return
            if on_commit is not None:
                on_commit(batchId, all_requests(messages))
            write_file(f"{marks}/{batchId}", b"")

        def abort(self, messages, batchId):
            if on_abort is not None:
                on_abort(batchId, sum(m is not None for m in messages))

    source = f"eventloom_push_{uuid.uuid4().hex[:12]}"

    class _Source(DataSource):
        @classmethod
        def name(cls):
            return source

        def schema(self):
            return "line string"

        def streamWriter(self, schema, overwrite):
            return _Writer()

    prepared.sparkSession.dataSource.register(_Source)
    writer = bulk_lines(accepted_events(prepared)).select("line").writeStream.format(source)
    writer = writer.option("checkpointLocation", checkpoint_location)
    writer = writer.trigger(availableNow=True) if available_now else writer
    return (writer.queryName(name) if name else writer).start()


def bulk_push(
    send: Callable[[list[str]], None],
    on_commit: Callable[[dict[int, int]], None] | None = None,
    on_abort: Callable[[int], None] | None = None,
) -> Callable[[EventLoad, int], None]:
    """:func:`push_bulk` as the ``sink`` of :func:`eventloom.load_events`."""
    return lambda load, batch_size: push_bulk(load, send, batch_size, on_commit, on_abort)
