"""

Every query reads the given tables: ``events`` rendered as event XML by a
column expression (FIXTURES.md F1), or ``documents`` as event payloads (F3), and
runs the load's operators on all rows.  The oracle SQL computes the expected
columns straight from the ``events`` / ``documents`` columns, never from XML,
so the parser and the reshaping are really tested.  All outputs are flat
(BIGINT / STRING columns).
"""

from __future__ import annotations

import hashlib
import uuid
from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from eventloom import EventLoad, load_events
from eventloom.fixtures import chunk_records, documents_as_events, events_as_xml, write_cut_exports, write_event_chunks, write_event_export
from eventloom.functions.jsontext import json_str
from eventloom.operators.parse import parse_events
from eventloom.operators.quarantine import accepted_events, reject_summary, rejected_events
from eventloom.plans.batches import assign_batches, load_report
from eventloom.plans.load import prepare_events
from eventloom.session import ensure_checkpoint_dir, scratch_path
from eventloom.sinks.bulk import bulk_files, bulk_lines, start_bulk_push
from eventloom.sinks.table import append_events, clear_event_table, lookup_events, store_events
from eventloom.sources.event_files import scan_event_files, stream_event_files
from eventloom.sources.ranges import write_file
from eventloom.sources.xml_records import scan_event_xml, stream_event_xml

INDEX = "hostlogs"
METADATA = {"source": "sf", "run": 1}
BATCH_SIZE = 500
CHUNK_BYTES = 4096
PER_FILE = 500  # F6
LOOKUP_USER = "7"
TASKS_PER_CORE = 3
_RECORD_ID = r"<EventRecordID>(\d+)</EventRecordID>"


def _events(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All events, dealt evenly over tasks: a table of few row groups would leave cores idle, and the load is much work a row."""
    tasks = TASKS_PER_CORE * spark.sparkContext.defaultParallelism
    return spark.read.parquet(f"{sf_dir}/events.parquet").repartition(tasks, "event_id")


def _prepared(spark: SparkSession, sf_dir: str) -> DataFrame:
    return prepare_events(events_as_xml(_events(spark, sf_dir)), index=INDEX, metadata=METADATA)


def _accepted(spark: SparkSession, sf_dir: str) -> DataFrame:
    return accepted_events(_prepared(spark, sf_dir))


def _flag(c) -> F.Column:
    return F.when(c, F.lit(1)).otherwise(F.lit(0)).cast("long")


# ---------------------------------------------------------------- queries


def q_scan_event_xml(spark: SparkSession, sf_dir: str) -> DataFrame:
    """F1 written as export files, read back with the ``</Event>`` splitter, then loaded."""
    ensure_checkpoint_dir(spark)
    path = scratch_path(spark, "event-export")
    write_event_export(events_as_xml(_events(spark, sf_dir)), path)
    loaded = prepare_events(scan_event_xml(spark, path + "/*.txt"), index=INDEX, metadata=METADATA)
    rid = F.regexp_extract("xml", r"<EventRecordID>(\d+)</EventRecordID>", 1).cast("long")
    return loaded.select(rid.alias("event_id"), "reason", "shape")


def q_parse_event_fields(spark, sf_dir):
    """Typed fields read from every record (NULL for malformed ones)."""
    e = parse_events(events_as_xml(_events(spark, sf_dir))).select("event_id", F.col("_e").alias("e"))
    s = F.col("e.System")[0]
    ed = F.col("e.EventData")[0]
    return e.select(
        "event_id",
        _flag(F.col("e._corrupt_record").isNotNull()).alias("corrupt"),
        s["EventRecordID"].alias("record_id"),
        s["Provider"]["_Name"].alias("provider"),
        s["EventID"]["_VALUE"].alias("event_code"),
        s["Execution"]["_ProcessID"].alias("process_id"),
        F.when(ed["Data"].isNull(), F.lit(0)).otherwise(F.size(ed["Data"])).cast("long").alias("n_data"),
    )


def q_event_time_raw(spark, sf_dir):
    """The nested ``System.TimeCreated.@SystemTime`` text."""
    return _prepared(spark, sf_dir).select("event_id", "time_text")


def q_parse_event_time(spark, sf_dir):
    """Parsed time (NULL when the text is not an accepted form)."""
    t = F.date_format(F.col("event_time"), "yyyy-MM-dd HH:mm:ss.SSSSSS")
    return _prepared(spark, sf_dir).select("event_id", t.alias("event_time"))


def q_event_time_iso(spark, sf_dir):
    """T4: ISO-8601 text of the parsed time."""
    from eventloom.functions.timefmt import iso_text

    return _prepared(spark, sf_dir).where(F.col("event_time").isNotNull()).select(
        "event_id", iso_text(F.col("event_time")).alias("iso")
    )


def q_add_timestamp(spark, sf_dir):
    """T5: root ``@timestamp`` (NULL for rejected and promoted records)."""
    return _prepared(spark, sf_dir).select("event_id", "`@timestamp`")


def q_set_nested_time(spark, sf_dir):
    """``System.TimeCreated.@SystemTime`` after the in-place rewrite, for every shape."""
    acc = _accepted(spark, sf_dir)
    t = F.coalesce(
        F.col("Event.System.TimeCreated").getField("@SystemTime"), F.col("System.TimeCreated").getField("@SystemTime")
    )
    return acc.select("event_id", t.alias("system_time"))


def q_event_shape(spark, sf_dir):
    """T7 + E1: outcome of every record."""
    return _prepared(spark, sf_dir).select("event_id", "reason", "shape")


def q_eventdata_map(spark, sf_dir):
    """The name -> text map of list records (flattened, sorted)."""
    acc = _accepted(spark, sf_dir).where(F.col("shape") == "list")
    pairs = F.array_sort(F.transform(F.map_entries("event_data"), lambda e: F.concat(e["key"], F.lit("="), e["value"])))
    return acc.select(
        "event_id",
        F.size(F.map_keys("event_data")).cast("long").alias("n_keys"),
        F.array_join(pairs, ";").alias("pairs"),
        F.to_json(F.col("Event.EventData.Data")).alias("data_json"),
    )


def q_eventdata_lookup(spark, sf_dir):
    """One named field read from the map."""
    acc = _accepted(spark, sf_dir).where(F.col("shape") == "list")
    return acc.select("event_id", F.col("event_data")["user"].alias("user"), F.col("event_data")["type"].alias("type"))


def q_promote_event(spark, sf_dir):
    """Promoted records: ``System`` at the root, no ``@timestamp``, open children as JSON."""
    acc = _accepted(spark, sf_dir).where(F.col("shape") == "promote")
    return acc.select(
        "event_id",
        F.col("System.TimeCreated").getField("@SystemTime").alias("system_time"),
        F.col("System.EventRecordID").alias("record_id"),
        _flag(F.col("`@timestamp`").isNotNull()).alias("has_timestamp"),
        _flag(F.col("Event").isNotNull()).alias("has_event"),
        F.col("other_json").alias("other_json"),
    )


def q_single_raw(spark, sf_dir):
    """``EventData.RawData`` of single records; siblings such as ``Binary`` stay."""
    acc = _accepted(spark, sf_dir).where(F.col("shape") == "single")
    return acc.select(
        "event_id",
        "eventdata_raw",
        F.col("Event.EventData.Binary").alias("binary"),
        F.col("Event.EventData.RawData").alias("struct_raw"),
    )


def q_nodata_raw(spark, sf_dir):
    """``Event.RawData``, the JSON text of the whole ``EventData``."""
    acc = _accepted(spark, sf_dir).where(F.col("shape") == "nodata")
    return acc.select("event_id", "event_raw", F.col("Event.RawData").alias("struct_raw"))


def q_drop_nested(spark, sf_dir):
    """Which nested fields exist after the reshape, per accepted record."""
    acc = _accepted(spark, sf_dir)
    return acc.select(
        "event_id",
        "shape",
        _flag(F.col("Event").isNotNull()).alias("has_event"),
        _flag(F.col("Event.EventData").isNotNull()).alias("has_eventdata"),
        _flag(F.col("Event.EventData.Data").isNotNull()).alias("has_data"),
        _flag(F.col("Event.RawData").isNotNull()).alias("has_event_raw"),
        _flag(F.col("System").isNotNull()).alias("has_root_system"),
    )


def q_json_encode_field(spark, sf_dir):
    """JSON string text of table values (quotes and backslashes escaped)."""
    ev = _events(spark, sf_dir)
    return ev.select("event_id", json_str(F.col("props")).alias("props_json"), json_str(F.col("event_type")).alias("type_json"))


def q_reject_events(spark, sf_dir):
    """Quarantined records with their reason."""
    return rejected_events(_prepared(spark, sf_dir), keep=("event_id",))


def q_accepted_events(spark, sf_dir):
    """Loaded records."""
    return accepted_events(_prepared(spark, sf_dir)).select("event_id", "shape", F.col("`@timestamp`").alias("ts_iso"))


def q_reject_summary(spark, sf_dir):
    """Rejected records per reason."""
    return reject_summary(_prepared(spark, sf_dir))


def q_event_document(spark, sf_dir):
    """The full JSON document text of each loaded record."""
    return _accepted(spark, sf_dir).select("event_id", "document")


def q_stamp_index(spark, sf_dir):
    """Destination name on every loaded record."""
    return _accepted(spark, sf_dir).select("event_id", "_index", "_type")


def q_stamp_meta(spark, sf_dir):
    """Metadata as VARIANT, read back by path."""
    acc = _accepted(spark, sf_dir)
    return acc.select(
        "event_id",
        F.variant_get(F.col("meta"), "$.source", "string").alias("meta_source"),
        F.variant_get(F.col("meta"), "$.run", "bigint").alias("meta_run"),
        F.to_json(F.col("meta")).alias("meta_json"),
    )


def q_assign_batches(spark, sf_dir):
    """K1: bulk batch of each loaded record, in event_id order."""
    acc = _accepted(spark, sf_dir).select("event_id")
    return assign_batches(acc, BATCH_SIZE, order_by="event_id").select("event_id", "batch")


def q_bulk_lines(spark, sf_dir):
    """K2: the NDJSON bulk text of each loaded record (action line + source line)."""
    return bulk_lines(_accepted(spark, sf_dir)).select("event_id", "line")


def q_load_report(spark, sf_dir):
    """K4: records per bulk batch."""
    acc = _accepted(spark, sf_dir).select("event_id")
    return load_report(assign_batches(acc, BATCH_SIZE, order_by="event_id"))


def q_document_payload(spark, sf_dir):
    """whole document texts carried through XML as a Data item and read back from the map."""
    docs = spark.read.parquet(f"{sf_dir}/documents.parquet")
    loaded = prepare_events(documents_as_events(docs), index=INDEX, metadata=METADATA)
    text = F.col("event_data")["text"]
    return loaded.select(
        "doc_id",
        "shape",
        text.alias("text"),
        F.length(text).cast("long").alias("n_chars"),
    )


def q_scan_event_chunks(spark, sf_dir):
    """F1 written as binary files of a header and fixed-size chunks, read back by ranges, then loaded."""
    path = scratch_path(spark, "event-chunks")
    write_event_chunks(events_as_xml(_events(spark, sf_dir)), path, CHUNK_BYTES)

    def decode(header: bytes, chunks: bytes):
        for lo in range(0, len(chunks), CHUNK_BYTES):
            yield from chunk_records(chunks[lo : lo + CHUNK_BYTES])

    files = scan_event_files(
        spark, path, decode, header_bytes=CHUNK_BYTES, chunk_bytes=CHUNK_BYTES, path_glob_filter="*.txt"
    )
    rid = F.regexp_extract("xml", r"<EventRecordID>(\d+)</EventRecordID>", 1).cast("long")
    return prepare_events(files, index=INDEX, metadata=METADATA).select(rid.alias("event_id"), "reason", "shape")


def q_reject_root(spark, sf_dir):
    """Every seventh record has another root element."""
    other = F.replace(F.replace("xml", F.lit("<Event "), F.lit("<Record ")), F.lit("</Event>"), F.lit("</Record>"))
    records = events_as_xml(_events(spark, sf_dir)).select(
        "event_id", F.when(F.col("event_id") % 7 == 0, other).otherwise(F.col("xml")).alias("xml")
    )
    return prepare_events(records, index=INDEX, metadata=METADATA).select("event_id", "reason", "shape")


def q_event_table(spark, sf_dir):
    """K5-K7: a typed table, appended to twice, read back by day and shape, then cleared."""
    name = f"eventloom_{uuid.uuid4().hex}"
    load = EventLoad(_prepared(spark, sf_dir))
    try:
        append_events(load, name)
        append_events(load, name)
        table = spark.table(name)
        typed = F.lit(int(dict(table.dtypes)["event_time"] == "timestamp_ntz")).cast("long")
        days = table.groupBy(F.col("event_date").cast("string").alias("event_date"), "shape").agg(
            F.count(F.lit(1)).alias("n"), F.date_format(F.max("event_time"), "yyyy-MM-dd HH:mm:ss.SSSSSS").alias("last_time")
        )
        ensure_checkpoint_dir(spark)
        days = days.withColumn("typed", typed).checkpoint()
    finally:
        clear_event_table(spark, name)
    return days.withColumn("cleared", F.lit(int(not spark.catalog.tableExists(name))).cast("long"))


def q_scan_cut_files(spark, sf_dir):
    """F6, files cut inside their last record, read by byte ranges: that record is rejected, all others load."""
    path = scratch_path(spark, "cut-exports")
    write_cut_exports(events_as_xml(_events(spark, sf_dir)), path, PER_FILE)
    loaded = prepare_events(scan_event_xml(spark, path), index=INDEX, metadata=METADATA)
    return loaded.select(F.regexp_extract("xml", _RECORD_ID, 1).cast("long").alias("event_id"), "reason", "shape")


def _streamed(prepared: DataFrame, name: str) -> DataFrame:
    """All that a stream of prepared records gives, by its outcome."""
    spark, out = prepared.sparkSession, scratch_path(prepared.sparkSession, name)
    rows = prepared.select(F.regexp_extract("xml", _RECORD_ID, 1).cast("long").alias("event_id"), "reason", "shape")
    writer = rows.writeStream.format("parquet").option("checkpointLocation", f"{out}-log").option("path", out)
    writer.trigger(availableNow=True).start().awaitTermination()
    return spark.read.schema(rows.schema).parquet(out)


def q_stream_cut_files(spark, sf_dir):
    """S2 on a stream: F6 by (file, length) offsets; a file cut inside its last record gives one reject for it."""
    path = scratch_path(spark, "cut-exports")
    write_cut_exports(events_as_xml(_events(spark, sf_dir)), path, PER_FILE)
    return _streamed(prepare_events(stream_event_xml(spark, path), index=INDEX, metadata=METADATA), "stream-records")


def q_stream_event_chunks(spark, sf_dir):
    """S1 on a stream: F5 by (file, chunk) offsets."""
    path = scratch_path(spark, "event-chunks")
    write_event_chunks(events_as_xml(_events(spark, sf_dir)), path, CHUNK_BYTES)

    def decode(header: bytes, chunks: bytes):
        for lo in range(0, len(chunks), CHUNK_BYTES):
            yield from chunk_records(chunks[lo : lo + CHUNK_BYTES])

    files = stream_event_files(spark, path, decode, CHUNK_BYTES, CHUNK_BYTES, path_glob_filter="*.txt")
    return _streamed(prepare_events(files, index=INDEX, metadata=METADATA), "stream-chunks")


def q_push_event_stream(spark, sf_dir):
    """K2 on a stream: every loaded record's lines as they were handed to ``send``, with no request above its size."""
    path, out = scratch_path(spark, "event-export"), scratch_path(spark, "pushed")
    write_event_export(events_as_xml(_events(spark, sf_dir)), path)

    def send(lines):
        # Named by its content: a request that a repeated task sends again is the same file.
        text = "\n".join(x.replace("\n", "\t") for x in lines)
        write_file(f"{out}/{hashlib.sha256(text.encode()).hexdigest()}-{len(lines)}.txt", text.encode())

    prepared = prepare_events(stream_event_xml(spark, path + "/*.txt"), index=INDEX, metadata=METADATA)
    start_bulk_push(prepared, send, f"{out}-log", batch_size=BATCH_SIZE, available_now=True).awaitTermination()
    rows = spark.read.schema("value string").text(out).withColumn("file", F.col("_metadata.file_name"))
    size = F.regexp_extract("file", r"-(\d+)\.txt", 1).cast("long")
    rid = F.regexp_extract("value", r'"EventRecordID": "(\d+)"', 1).cast("long")
    return rows.select(rid.alias("event_id"), F.translate("value", "\t", "\n").alias("line"), _flag(size <= BATCH_SIZE).alias("fits"))


def q_load_once_report(spark, sf_dir):
    """K4 + E7: the counts of a load by outcome, taken by the job that wrote it."""
    records = events_as_xml(_events(spark, sf_dir))
    load = load_events(spark, records, index=INDEX, metadata=METADATA, sink=bulk_files(scratch_path(spark, "bulk")))
    report = load.report
    rows = [("records", "all", report.records), ("records", "loaded", report.loaded)]
    rows += [("shape", k, n) for k, n in report.shapes.items()] + [("reason", k, n) for k, n in report.reasons.items()]
    return spark.createDataFrame(rows, "kind string, name string, n long")


def _stored(spark: SparkSession, sf_dir: str, store, read) -> DataFrame:
    """What ``read(table)`` gives of a table that ``store(load, table)`` filled; the table is dropped."""
    name = f"eventloom_{uuid.uuid4().hex}"
    ensure_checkpoint_dir(spark)
    try:
        store(EventLoad(_prepared(spark, sf_dir)), name)
        return read(name).checkpoint()
    finally:
        clear_event_table(spark, name)


def q_quarantine_table(spark, sf_dir):
    """E1 + K5: loaded and rejected records in one table from one write, read back by SQL."""
    loaded_id = "coalesce(Event.System.EventRecordID, System.EventRecordID)"
    return _stored(
        spark, sf_dir, lambda load, name: store_events(load, name, keep=("event_id", "xml")),
        lambda name: spark.sql(
            f"SELECT CAST({loaded_id} AS BIGINT) AS event_id, status, shape, reason, CAST(event_date AS STRING) AS event_date FROM {name} WHERE status = 'loaded' "
            f"UNION ALL SELECT event_id, status, shape, reason, NULL FROM {name} WHERE status = 'rejected' AND xml LIKE '<Event %'"
        ),
    )


def q_lookup_stored_field(spark, sf_dir):
    """T8b on a stored table: the records of one user by the field's own column."""
    return _stored(
        spark, sf_dir, lambda load, name: append_events(load, name, lookup=("user", "type")),
        lambda name: lookup_events(spark, name, "user", LOOKUP_USER).select(
            F.col("Event.System.EventRecordID").cast("long").alias("event_id"), F.col("lookup_user").alias("user"), F.col("lookup_type").alias("type")
        ),
    )


def q_event_tree(spark, sf_dir):
    """T1 + T15: an element and an attribute that the typed columns do not know, read by path from the record's tree."""
    child = F.concat(F.lit('<Custom Code="'), F.col("event_id") % 9, F.lit('"><Deep>d'), F.col("event_id"), F.lit("</Deep></Custom></System>"))
    records = events_as_xml(_events(spark, sf_dir)).withColumn("xml", F.replace("xml", F.lit("</System>"), child))
    load = accepted_events(prepare_events(records, index=INDEX, metadata=METADATA, tree=True))

    def read(path: str) -> F.Column:
        both = [F.variant_get("event_tree", f"$.{head}System.{path}", "string") for head in ("Event.", "")]
        return F.coalesce(*both)

    return load.select("event_id", read("Custom['@Code']").alias("code"), read("Custom.Deep").alias("deep"), read("EventID").alias("event_code"))


try:  # the training-data operators are a part of their own that may be absent
    import corpus_pipeline as _pipeline
    from eventloom.llm.queries import ORACLE_SQL as _LLM_SQL
    from eventloom.llm.queries import QUERIES as _LLM_QUERIES
except ModuleNotFoundError as e:
    if e.name not in ("corpus_pipeline", "eventloom.llm", "eventloom.llm.queries"):
        raise
    _LLM_QUERIES, _LLM_SQL = {}, {}
else:
    _LLM_QUERIES = {**_LLM_QUERIES, "pipeline": _pipeline.run}
    if _pipeline.ORACLE_SQL is not None:
        _LLM_SQL = {**_LLM_SQL, "pipeline": _pipeline.ORACLE_SQL}

_QUERIES: dict[str, Callable[[SparkSession, str], DataFrame]] = {
    "scan_event_xml": q_scan_event_xml,
    "parse_event_fields": q_parse_event_fields,
    "event_time_raw": q_event_time_raw,
    "parse_event_time": q_parse_event_time,
    "event_time_iso": q_event_time_iso,
    "add_timestamp": q_add_timestamp,
    "set_nested_time": q_set_nested_time,
    "event_shape": q_event_shape,
    "eventdata_map": q_eventdata_map,
    "eventdata_lookup": q_eventdata_lookup,
    "promote_event": q_promote_event,
    "single_raw": q_single_raw,
    "nodata_raw": q_nodata_raw,
    "drop_nested": q_drop_nested,
    "json_encode_field": q_json_encode_field,
    "reject_events": q_reject_events,
    "accepted_events": q_accepted_events,
    "reject_summary": q_reject_summary,
    "event_document": q_event_document,
    "stamp_index": q_stamp_index,
    "stamp_meta": q_stamp_meta,
    "assign_batches": q_assign_batches,
    "bulk_lines": q_bulk_lines,
    "load_report": q_load_report,
    "document_payload": q_document_payload,
    "scan_event_chunks": q_scan_event_chunks,
    "reject_root": q_reject_root,
    "event_table": q_event_table,
    "scan_cut_files": q_scan_cut_files,
    "stream_cut_files": q_stream_cut_files,
    "stream_event_chunks": q_stream_event_chunks,
    "push_event_stream": q_push_event_stream,
    "load_once_report": q_load_once_report,
    "quarantine_table": q_quarantine_table,
    "lookup_stored_field": q_lookup_stored_field,
    "event_tree": q_event_tree,
}


def entry(spark: SparkSession) -> DataFrame:
    """Flagship: the full load of sf0.001 events; one row per loaded record."""
    acc = _accepted(spark, "/root/testdata/sf0.001")
    return acc.select("event_id", "shape", F.col("`@timestamp`").alias("ts_iso"), "document")


def queries() -> dict[str, Callable[[SparkSession, str], DataFrame]]:
    return {**_QUERIES, **_LLM_QUERIES}


# ---------------------------------------------------------------- oracle SQL

# F1 expectations from the events columns alone: k picks the body, v the time form.
_BASE = r"""
WITH b AS (
  SELECT event_id, ts, user_id, event_type, props,
         event_id % 8 AS k, (event_id // 8) % 5 AS v,
         CAST(user_id AS VARCHAR) AS uid
  FROM events
), x AS (
  SELECT *,
    CASE WHEN event_id % 101 = 0 THEN 'xml' WHEN v = 4 THEN 'timestamp' WHEN k = 7 THEN 'shape' END AS reason,
    CASE WHEN v = 2 THEN date_trunc('second', ts) WHEN v = 3 THEN date_trunc('millisecond', ts) ELSE ts END AS t
  FROM b
), f1 AS (
  SELECT *,
    CASE WHEN reason IS NULL THEN
      CASE WHEN k IN (0, 1) THEN 'list' WHEN k IN (2, 3) THEN 'single' WHEN k IN (4, 5) THEN 'nodata' ELSE 'promote' END
    END AS shape,
    regexp_replace(strftime(t, '%Y-%m-%dT%H:%M:%S.%f'), '[.]000000$', '') AS iso
  FROM x
), docs AS (
  SELECT *,
    '{"Provider": {"@Name": "' || event_type || '"}, "EventID": "' || CAST(event_id % 5 AS VARCHAR)
      || '", "TimeCreated": {"@SystemTime": "' || iso || '"}, "EventRecordID": "' || CAST(event_id AS VARCHAR)
      || '", "Execution": {"@ProcessID": "' || uid || '"}}' AS sys_json,
    CASE k WHEN 2 THEN '{"@Name": "user", "#text": "' || uid || '"}' WHEN 3 THEN props END AS eventdata_raw,
    CASE k WHEN 4 THEN '{"Data": null}' WHEN 5 THEN '{"Binary": "' || uid || '"}' END AS event_raw
  FROM f1
), docs2 AS (
  SELECT *,
    CASE
      WHEN shape = 'promote' THEN
        '{"@xmlns": "urn:e", "System": ' || sys_json || ', "UserData": {"U": "' || uid || '"}'
      ELSE
        '{"Event": {"@xmlns": "urn:e", "System": ' || sys_json ||
        CASE k
          WHEN 0 THEN ', "EventData": {"Data": {"user": "' || uid || '", "type": "' || event_type || '"}}'
          WHEN 1 THEN ', "EventData": {"Data": {"user": "' || uid || '", "e": "None"}}'
          WHEN 2 THEN ', "EventData": {"RawData": "' || replace(eventdata_raw, '"', '\"') || '"}'
          WHEN 3 THEN ', "EventData": {"Binary": "FF", "RawData": "'
                      || replace(replace(eventdata_raw, '\', '\\'), '"', '\"') || '"}'
          ELSE ', "RawData": "' || replace(event_raw, '"', '\"') || '"'
        END || '}, "@timestamp": "' || iso || '"'
    END AS body
  FROM docs
)
"""

_META = '"meta": {"source": "sf", "run": 1}'

_CUT_REASON = f"CASE WHEN event_id % {PER_FILE} = {PER_FILE - 1} THEN 'xml' ELSE reason END"

_ORACLE_TAILS = {
    "scan_event_xml": "SELECT event_id, reason, shape FROM f1",
    "parse_event_fields": """
        SELECT event_id,
          CAST(CASE WHEN event_id % 101 = 0 THEN 1 ELSE 0 END AS BIGINT) AS corrupt,
          CASE WHEN event_id % 101 <> 0 THEN CAST(event_id AS VARCHAR) END AS record_id,
          CASE WHEN event_id % 101 <> 0 THEN event_type END AS provider,
          CASE WHEN event_id % 101 <> 0 THEN CAST(event_id % 5 AS VARCHAR) END AS event_code,
          CASE WHEN event_id % 101 <> 0 THEN uid END AS process_id,
          CAST(CASE WHEN event_id % 101 = 0 THEN 0 WHEN k = 0 THEN 2 WHEN k = 1 THEN 5
                    WHEN k IN (2, 3, 4) THEN 1 ELSE 0 END AS BIGINT) AS n_data
        FROM f1""",
    "event_time_raw": """
        SELECT event_id,
          CASE WHEN event_id % 101 = 0 THEN NULL
               WHEN v IN (0, 1) THEN strftime(ts, '%Y-%m-%d %H:%M:%S.%f')
               WHEN v = 2 THEN strftime(ts, '%Y-%m-%d %H:%M:%S')
               WHEN v = 3 THEN strftime(ts, '%Y-%m-%d %H:%M:%S.%g')
               ELSE strftime(ts, '%Y-%m-%dT%H:%M:%S') END AS time_text
        FROM f1""",
    "parse_event_time": """
        SELECT event_id,
          CASE WHEN event_id % 101 = 0 OR v = 4 THEN NULL ELSE strftime(t, '%Y-%m-%d %H:%M:%S.%f') END AS event_time
        FROM f1""",
    "event_time_iso": "SELECT event_id, iso FROM f1 WHERE event_id % 101 <> 0 AND v <> 4",
    "add_timestamp": """
        SELECT event_id, CASE WHEN shape IS NOT NULL AND shape <> 'promote' THEN iso END AS "@timestamp" FROM f1""",
    "set_nested_time": "SELECT event_id, iso AS system_time FROM f1 WHERE reason IS NULL",
    "event_shape": "SELECT event_id, reason, shape FROM f1",
    "eventdata_map": """
        SELECT event_id, CAST(2 AS BIGINT) AS n_keys,
          CASE k WHEN 0 THEN 'type=' || event_type || ';user=' || uid ELSE 'e=None;user=' || uid END AS pairs,
          CASE k WHEN 0 THEN '{"user":"' || uid || '","type":"' || event_type || '"}'
                 ELSE '{"user":"' || uid || '","e":"None"}' END AS data_json
        FROM f1 WHERE shape = 'list'""",
    "eventdata_lookup": """
        SELECT event_id, uid AS "user", CASE WHEN k = 0 THEN event_type END AS "type"
        FROM f1 WHERE shape = 'list'""",
    "promote_event": """
        SELECT event_id, iso AS system_time, CAST(event_id AS VARCHAR) AS record_id,
          CAST(0 AS BIGINT) AS has_timestamp, CAST(0 AS BIGINT) AS has_event,
          '"UserData": {"U": "' || uid || '"}' AS other_json
        FROM f1 WHERE shape = 'promote'""",
    "single_raw": """
        SELECT event_id, eventdata_raw, CASE WHEN k = 3 THEN 'FF' END AS binary, eventdata_raw AS struct_raw
        FROM docs WHERE shape = 'single'""",
    "nodata_raw": "SELECT event_id, event_raw, event_raw AS struct_raw FROM docs WHERE shape = 'nodata'",
    "drop_nested": """
        SELECT event_id, shape,
          CAST(CASE WHEN shape <> 'promote' THEN 1 ELSE 0 END AS BIGINT) AS has_event,
          CAST(CASE WHEN shape IN ('list', 'single') THEN 1 ELSE 0 END AS BIGINT) AS has_eventdata,
          CAST(CASE WHEN shape = 'list' THEN 1 ELSE 0 END AS BIGINT) AS has_data,
          CAST(CASE WHEN shape = 'nodata' THEN 1 ELSE 0 END AS BIGINT) AS has_event_raw,
          CAST(CASE WHEN shape = 'promote' THEN 1 ELSE 0 END AS BIGINT) AS has_root_system
        FROM f1 WHERE reason IS NULL""",
    "json_encode_field": r"""
        SELECT event_id,
          '"' || replace(replace(props, '\', '\\'), '"', '\"') || '"' AS props_json,
          '"' || replace(replace(event_type, '\', '\\'), '"', '\"') || '"' AS type_json
        FROM b""",
    "reject_events": "SELECT event_id, reason FROM f1 WHERE reason IS NOT NULL",
    "accepted_events": """
        SELECT event_id, shape, CASE WHEN shape <> 'promote' THEN iso END AS ts_iso FROM f1 WHERE reason IS NULL""",
    "reject_summary": "SELECT reason, COUNT(*) AS n FROM f1 WHERE reason IS NOT NULL GROUP BY reason",
    "event_document": f"""
        SELECT event_id, body || ', "_index": "hostlogs", "_type": "hostlogs", {_META}}}' AS document
        FROM docs2 WHERE reason IS NULL""",
    "stamp_index": "SELECT event_id, 'hostlogs' AS _index, 'hostlogs' AS _type FROM f1 WHERE reason IS NULL",
    "stamp_meta": """
        SELECT event_id, 'sf' AS meta_source, CAST(1 AS BIGINT) AS meta_run, '{"run":1,"source":"sf"}' AS meta_json
        FROM f1 WHERE reason IS NULL""",
    "assign_batches": f"""
        SELECT event_id, CAST((ROW_NUMBER() OVER (ORDER BY event_id) - 1) // {BATCH_SIZE} AS BIGINT) AS batch
        FROM f1 WHERE reason IS NULL""",
    "bulk_lines": f"""
        SELECT event_id,
          '{{"index": {{"_index": "hostlogs", "_type": "hostlogs"}}}}' || chr(10) || body || ', {_META}}}' AS line
        FROM docs2 WHERE reason IS NULL""",
    "scan_event_chunks": "SELECT event_id, reason, shape FROM f1",
    "reject_root": """
        SELECT event_id,
          CASE WHEN event_id % 101 = 0 THEN 'xml' WHEN event_id % 7 = 0 THEN 'root' ELSE reason END AS reason,
          CASE WHEN event_id % 7 <> 0 THEN shape END AS shape
        FROM f1""",
    "event_table": """
        SELECT strftime(t, '%Y-%m-%d') AS event_date, shape, 2 * COUNT(*) AS n,
          strftime(MAX(t), '%Y-%m-%d %H:%M:%S.%f') AS last_time, CAST(1 AS BIGINT) AS typed, CAST(1 AS BIGINT) AS cleared
        FROM f1 WHERE reason IS NULL GROUP BY 1, 2""",
    "scan_cut_files": f"""
        SELECT event_id, {_CUT_REASON} AS reason, CASE WHEN {_CUT_REASON} IS NULL THEN shape END AS shape FROM f1""",
    "stream_cut_files": f"""
        SELECT event_id, {_CUT_REASON} AS reason, CASE WHEN {_CUT_REASON} IS NULL THEN shape END AS shape FROM f1""",
    "stream_event_chunks": "SELECT event_id, reason, shape FROM f1",
    "push_event_stream": f"""
        SELECT event_id, CAST(1 AS BIGINT) AS fits,
          '{{"index": {{"_index": "hostlogs", "_type": "hostlogs"}}}}' || chr(10) || body || ', {_META}}}' AS line
        FROM docs2 WHERE reason IS NULL""",
    "load_once_report": """
        SELECT 'records' AS kind, 'all' AS name, COUNT(*) AS n FROM f1
        UNION ALL SELECT 'records', 'loaded', COUNT(*) FROM f1 WHERE reason IS NULL
        UNION ALL SELECT 'shape', shape, COUNT(*) FROM f1 WHERE reason IS NULL GROUP BY shape
        UNION ALL SELECT 'reason', reason, COUNT(*) FROM f1 WHERE reason IS NOT NULL GROUP BY reason""",
    "quarantine_table": """
        SELECT event_id, CASE WHEN reason IS NULL THEN 'loaded' ELSE 'rejected' END AS status, shape, reason,
          CASE WHEN reason IS NULL THEN strftime(t, '%Y-%m-%d') END AS event_date
        FROM f1""",
    "lookup_stored_field": f"""
        SELECT event_id, uid AS "user", CASE WHEN k = 0 THEN event_type END AS "type"
        FROM f1 WHERE shape = 'list' AND uid = '{LOOKUP_USER}'""",
    "event_tree": """
        SELECT event_id, CAST(event_id % 9 AS VARCHAR) AS code, 'd' || CAST(event_id AS VARCHAR) AS deep, CAST(event_id % 5 AS VARCHAR) AS event_code
        FROM f1 WHERE reason IS NULL""",
    "load_report": f"""
        SELECT batch, COUNT(*) AS n FROM (
          SELECT (ROW_NUMBER() OVER (ORDER BY event_id) - 1) // {BATCH_SIZE} AS batch FROM f1 WHERE reason IS NULL
        ) GROUP BY batch""",
}

_DOCUMENT_PAYLOAD = """
SELECT doc_id, 'list' AS shape, text, CAST(length(text) AS BIGINT) AS n_chars FROM documents
"""


def oracle_sql() -> dict[str, str]:
    out = {name: _BASE + tail for name, tail in _ORACLE_TAILS.items()}
    out["document_payload"] = _DOCUMENT_PAYLOAD
    return {**out, **_LLM_SQL}
