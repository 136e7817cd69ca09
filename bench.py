"""Bench: headline load queries at $BENCH_SF_DIR on local[$BENCH_CPUS]; prints one JSON line
(each query's figure goes to stderr as it ends).

Each query runs twice; the faster run is reported (the first pays JIT and
Python-worker start-up).  Results are written to the ``noop`` sink or to files in
the session's checkpoint folder, so every query does its full work.
"""

from __future__ import annotations

import json
import os
import sys
import time

sys.path.insert(0, os.path.dirname(os.path.abspath(__file__)))

from pyspark.sql import functions as F  # noqa: E402

from eventloom import load_events, prepare_events  # noqa: E402
from eventloom.fixtures import documents_as_events, events_as_xml, write_event_export  # noqa: E402
from eventloom.operators.quarantine import reject_summary  # noqa: E402
from eventloom.plans.batches import assign_batches, load_report  # noqa: E402
from eventloom.session import local_session, scratch_path  # noqa: E402
from eventloom.sinks.bulk import write_bulk_files  # noqa: E402
from eventloom.sources.xml_records import scan_event_xml  # noqa: E402

SF_DIR = os.environ.get("BENCH_SF_DIR", "/root/testdata/sf0.1")
CPUS = os.environ.get("BENCH_CPUS", "8")


def _sf(path: str) -> float | str:
    tail = os.path.basename(path.rstrip("/"))
    try:
        return float(tail.replace("sf", ""))
    except ValueError:
        return tail


def main() -> None:
    spark = local_session(CPUS, app="eventloom-bench", shuffle_partitions=int(CPUS))
    events = spark.read.parquet(f"{SF_DIR}/events.parquet")
    documents = spark.read.parquet(f"{SF_DIR}/documents.parquet")
    meta = {"source": "bench"}

    export_dir = scratch_path(spark, "bench-export")
    write_event_export(events_as_xml(events).repartition(int(CPUS)), export_dir)

    def noop(df):
        df.write.format("noop").mode("overwrite").save()

    def q_load_events():
        noop(prepare_events(events_as_xml(events), metadata=meta))

    def q_scan_export_load():
        noop(prepare_events(scan_event_xml(spark, export_dir + "/*.txt"), metadata=meta))

    def q_bulk_files():
        load = load_events(spark, events_as_xml(events), metadata=meta)
        write_bulk_files(load, scratch_path(spark, "bench-bulk"), batch_size=500)

    def q_document_payload():
        noop(prepare_events(documents_as_events(documents), metadata=meta).select("doc_id", "event_data", "document"))

    def q_reject_summary():
        reject_summary(prepare_events(events_as_xml(events))).collect()

    def q_assign_batches():
        acc = prepare_events(events_as_xml(events)).where(F.col("reason").isNull()).select("event_id")
        load_report(assign_batches(acc, 500, order_by="event_id")).collect()

    queries = {
        "load_events": q_load_events,
        "scan_export_load": q_scan_export_load,
        "bulk_files": q_bulk_files,
        "document_payload": q_document_payload,
        "reject_summary": q_reject_summary,
        "assign_batches": q_assign_batches,
    }
    timings: dict[str, float] = {}
    for name, fn in queries.items():
        best = None
        for _ in range(2):
            t0 = time.perf_counter()
            fn()
            dt = time.perf_counter() - t0
            best = dt if best is None else min(best, dt)
        timings[name] = round(best, 3)
        print(json.dumps({"query": name, "sec": timings[name]}), file=sys.stderr, flush=True)  # a run that is stopped keeps these
    n_events = events.count()
    out = {
        "metric": "total_sec",
        "value": round(sum(timings.values()), 3),
        "unit": "sec",
        "queries": timings,
        "sf": _sf(SF_DIR),
        "events": n_events,
        "events_per_sec_load": round(n_events / timings["load_events"], 1),
        "cpus": int(CPUS),
    }
    print(json.dumps(out))
    spark.stop()


if __name__ == "__main__":
    main()
