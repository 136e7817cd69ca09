"""K4 and E7 from the writing job, E1 into tables, T8b look-ups, and the record's tree as a value."""

from __future__ import annotations

import glob
import json
import subprocess
import sys
import textwrap
import uuid

import pytest
from conftest import ROOT, SF_SMALL
from helpers import event
from pyspark.sql import functions as F

from eventloom import LoadReport, load_events, prepare_events
from eventloom.fixtures import events_as_xml
from eventloom.sinks import (
    append_events, bulk_files, bulk_push, clear_event_table, event_store, event_table, loaded_events, lookup_events, quarantined_events,
    store_events,
)

LIST = event('<EventData><Data Name="a">1</Data><Data Name="b">2</Data></EventData>')
SINGLE = event("<EventData><Data>x</Data></EventData>")
ROWS = [LIST] * 7 + [SINGLE] * 3 + ["<Event>"] * 2 + ["<Other/>", event("<EventData>text</EventData>"), event("", time="yesterday")]
REPORT = LoadReport(15, 10, {"list": 7, "single": 3}, {"xml": 2, "root": 1, "timestamp": 1, "shape": 1})


def source(spark, rows=ROWS, parts=3):
    return spark.createDataFrame(list(enumerate(rows)), "rid long, xml string").repartition(parts)


@pytest.fixture
def table(spark):
    name = "eventloom_test_store"
    clear_event_table(spark, name)
    yield name
    clear_event_table(spark, name)


def jobs_of(spark, work):
    tracker, group = spark.sparkContext.statusTracker(), uuid.uuid4().hex
    spark.sparkContext.setJobGroup(group, "counted")
    try:
        return work(), len(tracker.getJobIdsForGroup(group))
    finally:
        spark.sparkContext._jsc.clearJobGroup()


def test_report_comes_from_the_writing_job(spark, tmp_path, table):
    """One job for files and pushes; a table's rows are shuffled first, and nothing is read or parsed again."""
    df = source(spark).persist()
    df.count()
    for sink, most in ((bulk_files(str(tmp_path / "f")), 1), (bulk_push(lambda lines: None), 1), (event_table(table), 3)):
        if most == 3:
            append_events(load_events(spark, df.limit(0)), table)  # makes the table
        load, n = jobs_of(spark, lambda: load_events(spark, df, sink=sink))  # noqa: B023
        report, more = jobs_of(spark, lambda: load.report)  # noqa: B023
        assert report == REPORT and n <= most and more == 0
    df.unpersist()


def test_report_of_nothing(spark, tmp_path):
    load = load_events(spark, source(spark, []), sink=bulk_files(str(tmp_path / "f")))
    assert load.report == LoadReport(0, 0, {}, {})
    assert load_events(spark, source(spark)).report is None


def test_report_of_all_events(spark, tmp_path):
    """The counts equal those of a second pass."""
    records = events_as_xml(spark.read.parquet(f"{SF_SMALL}/events.parquet"))
    report = load_events(spark, records, sink=bulk_files(str(tmp_path / "f"))).report
    again = prepare_events(records).groupBy("reason", "shape").count().collect()
    assert report.reasons == {r["reason"]: r["count"] for r in again if r["reason"]}
    assert report.shapes == {r["shape"]: r["count"] for r in again if r["shape"]}
    assert report.records == sum(r["count"] for r in again) and report.loaded == sum(report.shapes.values())


def test_both_outputs_in_one_table(spark, table):
    """Loaded and rejected records from one write, read back by SQL; the plan parses once."""
    load = load_events(spark, source(spark), sink=event_store(table, keep=("rid", "xml")))
    assert load.report == REPORT
    load_events(spark, source(spark), sink=event_store(table, keep=("rid", "xml")))
    loaded = spark.sql(f"SELECT shape, count(*) AS n, count(reason) AS r, count(rid) AS k FROM {table} WHERE status = 'loaded' GROUP BY shape").collect()
    assert {tuple(r) for r in loaded} == {("list", 14, 0, 0), ("single", 6, 0, 0)}
    bad = spark.sql(f"SELECT rid, reason, xml FROM {table} WHERE status = 'rejected'").collect()
    want = [(i, r, ROWS[i]) for i, r in ((10, "xml"), (11, "xml"), (12, "root"), (13, "shape"), (14, "timestamp"))]
    assert sorted(map(tuple, bad)) == sorted(2 * want)
    assert quarantined_events(spark, table).columns == ["reason", "rid", "xml"] and quarantined_events(spark, table).count() == 10
    assert loaded_events(spark, table).where("event_data['a'] = '1'").count() == 14
    # Only the folders of one side are read.
    files = loaded_events(spark, table).inputFiles()
    assert files and all("status=loaded" in f for f in files)
    with pytest.raises(ValueError, match="names that the table uses"):
        store_events(load_events(spark, source(spark).withColumnRenamed("rid", "status")), table, keep=("status",))


def test_lookup_columns(spark, table):
    """A field's own column gives what the map gives, on tables with and without it."""
    rows = [event(f'<EventData><Data Name="user">{i % 40}</Data><Data Name="odd name">x{i}</Data></EventData>') for i in range(400)] + ROWS
    append_events(load_events(spark, source(spark, rows)), table, lookup=("user", "odd name"))
    append_events(load_events(spark, source(spark, rows)), table)  # the table knows its columns
    assert lookup_events(spark, table, "user", "7").count() == 20 == spark.table(table).where("event_data['user'] = '7'").count()
    assert lookup_events(spark, table, "odd name", "x9").count() == 2
    assert lookup_events(spark, table, "a", "1").count() == 14 and lookup_events(spark, table, "user", "none").count() == 0
    plan = lookup_events(spark, table, "user", "7")._jdf.queryExecution().executedPlan().toString()
    assert "EqualTo(lookup_user,7)" in plan.split("PushedFilters")[1]


LOOKUP = """
    import sys
    sys.path.insert(0, {root!r})
    from pyspark.sql import SparkSession, functions as F
    spark = (SparkSession.builder.master("local[2]").config("spark.ui.enabled", "false").config("spark.eventLog.enabled", "true")
        .config("spark.eventLog.dir", "file://{logs}").config("spark.eventLog.rolling.enabled", "false").config("spark.eventLog.compress", "false")
        .config("spark.sql.warehouse.dir", "{house}").config("spark.sql.shuffle.partitions", "2").getOrCreate())
    from eventloom import load_events
    from eventloom.sinks import append_events, lookup_events, table
    table.ROW_GROUP_BYTES = 512 << 10
    n = 60_000
    user = F.when(F.col("id") == 31_415, "rare").otherwise(F.concat(F.lit("u"), F.sha2(F.col("id").cast("string"), 256)))
    xml = F.concat(F.lit('<Event><System><TimeCreated SystemTime="2024-01-02 03:04:05"/></System><EventData><Data Name="user">'), user,
        F.lit('</Data><Data Name="n">'), F.col("id").cast("string"), F.lit("</Data></EventData></Event>"))
    append_events(load_events(spark, spark.range(n).select(xml.alias("xml"))), "stored", lookup=("user",))
    by_map = spark.table("stored").where("event_data['user'] = 'rare'").select("event_data").collect()
    by_column = lookup_events(spark, "stored", "user", "rare").select("event_data").collect()
    assert by_map == by_column and [r[0]["n"] for r in by_map] == ["31415"]
    spark.stop()
"""


def test_lookup_skips_row_groups(tmp_path):
    """By the event log: the map look-up reads every row, that by the field's column the rows of few row groups."""
    logs, house = tmp_path / "logs", tmp_path / "house"
    logs.mkdir()
    script = textwrap.dedent(LOOKUP.format(root=ROOT, logs=logs, house=house))
    done = subprocess.run([sys.executable, "-c", script], capture_output=True, text=True, timeout=600, cwd=tmp_path)
    assert done.returncode == 0, done.stderr[-3000:]
    import pyarrow.parquet as pq

    groups = sum(pq.ParquetFile(f).num_row_groups for f in glob.glob(f"{house}/stored/**/*.parquet", recursive=True))
    assert groups >= 10
    (log,) = [p for p in logs.iterdir() if p.is_file()]
    scanned, names = {}, {}
    for line in log.read_text().rstrip("\n").split("\n"):  # plan texts hold other line separators
        e = json.loads(line)
        if "sparkPlanInfo" in e:
            todo = [e["sparkPlanInfo"]]
            while todo:
                node = todo.pop()
                todo += node["children"]
                if node["nodeName"].startswith("Scan parquet"):
                    names |= {m["accumulatorId"]: e["executionId"] for m in node["metrics"] if m["name"] == "number of output rows"}
        for a in e.get("Task Info", {}).get("Accumulables", []) if e["Event"] == "SparkListenerTaskEnd" else ():
            if a["ID"] in names:
                scanned[names[a["ID"]]] = scanned.get(names[a["ID"]], 0) + int(a["Update"])
    read = [n for _, n in sorted(scanned.items())][-2:]
    assert read[0] == 60_000 and 0 < read[1] <= 60_000 // 5, (read, groups)


def test_tree_reads_what_the_schema_does_not_know(spark):
    """Unknown elements and attributes by path, for native and routed records, promoted ones too; NULL for rejected ones."""
    custom = LIST.replace("</System>", '<Custom Code="7"><Deep>é "x"</Deep><Deep>z</Deep></Custom></System>').replace('Name="a"', 'Name="a" Type="t"')
    promoted = event("<UserData><U q='1'>v</U></UserData>")
    out = prepare_events(source(spark, [LIST, custom, promoted, "<Event>"]), tree=True)
    read = lambda path: F.variant_get("event_tree", path, "string")
    rows = out.orderBy("rid").select(
        F.schema_of_variant("event_tree").isNull(), read("$.Event.EventData.Data.a"), read("$.Event.System.Custom['@Code']"),
        read("$.Event.System.Custom.Deep[0]"), read("$.UserData.U['@q']"), F.to_json("event_tree"), F.col("document"),
    ).collect()
    assert [r[0] for r in rows] == [False, False, False, True]
    assert [r[1] for r in rows] == ["1", "1", None, None] and [r[2] for r in rows] == [None, "7", None, None]
    assert [r[3] for r in rows] == [None, 'é "x"', None, None] and [r[4] for r in rows] == [None, None, "1", None]
    for r in rows[:3]:
        document = json.loads(r[6])
        assert json.loads(r[5]) == {k: v for k, v in document.items() if k not in ("_index", "_type", "meta")}
    assert "event_tree" not in prepare_events(source(spark)).columns
    with pytest.raises(ValueError, match="names that the load uses"):
        prepare_events(source(spark).withColumn("event_tree", F.lit(1)))
