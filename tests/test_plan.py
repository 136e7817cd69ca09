"""Plan checks: one XML parse however many fields are used; no shuffle from scan to sink."""

from __future__ import annotations

import re

from conftest import SF_SMALL
import pytest
from pyspark.sql import functions as F

from eventloom import prepare_events
from eventloom.fixtures import events_as_xml
from eventloom.operators.quarantine import accepted_events


def _plan(df) -> str:
    return df._jdf.queryExecution().executedPlan().toString()


def test_single_from_xml_with_filters_on_parsed_fields(spark):
    ev = spark.read.parquet(f"{SF_SMALL}/events.parquet")
    df = accepted_events(prepare_events(events_as_xml(ev))).where(F.col("shape") == "list")
    df = df.select("event_id", "document", F.col("event_data")["user"].alias("u"))
    assert _plan(df).count("from_xml") == 1


def test_load_has_no_exchange(spark):
    """Scan to sink without a shuffle, unless the caller asks for one."""
    ev = spark.read.parquet(f"{SF_SMALL}/events.parquet")
    df = prepare_events(events_as_xml(ev)).select("event_id", "reason", "document")
    plan = _plan(df)
    assert "Exchange" not in plan


def test_under_split_input_gets_one_round_robin_exchange(spark):
    ev = spark.read.parquet(f"{SF_SMALL}/events.parquet")  # one split
    df = prepare_events(events_as_xml(ev), min_partitions=4).select("event_id", "reason", "document")
    plan = _plan(df)
    assert plan.count("Exchange") == 1 and "RoundRobinPartitioning(4)" in plan


def test_column_pruning_reaches_scan(spark):
    ev = spark.read.parquet(f"{SF_SMALL}/events.parquet")
    df = prepare_events(events_as_xml(ev)).select("event_id", "shape")
    plan = _plan(df)
    # value is never read by F1
    assert "value" not in plan.split("ReadSchema:")[1].split("\n")[0]


def test_python_only_for_open_subtrees(spark):
    """The Arrow function gets NULL input for records whose shape needs no second parse."""
    records = [
        '<Event><System><TimeCreated SystemTime="2024-01-02 03:04:05"/></System>'
        '<EventData><Data Name="a">1</Data><Data Name="b">2</Data></EventData></Event>'
    ]
    df = spark.createDataFrame([(0, records[0])], "rid long, xml string")
    out = prepare_events(df).select("reason", "shape", "other_json", "event_raw").collect()[0]
    assert out["shape"] == "list" and out["other_json"] is None and out["event_raw"] is None


def test_filter_on_outputs_does_not_copy_work(spark):
    """A predicate on computed columns stays above the output Generate: one time parse, one Arrow eval."""
    from eventloom.operators.quarantine import reject_summary

    ev = spark.read.parquet(f"{SF_SMALL}/events.parquet")
    df = reject_summary(prepare_events(events_as_xml(ev)))
    plan = _plan(df)
    assert plan.count("regexp_extract_all(_time_text") == 1
    assert plan.count("ArrowEvalPython") == 1
    assert plan.count("from_xml") == 1


def test_building_a_load_runs_no_job(spark):
    ev = spark.read.parquet(f"{SF_SMALL}/events.parquet").groupBy("event_id").agg(
        *[F.first(c).alias(c) for c in ("ts", "user_id", "event_type", "value", "props")]
    )
    tracker = spark.sparkContext.statusTracker()
    spark.sparkContext.setJobGroup("build", "building a load")
    prepare_events(events_as_xml(ev))
    assert not tracker.getJobIdsForGroup("build")
    spark.sparkContext._jsc.clearJobGroup()


@pytest.mark.parametrize("name", ["shape", "REASON", "System", "meta", "document"])
def test_clashing_input_column_is_an_error(spark, name):
    df = spark.createDataFrame([("<Event/>", "mine")], f"xml string, `{name}` string")
    with pytest.raises(ValueError, match="names that the load uses"):
        prepare_events(df)


def test_outcomes_build_no_document(spark):
    """What asks for reason, shape or time only has no document, struct or map in its plan; filters run before these."""
    from eventloom.operators.quarantine import reject_summary

    load = prepare_events(events_as_xml(spark.read.parquet(f"{SF_SMALL}/events.parquet")), metadata={"a": 1})
    for df in (reject_summary(load), accepted_events(load).select("event_id", "shape", "event_time")):
        plan = _plan(df)
        assert "map_from_entries" not in plan and "RawData" not in plan and "@SystemTime" not in plan
    plan = _plan(accepted_events(load).select("document"))
    reject = re.search(r"Filter [^\n]*isnull\([^)]*reason", plan)
    assert reject and reject.start() > plan.index("map_from_entries")  # the tree is printed from the top


def test_generates_hold_references_only(spark):
    """What a Generate holds itself is interpreted for each row; the clean-up and the completeness check stand in projections."""
    plan = _plan(prepare_events(events_as_xml(spark.read.parquet(f"{SF_SMALL}/events.parquet"))).select("event_id", "time_text"))
    held = re.findall(r"Generate explode\(([^\n]*)", plan)
    assert held and not any("RLIKE" in g or "trim" in g for g in held)
