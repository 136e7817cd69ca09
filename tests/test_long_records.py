"""Records with very long texts: the load's time follows their length, and their outcome is that of short ones."""

from __future__ import annotations

import time

import pytest
from pyspark.sql import functions as F

from eventloom import prepare_events
from eventloom.operators.parse import UNSEEN_PATTERN, parse_events, classify_events

HEAD = '<Event><System><TimeCreated SystemTime="2024-01-02 03:04:05"/></System><EventData>'
TAIL = "</EventData></Event>"
N = 1_000_000


def _two(text: str) -> str:
    return f'{HEAD}<Data Name="a">1</Data><Data Name="text">{text}</Data>{TAIL}'


LONG = {
    "letters": _two("x" * N),
    "words": _two("word " * (N // 5)),
    "raw_gt": _two("a > b " * 100_000 + "x" * (N - 600_000)),
    "only_gt": _two(">" * N),
    "slashes": _two("/> " * (N // 3)),
    "blanks": _two("a" + " " * N + "b"),
    "equals": _two("k = v " * (N // 6)),
    "lines": _two("one line\n" * (N // 9)),
    "attribute": f'{HEAD}<Data Name="{"long name " * (N // 10)}">1</Data><Data Name="text">t</Data>{TAIL}',
    "attribute_gt": f'{HEAD}<Data Name="{"a>b " * (N // 4)}">1</Data><Data Name="text">t</Data>{TAIL}',
    "mixed": f'{HEAD}<Data Name="a">1</Data>{"y " * (N // 2)}<Data Name="text">t</Data>{TAIL}',
}


@pytest.mark.parametrize("name", sorted(LONG))
def test_check_is_linear(spark, name):
    """The completeness check alone: a quadratic one takes many minutes for a million characters."""
    df = spark.createDataFrame([(LONG[name],)], "xml string")
    began = time.perf_counter()
    hit = df.select(F.col("xml").rlike(UNSEEN_PATTERN)).first()[0]
    assert time.perf_counter() - began < 20
    assert hit == (name in ("mixed", "slashes"))  # "/>" in a text only sends the record to the full tree


def test_long_records_load(spark):
    df = spark.createDataFrame(sorted(LONG.items()), "name string, xml string").repartition(4)
    began = time.perf_counter()
    rows = {r["name"]: r for r in prepare_events(df).select("name", "reason", "shape", "event_data", F.length("document").alias("n")).collect()}
    assert time.perf_counter() - began < 120
    assert all(r["reason"] is None and r["shape"] == "list" for r in rows.values())
    for name in ("letters", "raw_gt", "only_gt"):
        inside = LONG[name].partition('Name="text">')[2].removesuffix(f"</Data>{TAIL}")
        assert rows[name]["event_data"]["text"] == inside
    assert rows["mixed"]["event_data"] == {"a": "1", "text": "t"} and rows["mixed"]["n"] > N  # "#text" is kept
    assert rows["attribute"]["event_data"]["long name " * (N // 10)] == "1"


def test_long_malformed_records_are_rejected(spark):
    df = spark.createDataFrame([(LONG["words"].removesuffix("</Event>"),), (LONG["attribute"].replace("</Data>", "</data>"),)], "xml string")
    assert [r[0] for r in prepare_events(df).select("reason").collect()] == ["xml", "xml"]


def test_check_runs_once(spark):
    """Each of its patterns stands once in the optimized plan, however many columns are asked for."""
    df = classify_events(parse_events(spark.createDataFrame([("<Event/>",)], "xml string")))
    plan = prepare_events(spark.createDataFrame([("<Event/>",)], "xml string"))._jdf.queryExecution().optimizedPlan().toString()
    for text in (plan, df._jdf.queryExecution().optimizedPlan().toString()):
        assert text.count("<[^<>]*+>") == 1


def test_simple_records_hold_nothing_unseen(spark):
    """The one-pass pattern takes plain records, of any length, and none that the patterns for all records would not take."""
    from eventloom.operators.parse import PLAIN_PATTERN, SIMPLE_PATTERN

    head = '<Event xmlns="u"><System><EventID>1</EventID><Execution ProcessID="1" ThreadID="2"/></System><EventData>'
    plain = [head + body + "</EventData></Event>" for body in ("", '<Data Name="a">1 &lt; 2</Data>\n<Data/>', "<Data>x</Data>" * 20_000)]
    other = ["<data>x</data>", "<Data>x<!-- c --></Data>", "<Data>x</Data>y", "y<Data>x</Data>", '<Data Other="1"/>', "<Data>x<Binary/></Data>"]
    other += ["<Custom/>", '<Data Name="a b=1"/>', "<Data><![CDATA[x]]></Data>", "<Data/>y", "<Data Name='a'/>"]
    rows = [(True, x) for x in plain] + [(False, head + body + "</EventData></Event>") for body in other] + [(False, plain[0].removesuffix("</Event>"))]
    df = spark.createDataFrame(rows, "plain boolean, xml string")
    taken = F.col("xml").rlike(SIMPLE_PATTERN)
    known = F.col("xml").rlike(PLAIN_PATTERN) & ~F.col("xml").rlike(UNSEEN_PATTERN)
    assert [r["xml"] for r in df.where(taken != F.col("plain")).collect()] == []
    assert [r["xml"] for r in df.where(taken & ~known).collect()] == []
