"""literal records with hand-derived outcomes (one case per reference code path)."""

from __future__ import annotations

import json

import pytest
from helpers import ISO, event, load_rows

ED = "<EventData>{}</EventData>"


def ed(inner: str) -> str:
    return event(ED.format(inner))


CASES = {
    # id: (record, reason, shape)
    "X01": (ed('<Data Name="a">1</Data><Data Name="b">2</Data>'), None, "list"),
    "X02": (ed('<Data Name="a">1</Data><Data Name="b">2</Data><Data Name="a">3</Data>'), None, "list"),
    "X03": (ed("<Data>x</Data><Data>y</Data>"), None, "list"),
    "X04": (ed("<Data/><Data/>"), None, "list"),
    "X05": (ed('<Data Name="">e</Data><Data Name="b">2</Data>'), None, "list"),
    "X06": (ed('<Data Name="a"/><Data Name="b">2</Data>'), None, "list"),
    "X07": (ed('<Data Name="a"><Sub>1</Sub></Data><Data Name="b">2</Data>'), None, "list"),
    "X08": (ed('<Data Name="a">1</Data>'), None, "single"),
    "X09": (ed("<Data>plain</Data>"), None, "single"),
    "X10": (ed('<Data Name="x"/>'), None, "single"),
    "X10b": (ed("<Data><Sub>1</Sub></Data>"), None, "single"),
    "X11": (ed("<Data/>"), None, "nodata"),
    "X11b": (ed("<Data>   </Data>"), None, "nodata"),
    "X12": (ed("<Data>v</Data><Binary>AB</Binary>"), None, "single"),
    "X13": (event('<EventData Name="n"/>'), None, "nodata"),
    "X14": (event("<EventData/>"), None, "promote"),
    "X15": (event('<UserData><U a="1">5</U><U>6</U></UserData>'), None, "promote"),
    "X16": (event("<EventData>text</EventData>"), "shape", None),
    "X17": (event("<EventData><Data>a</Data></EventData><EventData><Data>b</Data></EventData>"), "shape", None),
    "X18": (ed('text<Data Name="a">1</Data><Data Name="b">2</Data>'), None, "list"),
    "X19": (event(ED.format("<Data>v</Data>"), time="2024-01-02 03:04:05"), None, "single"),
    "X20": (event(ED.format("<Data>v</Data>"), time="2024-01-02 03:04:05.5"), None, "single"),
    "X21": (event(ED.format("<Data>v</Data>"), time="2024-01-02 03:04:05.000000"), None, "single"),
    "X22a": (event(ED.format("<Data>v</Data>"), time="2024-01-02 03:04:05.1234567"), "timestamp", None),
    "X22b": (event(ED.format("<Data>v</Data>"), time="2024-01-02T03:04:05"), "timestamp", None),
    "X22c": (event(ED.format("<Data>v</Data>"), time="2024-01-02 03:04:05Z"), "timestamp", None),
    "X22d": (event(ED.format("<Data>v</Data>"), time="2024-01-02 03:04:05+00:00"), "timestamp", None),
    "X23a": (event(ED.format("<Data>v</Data>"), time="2024-02-30 03:04:05"), "timestamp", None),
    "X23b": (event(ED.format("<Data>v</Data>"), time="2024-01-02 03:04:60"), "timestamp", None),
    "X24": (event(ED.format("<Data>v</Data>"), time="2024-1-2 3:4:5"), None, "single"),
    "X25a": ("<Event><EventData><Data>v</Data></EventData></Event>", "timestamp", None),
    "X25b": (event("", system="<System><EventID>1</EventID></System>"), "timestamp", None),
    "X25c": (event("", system="<System><TimeCreated/></System>"), "timestamp", None),
    "X25d": (
        event(
            "",
            system='<System><TimeCreated SystemTime="2024-01-02 03:04:05"/>'
            '<TimeCreated SystemTime="2024-01-02 03:04:05"/></System>',
        ),
        "timestamp",
        None,
    ),
    "X25e": (
        '<Event><System><TimeCreated SystemTime="2024-01-02 03:04:05"/></System>'
        '<System><TimeCreated SystemTime="2024-01-02 03:04:05"/></System></Event>',
        "timestamp",
        None,
    ),
    "X26a": ('<Foo><System><TimeCreated SystemTime="2024-01-02 03:04:05"/></System></Foo>', "root", None),
    "X26b": (
        '<e:Event xmlns:e="urn:x"><System><TimeCreated SystemTime="2024-01-02 03:04:05"/></System></e:Event>',
        "root",
        None,
    ),
    "X27a": ('<Event><System><TimeCreated SystemTime="2024-01-02 03:04:05"/></System><EventData>', "xml", None),
    "X27b": ("", "xml", None),
    "X28a": (ed('<Data Name="n">café</Data>'), None, "single"),
    "X28b": (ed("<Data>café</Data>"), None, "single"),
    "X29": (ed('<Data Name="a"><![CDATA[<x>]]> &amp; &lt;y&gt;</Data><Data Name="b">2</Data>'), None, "list"),
    "X31": ('<?xml version="1.0"?>\n' + ed("<Data>v</Data>"), None, "single"),
}


@pytest.fixture(scope="module")
def loaded(spark):
    names = list(CASES)
    rows = load_rows(spark, [CASES[n][0] for n in names], metadata={"k": [1, 2]})
    return dict(zip(names, rows))


@pytest.mark.parametrize("case", list(CASES))
def test_outcome(loaded, case):
    _, reason, shape = CASES[case]
    row = loaded[case]
    assert (row["reason"], row["shape"]) == (reason, shape)


def test_list_maps(loaded):
    assert loaded["X01"]["event_data"] == {"a": "1", "b": "2"}
    assert loaded["X02"]["event_data"] == {"a": "3", "b": "2"}  # last text wins
    assert list(loaded["X02"]["event_data"]) == ["a", "b"]  # first position kept
    assert loaded["X03"]["event_data"] == {}  # unnamed texts are lost
    assert loaded["X04"]["event_data"] == {}
    assert loaded["X05"]["event_data"] == {"": "e", "b": "2"}
    assert loaded["X06"]["event_data"] == {"a": "None", "b": "2"}
    assert loaded["X07"]["event_data"] == {"a": "None", "b": "2"}
    assert loaded["X18"]["event_data"] == {"a": "1", "b": "2"}
    assert loaded["X29"]["event_data"]["a"] == "<x> & <y>"


def test_single_raw(loaded):
    assert loaded["X08"]["eventdata_raw"] == '{"@Name": "a", "#text": "1"}'
    assert loaded["X09"]["eventdata_raw"] == "plain"
    assert loaded["X10"]["eventdata_raw"] == '{"@Name": "x"}'
    assert loaded["X10b"]["eventdata_raw"] == '{"Sub": "1"}'
    assert loaded["X12"]["eventdata_raw"] == "v"
    assert loaded["X12"]["Event"]["EventData"]["Binary"] == "AB"
    assert loaded["X08"]["Event"]["EventData"]["Data"] is None  # Data dropped
    # json.dumps escapes non-ASCII with lower-case hex; plain text stays as is
    assert loaded["X28a"]["eventdata_raw"] == '{"@Name": "n", "#text": "caf\\u00e9"}'
    assert loaded["X28b"]["eventdata_raw"] == "café"


def test_nodata_raw(loaded):
    assert loaded["X11"]["event_raw"] == '{"Data": null}'
    assert loaded["X11b"]["event_raw"] == '{"Data": null}'
    assert loaded["X13"]["event_raw"] == '{"@Name": "n"}'
    assert loaded["X11"]["Event"]["EventData"] is None  # EventData dropped


def test_promote(loaded):
    doc = json.loads(loaded["X14"]["document"])
    assert "Event" not in doc and "@timestamp" not in doc
    assert doc["EventData"] is None and "EventData" in doc
    assert doc["System"]["TimeCreated"]["@SystemTime"] == ISO
    doc15 = json.loads(loaded["X15"]["document"])
    assert doc15["UserData"] == {"U": [{"@a": "1", "#text": "5"}, "6"]}
    assert loaded["X15"]["@timestamp"] is None
    assert loaded["X15"]["System"]["TimeCreated"]["@SystemTime"] == ISO


def test_times(loaded):
    assert loaded["X19"]["@timestamp"] == "2024-01-02T03:04:05"
    assert loaded["X20"]["@timestamp"] == "2024-01-02T03:04:05.500000"
    assert loaded["X21"]["@timestamp"] == "2024-01-02T03:04:05"
    assert loaded["X24"]["@timestamp"] == "2024-01-02T03:04:05"
    doc = json.loads(loaded["X20"]["document"])
    assert doc["Event"]["System"]["TimeCreated"]["@SystemTime"] == "2024-01-02T03:04:05.500000"


def test_metadata_and_stamps(loaded):
    doc = json.loads(loaded["X01"]["document"])
    assert doc["_index"] == "hostlogs" and doc["_type"] == "hostlogs"
    assert doc["meta"] == {"k": [1, 2]}


@pytest.mark.parametrize("meta", [{}, {"a": {"b": 1}}, [1, "x"], 7])
def test_metadata_forms(spark, meta):
    (row,) = load_rows(spark, [ed("<Data>v</Data>")], metadata=meta)
    assert json.loads(row["document"])["meta"] == meta


def test_bad_metadata_fails_before_job():
    from eventloom.operators.document import normalize_metadata

    with pytest.raises(json.JSONDecodeError):
        normalize_metadata("{not json")


def test_first_record_malformed_run_goes_on(spark):
    rows = load_rows(spark, ["<Event><System>", ed("<Data>v</Data>")])
    assert [r["reason"] for r in rows] == ["xml", None]


def test_unknown_attributes_follow_the_full_tree(spark):
    """SURVEY 7.5 L-a: attributes outside the typed schema decide shape and raw text as in the reference."""
    rows = load_rows(
        spark,
        [
            ed('<Data Type="t">v</Data>'),  # X10c
            ed('<Data Type="t"/>'),  # X10d
            ed('<Data Name="a" Type="t">v</Data>'),
            event('<EventData Foo="n"/>'),
            event('<EventData Foo="x">text</EventData>'),
            event('<EventData Foo="x"><Data/></EventData>'),
            ed('<Data Name="a" Type="t">1</Data><Data Name="b">2</Data>'),
        ],
    )
    got = [(r["reason"], r["shape"], r["eventdata_raw"], r["event_raw"]) for r in rows]
    assert got == [
        (None, "single", '{"@Type": "t", "#text": "v"}', None),
        (None, "single", '{"@Type": "t"}', None),
        (None, "single", '{"@Name": "a", "@Type": "t", "#text": "v"}', None),
        (None, "nodata", None, '{"@Foo": "n"}'),
        (None, "nodata", None, '{"@Foo": "x", "#text": "text"}'),
        (None, "nodata", None, '{"@Foo": "x", "Data": null}'),
        (None, "list", None, None),
    ]
    assert rows[6]["event_data"] == {"a": "1", "b": "2"}


def test_text_after_root_rejected(spark):
    """SURVEY 7.5 L-b: text or an element after the root is malformed; comments and blanks are not."""
    rows = load_rows(
        spark,
        [
            ed("<Data>v</Data>") + "tail",
            ed("<Data>v</Data>") + "<Other/>",
            ed("<Data>v</Data>") + "\n<!-- c --> <?pi x?>\n",
            ed("<Data>v</Data>").replace("</Event>", "</Event >"),
        ],
    )
    assert [r["reason"] for r in rows] == ["xml", "xml", None, None]


def test_repeated_names_of_a_long_record(spark):
    """Thousands of names, some repeated: first position, last text, without comparing all with all."""
    items = [(f"n{(i * 7919) % 2500}", str(i)) for i in range(3000)]
    record = event("<EventData>" + "".join(f'<Data Name="{k}">{v}</Data>' for k, v in items) + "</EventData>")
    once = event("<EventData>" + "".join(f'<Data Name="{k}">{v}</Data>' for k, v in items[:2500]) + "</EventData>")
    for got, want in zip(load_rows(spark, [record, once]), (dict(items), dict(items[:2500]))):
        assert got["event_data"] == want
        assert list(json.loads(got["document"])["Event"]["EventData"]["Data"].items()) == list(want.items())
