"""Whole records through the standard-library XML parser: one Arrow-batched Python function.

The typed ``from_xml`` parse sees a fixed set of elements and attributes.  A record that holds anything
else (an open subtree, an unknown or repeated or empty element, a comment, mixed text, another letter
case) is parsed again here, into the usual XML-to-dict tree, and takes everything from it: reason, shape,
time text, map, raw texts and document.

* attributes become ``@name`` keys, text becomes ``#text``, in document order;
* an element with neither attributes nor children gives its text, or ``None``
  when it is empty; text is stripped of surrounding blanks (blank text is none);
* a repeated child becomes a list; text parts around child elements are joined.

The JSON text is ``json.dumps`` with its default arguments.  Records that the typed parse saw completely
get a NULL input, so they cost no second parse.
"""

from __future__ import annotations

import json
from datetime import datetime
from xml.parsers import expat

import pandas as pd
from pyspark.sql import functions as F
from pyspark.sql import types as T

# "names" and "texts" are the map of a list record: as JSON text a very long name would not be read back.
RECORD_FIELDS = ["reason", "shape", "time_text", "names", "texts", "eventdata_raw", "event_raw", "others", "body"]
_TEXTS = T.ArrayType(T.StringType())
RECORD_SCHEMA = T.StructType([T.StructField(n, _TEXTS if n in ("names", "texts") else T.StringType()) for n in RECORD_FIELDS])


def xml_to_tree(text: str):
    """Parse one XML document into nested dicts / lists / strings (see module doc)."""
    parser = expat.ParserCreate()
    parser.buffer_text = True
    # Per open element: its attributes, its children's values by name in order of first sight, its text.
    top: tuple = ({}, {}, [])
    open_elements = [top]

    def start(name, attrs):
        open_elements.append(({"@" + k: v for k, v in attrs.items()}, {}, []))

    def end(name):
        attrs, children, text_parts = open_elements.pop()
        own_text = "".join(text_parts).strip()
        value = dict(attrs)
        for child, values in children.items():
            value[child] = values if len(values) > 1 else values[0]
        if own_text and value:
            value["#text"] = own_text
        open_elements[-1][1].setdefault(name, []).append(value or own_text or None)

    parser.StartElementHandler = start
    parser.EndElementHandler = end
    parser.CharacterDataHandler = lambda data: open_elements[-1][2].append(data)
    parser.Parse(text, True)
    return {name: values[0] for name, values in top[1].items()}


def _iso(text) -> str | None:
    """ISO text of an accepted time text, else None."""
    for form in ("%Y-%m-%d %H:%M:%S.%f",) if "." in text else ("%Y-%m-%d %H:%M:%S",):
        try:
            return datetime.strptime(text, form).isoformat()
        except ValueError:
            return None


def _inner(value: dict) -> str:
    """JSON text of an object without its braces."""
    return json.dumps(value)[1:-1]


def full_record(xml: str) -> dict:
    """Everything a record's tree decides (keys: RECORD_FIELDS; absent is NULL)."""
    try:
        tree = xml_to_tree(xml)
    except expat.ExpatError:
        return {"reason": "xml"}
    if "Event" not in tree:
        return {"reason": "root"}
    event = tree["Event"]
    system = event.get("System") if isinstance(event, dict) else None
    created = system.get("TimeCreated") if isinstance(system, dict) else None
    time_text = created.get("@SystemTime") if isinstance(created, dict) else None
    iso = _iso(time_text) if time_text else None
    if iso is None:
        return {"reason": "timestamp", "time_text": time_text}
    out = {"time_text": time_text}
    created["@SystemTime"] = iso
    payload = event.get("EventData")
    others = {k: v for k, v in event.items() if k[0] != "@" and k not in ("System", "EventData", "#text")}
    out["others"] = _inner(others) or None
    if payload is None:
        return out | {"shape": "promote", "body": _inner(event)}
    if not isinstance(payload, dict):
        return {"reason": "shape", "time_text": time_text}
    data = payload.get("Data")
    if data is None:
        out |= {"shape": "nodata", "event_raw": json.dumps(payload)}
        event["RawData"] = out["event_raw"]
        del event["EventData"]
    elif isinstance(data, list):
        named = {i["@Name"]: str(i.get("#text")) for i in data if isinstance(i, dict) and "@Name" in i}
        out |= {"shape": "list", "names": list(named), "texts": list(named.values())}
        payload["Data"] = named
    else:
        out |= {"shape": "single", "eventdata_raw": json.dumps(data) if isinstance(data, dict) else data}
        payload["RawData"] = out["eventdata_raw"]
        del payload["Data"]
    return out | {"body": _inner({"Event": event, "@timestamp": iso})}


@F.pandas_udf(RECORD_SCHEMA)
def full_records(xml: pd.Series) -> pd.DataFrame:
    """Arrow-batched :func:`full_record` (NULL xml -> all NULL)."""
    rows = [{} if x is None else full_record(x) for x in xml]
    return pd.DataFrame([[r.get(n) for n in RECORD_FIELDS] for r in rows], columns=RECORD_FIELDS, dtype=object)
