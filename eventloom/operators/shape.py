"""Reshape ``EventData`` into searchable fields (ops T8-T14) and build the event struct.

Per shape (decided by :func:`classify_events`):

``list``    ``event_data`` = map name -> text of the ``Data`` items that carry a
            ``Name`` (items without one are skipped); a missing text becomes the
            string ``None``; a repeated name keeps its first position and its last
            text.  No named item gives an empty map.
``single``  ``eventdata_raw`` = the one ``Data`` item: its text when it is plain
            text, else the JSON text of the item (``{"@Name": ..., "#text": ...}``).
            ``Data`` is dropped from ``EventData``, siblings such as ``Binary`` stay.
``nodata``  ``event_raw`` = JSON text of the whole ``EventData``; ``EventData`` is
            dropped from ``Event``.
``promote`` the content of ``Event`` becomes the document root (``System`` and
            any ``UserData`` move up) and the document has no ``@timestamp``.

JSON text is exact ``json.dumps`` text.  Records that the typed parse saw completely
are done with column expressions; all others take every part from their full tree
(:mod:`eventloom.functions.xmltree`).
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ..functions import jsontext as J
from ..functions.timefmt import iso_text
from .parse import PARSED, SYSTEM_ELEMENTS

# Fixed value: text written for a named Data item without text (str(None)).
MISSING_TEXT = "None"

def data_entries(data_items: Column) -> Column:
    """Named ``Data`` items as ``(k, v, i)``: name, text (``None`` when missing, T14), position.

    Items without a name are skipped (E6): an unnamed, empty or plain-text item."""
    named = F.filter(data_items, lambda x: x["_Name"].isNotNull())
    return F.transform(
        named,
        lambda x, i: F.struct(
            x["_Name"].alias("k"), F.coalesce(x["_VALUE"], F.lit(MISSING_TEXT)).alias("v"), i.alias("i")
        ),
    )


def entries_map(entries: Column) -> Column:
    """``MAP<STRING,STRING>`` from :func:`data_entries` output (pass a column reference).

    A repeated name keeps its first position and the text of its last occurrence,
    decided per record by expressions (no session-wide ``mapKeyDedupPolicy``).
    """

    def folded(s: Column) -> Column:
        # s is sorted by name and position: the first and the last item of each name stand at the ends of its run.
        firsts = F.filter(s, lambda e, j: (j == 0) | (F.get(s, j - 1)["k"] != e["k"]))
        lasts = F.filter(s, lambda e, j: (j == F.size(s) - 1) | (F.get(s, j + 1)["k"] != e["k"]))
        return F.zip_with(firsts, lasts, lambda a, z: F.struct(a["i"].alias("i"), a["k"].alias("key"), z["v"].alias("value")))

    by_name = F.array_sort(F.transform(entries, lambda e: F.struct(e["k"].alias("k"), e["i"].alias("i"), e["v"].alias("v"))))
    # One element: the sorted items are bound to a variable, not sorted again for each use.
    in_order = F.array_sort(F.element_at(F.transform(F.array(by_name), folded), 1))
    deduped = F.transform(in_order, lambda e: F.struct(e["key"].alias("key"), e["value"].alias("value")))
    plain = F.transform(entries, lambda e: F.struct(e["k"].alias("key"), e["v"].alias("value")))
    names = F.transform(entries, lambda e: e["k"])
    has_dup = F.size(F.array_distinct(names)) < F.size(names)
    return F.map_from_entries(F.when(has_dup, deduped).otherwise(plain))


def eventdata_map(data_items: Column) -> Column:
    """T8 as one expression (convenience; plans stage :func:`data_entries` first)."""
    return entries_map(data_entries(data_items))


def map_json(m: Column) -> Column:
    """JSON object text of a string map, entries in map order."""
    frags = F.transform(
        F.map_entries(m), lambda e: F.concat(J.json_text(e["key"]), F.lit(J.KEY_SEP), J.json_text(e["value"]))
    )
    return F.concat(F.lit("{"), F.array_join(frags, J.ITEM_SEP), F.lit("}"))


def single_raw_native(d0: Column) -> Column:
    """T10 for an item the typed parse reads fully: text, or ``{"@Name": ..., "#text": ...}``."""
    as_json = J.obj(
        [
            J.pair("@Name", J.json_text(d0["_Name"])),
            F.when(d0["_VALUE"].isNotNull(), J.pair("#text", J.json_text(d0["_VALUE"]))),
        ]
    )
    return F.when(d0["_Name"].isNull(), d0["_VALUE"]).otherwise(J.dumps_compatible(as_json))


def nodata_raw_native(ed: Column, n: Column) -> Column:
    """T11 for an ``EventData`` the typed parse reads fully: attribute, then its one
    child (``Data`` always null here, ``ComplexData`` or ``Binary``), then text."""
    return J.dumps_compatible(
        J.obj(
            [
                F.when(ed["_Name"].isNotNull(), J.pair("@Name", J.json_text(ed["_Name"]))),
                F.when(n == 1, F.lit('"Data": null')),
                F.when(ed["ComplexData"].isNotNull(), J.pair("ComplexData", J.json_text(ed["ComplexData"]))),
                F.when(ed["Binary"].isNotNull(), J.pair("Binary", J.json_text(ed["Binary"]))),
                F.when(ed["_VALUE"].isNotNull(), J.pair("#text", J.json_text(ed["_VALUE"]))),
            ]
        )
    )


def _system_struct(system: Column, iso: Column) -> Column:
    """Typed ``System`` with XML-to-dict field names; ``TimeCreated.@SystemTime`` set to ISO."""
    fields = []
    for name, attrs, text in SYSTEM_ELEMENTS:
        src = system[name]
        if name == "TimeCreated":
            fields.append(F.struct(iso.alias("@SystemTime")).alias(name))
        elif not attrs:
            fields.append(src.alias(name))
        else:
            sub = [src[f"_{a}"].alias("@" + a) for a in attrs]
            if text:
                sub.append(src["_VALUE"].alias("#text"))
            fields.append(F.when(src.isNotNull(), F.struct(*sub)).alias(name))
    return F.struct(*fields)


def _system_json(system: Column, iso: Column) -> Column:
    """JSON object text of ``System`` under the XML-to-dict conventions (absent elements left out)."""
    frags = []
    for name, attrs, text in SYSTEM_ELEMENTS:
        src = system[name]
        if name == "TimeCreated":
            value = J.obj([J.pair("@SystemTime", J.json_text(iso))])
            frags.append(J.pair(name, value))
        elif not attrs:
            frags.append(F.when(src.isNotNull(), J.pair(name, J.json_text(src))))
        else:
            frags.append(F.when(src.isNotNull(), J.pair(name, J.struct_element(src, attrs, text))))
    return J.obj(frags)


def reshape_events(df: DataFrame, xml_col: str = "xml") -> DataFrame:
    """T4-T14 on classified records; adds the reshaped columns and the document parts.

    Output columns added: ``@timestamp``, ``event_data``, ``eventdata_raw``,
    ``event_raw``, ``Event`` (struct, NULL when promoted), ``System`` (struct,
    promoted only), ``other_json`` (JSON fragments of open children such as
    ``UserData``) and internal ``_doc_event`` / ``_doc_system`` JSON parts.
    """
    e = F.col(PARSED)
    shape = F.col("shape")
    system = e["System"][0]
    ed = e["EventData"][0]
    d0 = ed["Data"][0]
    n = F.when(ed["Data"].isNull(), F.lit(0)).otherwise(F.size(ed["Data"]))
    py = F.col("_py")
    native = py.isNull()
    # Few, wide steps: every DataFrame step re-analyses the whole plan.
    staged = df.withColumns(
        {
            "_iso": iso_text(F.col("event_time")),
            "_nodata_native": F.when(native & (shape == "nodata"), nodata_raw_native(ed, n)),
            "_entries": F.when(native & (shape == "list"), data_entries(ed["Data"])),
        }
    )

    iso = F.col("_iso")
    accepted = shape.isNotNull()
    staged = staged.withColumns(
        {
            "@timestamp": F.when(accepted & (shape != "promote"), iso),
            "event_data": F.when(
                shape == "list", F.coalesce(F.map_from_arrays(py["names"], py["texts"]), entries_map(F.col("_entries")))
            ),
            "eventdata_raw": F.when(shape == "single", F.coalesce(py["eventdata_raw"], single_raw_native(d0))),
            "event_raw": F.when(shape == "nodata", F.coalesce(py["event_raw"], F.col("_nodata_native"))),
            "other_json": F.when(accepted, py["others"]),
            "System": F.when(accepted, _system_struct(system, iso)),
            "_doc_system": F.when(accepted & native, _system_json(system, iso)),
        }
    )
    ed_struct = F.struct(
        ed["_Name"].alias("@Name"),
        F.col("event_data").alias("Data"),
        ed["ComplexData"].alias("ComplexData"),
        ed["Binary"].alias("Binary"),
        ed["_VALUE"].alias("#text"),
        F.col("eventdata_raw").alias("RawData"),
    )
    event_struct = F.struct(
        e["_xmlns"].alias("@xmlns"),
        F.col("System"),
        F.when(shape.isin("list", "single"), ed_struct).alias("EventData"),
        F.col("event_raw").alias("RawData"),
    )
    out = staged.withColumns(
        {
            "Event": F.when(accepted & (shape != "promote"), event_struct),
            "System": F.when(shape == "promote", F.col("System")),
        }
    )
    return out.drop("_entries", "_nodata_native")

