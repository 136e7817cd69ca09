"""The loaded document (T15) and its destination stamps.

``document`` is the JSON text of the record as the destination stores it: the
``Event`` object and ``@timestamp`` (or, for promoted records, the content of
``Event`` at the root), then ``_index``, ``_type`` and ``meta``.  It is built from
column expressions (see :mod:`eventloom.functions.jsontext`) with ``json.dumps``
separators; non-ASCII text is escaped with upper-case hex, which is the same JSON
value.  The raw-text fields inside it are exact ``json.dumps`` text.  Open
subtrees come in as ready JSON fragments.
"""

from __future__ import annotations

import json
from typing import Any

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ..functions import jsontext as J
from .parse import PARSED
from .shape import map_json

# Fixed value: the reference's default destination name.
DEFAULT_INDEX = "hostlogs"


def normalize_metadata(metadata: Any) -> str:
    """JSON text of the metadata; a string is read as JSON and must be valid (checked before any job)."""
    if metadata is None:
        metadata = {}
    if isinstance(metadata, str):
        metadata = json.loads(metadata)
    return json.dumps(metadata)


def _eventdata_json(ed: Column, shape: Column) -> Column:
    common_head = [F.when(ed["_Name"].isNotNull(), J.pair("@Name", J.json_text(ed["_Name"])))]
    tail = [
        F.when(ed["ComplexData"].isNotNull(), J.pair("ComplexData", J.json_text(ed["ComplexData"]))),
        F.when(ed["Binary"].isNotNull(), J.pair("Binary", J.json_text(ed["Binary"]))),
        F.when(ed["_VALUE"].isNotNull(), J.pair("#text", J.json_text(ed["_VALUE"]))),
    ]
    list_obj = J.obj(common_head + [J.pair("Data", map_json(F.col("event_data")))] + tail)
    single_obj = J.obj(common_head + tail + [J.pair("RawData", J.json_text(F.col("eventdata_raw")))])
    return F.when(shape == "list", list_obj).when(shape == "single", single_obj)


def document_body(df: DataFrame) -> DataFrame:
    """Add ``_doc_body``: the document's leading ``"key": value`` fragments (no braces)."""
    e = F.col(PARSED)
    shape = F.col("shape")
    ed = e["EventData"][0]
    xmlns = F.when(e["_xmlns"].isNotNull(), J.pair("@xmlns", J.json_text(e["_xmlns"])))
    system = J.pair("System", F.col("_doc_system"))
    others = F.col("other_json")
    event_obj = J.obj(
        [
            xmlns,
            system,
            F.when(shape.isin("list", "single"), J.pair("EventData", _eventdata_json(ed, shape))),
            others,
            F.when(shape == "nodata", J.pair("RawData", J.json_text(F.col("event_raw")))),
        ]
    )
    event_body = F.concat_ws(
        J.ITEM_SEP, J.pair("Event", event_obj), J.pair("@timestamp", J.json_text(F.col("@timestamp")))
    )
    promoted_body = F.concat_ws(
        J.ITEM_SEP,
        xmlns,
        system,
        # an empty <EventData/> is a present key with a null value
        F.when(e["EventData"].isNotNull(), F.lit('"EventData": null')),
        others,
    )
    full = F.when(shape.isNotNull(), F.col("_py")["body"])
    body = F.when(full.isNotNull(), full).when(shape == "promote", promoted_body).when(shape.isNotNull(), event_body)
    return df.withColumn("_doc_body", body)


def stamp_destination(df: DataFrame, index: str = DEFAULT_INDEX, metadata: Any = None) -> DataFrame:
    """T16 + T17: ``_index`` = ``_type`` = index name; ``meta`` = the metadata as VARIANT."""
    meta_text = normalize_metadata(metadata)
    return df.withColumns(
        {
            "_index": F.lit(index),
            "_type": F.lit(index),
            "meta": F.parse_json(F.lit(meta_text)),
            "_meta_json": F.lit(meta_text),
        }
    )


def document_json(df: DataFrame) -> DataFrame:
    """``document`` = full JSON text (body, ``_index``, ``_type``, ``meta``); needs the stamps."""
    doc = F.concat(
        F.lit("{"),
        F.concat_ws(
            J.ITEM_SEP,
            F.col("_doc_body"),
            J.pair("_index", J.json_text(F.col("_index"))),
            J.pair("_type", J.json_text(F.col("_type"))),
            J.pair("meta", F.col("_meta_json")),
        ),
        F.lit("}"),
    )
    return df.withColumn("document", F.when(F.col("_doc_body").isNotNull(), doc))


def document_tree(df: DataFrame) -> DataFrame:
    """T1 + T15 as a value: ``event_tree``, the record's document (without the stamps) as VARIANT; needs the body.

    Whatever the record holds can be read by path (``variant_get(event_tree, '$.Event.System.Any.Thing', 'string')``);
    all leaves are text.  NULL for a rejected record, and for one beyond the size of a VARIANT.
    """
    tree = F.try_parse_json(F.concat(F.lit("{"), F.col("_doc_body"), F.lit("}")))
    return df.withColumn("event_tree", F.when(F.col("_doc_body").isNotNull(), tree))


def bulk_source_json() -> Column:
    """JSON text the destination stores for one record: the document without ``_index`` / ``_type``."""
    src = F.concat(
        F.lit("{"),
        F.concat_ws(J.ITEM_SEP, F.col("_doc_body"), J.pair("meta", F.col("_meta_json"))),
        F.lit("}"),
    )
    return F.when(F.col("_doc_body").isNotNull(), src)


def bulk_action_json() -> Column:
    """Bulk action line naming the destination (no ``_id``: a re-run adds the records again, K7)."""
    inner = J.obj([J.pair("_index", J.json_text(F.col("_index"))), J.pair("_type", J.json_text(F.col("_type")))])
    return J.obj([J.pair("index", inner)])
