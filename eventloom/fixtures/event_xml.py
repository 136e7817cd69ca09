"""event records rendered as XML by a column expression.

F1 turns every row of ``events`` into one event record whose body shape is picked
by ``k = event_id % 8`` and whose time text form by ``v = (event_id div 8) % 5``;
every 101st record loses its closing tag.  The expected outcome of each row is a
function of the ``events`` columns alone, so an oracle can compute it without
reading any XML (see ``__spark_entry__.oracle_sql``).

F3 puts each ``documents.text`` (escaped) into a ``Data`` item, whole.
"""

from __future__ import annotations

from collections.abc import Iterator

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

# The namespace written on every F1 record and the time text forms by v.
F1_NAMESPACE = "urn:e"
F1_TIME_FORMATS = [
    "yyyy-MM-dd HH:mm:ss.SSSSSS",
    "yyyy-MM-dd HH:mm:ss.SSSSSS",
    "yyyy-MM-dd HH:mm:ss",
    "yyyy-MM-dd HH:mm:ss.SSS",
    "yyyy-MM-dd'T'HH:mm:ss",
]


def xml_escape(c: Column) -> Column:
    """Escape text for XML content and attribute values."""
    out = F.replace(c, F.lit("&"), F.lit("&amp;"))
    out = F.replace(out, F.lit("<"), F.lit("&lt;"))
    out = F.replace(out, F.lit(">"), F.lit("&gt;"))
    return F.replace(out, F.lit('"'), F.lit("&quot;"))


def _data(name: str | None, text: Column | str | None) -> Column:
    open_tag = "<Data>" if name is None else f'<Data Name="{name}">'
    if text is None:
        return F.lit("<Data/>" if name is None else f'<Data Name="{name}"/>')
    t = F.lit(text) if isinstance(text, str) else text
    return F.concat(F.lit(open_tag), t, F.lit("</Data>"))


def events_as_xml(events: DataFrame) -> DataFrame:
    """``event_id, xml`` for every row of ``events`` (narrow; no shuffle)."""
    eid = F.col("event_id")
    k = eid % 8
    v = F.expr("(event_id div 8) % 5")
    uid = F.col("user_id").cast("string")
    etype = xml_escape(F.col("event_type"))
    time_text = F.coalesce(
        *[F.when(v == i, F.date_format(F.col("ts"), fmt)) for i, fmt in enumerate(F1_TIME_FORMATS)]
    )
    system = F.concat(
        F.lit("<System>"),
        F.concat(F.lit('<Provider Name="'), etype, F.lit('"/>')),
        F.concat(F.lit("<EventID>"), (eid % 5).cast("string"), F.lit("</EventID>")),
        F.concat(F.lit('<TimeCreated SystemTime="'), time_text, F.lit('"/>')),
        F.concat(F.lit("<EventRecordID>"), eid.cast("string"), F.lit("</EventRecordID>")),
        F.concat(F.lit('<Execution ProcessID="'), uid, F.lit('"/>')),
        F.lit("</System>"),
    )

    def ed(*parts: Column) -> Column:
        return F.concat(F.lit("<EventData>"), *parts, F.lit("</EventData>"))

    body = (
        F.when(k == 0, ed(_data("user", uid), _data("type", etype)))
        .when(
            k == 1,
            ed(_data("user", "x"), _data(None, "zz"), _data(None, None), _data("e", None), _data("user", uid)),
        )
        .when(k == 2, ed(_data("user", uid)))
        .when(k == 3, ed(_data(None, xml_escape(F.col("props"))), F.lit("<Binary>FF</Binary>")))
        .when(k == 4, ed(_data(None, None)))
        .when(k == 5, ed(F.concat(F.lit("<Binary>"), uid, F.lit("</Binary>"))))
        .when(k == 6, F.concat(F.lit("<UserData><U>"), uid, F.lit("</U></UserData>")))
        .otherwise(F.lit("<EventData>text</EventData>"))
    )
    close = F.when(eid % 101 == 0, F.lit("")).otherwise(F.lit("</Event>"))
    xml = F.concat(F.lit(f'<Event xmlns="{F1_NAMESPACE}">'), system, body, close)
    return events.select(eid.alias("event_id"), xml.alias("xml"))


def documents_as_events(documents: DataFrame) -> DataFrame:
    """``doc_id, xml``; the whole text is one named ``Data`` item next to the id."""
    did = F.col("doc_id").cast("string")
    xml = F.concat(
        F.lit('<Event><System><TimeCreated SystemTime="2024-01-01 00:00:00"/>'),
        F.concat(F.lit("<EventRecordID>"), did, F.lit("</EventRecordID></System><EventData>")),
        _data("doc_id", did),
        _data("text", xml_escape(F.col("text"))),
        F.lit("</EventData></Event>"),
    )
    return documents.select(F.col("doc_id"), xml.alias("xml"))


# The frame of an exported event file.
EXPORT_HEAD = '<?xml version="1.0" encoding="utf-8"?>\n<Events>'
EXPORT_TAIL = "</Events>"


def write_event_export(xml_df: DataFrame, path: str) -> None:
    """write records as exported event files: each task writes one file framed by
    an XML declaration, ``<Events>`` and ``</Events>``, one record per line."""
    import pandas as pd

    def frame(batches):
        yield pd.DataFrame({"value": [EXPORT_HEAD]})
        for pdf in batches:
            yield pd.DataFrame({"value": pdf["xml"]})
        yield pd.DataFrame({"value": [EXPORT_TAIL]})

    xml_df.select("xml").mapInPandas(frame, "value string").write.text(path)


# Fixed value: the digits of a record's length in a chunk.
LENGTH_DIGITS = 8


def write_event_chunks(xml_df: DataFrame, path: str, chunk_bytes: int) -> None:
    """write records as binary event files: each task writes a header of ``chunk_bytes`` and chunks of
    that size, each with as many whole records as it holds, padded with blanks (a longer record is an error).

    Each record stands behind its length; a record that fills a chunk without it stands alone."""
    import pandas as pd

    room = chunk_bytes - 1  # the text writer ends each chunk with a line feed

    def chunk(parts) -> str:
        return b"".join(parts).ljust(room).decode()

    def frame(batches):
        yield pd.DataFrame({"value": ["H" * room]})
        held, size = [], 0
        for pdf in batches:
            chunks = []
            for x in pdf["xml"]:
                record = x.encode()
                if len(record) > room:
                    raise ValueError(f"a record is longer than {room} bytes")
                whole = LENGTH_DIGITS + len(record)
                if held and size + whole > room:
                    chunks.append(chunk(held))
                    held, size = [], 0
                if whole > room:
                    chunks.append(chunk([record]))
                else:
                    held += [b"%0*d" % (LENGTH_DIGITS, len(record)), record]
                    size += whole
            yield pd.DataFrame({"value": chunks})
        if held:
            yield pd.DataFrame({"value": [chunk(held)]})

    xml_df.select("xml").mapInPandas(frame, "value string").write.text(path)


def chunk_records(chunk: bytes) -> Iterator[str]:
    """The records of one F5 chunk."""
    at = 0
    while (length := chunk[at : at + LENGTH_DIGITS]).isdigit():
        at += LENGTH_DIGITS
        yield chunk[at : at + int(length)].decode()
        at += int(length)
    if not at:
        yield chunk.decode().rstrip()


def write_cut_exports(xml_df: DataFrame, path: str, per_file: int) -> None:
    """export files of the records ``per_file * k <= event_id < per_file * (k + 1)``, in order, each cut inside its last one.

    The record of the highest possible id in a file has no closing tag and nothing follows it.
    """
    last = F.col("event_id") % per_file == per_file - 1
    text = F.when(last, F.regexp_replace("xml", "</Event>$", "")).otherwise(F.col("xml"))
    rows = xml_df.select("event_id", F.expr(f"event_id div {int(per_file)}").alias("file"), text.alias("value"))
    rows = rows.repartition("file").sortWithinPartitions("file", "event_id")
    rows.select("file", "value").write.partitionBy("file").text(path)
