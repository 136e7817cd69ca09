"""Parse event XML records (op T1) and decide each record's fate.

``parse_events`` adds one struct column ``_e`` holding the typed parse.  The parse
sits under a ``Generate`` (``explode(array(from_xml(...)))``): without that
barrier Catalyst pushes filters on parsed fields below the projection and the plan
evaluates ``from_xml`` once per reference.  With it the plan holds one
``from_xml`` however many fields are used (checked in the tests).

All leaves are strings: the loader never converts event values.  ``System``,
``TimeCreated`` and ``EventData`` are arrays only so that a repeated element can be
told from a single one; :func:`classify_events` turns them back into element 0.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ..functions.timefmt import time_from_parts, time_parts
from ..functions.xmltree import full_records

PARSED = "_e"

# The children of System in the published Windows event schema,
# with their attributes ("text" marks elements that carry text).
SYSTEM_ELEMENTS = [
    ("Provider", ["Name", "Guid", "EventSourceName"], False),
    ("EventID", ["Qualifiers"], True),
    ("Version", [], True),
    ("Level", [], True),
    ("Task", [], True),
    ("Opcode", [], True),
    ("Keywords", [], True),
    ("TimeCreated", ["SystemTime"], False),
    ("EventRecordID", [], True),
    ("Correlation", ["ActivityID", "RelatedActivityID"], False),
    ("Execution", ["ProcessID", "ThreadID", "ProcessorID", "SessionID", "KernelTime", "UserTime", "ProcessorTime"], False),
    ("Channel", [], True),
    ("Computer", [], True),
    ("Security", ["UserID"], False),
]

# Children of Event other than System / EventData in that schema.
OTHER_EVENT_ELEMENTS = ["UserData", "DebugData", "ProcessingErrorData", "BinaryEventData", "RenderingInfo"]


def _element_ddl(name: str, attrs: list[str], text: bool) -> str:
    if not attrs:
        return f"{name}: STRING"
    fields = [f"_{a}: STRING" for a in attrs] + (["_VALUE: STRING"] if text else [])
    if name == "TimeCreated":
        return f"{name}: ARRAY<STRUCT<{', '.join(fields)}>>"
    return f"{name}: STRUCT<{', '.join(fields)}>"


def event_schema_ddl() -> str:
    """DDL of the typed parse (see module doc)."""
    system = ", ".join(_element_ddl(n, a, t) for n, a, t in SYSTEM_ELEMENTS)
    data_item = "STRUCT<_Name: STRING, _VALUE: STRING, xs_any: ARRAY<STRING>>"
    event_data = (
        f"STRUCT<_Name: STRING, _VALUE: STRING, Data: ARRAY<{data_item}>, ComplexData: STRING, "
        "Binary: STRING, xs_any: ARRAY<STRING>>"
    )
    others = ", ".join(f"{n} STRING" for n in OTHER_EVENT_ELEMENTS)
    return (
        f"_xmlns STRING, System ARRAY<STRUCT<{system}>>, EventData ARRAY<{event_data}>, {others}, "
        "xs_any ARRAY<STRING>, _corrupt_record STRING"
    )


# Attribute values are kept as written; element text is stripped by text_leaf().
XML_OPTIONS = {
    "mode": "PERMISSIVE",
    "columnNameOfCorruptRecord": "_corrupt_record",
    "ignoreSurroundingSpaces": "false",
}

# Fixed value: the characters Python's str.strip() removes (str.isspace()).
WHITESPACE = (
    " \t\n\r\x0b\x0c\x1c\x1d\x1e\x1f\x85\xa0\u1680"
    "\u2000\u2001\u2002\u2003\u2004\u2005\u2006\u2007\u2008\u2009\u200a"
    "\u2028\u2029\u202f\u205f\u3000"
)


def text_leaf(c: Column) -> Column:
    """Element text as the XML-to-dict conventions give it: stripped, blank -> NULL."""
    return F.nullif(F.btrim(c, F.lit(WHITESPACE)), F.lit(""))


def _normalize_text(e: Column) -> Column:
    """Strip every element-text leaf of the typed parse once (attributes stay as written)."""
    def system(s: Column) -> Column:
        out = s
        for name, attrs, text in SYSTEM_ELEMENTS:
            if not attrs:
                out = out.withField(name, text_leaf(s[name]))
            elif text:
                out = out.withField(f"{name}._VALUE", text_leaf(s[name]["_VALUE"]))
        return out

    def data_item(d: Column) -> Column:
        return d.withField("_VALUE", text_leaf(d["_VALUE"]))

    def event_data(ed: Column) -> Column:
        return (
            ed.withField("_VALUE", text_leaf(ed["_VALUE"]))
            .withField("Binary", text_leaf(ed["Binary"]))
            .withField("ComplexData", text_leaf(ed["ComplexData"]))
            .withField("Data", F.transform(ed["Data"], data_item))
        )

    def each(items: Column, one) -> Column:
        # One element, as nearly always: compiled code, where a transform is interpreted.
        return F.when(F.size(items) == 1, F.array(one(items[0]))).otherwise(F.transform(items, one))

    return F.when(
        e.isNotNull(),
        e.withField("System", each(e["System"], system)).withField("EventData", each(e["EventData"], event_data)),
    )


# The element and attribute names the typed parse reads.
_TAGS = "|".join(["Event", "System", *[n for n, _, _ in SYSTEM_ELEMENTS], "EventData", "Data", "ComplexData", "Binary"])
_ATTRIBUTES = "|".join(sorted({"xmlns", "Name", *[a for _, attrs, _ in SYSTEM_ELEMENTS for a in attrs]}))

# Fixed value: the longest attribute that Spark's XML reader takes, in characters.
ATTRIBUTE_LIMIT = 8 * 65536

# A plain record: an optional XML declaration, the Event element, blanks.
PLAIN_PATTERN = r"(?s)\A\x{FEFF}?\s*(?:<\?xml\s[^>]*\?>\s*)?<Event[\s>].*</Event\s*>\s*\z"

# What the typed parse does not see: a comment, CDATA or instruction; an element or attribute of another
# name or letter case; text beside child elements.  Alternatives start at a tag and their runs are possessive
# where they could be cut in many ways: the time follows the length, whatever the text (a raw ">" included).
UNSEEN_PATTERN = (
    rf"<(?!/?(?:{_TAGS})[\s/>]|\?xml\s)"
    rf"|<[^<>?]*?\s(?!(?:{_ATTRIBUTES})\s*+=)[^\s=<>\"'/]++\s*+="
    r"|<[^<>]*+>\s*+[^<\s][^<]*+<[^/]"
    r"|(?:</[^<>]*+|/)>\s*+[^<\s]"
)

# A record that is surely free of all that, by one pass over it that never turns back: known elements, each with nothing
# but known attributes, text only right before an end tag, and no mark of XML inside texts and values.
_INNER = "|".join(_TAGS.split("|")[1:])
SIMPLE_PATTERN = (
    r"\A<Event(?:\sxmlns=\"[^\"<>=]*+\")?+>\s*+"
    rf"(?:<(?:(?:{_INNER})(?:\s(?:{_ATTRIBUTES})=\"[^\"<>=]*+\")*+(?:/>\s*+|>(?:[^<>]*+(?=</)|\s*+))|/(?:{_INNER})>\s*+))*+"
    r"</Event>\s*+\z"
)


def _seen(e: Column) -> tuple[Column, Column]:
    """How many elements and attributes the typed parse holds (a lost or repeated one makes the text hold more)."""
    one = lambda c: F.when(c.isNotNull(), 1).otherwise(0)

    def total(counts: list[Column]) -> Column:
        out = F.lit(0)
        for c in counts:
            out = out + c
        return out

    system, ed = e["System"][0], e["EventData"][0]
    elements = [F.lit(1), _size(e["System"]), _size(e["EventData"]), _size(ed["Data"]), one(ed["Binary"]), one(ed["ComplexData"])]
    attributes = [one(e["_xmlns"]), one(ed["_Name"]), _size(F.filter(ed["Data"], lambda d: d["_Name"].isNotNull()))]
    for name, attrs, _ in SYSTEM_ELEMENTS:
        if name == "TimeCreated":
            elements.append(_size(system[name]))
            attributes.append(one(system[name][0]["_SystemTime"]))
        else:
            elements.append(one(system[name]))
            attributes += [one(system[name][f"_{a}"]) for a in attrs]
    return total(elements), total(attributes)


def seen_completely(e: Column, xml: Column) -> Column:
    """True only when the typed parse ``e`` holds all there is in ``xml``.

    The text never has fewer elements and attributes than the parse, so equal counts leave none unseen;
    an attribute-like run inside a text only sends the record to the full tree.
    """
    elements, attributes = _seen(e)
    # The marks of a simple record are counted without a pattern: each "<" is a tag's, and a text that holds `="` only
    # makes it go by the patterns below.
    removed = lambda mark: F.octet_length(xml) - F.octet_length(F.replace(xml, F.lit(mark)))
    simple = (
        (removed("<") == elements + (removed("</") / 2).cast("int"))
        & ((removed('="') / 2).cast("int") == attributes)
        & xml.rlike(SIMPLE_PATTERN)
    )
    plain = (
        xml.rlike(PLAIN_PATTERN)
        & ~xml.rlike(UNSEEN_PATTERN)
        & (F.regexp_count(xml, F.lit(r"<[A-Za-z]")) == elements)
        & (F.regexp_count(xml, F.lit(r"\s[A-Za-z]+\s*=\s*[\x22\x27]")) == attributes + F.when(xml.rlike(r"<\?xml\s"), F.regexp_count(F.regexp_extract(xml, r"<\?xml\s[^>]*\?>", 0), F.lit(r"\s[A-Za-z]+\s*=\s*[\x22\x27]"))).otherwise(0))
    )
    return F.coalesce(simple | plain, F.lit(False))


def parse_events(df: DataFrame, xml_col: str = "xml") -> DataFrame:
    """Add the typed parse of ``xml_col`` as struct column ``_e`` (one ``from_xml`` in the plan)."""
    parsed = F.from_xml(F.col(xml_col), event_schema_ddl(), XML_OPTIONS)
    raw = df.select("*", F.explode(F.array(parsed)).alias("_e_raw"))
    # A second Generate: the text clean-up refers to the parse many times, and
    # must only ever see a column reference, never the from_xml call itself.
    # It stands below that Generate: what a Generate holds itself is interpreted, row by row, not compiled.
    return compiled(raw, _normalize_text(F.col("_e_raw")), PARSED).drop("_e_raw")


def compiled(df: DataFrame, value: Column, name: str) -> DataFrame:
    """Add ``value`` as ``name`` behind a Generate that only refers to it, so that a projection computes it, once."""
    staged = f"_staged{name}"
    return df.withColumn(staged, value).select("*", F.explode(F.array(F.col(staged))).alias(name)).drop(staged)


def _size(c: Column) -> Column:
    """Array size with NULL as 0 (independent of the legacy sizeOfNull setting)."""
    return F.when(c.isNull(), F.lit(0)).otherwise(F.size(c))


def _all_null(cols: list[Column]) -> Column:
    cond = None
    for c in cols:
        cond = c.isNull() if cond is None else (cond & c.isNull())
    return cond


def classify_events(df: DataFrame, xml_col: str = "xml") -> DataFrame:
    """Time (T2, T3), quarantine reason (E2-E5) and shape (T7) of parsed records.

    A record that the typed parse did not see completely takes all of this from its full tree (``_py``).

    Adds ``_time_text`` (T2), ``event_time`` (T3), ``reason`` and ``shape``; ``shape``
    is NULL for rejected records and ``reason`` NULL for accepted ones.  Reasons,
    first match wins: ``xml`` (malformed), ``root`` (root is not ``Event``),
    ``xml`` (text after the root element),
    ``timestamp`` (``System`` / ``TimeCreated`` missing or repeated, time text not
    accepted), ``shape`` (``EventData`` repeated, or plain text).
    """
    e = F.col(PARSED)
    system_n = _size(e["System"])
    system = e["System"][0]
    tc_n = _size(system["TimeCreated"])
    time_text = F.when((system_n == 1) & (tc_n == 1), system["TimeCreated"][0]["_SystemTime"])

    ed_n = _size(e["EventData"])
    ed = e["EventData"][0]
    ed_children = [ed["Data"], ed["ComplexData"], ed["Binary"], ed["xs_any"]]
    ed_text_only = ed["_VALUE"].isNotNull() & _all_null([ed["_Name"]] + ed_children)
    ed_empty = _all_null([ed["_Name"], ed["_VALUE"]] + ed_children)
    n = _size(ed["Data"])
    d0 = ed["Data"][0]

    # Staged projections: each expensive value is computed once and referred to
    # by name afterwards (Catalyst does not merge projections that would repeat it).
    malformed = e.isNull() | e["_corrupt_record"].isNotNull()
    # The completeness check reads the whole record: a Generate of its own keeps it to one run, whoever refers to it.
    # A record long enough to hold an attribute beyond the typed parse's limit is malformed only if the full tree says so.
    text = F.col(xml_col)
    unseen = F.when(F.when(malformed, F.length(text) > ATTRIBUTE_LIMIT).otherwise(~seen_completely(e, text)), text)
    staged = compiled(df, unseen, "_tree_xml")
    # NULL input for records that were seen completely: they cost no Python parse.
    staged = staged.withColumn("_py", F.when(F.col("_tree_xml").isNotNull(), full_records(F.col("_tree_xml")))).drop("_tree_xml")
    py = F.col("_py")
    staged = (
        staged.withColumn("_time_text", F.when(py.isNotNull(), py["time_text"]).otherwise(time_text))
        .withColumn("_time_parts", time_parts(F.col("_time_text")))
        .withColumn("event_time", time_from_parts(F.col("_time_parts")))
        .drop("_time_parts")
    )
    own = F.when((ed_n > 1) | ((ed_n == 1) & ed_text_only), F.lit("shape"))
    reason = (
        F.when(malformed & py.isNull(), F.lit("xml"))
        .when(py["reason"].isin("xml", "root"), py["reason"])
        .when(F.col("event_time").isNull(), F.lit("timestamp"))
        .otherwise(F.when(py.isNotNull(), py["reason"]).otherwise(own))
    )
    staged = staged.withColumn("reason", reason)
    shape = (
        F.when(F.col("reason").isNotNull(), F.lit(None).cast("string"))
        .when(py.isNotNull(), py["shape"])
        .when((ed_n == 0) | ed_empty, F.lit("promote"))
        .when(n >= 2, F.lit("list"))
        .when((n == 1) & ~_all_null([d0["_Name"], d0["_VALUE"], d0["xs_any"]]), F.lit("single"))
        .otherwise(F.lit("nodata"))
    )
    return staged.withColumn("shape", shape)
