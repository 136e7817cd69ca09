"""The load plan (U1): records -> parse -> time -> reshape -> quarantine -> stamps -> sink.

Every step is a narrow projection, so the plan from scan to sink has **no shuffle**:
it runs as one stage per input split and scales with the number of splits.  The
only Python in it is the Arrow function for open subtrees, fed NULL for rows that
do not need it.
"""

from __future__ import annotations

from dataclasses import dataclass
from typing import Any

from pyspark.sql import DataFrame, Observation, SparkSession
from pyspark.sql import functions as F

from ..operators.document import DEFAULT_INDEX, document_body, document_json, document_tree, normalize_metadata, stamp_destination
from ..operators.parse import PARSED, classify_events, parse_events
from ..operators.quarantine import accepted_events, rejected_events
from ..operators.shape import reshape_events

# Fixed value: the reference's default number of records per bulk request.
DEFAULT_BATCH_SIZE = 500

# Columns of the result; an input column of one of these names is an error, not silently replaced.
OUTPUTS = [
    "reason", "shape", "time_text", "event_time", "@timestamp", "event_data", "eventdata_raw", "event_raw", "other_json",
    "Event", "System", "_index", "_type", "meta", "document", "event_tree", "_doc_body", "_meta_json",
]
# The outcomes of a record.
REASONS = ["xml", "root", "timestamp", "shape"]
SHAPES = ["list", "single", "nodata", "promote"]
# Settled before any document is built.
OUTCOME = [PARSED, "_py", "_time_text", "event_time", "reason", "shape"]
INTERNAL = [PARSED, "_py", "_doc_system", "_iso"]


def spread(df: DataFrame, min_partitions: int | None = None) -> DataFrame:
    """One round-robin shuffle to ``min_partitions`` when the caller asks for it; else the input as it is."""
    return df if df.isStreaming or not min_partitions else df.repartition(min_partitions)


def prepare_events(
    df: DataFrame,
    xml_col: str = "xml",
    index: str = DEFAULT_INDEX,
    metadata: Any = None,
    min_partitions: int | None = None,
    tree: bool = False,
) -> DataFrame:
    """All records with their outcome: the input columns plus

    ``reason`` / ``shape`` (exactly one is NULL), ``time_text``, ``event_time``
    (TIMESTAMP_NTZ), ``@timestamp``, ``event_data``, ``eventdata_raw``,
    ``event_raw``, ``other_json``, ``Event`` / ``System`` structs, ``_index``,
    ``_type``, ``meta`` (VARIANT), ``document`` (JSON text) and the document parts
    ``_doc_body`` / ``_meta_json`` used by the sinks.  With ``tree``, ``event_tree``
    (VARIANT) holds everything of a loaded record, elements and attributes that the typed
    columns do not know included, to be read by path.
    """
    taken = {c.lower() for c in df.columns} & {c.lower() for c in [*OUTPUTS, *INTERNAL]}
    if taken:
        raise ValueError(f"input columns have names that the load uses: {sorted(taken)}")
    normalize_metadata(metadata)  # malformed metadata fails here, before any job
    out = parse_events(spread(df, min_partitions), xml_col)
    # A record's outcome stands behind a Generate of its own: what only asks for reason, shape or time
    # (a filter, a count) builds no document, and a filter on them runs before documents are built.
    out = _behind_generate(classify_events(out, xml_col), OUTCOME)
    out = reshape_events(out, xml_col)
    out = document_body(out)
    out = stamp_destination(out, index, metadata)
    out = document_json(out)
    out = document_tree(out) if tree else out
    out = out.withColumnRenamed("_time_text", "time_text").drop(*INTERNAL)
    return out


def _behind_generate(df: DataFrame, cols: list[str]) -> DataFrame:
    """Expose ``cols`` through a Generate so that later filters on them (``reason IS NULL``,
    a user's predicate on ``event_time``) stay above it.

    Catalyst pushes a filter through projections by copying the expressions it
    names into the filter; for these columns that copies the time parse many times
    over and runs the Arrow function a second time.  Generate is not crossed.  The
    columns built after it are plain projections: unused ones are pruned, and a
    filter on one of them copies that column's expression only.
    """
    keep = [c for c in df.columns if c not in cols]
    packed = F.struct(*[F.col(f"`{c}`").alias(c) for c in cols])
    wrapped = df.select(*[F.col(f"`{c}`") for c in keep], F.explode(F.array(packed)).alias("_out"))
    return wrapped.select(*[F.col(f"`{c}`") for c in keep], *[F.col("_out")[c].alias(c) for c in cols])


@dataclass(frozen=True)
class LoadReport:
    """What a load did: how many records it saw and loaded, the loaded ones by shape, the others by reason."""

    records: int
    loaded: int
    shapes: dict[str, int]
    reasons: dict[str, int]


@dataclass
class EventLoad:
    """Both outputs of one parse; ``all`` holds every record with its outcome."""

    all: DataFrame
    observation: Observation | None = None

    @property
    def accepted(self) -> DataFrame:
        return accepted_events(self.all)

    def rejected(self, keep: tuple[str, ...] = ("xml",)) -> DataFrame:
        return rejected_events(self.all, keep)

    def observed(self, df: DataFrame) -> DataFrame:
        """``df``, all records with ``reason`` and ``shape``, to be written: the job that writes it also counts for the report.

        Put behind a shuffle, if there is one: what a lost executor makes run again before it would count twice.
        """
        self.observation = Observation()
        counts = [F.count(F.lit(1)).alias("records"), F.count_if(F.col("reason").isNull()).alias("loaded")]
        counts += [F.count_if(F.col("shape") == s).alias(f"shape {s}") for s in SHAPES]
        counts += [F.count_if(F.col("reason") == r).alias(f"reason {r}") for r in REASONS]
        return df.observe(self.observation, *counts)

    @property
    def report(self) -> LoadReport | None:
        """K4 + E7 of the last write by a sink of :mod:`eventloom.sinks`, without another pass; None before."""
        if self.observation is None:
            return None
        n = self.observation.get
        return LoadReport(
            n["records"], n["loaded"],
            {s: n[f"shape {s}"] for s in SHAPES if n[f"shape {s}"]}, {r: n[f"reason {r}"] for r in REASONS if n[f"reason {r}"]},
        )


def load_events(
    spark: SparkSession,
    source: DataFrame | str,
    index: str = DEFAULT_INDEX,
    batch_size: int = DEFAULT_BATCH_SIZE,
    metadata: Any = None,
    sink: Any = None,
    xml_col: str = "xml",
    min_partitions: int | None = None,
    tree: bool = False,
) -> EventLoad:
    """Load event records.

    ``source`` is a DataFrame with an XML column, or a path / glob of exported
    event XML files (read with :func:`eventloom.sources.scan_event_xml`).
    ``sink``, when given, is called as ``sink(load, batch_size)``: one of
    ``bulk_files(path)``, ``bulk_push(send)``, ``event_table(name)`` and ``event_store(name)``
    of :mod:`eventloom.sinks`, or the caller's own; the prepared :class:`EventLoad` is
    returned either way.  After one of these sinks its ``report`` has the counts of the
    records, taken by the very job that wrote them.
    """
    if isinstance(source, str):
        from ..sources.xml_records import scan_event_xml

        source = scan_event_xml(spark, source)
    load = EventLoad(prepare_events(source, xml_col, index, metadata, min_partitions, tree))
    if sink is not None:
        sink(load, batch_size)
    return load
