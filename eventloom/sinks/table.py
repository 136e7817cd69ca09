"""Table sinks (K5, K6, K7): a typed, clearable destination.

The reference declares one field of its index as a date
(``Event.System.TimeCreated.@SystemTime``), which leaves promoted records
untyped.  Here every record carries ``event_time TIMESTAMP_NTZ`` and the table is
partitioned by ``event_date``, so time filters prune files for every shape.
"""

from __future__ import annotations

from collections.abc import Callable, Iterable

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from ..plans.load import EventLoad, LoadReport

# The stored columns, in order (the document parts used by the bulk sinks are left out).
TABLE_COLUMNS = [
    "event_time", "@timestamp", "shape", "Event", "System", "event_data", "eventdata_raw", "event_raw",
    "other_json", "_index", "_type", "meta", "document",
]


# A named field of ``event_data`` that is asked for often gets a column of its own under this name.
LOOKUP = "lookup_{}"
# Row groups that a lookup can skip, in bytes, and the distinct values that a group's bloom filter is made for (64 KB).
ROW_GROUP_BYTES = 16 << 20
GROUP_VALUES = 50_000


def _columns(lookup: Iterable[str]) -> list[Column]:
    fields = [F.col("event_data")[field].alias(LOOKUP.format(field)) for field in lookup]
    return [*[F.col(f"`{c}`") for c in TABLE_COLUMNS], *fields]


def table_frame(load: EventLoad, lookup: Iterable[str] = ()) -> DataFrame:
    """Loaded records in table form, with the partition column ``event_date``."""
    return load.accepted.select(*_columns(lookup), _day())


def _day() -> Column:
    return F.to_date(F.col("event_time")).alias("event_date")


def create_event_table(
    spark: SparkSession, name: str, like: DataFrame | None = None, lookup: Iterable[str] = (), partition_by: Iterable[str] = ("event_date",)
) -> None:
    """K5: create the destination (if missing) with its typed time column, partitioned by day.

    T8b: each field in ``lookup`` has a column ``lookup_<field>`` with a bloom filter per row group, so that a look-up
    by value (:func:`lookup_events`) reads the row groups that may hold it, where the map has to be read whole.
    """
    if spark.catalog.tableExists(name):
        return
    if like is None:
        raise ValueError("pass `like` (e.g. table_frame(load)) to define the columns")
    options = {"parquet.block.size": str(ROW_GROUP_BYTES)} if lookup else {}
    for field in lookup:
        options[f"parquet.bloom.filter.enabled#{LOOKUP.format(field)}"] = "true"
        options[f"parquet.bloom.filter.expected.ndv#{LOOKUP.format(field)}"] = str(GROUP_VALUES)
    empty = spark.createDataFrame([], like.schema)
    empty.write.format("parquet").options(**options).partitionBy(*partition_by).saveAsTable(name)


def lookup_fields(spark: SparkSession, name: str) -> list[str]:
    """The fields that have a column of their own in a table."""
    head = LOOKUP.format("")
    return [c.removeprefix(head) for c in spark.table(name).columns if c.startswith(head)]


def lookup_events(spark: SparkSession, name: str, field: str, value: str) -> DataFrame:
    """The stored records whose ``event_data`` has ``value`` under ``field``, by its column if there is one."""
    own = field in lookup_fields(spark, name)
    return spark.table(name).where((F.col(f"`{LOOKUP.format(field)}`") if own else F.col("event_data")[field]) == value)


def append_events(load: EventLoad, name: str, lookup: Iterable[str] = ()) -> LoadReport:
    """K7: append loaded records (no key: loading the same input twice stores it twice).

    The rows are brought together by day, so that a task writes few files; adaptive execution cuts a
    day with much data into several tasks and puts small days together.  Rejected records go as far as
    the report, with nothing but their reason.  ``lookup`` counts when the table is made here.
    """
    return _write(load, name, lookup, ("event_date",), keep=None)


def store_events(load: EventLoad, name: str, lookup: Iterable[str] = (), keep: Iterable[str] = ("xml",)) -> LoadReport:
    """E1 + K5 + K7: append both outputs of one parse to one table, in one write.

    The table is partitioned by ``status`` (``loaded`` / ``rejected``) and ``event_date``.  A rejected record has its
    ``reason`` and the input columns in ``keep``, which are NULL for a loaded one; its day is NULL unless its time was
    read.  :func:`loaded_events` and :func:`quarantined_events` are its two sides.
    """
    return _write(load, name, lookup, ("status", "event_date"), keep=list(keep))


def _write(load: EventLoad, name: str, lookup: Iterable[str], partition_by: tuple[str, ...], keep: list[str] | None) -> LoadReport:
    spark, rejected = load.all.sparkSession, F.col("reason").isNotNull()
    if spark.catalog.tableExists(name):
        lookup = lookup_fields(spark, name)
    columns = _columns(lookup)
    if keep is None:
        frame = load.all.select(*columns, _day(), "reason")
    else:
        taken = {"reason", "status", "event_date", *(c.lower() for c in TABLE_COLUMNS)} & {c.lower() for c in keep}
        if taken:
            raise ValueError(f"columns to keep have names that the table uses: {sorted(taken)}")
        kept = [F.when(rejected, F.col(f"`{c}`")).alias(c) for c in keep]
        status = F.when(rejected, F.lit("rejected")).otherwise(F.lit("loaded")).alias("status")
        frame = load.all.select(*columns, "reason", *kept, status, _day())
    out = frame.drop("reason") if keep is None else frame
    create_event_table(spark, name, out, lookup, partition_by)
    frame = load.observed(frame.hint("rebalance", *[F.col(c) for c in partition_by]))
    if keep is None:
        frame = frame.where(~rejected).drop("reason")
    frame.write.mode("append").insertInto(name)
    return load.report


def loaded_events(spark: SparkSession, name: str) -> DataFrame:
    """The loaded records of a table of :func:`store_events`."""
    return spark.table(name).where("status = 'loaded'")


def quarantined_events(spark: SparkSession, name: str) -> DataFrame:
    """The rejected records of a table of :func:`store_events`: ``reason`` and the input columns that were kept."""
    rows = spark.table(name).where("status = 'rejected'")
    names = {"status", "event_date", *TABLE_COLUMNS, *[LOOKUP.format(f) for f in lookup_fields(spark, name)]}
    return rows.select(*[F.col(f"`{c}`") for c in rows.columns if c not in names])


def event_table(name: str, lookup: Iterable[str] = ()) -> Callable[[EventLoad, int], None]:
    """:func:`append_events` as the ``sink`` of :func:`eventloom.load_events` (a table has no requests)."""
    return lambda load, batch_size: append_events(load, name, lookup)


def event_store(name: str, lookup: Iterable[str] = (), keep: Iterable[str] = ("xml",)) -> Callable[[EventLoad, int], None]:
    """:func:`store_events` as the ``sink`` of :func:`eventloom.load_events`."""
    return lambda load, batch_size: store_events(load, name, lookup, keep)


def clear_event_table(spark: SparkSession, name: str) -> None:
    """K6: delete the destination."""
    spark.sql(f"DROP TABLE IF EXISTS {name}")
