"""Event records from exported event XML files, and from tables.

Exported files hold ``<Event>...</Event>`` records one after another, usually
inside ``<Events>`` with an XML declaration and line breaks in between.  A record
starts at a start tag ``<Event`` and ends with the next ``</Event>``, or before the
next start tag or at the file's end if that comes first: such a record is passed on
as it is, and the parser rejects it with reason ``xml`` while the records after it
still load.  Text outside records (declaration, ``<Events>``, blanks) is dropped.

:func:`scan_event_xml` reads files by byte ranges, through a Python data source
reader: a file is cut into ranges, small files share a task, and a task hands on
the records whose start tag begins in its ranges.  The last one is read beyond the
range's end, in blocks, up to its own end: no task looks at another one's records, and a
file that was cut inside its last record is told by the position of its end.  Memory is
bounded by a block and the longest record; a record of more than ``MAX_RECORD`` bytes is
handed on cut there, and so rejected.  Files are listed once, on the driver, without a job.
Compressed files are read from start to end by one task.

:class:`EventXmlStreamReader` is the same on a stream: its progress is the length of each
file.  A file that ends inside a record gives that record as it is (one ``xml`` reject);
when the file is longer at a later trigger, the task that goes on with it looks back for
the record's start, in blocks, and hands on the whole record and those after it.

Where only Spark can open a store, ``check_tails=False`` reads with its text reader and
``</Event>`` as the separator; that reader cannot tell whether a file's last piece was closed.

Spark's own XML reader is not used for this: one bad record makes it swallow the
rest of the file.
"""

from __future__ import annotations

import re
import uuid
from collections.abc import Callable, Iterable, Iterator

import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.datasource import DataSource, DataSourceReader, DataSourceStreamReader, InputPartition

from .ranges import check_readable, filesystem_of, list_files as _list_files, read_range as _read_range, shown

# The record separator and the start of a record.
RECORD_END = "</Event>"
RECORD_START = r"<Event[\s/>]"
# File name endings of compressed files, with the name under which pyarrow knows the codec.
CODECS = {"gz": "gzip", "bz2": "bz2", "lz4": "lz4", "zst": "zstd"}
OTHER_CODECS = ("deflate", "snappy", "xz")
MAX_RECORD = 128 << 20
BLOCK = 4 << 20
# What opening a file counts when small ones are put together, as in Spark's own file sources.
OPEN_COST = 4 << 20
RANGES_PER_CORE = 3
_MARKS = re.compile(rb"<(?:/Event>|Event[\s/>])")
_MARK_BYTES, _SLASH = 8, ord("/")
_BATCH_BYTES = 4 << 20
SCHEMA = "source_file string, offset long, xml string"

ReadRange = Callable[[str, int, int], bytes]
ListFiles = Callable[[list[str]], Iterable[tuple[str, int]]]


def split_records(text_df: DataFrame, value_col: str = "value") -> DataFrame:
    """Turn text pieces that end at ``</Event>`` into one row per record (``xml``)."""
    pieces = F.split(F.col(value_col), f"(?={RECORD_START})")
    cols = [c for c in text_df.columns if c != value_col]
    exploded = text_df.select(*cols, F.posexplode(pieces).alias("_pos", "_piece"), F.size(pieces).alias("_n"))
    closed = F.col("_pos") == F.col("_n") - 1
    is_record = F.col("_piece").rlike(f"^{RECORD_START}")
    xml = F.when(closed, F.concat(F.col("_piece"), F.lit(RECORD_END))).otherwise(F.col("_piece"))
    return exploded.where(is_record).select(*cols, xml.alias("xml"))


def records_of(blocks: Iterable[bytes], start: int, stop: int | None, limit: int) -> Iterator[tuple[int, bytes]]:
    """(position, bytes) of the records that begin at ``start`` <= position < ``stop`` in consecutive blocks from ``start``.

    Takes no more blocks than it needs: it ends once the last of these records has ended.
    """
    held, at = b"", start  # the bytes not yet settled, and their position
    opened = None  # where the open record begins in `held`
    cut = False  # the open record was handed on at its limit
    for block in blocks:
        seen = max(0, len(held) - _MARK_BYTES + 1)
        held += block
        if opened is not None:
            seen = max(seen, opened + 1)
        for m in _MARKS.finditer(held, seen):
            if opened is not None and not cut:
                end = m.start() if held[m.start() + 1] != _SLASH else m.end()
                yield at + opened, held[opened : min(end, opened + limit)]
            opened, cut = None, False
            if held[m.start() + 1] != _SLASH:  # a start tag
                if stop is not None and at + m.start() >= stop:
                    return
                opened = m.start()
        if opened is None:
            keep = max(0, len(held) - _MARK_BYTES + 1)
            if stop is not None and at + keep >= stop:
                return
        else:
            if not cut and len(held) - opened > limit:
                yield at + opened, held[opened : opened + limit]
                cut = True
            keep = opened if not cut else max(opened + 1, len(held) - _MARK_BYTES + 1)
        held, at = held[keep:], at + keep
        opened = None if opened is None else max(opened - keep, -1)
    if opened is not None and not cut:
        yield at + opened, held[opened : opened + limit]


def _blocks(read: ReadRange, path: str, start: int, length: int) -> Iterator[bytes]:
    """The bytes of a file from ``start`` to ``length``, small blocks first."""
    size = 64 << 10
    while start < length:
        block = read(path, start, min(size, length - start))
        if not block:
            return
        yield block
        start += len(block)
        size = min(2 * size, BLOCK)


def _range_blocks(read: ReadRange, path: str, start: int, stop: int, length: int) -> Iterator[bytes]:
    """The blocks of a range, and then, in small blocks at first, what follows it."""
    while start < stop:
        block = read(path, start, min(BLOCK, stop - start))
        if not block:
            return
        yield block
        start += len(block)
    yield from _blocks(read, path, start, length)


def open_start(read: ReadRange, path: str, before: int, length: int, limit: int) -> int:
    """Where the record begins that is open at position ``before`` of a file; ``before`` itself if none is.

    Looks back in growing blocks for the last mark that begins before it, ``limit`` bytes at most.
    """
    size, end = 64 << 10, min(before + _MARK_BYTES - 1, length)
    low = before
    while low > 0 and before - low < limit:
        low = max(0, low - size, before - limit)
        block = read(path, low, end - low)
        marks = [m for m in _MARKS.finditer(block) if low + m.start() < before]
        if marks:
            last = marks[-1]
            closed = block[last.start() + 1] == _SLASH and low + last.end() <= before
            if not closed and block[last.start() + 1] == _SLASH:  # an end tag that was cut: its record was open
                starts = [m for m in marks[:-1] if block[m.start() + 1] != _SLASH]
                ends = [m for m in marks[:-1] if block[m.start() + 1] == _SLASH]
                if starts and (not ends or ends[-1].start() < starts[-1].start()):
                    return low + starts[-1].start()
                if ends or low == 0:
                    return before
            else:
                return before if closed else low + last.start()
        size = min(8 * size, 32 << 20)
    return before


def _compressed(path: str) -> str | None:
    tail = path.rpartition(".")[2].lower()
    if tail in OTHER_CODECS:
        raise ValueError(f"{path}: this compression is read with check_tails=False only")
    return CODECS.get(tail)


def _whole(path: str, codec: str) -> Iterator[bytes]:
    store, inner = filesystem_of(path)
    with store.open_input_stream(inner, compression=codec, buffer_size=BLOCK) as f:
        while block := f.read(BLOCK):
            yield block


def _rows(found: Iterable[tuple[str, int, bytes]]) -> Iterator[pa.RecordBatch]:
    """Records as Arrow batches of bounded size; bytes that are no UTF-8 become replacement characters."""
    names, offsets, texts, size = [], [], [], 0

    def batch() -> pa.RecordBatch:
        raw = pa.array(texts, pa.binary())
        try:
            xml = raw.cast(pa.string())
        except pa.ArrowInvalid:
            xml = pa.array([t.decode("utf-8", "replace") for t in texts], pa.string())
        return pa.RecordBatch.from_arrays([pa.array(names, pa.string()), pa.array(offsets, pa.int64()), xml], names=["source_file", "offset", "xml"])

    for name, offset, text in found:
        names.append(name)
        offsets.append(offset)
        texts.append(text)
        size += len(text)
        if size >= _BATCH_BYTES or len(texts) >= 10_000:
            yield batch()
            names, offsets, texts, size = [], [], [], 0
    if texts:
        yield batch()


class Runs(InputPartition):
    """What one task reads: (path, start, stop, length) of each range; a stop of -1 stands for a whole compressed file."""

    def __init__(self, runs: list[tuple[str, int, int, int]]):
        super().__init__(runs)


def cut_runs(files: Iterable[tuple[str, int, int]], split_bytes: int) -> list[Runs]:
    """Ranges of at most ``split_bytes`` of (path, from, length), short ones together in a task."""
    out, held, size = [], [], 0
    for path, start, length in files:
        if start >= length:
            continue
        whole = _compressed(path) is not None
        for lo in [start] if whole else range(start, length, split_bytes):
            hi = length if whole else min(lo + split_bytes, length)
            if held and size + hi - lo > split_bytes:
                out.append(Runs(held))
                held, size = [], 0
            held.append((path, lo, -1 if whole else hi, length))
            size += hi - lo + min(OPEN_COST, split_bytes // 4)
    return out + ([Runs(held)] if held else [])


def even_split(size: int, split_bytes: int, cores: int) -> int:
    """The size of a range when ``size`` bytes are to be read: some ranges for each core, none beyond ``split_bytes``.

    0 cores: ranges of ``split_bytes``, as the caller asked for.
    """
    return min(split_bytes, max(OPEN_COST, -(-size // (RANGES_PER_CORE * cores)))) if cores else split_bytes


def read_runs(runs: Runs, read: ReadRange, limit: int) -> Iterator[pa.RecordBatch]:
    def found() -> Iterator[tuple[str, int, bytes]]:
        for path, start, stop, length in runs.value:
            if stop < 0:
                records = records_of(_whole(path, _compressed(path)), 0, None, limit)
            else:
                records = records_of(_range_blocks(read, path, start, stop, length), start, stop, limit)
            name = shown(path)
            for offset, text in records:
                yield name, offset, text

    return _rows(found())


class EventXmlReader(DataSourceReader):
    """The records of the files that are there when the query is planned."""

    def __init__(self, paths: list[str], split_bytes: int, limit: int, read: ReadRange, listed: ListFiles, cores: int = 0):
        self._paths, self._split, self._limit, self._read, self._listed = paths, split_bytes, limit, read, listed
        self._cores = cores

    def partitions(self) -> list[Runs]:
        # At least one, as Spark asks for.
        files = [(path, 0, length) for path, length in self._listed(self._paths)]
        split = even_split(sum(length for _, _, length in files), self._split, self._cores)
        return cut_runs(files, split) or [Runs([])]

    def read(self, partition: Runs) -> Iterator[pa.RecordBatch]:
        return read_runs(partition, self._read, self._limit)


class EventXmlStreamReader(DataSourceStreamReader):
    """Records as files are added or grow; the offset is the length of every file that is there.

    A file that became shorter is a new one and read from its start.  Compressed files have to be complete when they
    are added.  Files that were loaded may be moved away, which also keeps the offset short.
    """

    def __init__(self, paths: list[str], split_bytes: int, limit: int, read: ReadRange, listed: ListFiles, cores: int = 0):
        self._paths, self._split, self._limit, self._read, self._listed = paths, split_bytes, limit, read, listed
        self._cores = cores

    def initialOffset(self) -> dict:
        return {}

    def latestOffset(self) -> dict:
        return dict(self._listed(self._paths))

    def partitions(self, start: dict, end: dict) -> list[Runs]:
        grown = [(path, start.get(path, 0), length) for path, length in sorted(end.items()) if length != start.get(path, 0)]
        # Marked by a negative start: the task looks back for a record that was open where the file ended.
        files = [(path, seen if 0 < seen < length and not _compressed(path) else 0, length) for path, seen, length in grown]
        out = cut_runs(files, even_split(sum(length - seen for _, seen, length in files), self._split, self._cores))
        went_on = {path: seen for path, seen, _ in files if seen}
        return [Runs([(p, -lo if went_on.get(p) == lo else lo, hi, n) for p, lo, hi, n in runs.value]) for runs in out]

    def read(self, partition: Runs) -> Iterator[pa.RecordBatch]:
        runs = []
        for path, start, stop, length in partition.value:
            start = open_start(self._read, path, -start, length, self._limit) if start < 0 else start
            runs.append((path, start, stop, length))
        return read_runs(Runs(runs), self._read, self._limit)


def record_source(paths: list[str], split_bytes: int, limit: int, read_range: ReadRange | None, listed: ListFiles | None, cores: int = 0) -> type[DataSource]:
    """A data source class of these files, under a name of its own."""
    if read_range is None or listed is None:
        check_readable(paths)
    how = (paths, split_bytes, limit, read_range or _read_range, listed or _list_files, cores)
    source = f"eventloom_xml_{uuid.uuid4().hex[:12]}"

    class EventXmlSource(DataSource):
        @classmethod
        def name(cls):
            return source

        def schema(self):
            return SCHEMA

        def reader(self, schema):
            return EventXmlReader(*how)

        def streamReader(self, schema):
            return EventXmlStreamReader(*how)

    return EventXmlSource


def split_size(spark: SparkSession) -> int:
    """The session's size of a file split, in bytes."""
    text = spark.conf.get("spark.sql.files.maxPartitionBytes")
    number, unit = re.fullmatch(r"(\d+)\s*([kmgt]?)b?", text.strip().lower()).groups()
    return int(number) << {"": 0, "k": 10, "m": 20, "g": 30, "t": 40}[unit]


def scan_event_xml(
    spark: SparkSession,
    path: str | list[str],
    check_tails: bool = True,
    read_range: ReadRange | None = None,
    files: ListFiles | None = None,
    split_bytes: int | None = None,
    max_record: int = MAX_RECORD,
    offsets: bool = False,
) -> DataFrame:
    """``source_file, xml``: one row per event record in exported XML files (glob allowed); with ``offsets``, its ``offset`` too.

    Stores that pyarrow does not know need ``read_range(path, start, size)`` and ``files(paths)``, which gives
    (path, length) of each file; or ``check_tails=False``, for which Spark's text reader is used (module doc).
    """
    paths = [path] if isinstance(path, str) else list(path)
    if not check_tails:
        raw = spark.read.option("lineSep", RECORD_END).text(paths)
        return split_records(raw.select(F.col("_metadata.file_path").alias("source_file"), F.col("value")))
    cores = 0 if split_bytes else spark.sparkContext.defaultParallelism
    source = record_source(paths, split_bytes or split_size(spark), max_record, read_range, files, cores)
    spark.dataSource.register(source)
    return spark.read.format(source.name()).load().select("source_file", *["offset"] * offsets, "xml")


def stream_event_xml(
    spark: SparkSession,
    path: str | list[str],
    max_files_per_trigger: int | None = None,
    read_range: ReadRange | None = None,
    files: ListFiles | None = None,
    split_bytes: int | None = None,
    max_record: int = MAX_RECORD,
) -> DataFrame:
    """Streaming ``source_file, xml``: records of exported event XML files that are added to ``path`` or grow there.

    A trigger takes all that is new.  With ``max_files_per_trigger`` Spark's text reader is used instead: it takes
    every file once, when it is first seen, and cannot tell whether its last piece was closed.
    """
    paths = [path] if isinstance(path, str) else list(path)
    if max_files_per_trigger:
        reader = spark.readStream.option("lineSep", RECORD_END).option("maxFilesPerTrigger", str(max_files_per_trigger))
        return split_records(reader.text(path).select(F.col("_metadata.file_path").alias("source_file"), F.col("value")))
    cores = 0 if split_bytes else spark.sparkContext.defaultParallelism
    source = record_source(paths, split_bytes or split_size(spark), max_record, read_range, files, cores)
    spark.dataSource.register(source)
    return spark.readStream.format(source.name()).load().select("source_file", "xml")


def events_from_table(df: DataFrame, xml_col: str = "xml") -> DataFrame:
    """Tables that already hold one record per row pass through under the name ``xml``."""
    return df if xml_col == "xml" else df.withColumnRenamed(xml_col, "xml")
